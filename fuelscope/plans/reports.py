"""Tables behind the charts and cards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.arith import crack_spread
from ..functions.clock import as_of_by_lag, from_new_york, month_start, ny_date, zone_text
from ..functions.text import money, plain
from ..joins import join_same
from ..operators.daily import last_n, resample_daily
from ..operators.lookup import latest_set, latest_with_fallback
from ..schema import DAILY_AVG, RBOB, RETAIL, RUNS, STOCKS, WTI

# Rows of the status table as (place, text, source, money).
STATUS_ROWS = [
    (1, "GasBuddy", RETAIL, True),
    (2, "AAA", DAILY_AVG, True),
    (3, "RBOB Future", RBOB, True),
    (4, "WTI", WTI, True),
    (5, "Gasoline Stocks Change Surprise", STOCKS, False),
    (6, "Refinery Runs", RUNS, False),
]


def futures_outer(df: DataFrame, keys: list[str]) -> DataFrame:
    """Daily means of both futures on all days of either."""
    rbob = resample_daily(df.filter(F.col("source") == RBOB), keys, out="RBOB")
    wti = resample_daily(df.filter(F.col("source") == WTI), keys, out="WTI")
    return rbob.join(wti, [*keys, "date"], "full_outer")


def crack_series(df: DataFrame, keys: list[str]) -> DataFrame:
    """Spread on the days that have both futures. Dropping incomplete days after the
    outer join is an inner join of the daily means, made in one aggregate."""
    futures = df.filter(F.col("source").isin(RBOB, WTI))
    days = futures.groupBy(*keys, ny_date(F.col("scraped_at")).alias("date")).agg(
        F.avg(F.when(F.col("source") == RBOB, F.col("price"))).alias("RBOB"),
        F.avg(F.when(F.col("source") == WTI, F.col("price"))).alias("WTI"),
    )
    return days.dropna(subset=["date", "RBOB", "WTI"]).withColumn(
        "Crack_Spread", crack_spread(F.col("RBOB"), F.col("WTI"))
    )


def spread_as_observations(spread: DataFrame) -> DataFrame:
    """Spread days as observations at New York midnight."""
    midnight = from_new_york(F.col("date").cast("timestamp_ntz"))
    return spread.withColumn("scraped_at", midnight).withColumn("price", F.col("Crack_Spread"))


def status_table(spark: SparkSession, df: DataFrame, history: DataFrame) -> DataFrame:
    """Six labelled rows with the last value and its New York time."""
    fields = ["price", "surprise", "scraped_at"]
    found = latest_with_fallback(latest_set(df), history, ["source"], fields)
    labels = spark.createDataFrame(STATUS_ROWS, "place int, description string, source string, money boolean")
    rows = found.filter(F.col("source").isin(*[r[2] for r in STATUS_ROWS]))
    out = rows.join(F.broadcast(labels), "source", "right")
    value = F.when(F.col("source") == STOCKS, F.coalesce("surprise", "price")).otherwise(F.col("price"))
    text = F.when(F.col("money"), money(value, 3, "—")).otherwise(plain(value))
    return out.select(
        "place", "description", text.alias("last_value"), zone_text(F.col("scraped_at")).alias("at")
    )


def retail_month(df: DataFrame, today: Column) -> DataFrame:
    """Retail rows of New York days from the first of the month to ``today``."""
    day = ny_date(F.col("scraped_at"))
    return df.filter((F.col("source") == RETAIL) & (day >= month_start(today)) & (day <= today))


def average_30_days(df: DataFrame, now: Column) -> DataFrame:
    """Daily-average rows whose as-of date lies in the last 30 days."""
    day, end = as_of_by_lag(F.col("scraped_at")), ny_date(now)
    kept = df.filter((F.col("source") == DAILY_AVG) & (day >= F.date_sub(end, 30)) & (day <= end))
    return kept.withColumn("as_of_date", day)


def future_30_days(df: DataFrame, source: str, now: Column, keys: list[str]) -> DataFrame:
    """Daily means since this time of day 30 days ago; the first day is partial."""
    start = now - F.expr("interval 30 days")
    return resample_daily(df.filter((F.col("source") == source) & (F.col("scraped_at") >= start)), keys)


def last_14(panel: DataFrame, keys: list[str]) -> DataFrame:
    return last_n(panel.select(*keys, "date", "aaa"), keys, 14, "aaa")


def kpis(df: DataFrame, points: DataFrame, probability: DataFrame, keys: list[str]) -> DataFrame:
    """Row count, latest retail price, predicted Sunday and its chance, per key."""
    retail = F.col("source") == RETAIL
    counts = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("records"),
        F.max_by("price", F.when(retail, F.struct("scraped_at", "seq"))).alias("retail"),
    )
    return (
        join_same(
            join_same(counts, points.select(*keys, "next_sunday_point"), keys, "left"),
            probability.select(*keys, "probability"),
            keys,
            "left",
        )
        .select(*keys, "records", "retail", "next_sunday_point", "probability")
    )
