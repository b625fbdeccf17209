"""The daily panel and the model features, one row per region and calendar day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.arith import GALLONS_PER_BARREL
from ..functions.clock import label_date, ny_date
from ..operators.daily import densify
from ..operators.series import (
    clipped_slope,
    fill_both,
    forward_fill,
    model_smooths,
    pulse,
    robust_smooths,
    shift,
)
from ..schema import DAILY_AVG, RBOB, RETAIL, RUNS, STOCKS, WTI

DAILY = {RETAIL: "gb", DAILY_AVG: "aaa", RBOB: "rbob", WTI: "wti"}
WEEKLY = {STOCKS: "stocks_surprise", RUNS: "refinery_runs"}


def daily_series(df: DataFrame, keys: list[str] = ["region"], tie: str = "seq", zone: str = "UTC") -> DataFrame:
    """Long daily values: mean per day of the four price series (the daily average
    on the day before it is read), first reported value of the weekly ones on the
    date of their label."""
    day = ny_date(F.col("scraped_at"))
    prices = df.filter(F.col("source").isin(*DAILY) & F.col("scraped_at").isNotNull())
    of_day = F.when(F.col("source") == DAILY_AVG, F.date_sub(day, 1)).otherwise(day)
    means = prices.groupBy(*keys, "source", of_day.alias("date")).agg(F.avg("price").alias("value"))
    value = F.when(F.col("source") == STOCKS, F.col("surprise")).otherwise(F.col("price"))
    weekly = df.filter(F.col("source").isin(*WEEKLY) & F.col("scraped_at").isNotNull()).select(
        *keys,
        "source",
        F.coalesce(label_date(F.col("label_ts"), zone), day).alias("date"),
        value.alias("value"),
        "scraped_at",
        tie,
    )
    firsts = (
        weekly.filter("value is not null and date is not null")
        .groupBy(*keys, "source", "date")
        .agg(F.min_by("value", F.struct("scraped_at", tie)).alias("value"))
    )
    return means.unionByName(firsts)


def daily_panel(
    df: DataFrame,
    keys: list[str] = ["region"],
    tie: str = "seq",
    zone: str = "UTC",
    keep_releases: bool = False,
) -> DataFrame:
    long = daily_series(df, keys, tie, zone)
    columns = {**DAILY, **WEEKLY}
    wide = long.groupBy(*keys, "date").agg(
        *[F.max(F.when(F.col("source") == s, F.col("value"))).alias(c) for s, c in columns.items()],
        F.max(F.col("source").isin(*DAILY)).alias("_priced"),
    )
    # The spine runs from the first to the last day of the price series.
    whole = W.partitionBy(*keys)
    priced = F.when(F.col("_priced"), F.col("date"))
    wide = wide.withColumns({"_a": F.min(priced).over(whole), "_b": F.max(priced).over(whole)})
    base = densify(wide.filter("date between _a and _b").drop("_priced", "_a", "_b"), keys)
    base = base.withColumn("gas_price", F.coalesce("aaa", "gb")).withColumn(
        "GB_gap", F.coalesce(F.col("gb") - F.col("aaa"), F.lit(0.0))
    )
    if keep_releases:
        base = base.withColumns({"stocks_release": F.col("stocks_surprise"), "runs_release": F.col("refinery_runs")})
    base = fill_both(base, keys, "gas_price", "rbob", "wti")
    base = model_smooths(base, keys, {"rbob": "rbob_sm", "wti": "wti_sm"})
    base = forward_fill(base, keys, "stocks_surprise", "refinery_runs")
    extra = ["stocks_release", "runs_release"] if keep_releases else []
    return base.select(
        *keys, "date", "aaa", "gb", "rbob", "wti", "stocks_surprise", "refinery_runs",
        "gas_price", "GB_gap", "rbob_sm", "wti_sm", *extra,
    )


def features(panel: DataFrame, keys: list[str] = ["region"], lag: int = 7, pulse_on: str = "filled") -> DataFrame:
    """Model columns beside the panel. ``pulse_on='release'`` needs a panel made
    with ``keep_releases``; the default builds pulses on the filled series."""
    base = panel.withColumn("Y", F.coalesce("aaa", "gas_price"))
    base = robust_smooths(base.drop("wti_sm"), keys, {"rbob": "rb_sm", "wti": "wti_sm"})
    base = clipped_slope(base, keys, "Y", "AAA_slope7")
    barrel = F.col("rb_sm") * GALLONS_PER_BARREL
    stocks, runs = (
        ("stocks_surprise", "refinery_runs") if pulse_on == "filled" else ("stocks_release", "runs_release")
    )
    base = base.withColumns(
        {
            "AAA_l1": shift(F.col("Y"), keys, 1),
            "rb42_l7": shift(barrel, keys, lag),
            "wti_l7": shift(F.col("wti_sm"), keys, lag),
            "crack_l7": shift(barrel - F.col("wti_sm"), keys, lag),
            "stocks_pulse": pulse(F.col(stocks), keys),
            "refinery_pulse": pulse(F.col(runs), keys),
        }
    )
    return base.withColumn("d_crack7", F.col("crack_l7") - shift(F.col("crack_l7"), keys, 7))


NEEDED = ["Y", "AAA_l1", "AAA_slope7", "rb42_l7", "wti_l7"]
DESIGN = [
    "one", "AAA_l1", "AAA_slope7", "rb42_l7", "wti_l7", "crack_l7", "d_crack7", "GB_gap",
    "stocks_pulse", "refinery_pulse",
]
BASE_SIZE = 8


def training_rows(feats: DataFrame, keys: list[str] = ["region"], lookback: int = 180) -> DataFrame:
    """Rows of the last ``lookback`` days that have all needed columns; missing
    crack features count as zero."""
    since = F.date_sub(F.max("date").over(W.partitionBy(*keys)), lookback)
    rows = feats.withColumn("_from", since).filter(F.col("date") >= F.col("_from")).drop("_from")
    return (
        rows.dropna(subset=NEEDED)
        .fillna(0.0, subset=["crack_l7", "d_crack7"])
        .withColumn("one", F.lit(1.0))
    )
