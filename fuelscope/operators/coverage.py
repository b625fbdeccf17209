"""Expected collection slots against the slots that were filled."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schema import DAILY_AVG, RBOB, RETAIL, RUNS, STOCKS, WTI

# Collection slots in UTC, as minutes of the day per ISO weekday
# (0 = Monday). Every source lists (weekdays, minutes).
EVERY_DAY = list(range(7))
FUTURES_SLOTS = [
    ([6], [23 * 60]),
    ([0], [h * 60 for h in range(0, 4)]),
    ([0, 1, 2, 3, 4], [h * 60 for h in range(11, 24)]),
    ([4], [0]),
]
RELEASE_SLOTS = [(EVERY_DAY, [16 * 60, 17 * 60, 18 * 60, 22 * 60])]
SLOTS = {
    RETAIL: [(EVERY_DAY, list(range(0, 1440, 10)))],
    DAILY_AVG: [(EVERY_DAY, [7 * 60 + 30])],
    RBOB: FUTURES_SLOTS,
    WTI: FUTURES_SLOTS,
    STOCKS: RELEASE_SLOTS,
    RUNS: RELEASE_SLOTS,
}
WIDTH_MINUTES = {RETAIL: 10, DAILY_AVG: 60, RBOB: 60, WTI: 60, STOCKS: 60, RUNS: 60}


def slot_table(spark: SparkSession, slots: dict = SLOTS, widths: dict = WIDTH_MINUTES) -> DataFrame:
    """The week's slots: a few hundred rows, whatever the data."""
    rows = [
        (source, day, minute, widths[source])
        for source, rules in slots.items()
        for days, minutes in rules
        for day in days
        for minute in minutes
    ]
    return spark.createDataFrame(rows, "source string, weekday int, minute int, width int").distinct()


def coverage(df: DataFrame, start: datetime, end: datetime, slots: DataFrame) -> DataFrame:
    """Per source and day in [start, end]: expected, filled and missing slots. A
    slot is filled by any observation within its width."""
    spark = df.sparkSession
    days = spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(str(start))), F.to_date(F.lit(str(end))))).alias("date")
    )
    wanted = days.join(F.broadcast(slots), F.weekday("date") == F.col("weekday"))
    of_day = F.hour("scraped_at") * 60 + F.minute("scraped_at")
    # Observations shrink to distinct minutes of the day before the slot match.
    seen = (
        df.filter(
            (F.col("scraped_at") >= F.lit(str(start)).cast("timestamp_ntz"))
            & (F.col("scraped_at") < F.date_add(F.to_date(F.lit(str(end))), 1).cast("timestamp_ntz"))
        )
        .select(
            "source",
            F.to_date("scraped_at").alias("date"),
            F.weekday("scraped_at").alias("weekday"),
            of_day.alias("at"),
        )
        .distinct()
    )
    hits = (
        seen.join(F.broadcast(slots), ["source", "weekday"])
        .filter((F.col("at") >= F.col("minute")) & (F.col("at") < F.col("minute") + F.col("width")))
        .select("source", "date", "minute", F.lit(1).alias("hit"))
        .distinct()
    )
    table = wanted.join(hits, ["source", "date", "minute"], "left")
    out = table.groupBy("source", "date").agg(
        F.count(F.lit(1)).alias("expected"), F.count("hit").alias("filled")
    )
    return out.withColumn("missing", F.col("expected") - F.col("filled")).withColumn(
        "ratio", F.col("filled") / F.col("expected")
    )
