"""Writers: append, replace, exports, backups and reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..schema import ADDED_LATER, BASE_COLUMNS, OBSERVATION, STOCKS, conform
from .observations import project_existing

# Written text keeps the microseconds that the stored times have.
CSV = {"header": "true", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def append(df: DataFrame, path: str, now: Column) -> bool:
    """Append a batch under one ingest time, laid out by source and day; an empty
    batch writes nothing."""
    if df.isEmpty():
        return False
    fields = [c for c in df.columns if c in OBSERVATION.fieldNames() and c != "scraped_at"]
    batch = conform(df.select(*fields).withColumn("scraped_at", now))
    _layout(batch).write.mode("append").partitionBy("source", "day").parquet(path)
    return True


def replace(df: DataFrame, path: str) -> None:
    """Drop and reload the whole table."""
    _layout(conform(_blank_to_null(df))).write.mode("overwrite").partitionBy("source", "day").parquet(path)


def _layout(df: DataFrame) -> DataFrame:
    """Rows of one source and day together, so a folder gets few files; a heavy day
    is split again and light ones share a task when the sizes are known."""
    return df.withColumn("day", F.to_date("scraped_at")).hint("rebalance", "source", "day")


def _blank_to_null(df: DataFrame) -> DataFrame:
    text = [c for c, t in df.dtypes if t == "string"]
    return df.withColumns({c: F.when(F.col(c) != "", F.col(c)) for c in text})


def evolve(df: DataFrame) -> DataFrame:
    """Add the later columns where the table lacks them."""
    missing = {c: t for c, t in ADDED_LATER.items() if c not in df.columns}
    return df.withColumns({c: F.lit(None).cast(t) for c, t in missing.items()})


def export_csv(df: DataFrame, path: str) -> None:
    """Everything, newest first across the numbered part files."""
    ordered = project_existing(df).orderBy(F.desc("scraped_at"))
    ordered.write.mode("overwrite").options(**CSV).csv(path)


def backup_slices(df: DataFrame, today: Column | date) -> DataFrame:
    """Rows with the name of each slice they belong to: today, yesterday, month."""
    today = today if isinstance(today, Column) else F.lit(today)
    day = F.to_date("scraped_at")
    names = F.array_compact(
        F.array(
            F.when(day == today, F.lit("today")),
            F.when(day == F.date_sub(today, 1), F.lit("yesterday")),
            F.when(day >= F.trunc(today, "month"), F.lit("month")),
        )
    )
    since = F.least(F.date_sub(today, 1), F.to_date(F.trunc(today, "month")))
    return df.filter(F.col("scraped_at") >= since.cast("timestamp_ntz")).select(
        "*", F.explode(names).alias("slice")
    )


def write_backup(df: DataFrame, path: str, today: date) -> None:
    """One folder per slice that has rows."""
    slices = backup_slices(df, today)
    slices.orderBy("slice", F.desc("scraped_at")).write.mode("overwrite").options(**CSV).partitionBy(
        "slice"
    ).csv(path)


def report_rows(df: DataFrame, first: Column, last: Column | None = None) -> DataFrame:
    """Report columns of the days from ``first`` (to ``last``); only weekly stocks
    carry expectation and surprise."""
    day = F.to_date("scraped_at")
    kept = df.filter(F.col("scraped_at") >= first.cast("timestamp_ntz"))
    if last is not None:
        kept = kept.filter(F.col("scraped_at") < F.date_add(last, 1).cast("timestamp_ntz"))
    stocks = F.col("source") == STOCKS
    return kept.filter(day.isNotNull()).select(
        *BASE_COLUMNS,
        F.when(stocks, F.col("consensus")).alias("consensus"),
        F.when(stocks, F.col("surprise")).alias("surprise"),
    )


def daily_report(df: DataFrame, today: Column) -> DataFrame:
    return report_rows(df, today, today)


def monthly_report(df: DataFrame, today: Column) -> DataFrame:
    """From the first of the month on, without an upper bound."""
    return report_rows(df, F.trunc(today, "month"))


def write_report(rows: DataFrame, path: str) -> None:
    """One section (folder) per source, newest first."""
    rows.orderBy("source", F.desc("scraped_at")).write.mode("overwrite").options(**CSV).partitionBy(
        "source"
    ).csv(path)


def append_collected(tagged: DataFrame, path: str) -> None:
    """Accepted and refused records in one write, in folders of their own and in the
    stored types; the table of observations is ``accepted=true``."""
    _layout(stored_types(tagged)).write.mode("append").partitionBy("accepted", "source", "day").parquet(path)


def read_collected(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All records written; ``schema`` is that of the tagged frame in stored types."""
    return spark.read.schema(schema).option("basePath", path).parquet(path).select(*schema.names)


def stored_types(df: DataFrame) -> DataFrame:
    """Columns of the stored table in its types; others stay as they are."""
    return df.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in OBSERVATION if f.name in df.columns})
