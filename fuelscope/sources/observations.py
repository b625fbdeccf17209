"""Readers of the observation table."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..schema import BASE_COLUMNS, OBSERVATION, OPTIONAL_COLUMNS

CSV_NAMES = {"timestamp": "label_ts"}
CSV_COLUMNS = ["source", "fuel_type", "price", "timestamp", "region", "consensus", "surprise", "scraped_at", "as_of_date"]


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All nine columns as text, absent ones NULL, in fixed order, with ``seq``:
    the place of the row in its file."""
    raw = spark.read.option("header", True).option("escape", '"').option("multiLine", False).csv(path)
    order = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    have = set(raw.columns)
    columns = [
        (F.col(c).cast("string") if c in have else F.lit(None).cast("string")).alias(CSV_NAMES.get(c, c))
        for c in CSV_COLUMNS
    ]
    return raw.select(*columns, order.alias("seq"))


def recent(df: DataFrame, now: Column, days: int = 90) -> DataFrame:
    """Rows from ``days`` before the day of ``now`` on. The bound is a literal, so
    it reaches the scan."""
    start = F.date_sub(F.to_date(now), days).cast("timestamp_ntz")
    return df.filter(F.col("scraped_at") >= start)


def project_existing(df: DataFrame) -> DataFrame:
    """Base columns, and the optional ones the table has."""
    have = set(df.columns)
    return df.select(*[c for c in BASE_COLUMNS + OPTIONAL_COLUMNS if c in have])


def time_slices(column: str, start: datetime, end: datetime, step: timedelta) -> list[str]:
    """Predicates of a parallel database read: one slice of time per task, plus the
    rows outside the range and those without a time, so none is lost."""
    text, at = [f"{column} < '{start}'", f"{column} >= '{end}'", f"{column} is null"], start
    while at < end:
        until = min(at + step, end)
        text.append(f"{column} >= '{at}' and {column} < '{until}'")
        at = until
    return text


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    start: datetime,
    end: datetime,
    step: timedelta = timedelta(days=1),
) -> DataFrame:
    """The table from a database the caller names; connection options come from the
    caller only."""
    return spark.read.jdbc(
        url, table, predicates=time_slices("scraped_at", start, end, step), properties=properties
    )


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """Stored parquet. The schema is given, so no footers are read for it, and
    columns that older files lack come out as NULL."""
    return spark.read.schema(OBSERVATION).parquet(path).select(*OBSERVATION.fieldNames())


def describe_schema(df: DataFrame) -> DataFrame:
    """Name, type and nullability of the columns in order, with their numbers of rows and
    of values, counted in one pass over all columns."""
    fields = df.schema.fields
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{f.name}`")).alias(f"_{i}") for i, f in enumerate(fields)])
    described = [
        F.struct(
            F.lit(i + 1).alias("ordinal"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit("YES" if f.nullable else "NO").alias("is_nullable"),
            F.col("_rows").alias("n_rows"),
            F.col(f"_{i}").alias("n_values"),
        )
        for i, f in enumerate(fields)
    ]
    return counts.select(F.inline(F.array(*described)))


def contract_violations(df: DataFrame, schema: T.StructType = OBSERVATION) -> DataFrame:
    """One row per broken rule: column absent, other type, NULL where none may be."""
    have = {f.name: f.dataType for f in df.schema.fields}
    found = []
    for f in schema:
        if f.name not in have:
            found.append((f.name, "missing", 1))
        elif have[f.name] != f.dataType:
            found.append((f.name, f"type {have[f.name].simpleString()}", 1))
    spark = df.sparkSession
    static = spark.createDataFrame(found, "column_name string, problem string, n long")
    must = [f.name for f in schema if not f.nullable and f.name in have]
    if not must:
        return static
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in must])
    parts = ", ".join(f"'{c}', 'null', `{c}`" for c in must)
    nulls = counts.select(F.expr(f"stack({len(must)}, {parts}) as (column_name, problem, n)"))
    return static.unionByName(nulls.filter("n > 0"))


def table_ready(spark: SparkSession, name: str) -> bool:
    """The catalog answers and knows the table."""
    return spark.catalog.tableExists(name)
