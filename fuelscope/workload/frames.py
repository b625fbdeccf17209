"""The given tables seen as observations, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.clock import ntz, to_new_york
from ..schema import DAILY_AVG, FUEL_TYPE, RBOB, RETAIL, RUNS, STOCKS, WTI

NOW = "2024-01-30 18:00:00"


def now():
    return ntz(NOW)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source_of_event():
    kind = F.col("event_type")
    k = F.regexp_extract("props", "(-?[0-9]+)", 1).cast("double")
    return (
        F.when(kind == "view", RETAIL)
        .when(kind == "click", DAILY_AVG)
        .when(kind == "purchase", RBOB)
        .when(kind == "signup", WTI)
        .when(k < 50, STOCKS)
        .otherwise(RUNS)
    )


def as_observations(events: DataFrame) -> DataFrame:
    k = F.regexp_extract("props", "(-?[0-9]+)", 1).cast("double")
    kind = F.col("event_type")
    source = source_of_event()
    wall = to_new_york(F.col("ts"))
    label = (
        F.when(kind == "view", F.date_format(wall, "M/d/yyyy h:mm:ss a"))
        .when(kind == "click", F.concat(F.lit("Current as of "), F.date_format(wall, "yyyy-MM-dd")))
        .when(kind.isin("purchase", "signup"), F.concat(F.date_format(wall, "yyyy-MM-dd HH:mm:ss"), F.lit(" ET")))
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
    )
    base = events.select(
        F.col("event_id").alias("seq"),
        F.col("user_id").cast("string").alias("region"),
        source.alias("source"),
        F.col("value").alias("price"),
        label.alias("label_ts"),
        k.alias("consensus"),
        (F.col("value") - k).alias("surprise"),
        F.col("ts").alias("scraped_at"),
    )
    fuel = F.coalesce(*[F.when(F.col("source") == s, F.lit(f)) for s, f in FUEL_TYPE.items()])
    return base.withColumn("fuel_type", fuel)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_observations(table(spark, sf_dir, "events"))


def order_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a longer history: priority is the source, status the region."""
    kind = F.substring("o_orderpriority", 1, 1)
    price = F.col("o_totalprice") / 100000.0
    source = (
        F.when(kind == "1", RETAIL)
        .when(kind == "2", DAILY_AVG)
        .when(kind == "3", RBOB)
        .when(kind == "4", WTI)
        .when(price < 2.5, STOCKS)
        .otherwise(RUNS)
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderstatus").alias("region"),
        source.alias("source"),
        price.alias("price"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("label_ts"),
        F.lit(2.0).alias("consensus"),
        (price - 2.0).alias("surprise"),
        F.col("o_orderdate").alias("scraped_at"),
    )


def ny(x: str) -> str:
    return f"((({x}) AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York')"


def utc(x: str) -> str:
    return f"((({x}) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC')"


OBS = f"""obs AS (
  SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS region,
    CASE WHEN event_type = 'view' THEN '{RETAIL}' WHEN event_type = 'click' THEN '{DAILY_AVG}'
         WHEN event_type = 'purchase' THEN '{RBOB}' WHEN event_type = 'signup' THEN '{WTI}'
         WHEN k < 50 THEN '{STOCKS}' ELSE '{RUNS}' END AS source,
    CASE WHEN event_type = 'view' THEN 'regular_gas' WHEN event_type = 'click' THEN 'regular'
         WHEN event_type = 'purchase' THEN 'rbob_futures' WHEN event_type = 'signup' THEN 'wti_futures'
         WHEN k < 50 THEN 'gasoline_stocks_change' ELSE 'refinery_crude_runs' END AS fuel_type,
    value AS price,
    CASE WHEN event_type = 'view' THEN strftime(w, '%-m/%-d/%Y %-I:%M:%S %p')
         WHEN event_type = 'click' THEN 'Current as of ' || strftime(w, '%Y-%m-%d')
         WHEN event_type IN ('purchase', 'signup') THEN strftime(w, '%Y-%m-%d %H:%M:%S') || ' ET'
         ELSE strftime(ts, '%Y-%m-%d') END AS label_ts,
    k AS consensus, value - k AS surprise, ts AS scraped_at, w AS wall, CAST(w AS DATE) AS day
  FROM (SELECT *, CAST(regexp_extract(props, '-?[0-9]+') AS DOUBLE) AS k, {ny('ts')} AS w FROM events))"""

ORD = f"""ord AS (
  SELECT o_orderkey AS seq, o_orderstatus AS region,
    CASE WHEN left(o_orderpriority, 1) = '1' THEN '{RETAIL}' WHEN left(o_orderpriority, 1) = '2' THEN '{DAILY_AVG}'
         WHEN left(o_orderpriority, 1) = '3' THEN '{RBOB}' WHEN left(o_orderpriority, 1) = '4' THEN '{WTI}'
         WHEN o_totalprice / 100000.0 < 2.5 THEN '{STOCKS}' ELSE '{RUNS}' END AS source,
    o_totalprice / 100000.0 AS price, o_totalprice / 100000.0 - 2.0 AS surprise,
    strftime(o_orderdate, '%Y-%m-%d') AS label_ts, o_orderdate AS scraped_at,
    CAST({ny('o_orderdate')} AS DATE) AS day
  FROM orders)"""
