"""Crawled pages: ``page_id, url, html``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schema import DAILY_AVG, RBOB, RETAIL, RUNS, STOCKS, WTI

# What the address of a page tells about its source.
URL_RULES = [
    ("fuelinsights.gasbuddy.com", RETAIL),
    ("gasprices.aaa.com", DAILY_AVG),
    ("marketwatch.com/investing/future/rb.1", RBOB),
    ("marketwatch.com/investing/future/cl.1", WTI),
    ("tradingeconomics.com/united-states/gasoline-stocks-change", STOCKS),
    ("tradingeconomics.com/united-states/refinery-crude-runs", RUNS),
]


def source_of(url: Column, rules: list[tuple[str, str]] = URL_RULES) -> Column:
    """First rule whose text the address contains."""
    return F.coalesce(*[F.when(url.contains(text), F.lit(source)) for text, source in rules])


def read_pages(spark: SparkSession, path: str, rules: list[tuple[str, str]] = URL_RULES) -> DataFrame:
    """Pages with a known source; only the three columns are read."""
    pages = spark.read.parquet(path).select("page_id", "url", "html")
    return pages.withColumn("source", source_of(F.col("url"), rules)).filter("source is not null")
