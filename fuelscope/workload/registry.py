"""Name -> Spark callable, name -> SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir.rstrip("/"))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return add


# Added before rounding where exact halves are common (means of halves), so that
# both engines round them the same way.
NUDGE = 1e-9


def rounded(df: DataFrame, digits: int = 6, *names: str, nudge: float = 0.0) -> DataFrame:
    """Doubles rounded for comparison; all of them when none is named."""
    chosen = names or [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(F.col(c) + nudge if nudge else F.col(c), digits) for c in chosen})


def bigint(column: Column) -> Column:
    return column.cast("bigint")
