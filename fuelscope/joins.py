"""Joins on keys that may be NULL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def join_same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal ``keys``, NULL being equal to NULL; the keys stand once."""
    other = {k: f"_same_{k}" for k in keys}
    both = [F.col(k).eqNullSafe(F.col(o)) for k, o in other.items()]
    out = left.join(right.withColumnsRenamed(other), reduce(lambda a, b: a & b, both), how)
    return out if how in ("left_semi", "left_anti") else out.drop(*other.values())
