"""Clean-up of an imported file: numbers, times, names, copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..functions.clock import as_of_from_label, event_time
from ..functions.text import is_blank_name, normal_fuel_type, number
from ..operators.lookup import keep_first
from ..schema import COLUMNS, KEY


def clean_import(
    raw: DataFrame, now: Column, on_bad_time: str = "now"
) -> tuple[DataFrame, dict[str, Observation]]:
    """Clean rows, and row counts that fill when the rows are written: ``read``,
    ``named`` (source and fuel type present) and ``kept`` (first of each key)."""
    counts = {name: Observation(name) for name in ("read", "named", "kept")}
    tally = F.count(F.lit(1)).alias("rows")
    when = event_time(F.col("source"), F.col("label_ts"), F.col("scraped_at"))
    rows = raw.observe(counts["read"], tally).select(
        F.col("source"),
        normal_fuel_type(F.col("source"), F.col("fuel_type")).alias("fuel_type"),
        number(F.col("price")).alias("price"),
        "label_ts",
        "region",
        number(F.col("consensus")).alias("consensus"),
        number(F.col("surprise")).alias("surprise"),
        (F.coalesce(when, now) if on_bad_time == "now" else when).alias("scraped_at"),
        as_of_from_label(F.col("source"), F.col("label_ts")).alias("as_of_date"),
        "seq",
        when.isNull().alias("_unread"),
    )
    rows = rows.filter(~is_blank_name(F.col("source")) & ~is_blank_name(F.col("fuel_type")))
    if on_bad_time != "now":
        rows = rows.filter(F.col("scraped_at").isNotNull())
    rows = rows.observe(counts["named"], tally)
    # Rows whose time could not be read share one clock time; they are no copies for it.
    kept = keep_first(rows.filter("not _unread"), KEY, "seq").unionByName(rows.filter("_unread"))
    return kept.observe(counts["kept"], tally).select(*COLUMNS), counts
