"""Latest, previous and as-of lookups, top-n, keep-first and conflict rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.arith import jump
from ..joins import join_same
from ..schema import DAILY_AVG, KEY
from ..session import broadcast_if_small


def latest_rows(df: DataFrame, keys: list[str], time: str = "scraped_at") -> DataFrame:
    """All rows at the newest time of their key. The newest times are one row per
    key, so the wide rows are filtered where they are read."""
    newest = df.groupBy(*keys).agg(F.max(time).alias(time)).filter(F.col(time).isNotNull())
    return join_same(df, broadcast_if_small(newest), [*keys, time], "left_semi")


def previous_rows(df: DataFrame, keys: list[str], time: str = "scraped_at") -> DataFrame:
    """All rows at the second-newest time of their key: the newest time of what lies
    before the newest. Both are sums by key in each task first."""
    newest = df.groupBy(*keys).agg(F.max(time).alias("_newest")).filter("_newest is not null")
    older = join_same(df.select(*keys, time), broadcast_if_small(newest), keys).filter(F.col(time) < F.col("_newest"))
    second = older.groupBy(*keys).agg(F.max(time).alias(time))
    return join_same(df, broadcast_if_small(second), [*keys, time], "left_semi")


def latest_set(df: DataFrame, keys: list[str] = ["source"], time: str = "scraped_at") -> DataFrame:
    """Newest rows of every source but the daily average, and all of the daily
    average's rows whose label says they are current."""
    others = latest_rows(df.filter(F.col("source") != DAILY_AVG), keys, time)
    current = df.filter((F.col("source") == DAILY_AVG) & F.col("label_ts").like("%Current%"))
    return others.unionByName(current)


def latest_value(
    df: DataFrame, keys: list[str], value: str = "price", time: str = "scraped_at", tie: str | None = None
) -> DataFrame:
    """Newest value per key, one row per key, combined before the shuffle; a
    tie-breaker costs a sort within each task."""
    order = F.struct(time, tie) if tie else F.col(time)
    return df.groupBy(*keys).agg(F.max_by(value, order).alias(value), F.max(time).alias(time))


def latest_with_fallback(
    first: DataFrame, second: DataFrame, keys: list[str], fields: list[str], time: str = "scraped_at", tie: str = "seq"
) -> DataFrame:
    """Per key the newest row of ``first``; keys it lacks come from ``second``."""
    kept = list(dict.fromkeys([*fields, time]))
    columns = list(dict.fromkeys([*keys, *kept, tie]))
    both = first.select(*columns, F.lit(1).alias("_rank")).unionByName(
        second.select(*columns, F.lit(0).alias("_rank"))
    )
    row = F.max_by(F.struct(*kept), F.struct("_rank", time, tie)).alias("_row")
    return both.groupBy(*keys).agg(row).select(*keys, "_row.*")


def asof(
    probes: DataFrame,
    refs: DataFrame,
    keys: list[str],
    value: str,
    out: str,
    lag: str = "0 seconds",
    time: str = "scraped_at",
    tie: str = "seq",
    piece: str = "DAY",
) -> DataFrame:
    """Newest ``refs.value`` of the same key at or before ``probe time - lag``.

    A key's time is cut into calendar pieces (a unit of ``date_trunc``), so that a heavy
    key is many tasks. The last reference of each piece, a partial aggregate, is carried
    on to the pieces behind it and stands there in front of all rows; one sorted pass
    inside each piece does the rest. Nothing runs while the plan is built, and nothing
    is broadcast.
    """
    columns = probes.columns
    kind = f"struct<v:{refs.schema[value].dataType.simpleString()}>"
    order = refs.schema[tie].dataType
    asked = probes.withColumns(
        {
            "_t": F.col(time) - F.expr(f"interval {lag}"),
            "_side": F.lit(1),
            "_tie": F.col(tie),
            "_ref": F.lit(None).cast(kind),
        }
    )
    given = refs.filter(F.col(time).isNotNull()).select(
        *keys,
        F.col(time).alias("_t"),
        F.lit(0).alias("_side"),
        F.col(tie).alias("_tie"),
        F.struct(F.col(value).alias("v")).alias("_ref"),
    )
    unit = F.date_trunc(piece, "_t").alias("_unit")
    asked, given = asked.select("*", unit), given.select("*", unit)
    ends = given.groupBy(*keys, "_unit").agg(F.max_by("_ref", F.struct("_t", "_tie")).alias("_end"))
    reached = asked.groupBy(*keys, "_unit").agg(F.lit(None).cast(kind).alias("_end"))
    pieces = ends.unionByName(reached).groupBy(*keys, "_unit").agg(F.first("_end", ignorenulls=True).alias("_end"))
    # One row per piece of a key: bounded by the calendar, not by the rows.
    earlier = W.partitionBy(*keys).orderBy("_unit").rowsBetween(W.unboundedPreceding, -1)
    carried = pieces.select(*keys, "_unit", F.last("_end", ignorenulls=True).over(earlier).alias("_ref"))
    carried = carried.filter("_ref is not null and _unit is not null").select(
        *keys, "_unit", F.lit(-1).alias("_side"), F.lit(None).cast(order).alias("_tie"), "_ref"
    )
    both = asked.unionByName(given, allowMissingColumns=True).unionByName(carried, allowMissingColumns=True)
    # What is carried has no time, so it comes first.
    inside = W.partitionBy(*keys, "_unit").orderBy(F.asc_nulls_first("_t"), "_side", F.asc_nulls_first("_tie"))
    got = F.last("_ref", ignorenulls=True).over(inside.rowsBetween(W.unboundedPreceding, 0))
    return both.withColumn("_got", got).filter("_side = 1").select(*columns, F.col("_got.v").alias(out))


def newest(df: DataFrame, n: int = 20, time: str = "scraped_at", tie: str = "seq") -> DataFrame:
    return df.orderBy(F.desc(time), F.desc(tie)).limit(n)


def keep_first(df: DataFrame, keys: list[str], *order: str | Column) -> DataFrame:
    """First row per key in the given order. Each task keeps one row per key
    before the shuffle, so copies do not pile up."""
    rank = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(rank)).filter("_rn = 1").drop("_rn")


def insert_if_absent(
    existing: DataFrame, incoming: DataFrame, keys: list[str] = KEY, order: str = "seq"
) -> DataFrame:
    """Rows of ``incoming`` that a unique key would let in. A key with a NULL part
    never conflicts, neither with the table nor within the batch."""
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    fresh = keep_first(incoming.filter(whole), keys, order)
    wanted = broadcast_if_small(fresh.select(*keys))
    # The stored table is reduced to the keys of the batch where it is read.
    taken = existing.select(*keys).join(wanted, keys, "left_semi").distinct()
    return fresh.join(taken, keys, "left_anti").unionByName(incoming.filter(~whole))


def value_at_or_latest(
    panel: DataFrame, wanted: DataFrame, keys: list[str], day: str, values: list[str]
) -> DataFrame:
    """Value on the wanted day; a day that is not in the panel takes the latest
    non-null value of the series."""
    last = panel.groupBy(*keys).agg(
        *[F.max_by(v, F.when(F.col(v).isNotNull(), F.col("date"))).alias(f"_last_{v}") for v in values]
    )
    at = panel.select(*keys, F.col("date").alias(day), *values, F.lit(True).alias("_hit"))
    got = join_same(join_same(wanted, at, [*keys, day], "left"), last, keys, "left")
    return got.withColumns(
        {v: F.when(F.col("_hit"), F.col(v)).otherwise(F.col(f"_last_{v}")) for v in values}
    ).drop("_hit", *[f"_last_{v}" for v in values])


def screen_batch(
    candidates: DataFrame,
    history: DataFrame,
    now: Column,
    keys: list[str],
    screened: list[str],
    limit: float = 0.50,
    tie: str | None = None,
) -> DataFrame:
    """Candidates with ``accepted`` and ``reason``: a move of more than ``limit``
    against the last stored price, or the last one a week old, is refused. The
    history is reduced to one row per key in a single pass; without a tie-breaker
    that pass needs no sort."""
    order = F.struct("scraped_at", tie) if tie else F.col("scraped_at")
    week_old = F.col("scraped_at") <= now - F.expr("interval 7 days")
    refs = history.groupBy(*keys).agg(
        F.max_by("price", order).alias("last_price"),
        F.max_by("price", F.when(week_old, order)).alias("week_price"),
    )
    out = join_same(candidates, broadcast_if_small(refs), keys, "left")
    out = out.withColumns(
        {
            "last_jump": jump(F.col("price"), F.col("last_price")),
            "week_jump": jump(F.col("price"), F.col("week_price")),
        }
    )
    reason = (
        F.when(~F.col("source").isin(screened), F.lit(None))
        .when(F.col("last_jump") > limit, F.lit("last"))
        .when(F.col("week_jump") > limit, F.lit("week"))
    )
    return out.withColumn("reason", reason).withColumn("accepted", F.col("reason").isNull())
