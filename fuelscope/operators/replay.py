"""Sequential plausibility replay: only accepted rows become reference prices.

Against the last price alone, a calendar piece of a key is a map from the price that
enters it to the price that leaves it. All pieces are tabulated at the same time, their
maps are followed piece by piece, and all pieces are scanned at the same time from the
prices found; no job runs while the plan is built, and no key is counted.

With the week-old price a key that fits one task is scanned in order, the keys of a task
one behind the other. A larger key goes week by week: the week-old prices of all rows of
a calendar week are accepted rows of the weeks before it, so they are known when the week
begins. Rows they refuse are out; the others are a replay against the last price alone,
whose days are tabulated, followed and scanned at the same time. Each week takes the same
few passes, whatever the prices.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..joins import join_same
from ..session import broadcast_if_small, cut_lineage, new_folder
from .lookup import asof

# A key of more rows is not held by one Python task.
ROWS_PER_SCAN = 1_000_000
WEEK_US = 7 * 86_400 * 1_000_000
EPOCH = "timestamp_ntz'1970-01-05 00:00:00'"


def too_far(new: float, ref: float | None, limit: float) -> bool:
    return ref is not None and ref == ref and ref != 0 and abs((new - ref) / ref) > limit


class Series:
    """One series after another, each row in its turn against the last accepted price and
    the newest accepted one that is a week old. ``times`` and ``prices`` are the accepted
    rows, ``week`` the place of the week-old one among them."""

    def __init__(self, limit: float):
        self.limit = limit
        self.begin()

    def begin(self) -> None:
        self.times: list[int] = []
        self.prices: list[float] = []
        self.week = -1

    def keep(self, t: int, p: float) -> None:
        self.times.append(t)
        self.prices.append(p)

    def judge(self, t: int, p: float) -> bool:
        times, prices, week = self.times, self.prices, self.week
        while week + 1 < len(times) and times[week + 1] <= t - WEEK_US:
            week += 1
        self.week = week
        if p != p or (prices and too_far(p, prices[-1], self.limit)) or (week >= 0 and too_far(p, prices[week], self.limit)):
            return False
        self.keep(t, p)
        return True


def micros(times: pd.Series) -> np.ndarray:
    return times.to_numpy("datetime64[us]").astype("int64")


class Passage:
    """Which price leaves a piece, for every price that may enter it.

    An entering price waits for the first row that accepts it and then shares the fate of
    all others accepted there. Kept are the rows that are first for some entering price,
    each with a state; states that accept the same row become one. Two living states are
    too far apart to accept each other, so there are at most as many as steps of
    ``1 + limit`` in the range of the prices.
    """

    def __init__(self, limit: float):
        self.limit = limit
        self.firsts: list[float] = []
        self.state_of: list[int] = []
        self.parent: list[int] = []
        self.value: list[float] = []
        self.living: list[int] = []
        self.seen: set[float] = set()
        self.covered: list[tuple[float, float]] = []

    def step(self, p: float) -> None:
        if p != p:
            return
        accepting = [s for s in self.living if not too_far(p, self.value[s], self.limit)]
        state = accepting[0] if accepting else None
        if len(accepting) > 1:
            for other in accepting[1:]:
                self.parent[other] = state
            self.living = [s for s in self.living if s == state or s not in accepting]
        if self._may_be_first(p):
            if state is None:
                state = len(self.value)
                self.parent.append(state)
                self.value.append(p)
                self.living.append(state)
            self.firsts.append(p)
            self.state_of.append(state)
        if state is not None:
            self.value[state] = p

    def _may_be_first(self, p: float) -> bool:
        """False only if every price that accepts ``p`` has met an accepting row before.
        Bounds are moved by more than rounding, so that doubt keeps the row."""
        if p in self.seen:
            return False
        self.seen.add(p)
        if not self.firsts:
            self._cover(p)
            return True
        if not 0 <= self.limit < 1 or not np.isfinite(p):
            return True
        if p == 0:
            # Only a price of zero or none accepts it, and those take the first row.
            return False
        low, high = self._bounds(p, 1e-9)
        if any(a <= low and high <= b for a, b in self.covered):
            return False
        self._cover(p)
        return True

    def _bounds(self, p: float, slack: float) -> tuple[float, float]:
        a, b = p / (1 + self.limit), p / (1 - self.limit)
        low, high = (a, b) if p > 0 else (b, a)
        return low - abs(low) * slack, high + abs(high) * slack

    def _cover(self, p: float) -> None:
        if not 0 <= self.limit < 1 or not np.isfinite(p) or p == 0:
            return
        low, high = self._bounds(p, -1e-12)
        apart = [(a, b) for a, b in self.covered if b < low or high < a]
        touching = [(a, b) for a, b in self.covered if not (b < low or high < a)]
        self.covered = [*apart, (min([low, *[a for a, _ in touching]]), max([high, *[b for _, b in touching]]))]

    def exits(self) -> list[float]:
        """The leaving price behind each of ``firsts``."""
        out = []
        for s in self.state_of:
            while self.parent[s] != s:
                s = self.parent[s]
            out.append(self.value[s])
        return out


def leaving(entering: float | None, firsts: list[float], exits: list[float], limit: float) -> float | None:
    """The price that leaves a piece which ``entering`` enters."""
    for p, out in zip(firsts, exits):
        if not too_far(p, entering, limit):
            return out
    return entering


def begin_flags(pdf: pd.DataFrame, columns: list[str], before: tuple | None) -> np.ndarray:
    """Where a row differs from the one above it in ``columns``; NULLs are equal."""
    new = np.zeros(len(pdf), dtype=bool)
    for c in columns:
        here, above = pdf[c], pdf[c].shift()
        new |= ~((here == above) | (here.isna() & above.isna())).to_numpy(dtype=bool)
    first = zip((pdf[c].iloc[0] for c in columns), before or ())
    new[0] = before is None or not all((pd.isna(a) and pd.isna(b)) or a == b for a, b in first)
    return new


def _pieces(frames: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Sorted batches, each with the rows that begin a new piece."""
    before = None
    for pdf in frames:
        if len(pdf):
            begins = begin_flags(pdf, columns, before)
            before = tuple(pdf[c].iloc[-1] for c in columns)
            yield pdf, begins


def _in_order(df: DataFrame, piece: list[str], order: list) -> DataFrame:
    """The rows of a piece behind each other in one task, which streams over them."""
    return df.repartition(*piece).sortWithinPartitions(*piece, *order)


def _with_flag(df: DataFrame) -> T.StructType:
    kept = [f for f in df.schema.fields if f.name != "accepted"]
    return T.StructType([*kept, T.StructField("accepted", T.BooleanType())])


def _whole(df: DataFrame, keys: list[str], time: str, tie: str, limit: float) -> DataFrame:
    """Many keys to a task, which streams over their rows; columns pass through as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        series, before = Series(limit), None
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.select(keys).to_pandas()
            begins = begin_flags(names, keys, before)
            before = tuple(names[c].iloc[-1] for c in keys)
            times = micros(batch.column(time).to_pandas()).tolist()
            prices = batch.column("price").to_pandas().to_numpy("float64").tolist()
            flags = []
            for new, t, p in zip(begins.tolist(), times, prices):
                if new:
                    series.begin()
                flags.append(series.judge(t, p))
            kept = batch.drop_columns([c for c in ("accepted",) if c in batch.schema.names])
            yield kept.append_column("accepted", pa.array(flags, pa.bool_()))

    ordered = df.repartition(*keys).sortWithinPartitions(*keys, time, F.asc_nulls_last(tie))
    return ordered.mapInArrow(run, _with_flag(df))


def _large(
    df: DataFrame, keys: list[str], time: str, tie: str, limit: float
) -> DataFrame:
    """Week by week, the days of a week at the same time."""
    spark, columns = df.sparkSession, [c for c in df.columns if c != "accepted"]
    slab = F.expr(f"cast(floor(timestampdiff(DAY, {EPOCH}, {time}) / 7.0) as int)")
    cut = df.select(*columns).withColumns({"_day": F.date_trunc("DAY", time), "_slab": slab})
    folder = new_folder(spark, "weeks")
    cut.hint("rebalance", "_slab").write.partitionBy("_slab").parquet(folder)
    cut = spark.read.schema(cut.schema).parquet(folder)
    # One number per calendar week.
    weeks = [r[0] for r in cut.select("_slab").distinct().orderBy("_slab").collect()]
    tail = spark.createDataFrame([], cut.select(*keys, "_slab", time, tie, "price").schema)
    order = F.struct(time, tie)
    done: list[DataFrame] = []
    for week in weeks:
        part = asof(cut.filter(F.col("_slab") == week), tail, keys, "price", "_week", "7 days", time, tie)
        price, ref = F.col("price").cast("double"), F.col("_week").cast("double")
        move = F.abs((price - ref) / F.nullif(ref, F.lit(0.0)))
        refused = F.coalesce((move > limit) & ~F.isnan(move), F.lit(False))
        part = cut_lineage(part.withColumn("_judged", F.when(~refused, price)).drop("_week").withColumnRenamed("_day", "_unit"))
        before = tail.groupBy(*keys).agg(F.max_by("price", order).alias("_end"))
        settled = cut_lineage(_against_last(part, keys, time, tie, limit, "_judged", before).drop("_judged"))
        done.append(settled.select(*columns, "accepted"))
        # The next week looks back into this one and to one older row per key.
        seen = tail.unionByName(settled.filter("accepted").select(*tail.columns))
        older = seen.filter(F.col("_slab") < week)
        row = F.max_by(F.struct("_slab", time, tie, "price"), order).alias("_r")
        older = older.groupBy(*keys).agg(row).select(*keys, "_r.*")
        tail = cut_lineage(seen.filter(F.col("_slab") >= week).unionByName(older))
    return reduce(DataFrame.unionByName, done)


def replay(
    df: DataFrame,
    keys: list[str],
    time: str = "scraped_at",
    tie: str = "seq",
    limit: float = 0.50,
    rows_per_segment: int = ROWS_PER_SCAN,
) -> DataFrame:
    """The rows with ``accepted`` as a job run after each of them would have set it.
    Rows without a time stay and are not accepted."""
    df, untimed = _timed(df, time)
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = broadcast_if_small(counted.filter(F.col("_n") > rows_per_segment).drop("_n"))
    if hot.isEmpty():
        return _whole(df, keys, time, tie, limit).unionByName(untimed)
    cold = join_same(df, hot, keys, "left_anti")
    large = join_same(df, hot, keys, "left_semi")
    return _whole(cold, keys, time, tie, limit).unionByName(_large(large, keys, time, tie, limit)).unionByName(untimed)


def _timed(df: DataFrame, time: str) -> tuple[DataFrame, DataFrame]:
    """The rows with a time, and the others as not accepted."""
    return df.filter(F.col(time).isNotNull()), df.filter(F.col(time).isNull()).withColumn("accepted", F.lit(False))


def replay_last_only(
    df: DataFrame,
    keys: list[str],
    time: str = "scraped_at",
    tie: str = "seq",
    limit: float = 0.50,
    piece: str = "DAY",
) -> DataFrame:
    """Replay against the last accepted price only; rows without a time as in ``replay``.
    ``piece`` is a unit of ``date_trunc`` and changes the tasks, never the answer. What
    follows the maps reads one row for each piece of a key, bounded by the calendar."""
    df, untimed = _timed(df, time)
    rows = df.withColumn("_unit", F.date_trunc(piece, time))
    return _against_last(rows, keys, time, tie, limit).unionByName(untimed)


def _against_last(
    rows: DataFrame, keys: list[str], time: str, tie: str, limit: float, judged: str = "price", before: DataFrame | None = None
) -> DataFrame:
    """Flags against the last accepted price, in pieces ``_unit`` of a key, which is dropped.
    Rows without a ``judged`` price are refused. ``before`` holds the price ``_end`` that
    enters the first piece of a key."""
    by = [*keys, "_unit"]
    passages = _in_order(rows.select(*by, time, tie, F.col(judged).cast("double").alias("price")), by, [time, tie])
    table = "_firsts array<double>, _exits array<double>"
    maps = passages.select(*by, "price").mapInPandas(_tabulate(by, limit), _shape(rows, by, table))
    if before is not None:
        # A piece in front of all others, which the same price always leaves.
        end, unit = F.array(F.col("_end").cast("double")), F.lit(None).cast(rows.schema["_unit"].dataType)
        maps = maps.unionByName(before.select(*keys, unit.alias("_unit"), end.alias("_firsts"), end.alias("_exits")))
    entries = _in_order(maps, keys, ["_unit"]).mapInPandas(_follow(keys, limit), _shape(rows, by, "_last double"))
    both = rows.withColumn("_side", F.lit(1)).unionByName(entries.withColumn("_side", F.lit(0)), allowMissingColumns=True)
    ready = _in_order(both, by, ["_side", time, tie])
    return ready.mapInPandas(_scan(by, limit, judged), _with_flag(rows.drop("_unit")))


def _shape(df: DataFrame, columns: list[str], more: str) -> T.StructType:
    return T.StructType([*[df.schema[c] for c in columns], *T.StructType.fromDDL(more)])


def _tabulate(by: list[str], limit: float):
    """One row for each piece: its first rows and the prices that leave behind them."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        passage, names = None, None
        for pdf, begins in _pieces(frames, by):
            done = []
            for i, (new, p) in enumerate(zip(begins.tolist(), pdf["price"].tolist())):
                if new:
                    if passage is not None:
                        done.append((*names, passage.firsts, passage.exits()))
                    passage, names = Passage(limit), [pdf[c].iloc[i] for c in by]
                passage.step(p)
            if done:
                yield pd.DataFrame(done, columns=[*by, "_firsts", "_exits"])
        if passage is not None:
            yield pd.DataFrame([(*names, passage.firsts, passage.exits())], columns=[*by, "_firsts", "_exits"])

    return run


def _follow(keys: list[str], limit: float):
    """The price that enters each piece, piece by piece of a key."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for pdf, begins in _pieces(frames, keys):
            entering = []
            for new, firsts, exits in zip(begins.tolist(), pdf["_firsts"], pdf["_exits"]):
                if new:
                    last = None
                entering.append(last)
                last = leaving(last, firsts.tolist(), exits.tolist(), limit)
            yield pdf.drop(columns=["_firsts", "_exits"]).assign(_last=pd.Series(entering, index=pdf.index, dtype="float64"))

    return run


def _scan(by: list[str], limit: float, judged: str):
    """Flags of the rows of each piece, which the entering price stands in front of."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for pdf, _ in _pieces(frames, by):
            flags = np.zeros(len(pdf), dtype=bool)
            sides = pdf["_side"].to_numpy()
            columns = (pdf[c].to_numpy("float64").tolist() for c in (judged, "_last"))
            for i, (side, p, start) in enumerate(zip(sides.tolist(), *columns)):
                if side == 0:
                    last = start
                elif p == p and not too_far(p, last, limit):
                    flags[i] = True
                    last = p
            yield pdf.assign(accepted=flags)[sides == 1].drop(columns=["_unit", "_side", "_last"])

    return run
