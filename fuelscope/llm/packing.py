"""Best-fit packing with certified bounds.

A document's ids (and an end id) are cut into pieces of at most ``capacity``; full
pieces fill a sequence of their own. The others are dealt by hash to partitions of
bounded size, each packed by best-fit decreasing. Dual-feasible functions bound the
number of sequences that a partition needs from below: where the bound is met the
partition is certified and done. Partitions with a gap release the pieces of their
unfilled sequences; these are dealt anew, to fewer partitions, and packed again, until
no gap is left, a round no longer lowers the number, or ``rounds`` are over.

Null and empty texts are the end id alone. Repeated rows are documents of their own.
An empty table gives no piece. Only doc_id and text are read.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .common import fresh_name, in_batches, query, read
from .tokenize import encoder

CAPACITY = 4096
TOKENIZER = "word_bpe_49k.json"
END_ID = 1
# Pieces that one task packs, on average.
PART_PIECES = 20_000
ROUNDS = 3

def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, end_id: int = END_ID, with_ids: bool = False, copy: str | None = None) -> DataFrame:
    """One row per piece; with ``with_ids`` also its ids, little-endian unsigned 32-bit,
    and with ``copy`` the number in that column of ``docs``, which tells copies apart."""
    kept = ["doc_id"] + ([copy] if copy else [])
    names = [*kept, "piece", "start", "length", "ids_crc32"] + (["ids"] if with_ids else [])

    def cut(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for *own, ids in zip(*(frame[c] for c in kept), encoder(tokenizer, False)(list(frame["text"]))):
            ids = np.append(ids, np.uint32(end_id)).astype("<u4")
            for k, at in enumerate(range(0, len(ids), capacity)):
                raw = ids[at : at + capacity].tobytes()
                out.append((*own, k, at, len(raw) // 4, zlib.crc32(raw), raw)[: len(names)])
        return pd.DataFrame(out, columns=names).astype({c: "Int64" for c in kept})

    schema = ", ".join(f"{c} {'binary' if c == 'ids' else 'int' if c == 'piece' else 'long'}" for c in names)
    return docs.select(*[F.col(c).cast("long").alias(c) for c in kept], F.col("text").cast("string").alias("text")).mapInPandas(in_batches(cut), schema)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing of these lengths has fewer sequences: a function f on 0..capacity is
    dual feasible if f sums to at most 1 over whatever fits together, so the sum of f
    bounds the number from below. Tried are the share of the capacity, the rounding
    family u(k), and the family that counts long pieces whole and drops short ones."""
    if not len(lengths):
        return 0
    x = lengths.astype(np.int64)
    best = -(-int(x.sum()) // capacity)
    for k in range(1, 33):
        scaled = (k + 1) * x
        # In units of 1 / (k capacity), so that sums stay whole.
        u = np.where(scaled % capacity == 0, x * k, scaled // capacity * capacity)
        best = max(best, -(-int(u.sum()) // (k * capacity)))
    # Every cut of the last family at once: lengths beyond capacity - cut count whole.
    x = np.sort(x)
    sums = np.concatenate([[0], np.cumsum(x)])
    cuts = np.arange(1, capacity // 2 + 1)
    short, long = np.searchsorted(x, cuts), np.searchsorted(x, capacity - cuts, "right")
    v = sums[long] - sums[short] + (len(x) - long) * capacity
    return max(best, -(-int(v.max(initial=0)) // capacity))


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each length by best-fit decreasing, and the fill of each bin."""
    bin_of, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room: list[int] = []  # distinct free amounts, ascending
    at: dict[int, list[int]] = {}  # bins by free amount
    fill: list[int] = []
    for i in np.argsort(-lengths, kind="stable"):
        need = int(lengths[i])
        k = bisect.bisect_left(room, need)
        if k < len(room):
            free = room[k]
            b = at[free].pop()
            if not at[free]:
                del at[free], room[k]
        else:
            b, free = len(fill), capacity
            fill.append(0)
        bin_of[i], offset[i] = b, fill[b]
        fill[b] += need
        left = capacity - fill[b]
        if left:
            if left not in at:
                at[left] = []
                bisect.insort(room, left)
            at[left].append(b)
    return bin_of, offset, np.array(fill, np.int64)


def pack(items: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS, part_pieces: int = PART_PIECES) -> DataFrame:
    """``items`` (with a column length of 1..capacity) plus sequence_id and offset, which
    replace columns of these names; other columns pass through, whatever their names."""
    columns = [c for c in items.columns if c.lower() not in ("sequence_id", "offset")]
    items = items.select(*columns)
    at, bin_, fill_, gap, part_ = (fresh_name(items, c) for c in ("_at", "_bin", "_fill", "_gap", "_part"))
    # Written, so that the row numbers hold when a task runs again.
    items = cut_lineage(items.withColumn(at, F.monotonically_increasing_id()))
    whole = items.where(F.col("length") == capacity).select(*columns, F.col(at).bitwiseOR(F.lit(1 << 62)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    todo, done, before = items.where(F.col("length") < capacity), [whole], None
    schema = f"{todo._jdf.schema().toDDL()}, {bin_} long, offset long, {fill_} long, {gap} long, {part_} long"

    def packed(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", at], ascending=[False, True], ignore_index=True)
        lengths = frame["length"].to_numpy(np.int64)
        bin_of, offset, fill = best_fit(lengths, capacity)
        return frame.assign(**{bin_: bin_of, "offset": offset, fill_: fill[bin_of], gap: len(fill) - lower_bound(lengths, capacity)})

    for r in range(rounds):
        n = todo.count()
        if not n:
            break
        parts = -(-n // part_pieces)
        dealt = todo.withColumn(part_, F.pmod(F.xxhash64(at, F.lit(r)), F.lit(parts)))
        out = cut_lineage(dealt.groupBy(part_).applyInPandas(packed, schema))
        sequence = (F.lit(r << 56).cast("long").bitwiseOR(F.shiftleft(F.col(part_), 28))).bitwiseOR(F.col(bin_))
        out = out.withColumn("sequence_id", sequence)
        open_bins = out.where((F.col(gap) > 0) & (F.col(fill_) < capacity))
        left = open_bins.agg(F.countDistinct("sequence_id").alias("bins"), F.max(gap).alias("gap")).first()
        final = r == rounds - 1 or parts == 1 or not left["bins"] or (before is not None and left["bins"] >= before)
        held = out if final else out.where(~((F.col(gap) > 0) & (F.col(fill_) < capacity)))
        done.append(held.select(*columns, "sequence_id", "offset"))
        if final:
            break
        before, todo = left["bins"], open_bins.select(*columns, at)
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


@query("op5_pack")
def op5(spark, sf_dir):
    return pack(pieces(read(spark, sf_dir, "documents")))
