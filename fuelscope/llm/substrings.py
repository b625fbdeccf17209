"""Removal of repeated passages by recompression.

A window of ``window`` consecutive words is a repeat if its words also start somewhere
else, in any document. Every word that a repeated window covers is removed.

Rounds rename the words of a text. The first names runs (two equal neighbours, no
third), each further one pairs: symbols fall to a left or right half by a bit of their
name and the round, and a left one followed by a right one become one symbol. A name
is a hash of what it stands for, so it is the same in every document and every task
without a table of names, and no symbol is longer than six words. Whether two symbols
join depends on nothing but their neighbours, so two equal windows are cut alike
inside: all but the outer eight words (two for the run round, two and four for the
pair rounds) carry the same symbols.

Each window picks the smallest name among the symbols that start in its inner part as
its anchor; equal windows pick the same one in the same place. Texts thus meet at few
places: an anchor is compared by the words that every window picking it must cover.
Where these repeat, all windows of the anchor are repeats if the words of their union
agree in all places that share the anchor; otherwise the windows of these anchors are
compared one by one. Both comparisons are sums by key before a join, which splits a
heavy key.

Null and empty texts and texts shorter than the window lose nothing. Repeated rows
count as two places. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType

from ..session import cut_lineage
from .common import hashed_words, in_batches, mix64, powers, query, read

WINDOW = 35
# Fixed by the rounds: words at either end that may be cut otherwise, and the longest symbol.
MARGIN, LONGEST = 8, 6
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def symbols(h: np.ndarray, wall: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and name of each symbol after the rounds over word hashes ``h``; ``wall``
    marks places between texts, which join nothing."""
    name, start, length = h, np.arange(len(h)), np.ones(len(h), np.int64)

    def joined(first: np.ndarray, salt: int):
        """Symbols at ``first`` take in their right neighbour."""
        gone = np.zeros(len(name), bool)
        gone[first + 1] = True
        new, size = name.copy(), length.copy()
        new[first] = mix64(name[first] * np.uint64(3) + mix64(name[first + 1] + np.uint64(salt)))
        size[first] += length[first + 1]
        return new[~gone], start[~gone], size[~gone]

    for r in range(3):
        if len(name) < 2:
            break
        free = ~(wall[start[:-1]] | wall[start[1:]])
        if r == 0:
            same = np.concatenate([[False], (name[:-1] == name[1:]) & free, [False]])
            # Neighbours i, i + 1 are equal and neither has another equal neighbour.
            first = np.flatnonzero(same[1:-1] & ~same[:-2] & ~same[2:])
        else:
            right = (mix64(name + np.uint64(r)) & np.uint64(1)).astype(bool)
            first = np.flatnonzero(~right[:-1] & right[1:] & free & (length[:-1] + length[1:] <= LONGEST))
        name, start, length = joined(first, r)
    return start, name


class Batch:
    """Word hashes of some texts with a wall after each, and hashes of any stretch."""

    def __init__(self, texts):
        h, begins = hashed_words(texts)
        n = len(begins) - 1
        self.begins = begins + np.arange(n + 1)
        self.h = np.zeros(len(h) + n, np.uint64)
        self.wall = np.zeros(len(h) + n, bool)
        self.wall[self.begins[1:] - 1] = True
        self.h[~self.wall] = h
        up, self.down = powers(len(self.h) + 1)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(self.h * up[: len(self.h)])])

    def stretch(self, at: np.ndarray, length) -> np.ndarray:
        return mix64((self.sums[at + length] - self.sums[at]) * self.down[at] + np.uint64(1) * np.asarray(length).astype(np.uint64))


def anchors(batch: Batch, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """(text, first window, last window, key, union) for each anchor: windows that
    pick it follow one another; ``key`` hashes the words they share, ``union`` all."""
    n = len(batch.h)
    inner = window - 2 * MARGIN - LONGEST + 1
    count = n - window + 1
    if count <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    start, name = symbols(batch.h, batch.wall)
    place = np.full(n, _NONE)
    # Name first, then the leftmost place; the low bits are the place itself.
    bits = np.uint64(max(n.bit_length(), 1))
    place[start] = (mix64(name) >> bits << bits) | start.astype(np.uint64)
    low, width = place, 1
    while 2 * width <= inner:
        low = np.minimum(low[: len(low) - width], low[width:])
        width *= 2
    low = np.minimum(low[: len(low) - (inner - width)], low[inner - width :]) if inner > width else low
    pick = (low[MARGIN : MARGIN + count] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    whole = np.concatenate([[0], np.cumsum(batch.wall)])
    at = np.flatnonzero(whole[window:] == whole[:-window])
    if not len(at):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    pick = pick[at]
    new = np.concatenate([[True], (pick[1:] != pick[:-1]) | (at[1:] != at[:-1] + 1)])
    first, last = at[new], np.append(at[np.flatnonzero(new)[1:] - 1], at[-1])
    anchor = pick[new]
    key = batch.stretch(anchor - MARGIN, window - inner + 1)
    union = mix64(batch.stretch(first, last - first + window) + mix64((anchor - first).astype(np.uint64)))
    return np.searchsorted(batch.begins, first, "right") - 1, first, last, key, union


@F.pandas_udf(BinaryType())
def _pressed(texts: pd.Series) -> pd.Series:
    press = zstandard.ZstdCompressor(level=1)
    return pd.Series([press.compress((t or "").encode("utf-8", "surrogatepass")) for t in texts])


# Compressed bytes of one batch: texts of about four times as many characters.
_PRESSED = 1 << 20


def _opened(raw: bytes) -> str:
    return zstandard.ZstdDecompressor().decompress(raw).decode("utf-8", "surrogatepass")


def _covered(begins, lengths, n: int) -> np.ndarray:
    """Which of ``n`` words the stretches cover."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, np.asarray(begins, np.int64), 1)
    np.add.at(step, np.asarray(begins, np.int64) + np.asarray(lengths, np.int64), -1)
    return np.cumsum(step[:-1]) > 0


def repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(row_key, begins, lengths): stretches of words to remove from a row."""
    rows = docs.select(_row_key(docs).alias("row_key"), docs["text"].cast("string").alias("text"))

    def found(frame: pd.DataFrame) -> pd.DataFrame:
        batch = Batch(frame["text"])
        text, first, last, key, union = anchors(batch, window)
        return pd.DataFrame({"key": key.view(np.int64), "all_words": union.view(np.int64), "row_key": frame["row_key"].to_numpy()[text], "at": (first - batch.begins[text]).astype(np.int32), "n": (last - first + 1).astype(np.int32)})

    places = rows.where(F.col("text").isNotNull()).mapInPandas(in_batches(found), "key long, all_words long, row_key long, at int, n int")
    shared = (
        places.groupBy(F.col("key").alias("of"))
        .agg(F.count(F.lit(1)).alias("c"), F.min("all_words").alias("lo"), F.max("all_words").alias("hi"))
        .where("c > 1")
        .select("of", (F.col("lo") == F.col("hi")).alias("alike"))
    )
    # Written, so that the join splits a heavy key instead of following the sums.
    shared = cut_lineage(shared)
    hits = cut_lineage(places.join(shared, F.col("key") == F.col("of")).select("row_key", "at", "n", "alike"))
    alike = hits.where("alike").select("row_key", "at", (F.col("n") + window - 1).alias("n"))

    # The windows of anchors whose surroundings differ in places, one by one.
    unsure = hits.where("not alike").groupBy("row_key").agg(F.collect_set(F.struct("at", "n")).alias("spans"))
    pressed = rows.where(F.col("text").isNotNull()).select("row_key", _pressed("text").alias("z")).dropDuplicates(["row_key"])

    def single(frame: pd.DataFrame) -> pd.DataFrame:
        batch = Batch([_opened(z) for z in frame["z"]])
        out_key, out_hash, out_at = [], [], []
        for k, (row_key, spans) in enumerate(zip(frame["row_key"], frame["spans"])):
            at = np.concatenate([np.arange(s["at"], s["at"] + s["n"]) for s in spans])
            out_hash.append(batch.stretch(batch.begins[k] + at, window))
            out_at.append(at)
            out_key.append(np.full(len(at), row_key, np.int64))
        return pd.DataFrame({"row_key": np.concatenate(out_key), "h": np.concatenate(out_hash).view(np.int64), "at": np.concatenate(out_at).astype(np.int32)})

    # A row that comes twice holds its windows twice.
    times = rows.groupBy("row_key").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    windows = cut_lineage(pressed.join(unsure, "row_key").mapInPandas(in_batches(single, column="z", size=_PRESSED), "row_key long, h long, at int"))
    twice = cut_lineage(windows.groupBy(F.col("h").alias("of")).agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("of"))
    one_by_one = windows.join(twice, F.col("h") == F.col("of")).select("row_key", "at", F.lit(window).alias("n"))
    doubled = windows.join(times, "row_key").select("row_key", "at", F.lit(window).alias("n"))
    every = alike.unionByName(one_by_one).unionByName(doubled)
    return every.groupBy("row_key").agg(F.collect_set(F.struct("at", "n")).alias("spans")).select("row_key", F.col("spans.at").alias("begins"), F.col("spans.n").alias("lengths"))


def _row_key(docs: DataFrame):
    return F.xxhash64(docs["doc_id"], F.xxhash64(docs["text"].cast("string")))


def remove_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """One row per row: doc_id, n_words, n_removed, kept_sha256 and, with ``with_text``,
    the kept words joined by one space."""
    spans = repeats(docs, window).withColumnRenamed("row_key", "of")
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), _row_key(docs).alias("row_key"), _pressed(docs["text"].cast("string")).alias("z"))

    def cut(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for doc_id, z, begins, lengths in zip(frame["doc_id"], frame["z"], frame["begins"], frame["lengths"]):
            found = _opened(z).encode("utf-8", "surrogatepass").split()
            kept = found
            if begins is not None:
                covered = _covered(begins, lengths, len(found))
                kept = [w for w, gone in zip(found, covered.tolist()) if not gone]
            raw = b" ".join(kept)
            out.append((doc_id, len(found), len(found) - len(kept), hashlib.sha256(raw).hexdigest(), raw.decode("utf-8", "surrogatepass"))[: 5 if with_text else 4])
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
        return pd.DataFrame(out, columns=names[: 5 if with_text else 4]).astype({"doc_id": "Int64"})

    joined = rows.join(spans, F.col("row_key") == F.col("of"), "left").select("doc_id", "z", "begins", "lengths")
    return joined.mapInPandas(in_batches(cut, column="z", size=_PRESSED), "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept string" if with_text else ""))


@query("op2_repeats")
def op2(spark, sf_dir):
    return remove_repeats(read(spark, sf_dir, "documents"), with_text=False)
