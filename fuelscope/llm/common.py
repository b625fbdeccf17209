"""What the operators share: words, row keys, bounded broadcasts, the query registry."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import cut_lineage, prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir.rstrip("/"))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    while name.lower() in map(str.lower, df.columns):
        name = f"_{name}"
    return name


def words(text: str | None) -> list[bytes]:
    """``bytes.split`` parts at exactly the white space that ``WORD`` excludes."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column) -> Column:
    """A fifth of the rows by checksum; a row without an id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


_BASE = 0x9E3779B97F4A7C15
_BLOCK = 1 << 19
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BYTE = mix64(np.arange(1, 257))
_LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint8)
_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd number and of its inverse, modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        _POWERS[:] = [np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, b, np.uint64))]) for b in (_BASE, inverse)]
    return _POWERS[0][:n], _POWERS[1][:n]


def _block_words(block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words in a block of bytes."""
    inside = np.concatenate([[False], ~_SPACE[block], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = powers(len(block) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[block] * up[: len(block)])])
    return starts, ends, mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Words:
    """The words of all texts, one text after another: ``hashes``, ``starts`` and ``ends``
    in the bytes ``joined``, and ``begins``, the number of words before each text and at
    the end. Works on the bytes of many texts at a time, cut at white space, without an
    object per word."""

    def __init__(self, texts, lower: bool = False):
        raws = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        joined = np.frombuffer(b"\n".join(raws), np.uint8)
        self.joined = _LOWER[joined] if lower else joined
        at, parts = 0, [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))]
        while at < len(joined):
            end, reach = at + _BLOCK, _BLOCK
            while end < len(joined):
                spaces = np.flatnonzero(_SPACE[joined[max(at, end - 4096) : end]])
                if len(spaces):
                    end = max(at, end - 4096) + int(spaces[-1]) + 1
                    break
                reach *= 2
                end = at + reach
            starts, ends, hashes = _block_words(self.joined[at:end])
            parts.append((starts + at, ends + at, hashes))
            at = end
        self.starts, self.ends, self.hashes = (np.concatenate(x) for x in zip(*parts))
        limits = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raws])]) if raws else np.zeros(1, np.int64)
        self.begins = np.searchsorted(self.starts, limits).astype(np.int64)

    def distinct(self) -> tuple[list[bytes], np.ndarray]:
        """The different words, and which of them each word is."""
        _, first, which = np.unique(self.hashes, return_index=True, return_inverse=True)
        raw = self.joined.tobytes()
        return [raw[a:b] for a, b in zip(self.starts[first].tolist(), self.ends[first].tolist())], which


def hashed_words(texts, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    found = Words(texts, lower)
    return found.hashes, found.begins


def by_bytes(fn: Callable[[pd.DataFrame], pd.DataFrame], size: int = 1 << 22, column: str = "text", rows: int | None = None):
    """For ``mapInPandas``: hand ``fn`` rows whose texts hold about ``size`` characters
    together, at most ``rows`` of them; a longer text comes alone."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ends = np.cumsum([len(t) + 64 if t is not None else 64 for t in frame[column]])
            at = 0
            while at < len(frame):
                done = ends[at - 1] if at else 0
                to = max(int(np.searchsorted(ends, done + size, side="right")), at + 1)
                out = fn(frame.iloc[at : to if rows is None else min(to, at + rows)])
                at = to if rows is None else min(to, at + rows)
                if len(out):
                    yield out

    return run


def in_batches(fn: Callable[[pd.DataFrame], pd.DataFrame], rows: int = 512, column: str = "text", size: int = 1 << 22):
    """For ``mapInPandas``: hand ``fn`` at most ``rows`` rows of bounded texts at a time, so
    that long texts stay few in memory. ``size`` bounds what ``column`` holds, texts or
    their compressed bytes."""
    return by_bytes(fn, size, column, rows)


__all__ = ["QUERIES", "SQL", "WORD", "Words", "by_bytes", "cut_lineage", "fresh_name", "hashed_words", "held_out", "in_batches", "mix64", "n_words", "powers", "query", "read", "words"]
