"""Periodic runs of words, by longest common extensions on suffix trees.

A run is a stretch of consecutive words with smallest period ``q`` and at least
``MIN_LENGTH`` and ``EXPONENT * q`` words that no neighbouring word extends.

Every run holds a Lyndon word as its period, and that word is the longest Lyndon word
at its place under one of two orders of the alphabet. So each place has two candidates:
from the place to the next smaller suffix, under either order. A candidate is extended
to the right by the longest common extension of its two ends, and to the left by the
same on the reversed words. Both come from a suffix tree, built by Ukkonen's algorithm
and toured once: the extension of two suffixes is the least depth the tour meets between
their leaves, found in constant time from minima over blocks. The order in which the
tour meets the leaves ranks the suffixes, which gives the Lyndon words.

Trees are built only where a run can be. Three words in a row inside a run occur at
least three times there, so a text is cut at every word that no such triple covers,
again and again until nothing changes. Trees take time and memory in proportion to the
stretches that remain, whatever their words; a stretch is worked on whole.

Texts are independent: rows are never shuffled, and a lost executor repeats its own.
Null and empty texts have no run and an empty ``collapsed`` text; repeated rows have the
same result; an empty table gives an empty one. Only doc_id and text are read, so other
columns cannot clash. Two runs at one start differ in period and are ordered by it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import WORD, Words, by_bytes, mix64, query, read

MIN_LENGTH, EXPONENT = 6, 4
# Words in a row that a run of EXPONENT periods repeats as often, inside itself.
_GRAM, _TIMES = 3, 3
_RUNS = "array<struct<start:long,length:long,period:long>>"


class SuffixTree:
    """Of ``symbols`` (1 and up) with an end mark 0, below every symbol in both orders."""

    def __init__(self, symbols: list[int]):
        self.text = [*symbols, 0]
        self.n = len(self.text)
        self.sigma = max(self.text) + 1
        self._build()
        keys = np.fromiter(self.kids, np.int64, len(self.kids))
        self.child = np.fromiter(self.kids.values(), np.int64, len(keys))
        self.parent, self.symbol = keys // self.sigma, keys % self.sigma
        del self.kids

    def _build(self) -> None:
        s, n, sigma = self.text, self.n, self.sigma
        # Node 0 is the root; a node's label is s[begin:end], a leaf's reaches the end.
        begin, end, link, kids = [0], [0], [0], {}
        node = length = edge = open_ = 0
        for i, c in enumerate(s):
            open_ += 1
            unlinked = 0
            while open_:
                if not length:
                    edge = i
                key = node * sigma + s[edge]
                below = kids.get(key)
                if below is None:
                    kids[key] = len(begin)
                    begin.append(i), end.append(n), link.append(0)
                    if unlinked:
                        link[unlinked] = node
                        unlinked = 0
                else:
                    size = min(end[below], i + 1) - begin[below]
                    if length >= size:
                        node, edge, length = below, edge + size, length - size
                        continue
                    middle = begin[below] + length
                    if s[middle] == c:
                        if unlinked:
                            link[unlinked] = node
                        length += 1
                        break
                    inner = len(begin)
                    begin.append(begin[below]), end.append(middle), link.append(0)
                    begin.append(i), end.append(n), link.append(0)
                    kids[key] = inner
                    kids[inner * sigma + c] = inner + 1
                    kids[inner * sigma + s[middle]] = below
                    begin[below] = middle
                    if unlinked:
                        link[unlinked] = inner
                    unlinked = inner
                open_ -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - open_ + 1
        self.kids, self.begin, self.end = kids, begin, end

    def tour(self, descending: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in the order the tour meets their leaves, and the least depth met
        between each leaf and the one before."""
        rank = np.where(self.symbol > 0, self.sigma - self.symbol, 0) if descending else self.symbol
        order = np.lexsort((rank, self.parent))
        parent, child = self.parent[order], self.child[order].tolist()
        bounds = np.searchsorted(parent, np.arange(len(self.begin) + 1)).tolist()
        label = (np.array(self.end) - np.array(self.begin)).tolist()
        depth = [0] * len(label)
        suffixes, lows = [], []
        low, n = 0, self.n
        stack = [0]
        while stack:
            node = stack.pop()
            if node < 0:
                # Not its parent's first child: the tour has just been at the parent.
                node = ~node
                low = depth[node] - label[node]
            a, b = bounds[node], bounds[node + 1]
            d = depth[node]
            if a == b:
                suffixes.append(n - d)
                lows.append(low)
                continue
            for k in range(b - 1, a, -1):
                v = child[k]
                depth[v] = d + label[v]
                stack.append(~v)
            v = child[a]
            depth[v] = d + label[v]
            stack.append(v)
        return np.array(suffixes, np.int64), np.array(lows, np.int64)


_BLOCK = 16


class RangeMinimum:
    """Least value between two places in constant time: minima over runs of whole blocks
    by powers of two, and at both ends from the blocks' edges inwards."""

    def __init__(self, values: np.ndarray):
        blocks = -(-max(len(values), 1) // _BLOCK)
        self.values = np.full(blocks * _BLOCK, np.iinfo(np.int64).max)
        self.values[: len(values)] = values
        grid = self.values.reshape(blocks, _BLOCK)
        self.ahead = np.minimum.accumulate(grid, axis=1).ravel()
        self.behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        self.table = [grid.min(axis=1)]
        while 2 ** len(self.table) <= blocks:
            last, step = self.table[-1], 2 ** (len(self.table) - 1)
            self.table.append(np.minimum(last[:-step], last[step:]))

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Least of values[lo..hi], both included."""
        a, b = lo // _BLOCK, hi // _BLOCK
        out = np.minimum(self.behind[lo], self.ahead[hi])
        wide = b - a > 1
        level = np.zeros(len(lo), np.int64)
        level[wide] = np.log2(b[wide] - a[wide] - 1).astype(np.int64)
        for k in np.unique(level[wide]):
            some = np.flatnonzero(wide & (level == k))
            t = self.table[k]
            out[some] = np.minimum(out[some], np.minimum(t[a[some] + 1], t[b[some] - (1 << k)]))
        same = np.flatnonzero(a == b)
        if len(same):
            places = lo[same, None] + np.arange(_BLOCK)
            inside = places <= hi[same, None]
            out[same] = np.where(inside, self.values[np.where(inside, places, 0)], np.iinfo(np.int64).max).min(axis=1)
        return out


class Extensions:
    """Longest common extensions of suffixes of ``symbols``."""

    def __init__(self, symbols: list[int]):
        self.tree = SuffixTree(symbols)
        order, lows = self.tree.tour()
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.arange(len(order))
        self.least = RangeMinimum(lows)

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols agree from ``i`` and from ``j`` on (i <> j; the end is a place)."""
        x, y = self.rank[i], self.rank[j]
        return self.least(np.minimum(x, y) + 1, np.maximum(x, y))


def _next_smaller(rank: list[int]) -> list[int]:
    """For each place but the last, the next with a smaller rank; the last has the least."""
    out, at = [0] * len(rank), len(rank) - 1
    for i in range(len(rank) - 2, -1, -1):
        at, r = i + 1, rank[i]
        while rank[at] > r:
            at = out[at]
        out[i] = at
    return out[:-1]


def runs_of(symbols: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period."""
    n = len(symbols)
    if n < MIN_LENGTH:
        return []
    right, left = Extensions(symbols), Extensions(symbols[::-1])
    found = []
    for descending in (False, True):
        rank = right.rank
        if descending:
            order, _ = right.tree.tour(True)
            rank = np.empty(n + 1, np.int64)
            rank[order] = np.arange(n + 1)
        i, j = np.arange(n), np.array(_next_smaller(rank.tolist()), np.int64)
        # The words before i and before j, read backwards.
        start = i - left(n - i, n - j)
        end = j + right(i, j)
        keep = end - start >= np.maximum(MIN_LENGTH, EXPONENT * (j - i))
        found.append(np.stack([start, end - start, j - i])[:, keep])
    rows = np.unique(np.concatenate(found, axis=1), axis=1)
    order = np.lexsort((rows[2], rows[0]))
    return [tuple(r) for r in rows[:, order].T.tolist()]


def stretches(hashes: np.ndarray, begins: np.ndarray) -> list[tuple[int, int]]:
    """Where runs can be in texts of words ``hashes`` that begin at ``begins``: ascending
    (begin, end), none across texts. No run reaches outside."""
    at = np.arange(len(hashes))
    of = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    while len(at):
        joined = (at[_GRAM - 1 :] - at[: -(_GRAM - 1)] == _GRAM - 1) & (of[_GRAM - 1 :] == of[: -(_GRAM - 1)])
        first = np.flatnonzero(joined)
        key = mix64(of[first].astype(np.uint64) + np.uint64(1))
        for k in range(_GRAM):
            key = mix64(key + hashes[at[first + k]])
        order = np.argsort(key)
        ordered = key[order]
        edge = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(key) else np.zeros(0, np.int64)
        many = np.repeat(np.diff(np.append(edge, len(key))) >= _TIMES, np.diff(np.append(edge, len(key))))
        covered = np.zeros(len(at), bool)
        for k in range(_GRAM):
            covered[first[order[many]] + k] = True
        kept, before = at[covered], of[covered]
        new = np.concatenate([[True], (np.diff(kept) > 1) | (np.diff(before) > 0)]) if len(kept) else np.zeros(0, bool)
        part = np.cumsum(new) - 1
        long = (np.bincount(part) >= MIN_LENGTH)[part] if len(part) else new
        if len(kept) == len(at) and long.all():
            edges = np.append(np.flatnonzero(new), len(at))
            return [(int(at[a]), int(at[b - 1]) + 1) for a, b in zip(edges[:-1], edges[1:])]
        at, of = kept[long], part[long]
    return []


def _frame(frame: pd.DataFrame) -> pd.DataFrame:
    found = Words(frame["text"])
    raw = found.joined.tobytes()
    begins = found.begins.tolist()
    runs: list[list[tuple[int, int, int]]] = [[] for _ in range(len(frame))]
    gone: list[list[tuple[int, int]]] = [[] for _ in range(len(frame))]
    for a, b in stretches(found.hashes, found.begins):
        # Words are told apart by their bytes.
        ids: dict[bytes, int] = {}
        symbols = [ids.setdefault(raw[x:y], len(ids) + 1) for x, y in zip(found.starts[a:b].tolist(), found.ends[a:b].tolist())]
        row = int(np.searchsorted(found.begins, a, side="right")) - 1
        for start, length, period in runs_of(symbols):
            start += a - begins[row]
            runs[row].append((start, length, period))
            gone[row].append((start + period, start + length))
    texts = []
    for i, text in enumerate(frame["text"]):
        parts = text.encode("utf-8", "surrogatepass").split() if text else []
        if gone[i]:
            cover = np.zeros(len(parts) + 1, np.int64)
            np.add.at(cover, [a for a, _ in gone[i]], 1)
            np.add.at(cover, [b for _, b in gone[i]], -1)
            parts = [parts[k] for k in np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()]
        texts.append(b" ".join(parts).decode("utf-8", "surrogatepass"))
    return pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "runs": [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in runs], "collapsed": texts})


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, runs (by start and period; word numbers from 0) and collapsed, the text's
    words joined by one space without those that a run repeats, for every row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(by_bytes(_frame), f"doc_id long, runs {_RUNS}, collapsed string")


def with_planted_period(doc_id: Column, text: Column) -> Column:
    """A tenth of the texts, by checksum of the id, with words from a drawn place on
    replaced by repetitions of the first of them. Rows without an id stay."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n = F.size(words)
    a = F.pmod(g, n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    repeated = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    changed = F.slice(F.concat(F.slice(words, F.lit(1), a), repeated), F.lit(1), n)
    return F.when((h % 10 == 0) & F.regexp_like(text, F.lit(WORD)), F.concat_ws(" ", changed)).otherwise(text)


@query("op13_periods")
def op13(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    found = periodic_runs(docs.select("doc_id", with_planted_period(docs["doc_id"], docs["text"]).alias("text")))
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    # Runs come by start and period, so the first of equal ones stays.
    longest = F.aggregate("runs", none, lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("best"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return out.select("doc_id", "n_runs", F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"), F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
