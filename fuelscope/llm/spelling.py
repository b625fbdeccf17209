"""Spelling variants of words, by k-d trees over letter counts.

Two words are near if one inserted, deleted or replaced code point makes one the other.
Their letter counts then differ by one letter more and one letter less at most, an L1
distance of two; between lengths L and L + 1 by one letter more. So each word is looked
up twice: among the words of its own length and among those one longer.

A coarse k-d tree for each length, fitted to a bounded sample of words (``SAMPLE``) and
broadcast, cuts the space of letter counts into cells. Every word is stored in its
cell, and sent as a query to the cells whose boxes it can reach with the allowed letters.
A cell with more words or queries than one task should hold is split into blocks of
both. Inside a block a finer k-d tree is searched the same way; what shares a leaf is
checked by L1 distance, then letter by letter. Nothing is capped: the sample decides
only where cells are cut.

Letters share 32 counters and counts end at 255; both only bring vectors closer, so no
pair is lost. Words are compared by code point, ties broken in code-point order (which
is the order of their UTF-8 bytes). Nulls and words without a count are left out, a word
given twice has its counts added; empty tables give empty ones. Very long words have
cells like others. Only the columns named in each function are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..session import broadcast_if_small, cut_lineage
from .common import query, read

RUN = "[A-Za-zÀ-ÿ]+"
MIN_LENGTH, MIN_COUNT = 6, 5
# A form is this many times as frequent as its variant, at least.
DOMINANCE = 5
# Words that the coarse trees are fitted to, words of a cell to aim at, and of a leaf.
SAMPLE = 65_536
CELL = 8_192
LEAF = 8
_COUNTERS = 32
_PAIRS = 1 << 18


def letters(words, length: int) -> np.ndarray:
    """Code points of words of one length, a row for each."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, length)


def letter_counts(points: np.ndarray) -> np.ndarray:
    low = (points >= 97) & (points <= 122)
    slot = np.where(low, points - 97, 26 + points % 6).astype(np.int64)
    at = np.repeat(np.arange(len(points)), points.shape[1]) * _COUNTERS + slot.ravel()
    return np.minimum(np.bincount(at, minlength=len(points) * _COUNTERS), 255).reshape(-1, _COUNTERS).astype(np.uint8)


class KdTree:
    """Over letter counts. A node is cut at a count of one letter, until it holds
    ``leaf`` vectors or all of them are equal; ``low`` and ``high`` are what its box
    allowed for that letter above the cut."""

    def __init__(self, vectors: np.ndarray, leaf: int):
        self.letter, self.cut, self.low, self.high, self.left, self.right = ([] for _ in range(6))
        self.members: list[np.ndarray] = []
        nodes = [(np.arange(len(vectors)), {})]
        while len(self.letter) < len(nodes):
            rows, box = nodes[len(self.letter)]
            best = None
            if len(rows) > leaf:
                some = vectors[rows]
                mean = some.mean(axis=0)
                # The cut at the mean that parts the rows most evenly.
                share = np.abs((some <= np.floor(mean)).mean(axis=0) - 0.5)
                best = int(share.argmin())
                cut = int(mean[best])
                under = some[:, best] <= cut
                if share[best] >= 0.5:
                    best = None
            if best is None:
                for x, v in zip((self.letter, self.cut, self.low, self.high, self.left, self.right), (-1, 0, 0, 0, len(self.members), -1)):
                    x.append(v)
                self.members.append(rows)
                continue
            low, high = box.get(best, (0, 255))
            for x, v in zip((self.letter, self.cut, self.low, self.high, self.left, self.right), (best, cut, low, high, len(nodes), len(nodes) + 1)):
                x.append(v)
            nodes.append((rows[under], {**box, best: (low, cut)}))
            nodes.append((rows[~under], {**box, best: (cut + 1, high)}))
            nodes[len(self.letter) - 1] = (rows[:0], {})
        self.letter, self.cut, self.low, self.high, self.left, self.right = (np.array(x, np.int64) for x in (self.letter, self.cut, self.low, self.high, self.left, self.right))

    def reach(self, queries: np.ndarray, more: int, less: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) for all leaves whose boxes a query enters by at most ``more``
        letters more and ``less`` less."""
        q, node = np.arange(len(queries)), np.zeros(len(queries), np.int64)
        up, down = np.zeros(len(q), np.int16), np.zeros(len(q), np.int16)
        found = []
        while len(q):
            done = self.letter[node] < 0
            found.append((q[done], self.left[node[done]]))
            q, node, up, down = q[~done], node[~done], up[~done], down[~done]
            if not len(q):
                break
            c = queries[q, self.letter[node]].astype(np.int16)
            cut, low, high = (x[node].astype(np.int16) for x in (self.cut, self.low, self.high))
            # What this letter already costs counts once.
            to_left = down + np.maximum(c - cut, 0) - np.maximum(c - high, 0)
            to_right = up + np.maximum(cut + 1 - c, 0) - np.maximum(low - c, 0)
            a, b = to_left <= less, to_right <= more
            node, q, up, down = (
                np.concatenate([self.left[node[a]], self.right[node[b]]]),
                np.concatenate([q[a], q[b]]),
                np.concatenate([up[a], to_right[b]]),
                np.concatenate([to_left[a], down[b]]),
            )
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (q, node)


def _near_equal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x != y).sum(axis=1) == 1


def _near_longer(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether one letter put into ``x`` makes ``y``."""
    parted = np.logical_or.accumulate(x != y[:, :-1], axis=1)
    return ~(parted & (x != y[:, 1:])).any(axis=1)


def near_in_block(stored: list[str], queries: list[str], length: int, longer: bool) -> tuple[np.ndarray, np.ndarray, int]:
    """Near pairs (query, stored), and how many pairs were looked at. ``stored`` are words
    of ``length``, queries of the same or, with ``longer``, one shorter."""
    none = np.zeros(0, np.int64)
    if not stored or not queries:
        return none, none, 0
    y, x = letters(stored, length), letters(queries, length - longer)
    vy, vx = letter_counts(y), letter_counts(x)
    tree = KdTree(vy, LEAF)
    size = np.array([len(m) for m in tree.members])
    members, begin = np.concatenate(tree.members), np.cumsum(size) - size
    check, out, seen = (_near_longer if longer else _near_equal), [(none, none)], 0
    step = max(_PAIRS // (length + 64), 16)
    for at in range(0, len(queries), 2048):
        q, leaf = tree.reach(vx[at : at + 2048], 1, 0 if longer else 1)
        q, n = q + at, size[leaf]
        # Pairs are formed some at a time.
        edges = np.searchsorted(np.cumsum(n), np.arange(0, int(n.sum()), step))
        for a, b in zip(edges, np.append(edges[1:], len(n))):
            k = n[a:b]
            i = np.repeat(q[a:b], k)
            j = members[np.repeat(begin[leaf[a:b]] - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))]
            seen += len(i)
            u, v = vx[i], vy[j]
            close = np.flatnonzero((np.maximum(u, v) - np.minimum(u, v)).sum(axis=1, dtype=np.int64) <= (1 if longer else 2))
            i, j = i[close], j[close]
            near = check(x[i], y[j])
            out.append((i[near], j[near]))
    i, j = (np.concatenate(p) for p in zip(*out))
    return i, j, seen


def _coarse(words: DataFrame, total: int, sample: int, cell: int) -> dict[int, KdTree]:
    """A tree for each length in a sample; cells hold about ``cell`` of all words."""
    some = words.orderBy(F.xxhash64("word"), "word").limit(sample).select("word").toPandas()["word"]
    share = max(total / max(len(some), 1), 1.0)
    by: dict[int, list[str]] = {}
    for w in some:
        by.setdefault(len(w), []).append(w)
    out = {}
    for length, group in by.items():
        tree = KdTree(letter_counts(letters(group, length)), max(int(cell / share), 1))
        # Only where to cut is kept.
        tree.members = [np.zeros(0, np.int64)] * len(tree.members)
        out[length] = tree
    return out


def near_words(words: DataFrame, sample: int = SAMPLE, cell: int = CELL) -> DataFrame:
    """(word, other, n_other): all near pairs of ``words`` (word, n; different words), each
    in both directions."""
    spark = words.sparkSession
    trees = spark.sparkContext.broadcast(_coarse(words, words.count(), sample, cell))

    def dealt(frames):
        for frame in frames:
            length = frame["word"].str.len().to_numpy()
            for own in np.unique(length):
                some = frame[length == own].reset_index(drop=True)
                vectors = letter_counts(letters(some["word"], int(own)))
                # Where it is stored, and where it looks for words as long or one longer.
                for target, more, less, role in ((own, 0, 0, 0), (own, 1, 1, 1), (own + 1, 1, 0, 2)):
                    tree = trees.value.get(int(target))
                    q, leaf = tree.reach(vectors, more, less) if tree else (np.arange(len(some)), np.zeros(len(some), np.int64))
                    yield pd.DataFrame({"length": np.int32(target), "cell": leaf.astype(np.int32), "role": np.int32(role), "word": some["word"].to_numpy()[q], "n": some["n"].to_numpy()[q]})

    rows = cut_lineage(words.select("word", "n").mapInPandas(dealt, "length int, cell int, role int, word string, n long"))
    size = rows.groupBy("length", "cell").agg(F.count_if(F.col("role") == 0).alias("stored"), F.count_if(F.col("role") > 0).alias("asked"))
    # Cells without a stored word answer nothing.
    size = size.where("stored > 0 and asked > 0").select(F.col("length").alias("of"), F.col("cell").alias("at"), F.ceil(F.col("stored") / cell).cast("int").alias("ns"), F.ceil(F.col("asked") / (4 * cell)).cast("int").alias("na"))
    rows = rows.join(broadcast_if_small(size), (F.col("length") == F.col("of")) & (F.col("cell") == F.col("at")))
    stored = F.col("role") == 0
    mine = F.pmod(F.xxhash64("word"), F.when(stored, F.col("ns")).otherwise(F.col("na"))).cast("int")
    rows = rows.withColumn("own", mine).withColumn("every", F.explode(F.sequence(F.lit(0), F.when(stored, F.col("na")).otherwise(F.col("ns")) - 1)))
    rows = rows.select("length", "cell", F.when(stored, F.col("own")).otherwise(F.col("every")).alias("sb"), F.when(stored, F.col("every")).otherwise(F.col("own")).alias("ab"), "role", "word", "n")

    def searched(frame: pd.DataFrame) -> pd.DataFrame:
        length = int(frame["length"].iloc[0])
        parts = [frame[frame["role"] == k] for k in range(3)]
        held, count = parts[0]["word"].to_numpy(), parts[0]["n"].to_numpy()
        out = []
        for k in (1, 2):
            asked, n = parts[k]["word"].to_numpy(), parts[k]["n"].to_numpy()
            i, j, _ = near_in_block(list(held), list(asked), length, k == 2)
            out.append((asked[i], held[j], count[j]))
            if k == 2:
                out.append((held[j], asked[i], n[i]))
        word, other, n = (np.concatenate(x) for x in zip(*out))
        return pd.DataFrame({"word": word, "other": other, "n_other": n})

    return rows.groupBy("length", "cell", "sb", "ab").applyInPandas(searched, "word string, other string, n_other long")


def variant_forms(words: DataFrame, dominance: int = DOMINANCE, sample: int = SAMPLE, cell: int = CELL) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of ``words`` (word, n): how many words are near;
    the most frequent of them, if at least ``dominance`` times as frequent; and where
    following forms ends."""
    words = cut_lineage(words.where("word is not null and n is not null and word <> ''").groupBy("word").agg(F.sum("n").alias("n")))
    # The smallest of (-n, word) is the most frequent, then the first by code point.
    near = near_words(words, sample, cell).groupBy(F.col("word").alias("w")).agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_other")).alias("minus"), F.col("other").alias("other"))).alias("best"))
    held = words.join(near, F.col("word") == F.col("w"), "left")
    strong = -F.col("best.minus") >= dominance * F.col("n")
    held = cut_lineage(held.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(strong, F.col("best.other")).alias("form"), F.when(strong, -F.col("best.minus")).alias("form_n")))
    # Each round follows twice as many forms; a form is more frequent, so paths end.
    heads = cut_lineage(held.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        ahead = heads.select(F.col("word").alias("via"), F.col("root").alias("next"))
        moved = cut_lineage(heads.join(ahead, F.col("root") == F.col("via"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went")))
        heads = moved.select("word", "root")
        if not moved.where("went").limit(1).count():
            break
    heads = heads.select(F.col("word").alias("via"), "root")
    return held.join(heads, F.col("word") == F.col("via"), "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def small_letters(run: Column) -> Column:
    """A-Z alone in lower case."""
    upper = "".join(chr(c) for c in range(65, 91))
    return F.translate(run, upper, upper.lower())


def word_counts(docs: DataFrame, changed=None, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the letter runs of whole texts, A-Z in lower case. ``changed`` may turn
    (doc_id, run) into another word, no longer than the run."""
    runs = docs.select(F.col("doc_id").alias("id"), F.explode(F.regexp_extract_all(docs["text"].cast("string"), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.char_length("run") >= min_length).select("id", small_letters(F.col("run")).alias("run"))
    word = changed(F.col("id"), F.col("run")) if changed else F.col("run")
    counted = runs.select(word.alias("word")).where(F.char_length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count)


def with_planted_typos(doc_id: Column, run: Column) -> Column:
    """One in 199 runs, by checksum, without one of its code points. No id is the empty text."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = F.pmod(h, F.char_length(run)).cast("int")
    return F.when(h % 199 == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


@query("op11_spelling")
def op11(spark, sf_dir):
    counts = word_counts(read(spark, sf_dir, "documents"), with_planted_typos)
    return variant_forms(counts).select("word", "form", "root", "n", "n_near", "form_n")
