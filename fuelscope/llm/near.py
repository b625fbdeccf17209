"""N-gram Jaccard join by PartEnum signatures.

A document's features are its distinct 5-word shingles, as 64-bit hashes. Two sets of
similarity J or more differ in at most ``(1 - J) / (1 + J) * (|A| + |B|)`` features. Sizes
fall into windows that grow by 2 and overlap by 1/J, so any linked pair shares one.

Inside a window the feature domain is cut into first-level parts, each into three
second-level parts, and a part gives one signature for each pair of sub-parts (the
subset enumerated): all features that the set has there. A part agrees if A and B
share one that is not empty. To spoil a part takes two differences if the set has
features in two of its sub-parts or more (its weight is 2), and one if only in one
(weight 1). So the parts in front of the first that agrees weigh at most k together,
k being the most that the sets can differ, for A and for B: both sign their parts in a
fixed order until the weight exceeds k, and both sign that part. Windows of small sets
cut so finely that every feature is a part of its own: a set signs its first k + 1. A
larger set has six features to a part where its window ends, so that its parts weigh
more than k; the odds against are below one in 10^10 a set.

Features that a sample shows to be frequent (shared passages, boilerplate, large groups
of copies) form parts of their own, last in the order, so that texts meet by what is
rare in them first.

Sets travel as fingerprints, so equal sets are one vertex. Vertices with a signature
in common are compared with one of them, the leader. Those linked with it are its ball.
A vertex outside differs from a ball member at least by its difference from the leader
less the member's, so most are clear of the whole ball at once. What may still be linked,
those outside with each other and the unclear ones with the ball, is compared in blocks
(``BLOCK_SETS``), first by sketches: a set that differs too much from all across, or is
joined with them, goes out of its two blocks before any features travel. For the others
a task gets the two blocks, counts all shared features at once and returns only links
that join what was not joined, so no group's pairs are ever rows. Signatures of one
leader are handled together. Is the remainder of more than ``BLOCKS`` blocks, it gets
a new leader if the ball took a good part, or signs anew under another seed, keeping only
who shares the old and a new signature; that repeats until it is smaller. Either way
every pair with a common signature is compared or excluded by its bound.

Sketches are kept for all sets that meet another one, features only read for those that
sketches leave: chance meetings, whose share grows with the table, carry no features.

Signatures travel once. Those that a sample shows to be frequent have a leader named
beforehand and are dealt by vertex, so no task holds a large group of them.

Null and empty texts have no shingle and no link. Fewer than five words make one
shingle. Repeated rows share a component. Only doc_id and text are read; a null
doc_id is a vertex of its own set like any other.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import broadcast_if_small, cut_lineage
from .common import by_bytes, hashed_words, mix64, n_words, query, read

WORDS = 5
NUMERATOR, DENOMINATOR = 80, 100
# Sets and features of a block that is compared whole, and blocks of a remainder at most.
BLOCK_SETS, BLOCK_FEATURES = 512, 1 << 20
BLOCKS = 64
# Characters of texts, or bytes of features, that a task works on at a time, about, and
# cells of the table in which it counts what two blocks share.
AT_ONCE = 1 << 20
CELLS = 1 << 22
# Windows from this size on use parts of several features.
COARSE_FROM = 150
# Documents looked at for frequent features and signatures, and how many are taken at
# most. A signature is taken as frequent if as many sets of the sample have it.
SAMPLE_ROWS = 8_192
FREQUENT = 500_000
HOT = 8
_FACTORS = mix64(np.arange(1, WORDS + 1))


def shingles(texts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, one text after another, and
    where each text's begin (with the end as last)."""
    h, begins = hashed_words(texts, lower=True)
    size = np.diff(begins)
    full = np.zeros(max(len(h) - WORDS + 1, 0), np.uint64)
    for k in range(WORDS):
        full += h[k : k + len(full)] * _FACTORS[k]
    full = np.concatenate([mix64(full), np.zeros(len(h) - len(full), np.uint64)])
    for i in np.flatnonzero((size > 0) & (size < WORDS)):
        a, b = begins[i], begins[i + 1]
        few = (h[a:b] * _FACTORS[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
        full[a] = mix64(np.array([few], np.uint64))[0]
    count = np.where(size >= WORDS, size - WORDS + 1, np.minimum(size, 1))
    for a, n in zip(begins[:-1].tolist(), count.tolist()):
        full[a : a + n].sort()
    text = np.repeat(np.arange(len(size)), size)
    used = np.arange(len(h)) - begins[text] < count[text]
    used[1:] &= (full[1:] != full[:-1]) | (text[1:] != text[:-1])
    return full[used], np.searchsorted(text[used], np.arange(len(size) + 1))


def _sums(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    total = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
    return total[begins[1:]] - total[begins[:-1]]


def fingerprints(features: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """One signed 64-bit number for each set; 0 for an empty one."""
    size = np.diff(begins).astype(np.uint64)
    return np.where(size > 0, mix64(_sums(mix64(features), begins) + size), np.uint64(0)).view(np.int64)


def windows(size: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Upper ends of the (at most two) windows that hold a size, 0 for none, and the
    most that a set of this size can differ from a partner there. Window j is
    [2^j, 2^(j+1) / J]."""
    level = np.int64(1) << np.floor(np.log2(np.maximum(size, 1))).astype(np.int64)
    out = []
    for low in (level, level >> 1):
        high = 2 * low * DENOMINATOR // NUMERATOR
        high = np.where((low > 0) & (size > 0) & (size <= high), high, 0)
        partner = np.minimum(size * DENOMINATOR // NUMERATOR, high)
        out.append((high, (DENOMINATOR - NUMERATOR) * (size + partner) // (DENOMINATOR + NUMERATOR)))
    return out


def signatures(features: np.ndarray, begins: np.ndarray, frequent: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """PartEnum signatures of sets (hashes, ascending in each set), and their sets.
    ``frequent`` (ascending) are features that form parts of their own, last in order."""
    size = np.diff(begins)
    owner = np.repeat(np.arange(len(size)), size)
    x = features
    place = np.searchsorted(frequent, x)
    common = (frequent[np.minimum(place, len(frequent) - 1)] == x) if len(frequent) else np.zeros(len(x), bool)
    if seed:
        x = mix64(features + np.uint64(seed * 0xD1B54A32D192ED03 % 2**64))
        order = np.lexsort((x, owner))
        x, common = x[order], common[order]
    # Rare ones to the front of their set, both kinds in their order.
    rank = np.concatenate([[0], np.cumsum(common)])
    own = rank[begins[owner]]
    back = begins[owner + 1] - rank[begins[owner + 1]] + rank[:-1]
    to = np.where(common, back, np.arange(len(x)) - (rank[:-1] - own))
    y, late = np.empty_like(x), np.empty_like(common)
    y[to], late[to] = x, common
    x = y
    sigs, sets = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for high, k in windows(size):
        salt = (high * 31 + seed).astype(np.uint64)
        fine = (high > 0) & (high < COARSE_FROM)
        some = np.flatnonzero(fine[owner] & (np.arange(len(x)) - begins[owner] <= k[owner]))
        sigs.append(mix64(x[some] + salt[owner[some]]))
        sets.append(owner[some])

        some = np.flatnonzero((high >= COARSE_FROM)[owner])
        if not len(some):
            continue
        o, y, last = owner[some], x[some], late[some]
        # A part of six features at the upper end of the window, two to a sub-part.
        place = ((y >> np.uint64(32)) * (high[o] // 6 * 3).astype(np.uint64) >> np.uint64(32)).astype(np.int64) + np.where(last, 3 << 40, 0)
        first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (o[1:] != o[:-1])]))
        sums = np.add.reduceat(mix64(y + salt[o]), first)
        o, place = o[first], place[first]
        part = place // 3
        new = np.concatenate([[True], (part[1:] != part[:-1]) | (o[1:] != o[:-1])])
        start = np.flatnonzero(new)
        weight = np.minimum(np.diff(np.append(start, len(part))), 2)
        of = o[start]
        before = np.cumsum(weight) - weight
        begin = np.searchsorted(of, of)
        signs = before - before[begin] <= k[of]
        grid = np.zeros((len(start), 3), np.uint64)
        grid[np.cumsum(new) - 1, place % 3] = sums
        grid, of = grid[signs], of[signs]
        base = mix64(part[start[signs]].astype(np.uint64) * np.uint64(0xA24BAED4963EE407) + salt[of])
        for a, b in ((0, 1), (0, 2), (1, 2)):
            some = np.flatnonzero((grid[:, a] != 0) | (grid[:, b] != 0))
            sigs.append(mix64(base[some] + np.uint64(a * 3 + b) + mix64(grid[some, a] + np.uint64(1)) + mix64(grid[some, b]) * np.uint64(3)))
            sets.append(of[some])
    return np.concatenate(sigs), np.concatenate(sets)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def vertices(docs: DataFrame) -> DataFrame:
    """(doc_id, h, n_shingles, v, sketch): the text's hash, the set's fingerprint and
    its sketch, null for an empty set."""

    def measured(frame: pd.DataFrame) -> pd.DataFrame:
        features, begins = shingles(frame["text"])
        sketch = [_sketch(features[a:b]) if b > a else None for a, b in zip(begins[:-1], begins[1:])]
        return pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "h": frame["h"], "n_shingles": np.diff(begins), "v": fingerprints(features, begins), "sketch": sketch})

    out = _texts(docs).withColumn("h", F.xxhash64("text")).mapInPandas(by_bytes(measured, AT_ONCE), "doc_id long, h long, n_shingles long, v long, sketch binary")
    return out.withColumn("v", F.when(F.col("n_shingles") > 0, F.col("v")))


def _sample(docs: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` documents at most, by hash of the row."""
    share = F.lit(max(-(-docs.count() // rows), 1))
    return _texts(docs).where(F.pmod(F.xxhash64("doc_id", "text"), share) == 0).select("text")


def frequent_features(some: DataFrame, most: int = FREQUENT) -> np.ndarray:
    """Features that occur often in a sample, at most ``most``. They only order the parts:
    any choice gives the same links, a good one fewer chance meetings."""

    def exploded(frame: pd.DataFrame) -> pd.DataFrame:
        features, _ = shingles(frame["text"])
        # What a batch has once or more often is counted before it travels.
        f, n = np.unique(features, return_counts=True)
        return pd.DataFrame({"f": f.view(np.int64), "n": n})

    counted = some.mapInPandas(by_bytes(exploded, AT_ONCE), "f long, n long")
    top = counted.groupBy("f").agg(F.sum("n").alias("n")).where("n > 2").orderBy(F.desc("n"), "f").limit(most)
    return np.sort(top.toPandas()["f"].to_numpy(np.int64).view(np.uint64))


def _signer(frequent, hot=None):
    """For ``mapInPandas``: (sig, v, hot) of texts; a task signs equal sets once. ``hot`` is
    a signature's place among those of ``hot``, or -1."""

    def sign(frames):
        seen: set[int] = set()
        known = hot.value[0] if hot else np.zeros(0, np.int64)

        def some(frame: pd.DataFrame) -> pd.DataFrame:
            features, begins = shingles(frame["text"])
            v = fingerprints(features, begins)
            fresh = np.array([x not in seen and not seen.add(x) for x in v.tolist()], bool)
            size = np.diff(begins)
            begins = np.concatenate([[0], np.cumsum(size * fresh)])
            sig, of = signatures(features[np.repeat(fresh, size)], begins, frequent.value)
            sig = sig.view(np.int64)
            place = np.searchsorted(known, sig)
            there = known[np.minimum(place, len(known) - 1)] == sig if len(known) else np.zeros(len(sig), bool)
            return pd.DataFrame({"sig": sig, "v": v[of], "hot": np.where(there, place, -1).astype(np.int32)})

        yield from by_bytes(some, AT_ONCE)(frames)

    return sign


_SIGNED = "sig long, v long, hot int"


def hot_signatures(some: DataFrame, frequent, often: int = HOT, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """Signatures that ``often`` sets of a sample have (ascending, at most ``most``), and
    their leaders: of those sets the one with most signatures."""
    rows = some.mapInPandas(_signer(frequent), _SIGNED).select("sig", "v").distinct()
    rows = cut_lineage(rows.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("sig"))).where(F.col("n") >= often))
    weight = rows.groupBy(F.col("v").alias("of")).agg(F.count(F.lit(1)).alias("weight"))
    led = rows.join(weight, F.col("v") == F.col("of")).groupBy("sig").agg(F.max("n").alias("n"), F.max(F.struct("weight", "v")).alias("first"))
    top = led.orderBy(F.desc("n"), "sig").limit(most).select("sig", F.col("first.v").alias("v")).toPandas().sort_values("sig")
    return top["sig"].to_numpy(np.int64), top["v"].to_numpy(np.int64)


def led_rows(docs: DataFrame, frequent, hot) -> DataFrame:
    """(sig, v, leader) of all vertices that share a signature with another one. Each
    signature travels once. Frequent ones know their leader beforehand and are spread by
    vertex; of the others the smallest vertex leads, met first in the order of the sort."""

    def follow(frames):
        leaders = hot.value[1]
        last = None
        for frame in frames:
            sig, v, at = (frame[c].to_numpy() for c in ("sig", "v", "hot"))
            if not len(sig):
                continue
            same = np.concatenate([[last is not None and last[0] == sig[0]], sig[1:] == sig[:-1]])
            twice = same & np.concatenate([[last is not None and last[1] == v[0]], v[1:] == v[:-1]])
            # The first of each signature, or the one that a batch before began with.
            begins = np.maximum.accumulate(np.where(same, -1, np.arange(len(sig))))
            leader = np.where(begins >= 0, v[np.maximum(begins, 0)], last[2] if last else 0)
            if len(leaders):
                leader = np.where(at >= 0, leaders[np.maximum(at, 0)], leader)
            last = (sig[-1], v[-1], leader[-1])
            keep = np.flatnonzero((v != leader) & ~twice)
            if len(keep):
                yield pd.DataFrame({"sig": sig[keep], "v": v[keep], "leader": leader[keep]})

    rows = _texts(docs).select("text").mapInPandas(_signer(frequent, hot), _SIGNED)
    # An explicit number would stand in the way of adaptive execution.
    dealt = rows.repartition(F.when(F.col("hot") < 0, F.col("sig")).otherwise(F.col("v"))).sortWithinPartitions("sig", "v")
    return dealt.mapInPandas(follow, "sig long, v long, leader long")


def sketches(own: DataFrame, members: DataFrame) -> DataFrame:
    """(v, doc_id, h, sketch) of ``members`` (v, distinct), with one document each."""
    rows = own.join(members, "v", "left_semi")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "h", "sketch"))
    return cut_lineage(rows.groupBy("v").agg(first.alias("first")).select("v", "first.doc_id", "first.h", "first.sketch"))


def feature_sets(docs: DataFrame, sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """(v, features) of the vertices ``wanted`` (v, distinct), of which ``sets`` names a
    document each."""

    def found(frame: pd.DataFrame) -> pd.DataFrame:
        features, begins = shingles(frame["text"])
        # Texts of one hash may differ; only those of the vertex stay.
        own = np.flatnonzero(fingerprints(features, begins) == frame["v"].to_numpy(np.int64))
        return pd.DataFrame({"v": frame["v"].to_numpy()[own], "features": [features[begins[i] : begins[i + 1]].tobytes() for i in own]})

    texts = _texts(docs).select(F.col("doc_id").alias("other"), F.xxhash64("text").alias("other_h"), "text")
    named = broadcast_if_small(sets.join(wanted, "v").select("v", "doc_id", "h"))
    # By hash too: rows without an id would all meet each other.
    joined = texts.join(named, (F.col("h") == F.col("other_h")) & F.col("doc_id").eqNullSafe(F.col("other"))).select("v", "text")
    out = cut_lineage(joined.mapInPandas(by_bytes(found, AT_ONCE), "v long, features binary"))
    # Only repeated rows give a vertex twice; without them no set travels again.
    twice = out.groupBy("v").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count()
    return cut_lineage(out.dropDuplicates(["v"])) if twice else out


def _sketch(features: np.ndarray) -> bytes:
    """Features counted by hash in about a fourth as many cells (a power of two), at
    most 255 each. The cells of two sets differ in sum by no more than the sets do."""
    x = mix64(features)
    cells = max(32, 1 << len(x).bit_length() >> 2)
    count = np.bincount((x >> np.uint64(65 - cells.bit_length())).astype(np.int64), minlength=cells)
    return len(x).to_bytes(8, "little") + np.minimum(count, 255).astype(np.uint8).tobytes()


@F.pandas_udf(StructType([StructField(c, LongType()) for c in ("na", "nb", "delta")]))
def _at_least(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """Sizes of two sets and the least that they differ, by their sketches."""
    out = []
    for x, y in zip(a, b):
        n, m = int.from_bytes(x[:8], "little"), int.from_bytes(y[:8], "little")
        cells = min(len(x), len(y)) - 8
        p, q = (np.frombuffer(z, np.uint8, offset=8).reshape(cells, -1) for z in (x, y))
        # A cell at 255 may hold more and then tells nothing.
        sure = (p.max(axis=1) < 255) & (q.max(axis=1) < 255)
        apart = np.abs(p.sum(axis=1, dtype=np.int64) - q.sum(axis=1, dtype=np.int64))[sure].sum()
        out.append((n, m, max(int(apart), abs(n - m))))
    return pd.DataFrame(out, columns=["na", "nb", "delta"])


@F.pandas_udf(LongType())
def _difference(a: pd.Series, b: pd.Series) -> pd.Series:
    out = []
    for x, y in zip(a, b):
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        out.append(len(x) + len(y) - 2 * len(np.intersect1d(x, y, assume_unique=True)))
    return pd.Series(out, dtype=np.int64)


def _allowed(na, nb):
    """The most that linked sets of these sizes differ."""
    return F.floor((DENOMINATOR - NUMERATOR) * (na + nb) / (DENOMINATOR + NUMERATOR))


def measured(pairs: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b, na, nb, delta, linked) of pairs (a, b). ``delta`` is how much they differ;
    where sizes and cell counts already forbid a link, a lower bound of it."""
    rough = pairs.join(sets.select(F.col("v").alias("a"), F.col("sketch").alias("sa")), "a").join(sets.select(F.col("v").alias("b"), F.col("sketch").alias("sb")), "b")
    rough = cut_lineage(rough.select("a", "b", _at_least("sa", "sb").alias("m")).select("a", "b", "m.*"))
    close = rough.where(F.col("delta") <= _allowed(F.col("na"), F.col("nb"))).select("a", "b")
    held = feature_sets(docs, sets, close.select(F.col("a").alias("v")).union(close.select("b")).distinct())
    exact = close.join(held.select(F.col("v").alias("a"), F.col("features").alias("fa")), "a").join(held.select(F.col("v").alias("b"), F.col("features").alias("fb")), "b")
    exact = exact.select(F.col("a").alias("ea"), F.col("b").alias("eb"), _difference("fa", "fb").alias("exact"))
    out = rough.join(exact, (F.col("a") == F.col("ea")) & (F.col("b") == F.col("eb")), "left")
    linked = F.col("exact").isNotNull() & (F.col("exact") <= _allowed(F.col("na"), F.col("nb")))
    return cut_lineage(out.select("a", "b", "na", "nb", F.coalesce("exact", "delta").alias("delta"), linked.alias("linked")))


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(v, root): the smallest vertex reachable. Each round every vertex takes the
    smallest root among its neighbours' and then its root's root; the rounds grow with
    the logarithm of a component's width. Sums before each shuffle, no group in memory."""
    both = cut_lineage(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    roots = both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("root"))
    roots = cut_lineage(roots)
    while True:
        near = both.join(roots.select(F.col("v").alias("b"), F.col("root").alias("seen")), "b").groupBy(F.col("a").alias("v")).agg(F.min("seen").alias("seen"))
        # A root hears of smaller roots from any of its members.
        told = roots.join(near, "v")
        lower = told.groupBy(F.col("root").alias("of")).agg(F.min("seen").alias("low"))
        moved = told.join(lower, F.col("root") == F.col("of")).select("v", F.least("root", "seen", "low").alias("root"), F.col("root").alias("old"))
        moved = cut_lineage(moved)
        changed = moved.where("root <> old").limit(1).count()
        roots = moved.select("v", "root")
        if not changed:
            return roots


def _to_leader(rows: DataFrame) -> DataFrame:
    """(sig, v, leader) for all but the smallest vertex of each signature."""
    # Minima are summed before the shuffle, and the join can split a large group.
    rows = cut_lineage(rows)
    least = rows.groupBy("sig").agg(F.min("v").alias("leader"), F.max("v").alias("most"))
    least = cut_lineage(least.where("leader < most").select("sig", "leader"))
    return rows.join(least, "sig").where("v <> leader").distinct().select("sig", "v", "leader")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id; h and component_h
    are the hashes of the row's text and of the component's first text."""
    spark = docs.sparkSession
    every = cut_lineage(vertices(docs))
    own = every.drop("sketch")

    some = cut_lineage(_sample(docs, SAMPLE_ROWS))
    frequent = spark.sparkContext.broadcast(frequent_features(some))
    hot = spark.sparkContext.broadcast(hot_signatures(some, frequent, HOT))
    led = cut_lineage(led_rows(docs, frequent, hot))
    members = led.select("v").union(led.select("leader")).distinct()
    sets = sketches(every, members)
    edges, seed = None, 0
    while True:
        found = measured(led.select(F.col("leader").alias("a"), F.col("v").alias("b")).distinct(), sets, docs)
        new = found.where("linked").select("a", "b")
        edges = new if edges is None else edges.union(new)
        roots = components(spark, edges)
        more, led = _next_round(led, found, roots, sets, docs, frequent, seed + 1)
        seed += 1
        edges = edges.union(more)
        if not led.limit(1).count():
            roots = components(spark, edges)
            break
    named = own.join(roots.withColumnRenamed("v", "of"), F.col("v") == F.col("of"), "left").withColumn("root", F.coalesce("root", "v")).drop("of")
    first = named.where("root is not null").groupBy(F.col("root").alias("of")).agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "h")).alias("first"))
    out = named.join(first, F.col("root") == F.col("of"), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("first.doc_id", "doc_id").alias("component_id"), "h", F.coalesce("first.h", "h").alias("component_h"))


def links_between(a: list[np.ndarray], b: list[np.ndarray] | None) -> np.ndarray:
    """Which sets of ``a`` (rows) link with which of ``b``, or with others of ``a``."""
    both = a if b is None else a + b
    size = np.array([len(x) for x in both])
    flat = np.concatenate(both)
    owner = np.repeat(np.arange(len(both)), size)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    column = np.cumsum(new) - 1
    left = owner < len(a)
    # Only features on both sides count.
    ours = np.bincount(column, weights=left)
    theirs = ours - 1 if b is None else np.bincount(column, weights=~left)
    keep = ((ours > 0) & (theirs > 0))[column]
    column, owner = np.unique(column[keep], return_inverse=True)[1], owner[keep]
    shared = np.zeros((len(a), len(both) - (0 if b is None else len(a))), np.float32)
    step = max(CELLS // max(len(both), 1), 1)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        lo, hi = np.searchsorted(column, [at, at + step])
        grid = np.zeros((len(both), min(step, int(column[-1]) + 1 - at)), np.float32)
        grid[owner[lo:hi], column[lo:hi] - at] = 1
        shared += grid[: len(a)] @ (grid if b is None else grid[len(a) :]).T
    union = size[: len(a), None] + (size if b is None else size[len(a) :])[None, :] - shared
    return DENOMINATOR * shared >= NUMERATOR * union


def _folded(sketches: list[bytes], cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Sketches of one length summed to ``cells`` cells, and which of these hold one at 255."""
    x = np.frombuffer(b"".join(s[8:] for s in sketches), np.uint8).reshape(len(sketches), cells, -1)
    return x.sum(axis=2, dtype=np.int32), (x == 255).any(axis=2)


def may_link(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Which sets of ``a`` (rows) may link with which of ``b``, by sizes and sketches: all
    that do, and some that do not."""
    size, length = ([np.array([f(x) for x in side], np.int64) for side in (a, b)] for f in (lambda x: int.from_bytes(x[:8], "little"), lambda x: len(x) - 8))
    allowed = (DENOMINATOR - NUMERATOR) * (size[0][:, None] + size[1][None, :]) // (DENOMINATOR + NUMERATOR)
    out = np.abs(size[0][:, None] - size[1][None, :]) <= allowed
    for p in np.unique(length[0]):
        for q in np.unique(length[1]):
            one, two, cells = np.flatnonzero(length[0] == p), np.flatnonzero(length[1] == q), int(min(p, q))
            if not out[np.ix_(one, two)].any():
                continue
            (x, over_x), (y, over_y) = _folded([a[i] for i in one], cells), _folded([b[i] for i in two], cells)
            capped = over_x.any() or over_y.any()
            step = max(CELLS // (len(two) * cells), 1)
            for at in range(0, len(one), step):
                apart = np.abs(x[at : at + step, None, :] - y[None, :, :])
                # A cell at 255 may hold more and then tells nothing.
                if capped:
                    apart[over_x[at : at + step, None, :] | over_y[None, :, :]] = 0
                here = np.ix_(one[at : at + step], two)
                out[here] &= apart.sum(axis=2) <= allowed[here]
    return out


_BLOCK = ["leader", "ball", "i", "j"]


def _possible(frames):
    """For ``mapInPandas`` over rows in order of ``_BLOCK``: those that may link with a
    set across and are not joined with it, without their sketches."""

    def kept(frame: pd.DataFrame, begins: np.ndarray) -> pd.DataFrame:
        ball, i, j, side, root = (frame[c].to_numpy() for c in ("ball", "i", "j", "side", "root"))
        sketch, keep = frame["sketch"].tolist(), np.zeros(len(frame), bool)
        for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(frame)]):
            one, two = a + np.flatnonzero(side[a:b] == 0), a + np.flatnonzero(side[a:b] == 1)
            if i[a] == j[a] and not ball[a]:
                two = one
            if not len(one) or not len(two):
                continue
            may = root[one][:, None] != root[two][None, :]
            if may.any():
                may &= may_link([sketch[k] for k in one], [sketch[k] for k in two])
                keep[one[may.any(axis=1)]] = True
                keep[two[may.any(axis=0)]] = True
        return frame.loc[keep].drop(columns="sketch")

    rest = None
    for frame in frames:
        frame = frame.reset_index(drop=True) if rest is None else pd.concat([rest, frame], ignore_index=True)
        if not len(frame):
            continue
        new = np.ones(len(frame), bool)
        new[1:] = np.any([frame[c].to_numpy()[1:] != frame[c].to_numpy()[:-1] for c in _BLOCK], axis=0)
        begins = np.flatnonzero(new)
        # The last one may go on in the next batch.
        rest = frame.iloc[begins[-1] :]
        if len(begins) > 1:
            yield kept(frame.iloc[: begins[-1]], begins[:-1])
    if rest is not None and len(rest):
        yield kept(rest, np.zeros(1, np.int64))


def _compared(frame: pd.DataFrame) -> pd.DataFrame:
    """Links between the sides of two blocks: enough of them to join all that are linked
    and were not joined yet."""
    sets = [np.frombuffer(f, np.uint64) for f in frame["features"]]
    side = frame["side"].to_numpy()
    v, root = frame["v"].to_numpy(), frame["root"].to_numpy()
    one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    none = pd.DataFrame({"a": v[:0], "b": v[:0]})
    if not len(one) or not (len(two) or (frame["i"].iloc[0] == frame["j"].iloc[0] and not frame["ball"].iloc[0])):
        return none
    linked = links_between([sets[k] for k in one], [sets[k] for k in two] if len(two) else None)
    parent: dict[int, int] = {}

    def top(x):
        while parent.get(x, x) != x:
            parent[x] = x = parent.get(parent[x], parent[x])
        return x

    out = []
    other = two if len(two) else one
    for p, q in zip(*np.nonzero(linked)):
        x, y = top(root[one[p]]), top(root[other[q]])
        if x != y:
            parent[x] = y
            out.append((v[one[p]], v[other[q]]))
    return pd.DataFrame(out, columns=["a", "b"]) if out else none


def _next_round(led: DataFrame, found: DataFrame, roots: DataFrame, sets: DataFrame, docs: DataFrame, frequent, seed: int) -> tuple[DataFrame, DataFrame]:
    """New links, and the (sig, v, leader) that go on."""
    root = lambda v: roots.select(F.col("v").alias(v), F.col("root").alias(f"root_{v}"))
    facts = found.select(F.col("a").alias("leader"), F.col("b").alias("v"), "nb", "delta", "linked")
    facts = facts.join(root("v"), "v", "left").join(root("leader"), "leader", "left")
    facts = cut_lineage(facts.withColumn("root_v", F.coalesce("root_v", "v")).withColumn("root_leader", F.coalesce("root_leader", "leader")))
    outside = F.when(~F.col("linked"), F.col("root_v"))
    blocks = lambda side: F.greatest(F.ceil(F.count_if(side) / BLOCK_SETS), F.ceil(F.sum(F.when(side, F.col("nb"))) / BLOCK_FEATURES), F.lit(1)).cast("int")
    stats = facts.groupBy(F.col("leader").alias("of")).agg(
        F.count_if("linked").alias("ball"),
        F.count_if(~F.col("linked")).alias("rest"),
        F.max(F.when(F.col("linked"), F.col("delta"))).alias("far"),
        F.max(F.when(F.col("linked"), F.col("nb"))).alias("widest"),
        F.min(outside).alias("lo"),
        F.max(outside).alias("hi"),
        blocks(F.col("linked")).alias("ball_blocks"),
        blocks(~F.col("linked")).alias("rest_blocks"),
    )
    rows = cut_lineage(facts.join(stats.where("rest > 0"), F.col("leader") == F.col("of")).drop("of"))
    # Outside, but not surely clear of the ball. The leader itself has been compared.
    unclear = ~F.col("linked") & (F.col("root_v") != F.col("root_leader")) & (F.col("delta") <= F.col("far") + _allowed(F.col("nb"), F.col("widest")))
    rows = rows.withColumn("unclear", F.coalesce(unclear, F.lit(False)))
    many = (F.col("lo") != F.col("hi")) & (F.col("rest_blocks") > BLOCKS)
    among = rows.where(~F.col("linked") & (F.col("lo") != F.col("hi")) & (F.col("rest_blocks") <= BLOCKS))
    place = lambda n: F.pmod(F.xxhash64("v"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = [*_BLOCK, "side", "v", "root"]
    mine = among.select("leader", F.lit(False).alias("ball"), place("rest_blocks").alias("own"), every("rest_blocks").alias("k"), "v", F.col("root_v").alias("root"))
    mine = mine.withColumn("i", F.least("own", "k")).withColumn("j", F.greatest("own", "k")).withColumn("side", (F.col("own") > F.col("k")).cast("int")).select(*columns)
    # Only balls that something outside may touch.
    touched = rows.where("unclear").select(F.col("leader").alias("of")).distinct()
    ball = rows.where("linked").join(touched, F.col("leader") == F.col("of"), "left_semi")
    near = rows.where("unclear").select("leader", F.lit(True).alias("ball"), place("rest_blocks").alias("i"), every("ball_blocks").alias("j"), F.lit(0).alias("side"), "v", F.col("root_v").alias("root"))
    near = near.union(ball.select("leader", F.lit(True).alias("ball"), every("rest_blocks").alias("i"), place("ball_blocks").alias("j"), F.lit(1).alias("side"), "v", F.col("root_v").alias("root")))
    sides = mine.union(near.select(*columns)).join(sets.select(F.col("v").alias("of"), "sketch"), F.col("v") == F.col("of")).drop("of")
    dealt = sides.repartition(*_BLOCK).sortWithinPartitions(*_BLOCK)
    pairs = cut_lineage(dealt.mapInPandas(_possible, "leader long, ball boolean, i int, j int, side int, v long, root long"))
    held = feature_sets(docs, sets, pairs.select("v").distinct()).withColumnRenamed("v", "of")
    pairs = pairs.join(held, F.col("v") == F.col("of")).drop("of")
    links = cut_lineage(pairs.groupBy(*_BLOCK).applyInPandas(_compared, "a long, b long"))
    # Remainders of too many blocks get another leader, or other signatures.
    large = rows.where(many & ~F.col("linked")).select(F.col("leader").alias("of"), F.col("v").alias("out"), "ball", "rest")
    large = led.join(large, (F.col("leader") == F.col("of")) & (F.col("v") == F.col("out"))).select("sig", "v", "ball", "rest")
    large = cut_lineage(large)
    if not large.limit(1).count():
        return links, large.select("sig", "v", F.col("v").alias("leader"))
    again = large.where(F.col("ball") * 8 >= F.col("rest")).select("sig", "v")
    signed_again = _signed_again(large.where(F.col("ball") * 8 < F.col("rest")).select("sig", "v"), sets, docs, frequent, seed)
    return links, cut_lineage(_to_leader(again.union(signed_again)))


def _signed_again(rows: DataFrame, sets: DataFrame, docs: DataFrame, frequent, seed: int) -> DataFrame:
    """(sig, v) of groups too large to pair, refined by signatures under another seed."""

    def again(frame: pd.DataFrame) -> pd.DataFrame:
        own = [np.frombuffer(f, np.uint64) for f in frame["features"]]
        sig, of = signatures(np.concatenate(own), np.concatenate([[0], np.cumsum([len(x) for x in own])]), frequent.value, seed)
        return pd.DataFrame({"other": frame["v"].to_numpy()[of], "new": sig.view(np.int64)})

    signs = feature_sets(docs, sets, rows.select("v").distinct()).mapInPandas(by_bytes(again, AT_ONCE, "features"), "other long, new long")
    return rows.join(signs, F.col("v") == F.col("other")).select(F.xxhash64("sig", "new").alias("sig"), "v")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component: the smallest doc_id, of repeated ids the smallest
    text hash, of repeated rows any. Rows without a word are no copies and all stay."""
    near = near_duplicates(docs.where(n_words(F.col("text")) > 0))
    kept = near.where(F.col("doc_id").eqNullSafe(F.col("component_id")) & F.col("h").eqNullSafe(F.col("component_h")))
    kept = broadcast_if_small(kept.select(F.col("doc_id").alias("kept_id"), F.col("h").alias("kept_h")).distinct())
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.xxhash64(docs["text"].cast("string")).alias("h"), docs["doc_id"].cast("long").alias("id"), (n_words(docs["text"]) == 0).alias("blank"))
    first = rows.where(~F.col("blank")).join(kept, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("h") == F.col("kept_h")), "left_semi")
    return first.dropDuplicates(["id", "h"]).unionByName(rows.where("blank")).select("row.*")


@query("op8_near")
def op8(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
