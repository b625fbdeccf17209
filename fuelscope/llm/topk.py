"""Exact top-k inner products by dual-tree search over cover trees.

Queries and candidates are dealt to blocks of bounded size; each pair of a query block
and a candidate block is one task's work, and the best k of the blocks are ranked per
query. Inside, both sides stand in cover trees: a node holds its points within a
radius of its centre, its children's centres are points farther apart than half the
radius, and together they cover it. For centres q, c and radii s, r no pair of points
below two nodes scores more than ``qc + s |c| + r |q| + s r``; where that stays under the
worst kth score that any query of the group still has, the pair of nodes is pruned.

Components are ``floor(256 x)``, whole numbers, so scores are exact; those too large for
exact doubles are multiplied as Python integers, unpruned. Ties go to the smaller id.
Rows with a null id, a null vector, or a null or non-finite component take no part. A
query meets every row but those with its own id; vectors of different length are
compared over the shorter. An empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut_lineage
from .common import query, read

BLOCK_ROWS = 4_096
LEAF = 128
# A node whose first PROBES children hold hardly more than themselves stays a leaf.
PROBES = 16
# Products of sums below this are exact in doubles.
_EXACT = float(1 << 53)


class Node:
    __slots__ = ("center", "radius", "norm", "rows", "children")

    def __init__(self, center, radius, rows):
        self.center, self.radius, self.rows, self.children = center, radius, rows, []
        self.norm = float(np.sqrt(center @ center))


def cover_tree(points: np.ndarray) -> Node:
    """Radii halve from level to level; a centre is its own first child."""

    def grow(rows: np.ndarray, center: int, gap: np.ndarray) -> Node:
        node = Node(points[center], float(gap.max()), rows)
        if len(rows) <= LEAF or node.radius == 0:
            return node
        reach, left = node.radius / 2, np.ones(len(rows), bool)
        next_center, next_gap = center, gap
        while True:
            took = left & (next_gap <= reach)
            node.children.append(grow(rows[took], next_center, next_gap[took]))
            left &= ~took
            if not left.any():
                return node
            if len(node.children) == PROBES and len(rows) - left.sum() < len(rows) // 20 + PROBES:
                # Points all far apart: smaller radii would part them one by one.
                node.children = []
                return node
            next_center = int(rows[np.argmax(left)])
            delta = points[rows] - points[next_center]
            next_gap = np.sqrt(np.einsum("ij,ij->i", delta, delta))

    delta = points - points[0]
    return grow(np.arange(len(points)), 0, np.sqrt(np.einsum("ij,ij->i", delta, delta)))


def dual_tree(queries: np.ndarray, query_ids: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best scores and their ids for every query, -inf where there are fewer."""
    score, who = np.full((len(queries), k), -np.inf), np.full((len(queries), k), np.iinfo(np.int64).max)

    def meet(q: np.ndarray, c: np.ndarray) -> None:
        got = queries[q] @ points[c].T
        got[query_ids[q][:, None] == ids[c][None, :]] = -np.inf
        hopeful = got.max(axis=1) >= score[q, k - 1]
        if not hopeful.any():
            return
        q, got = q[hopeful], got[hopeful]
        if got.shape[1] > 4 * k:
            # Only what reaches the kth best of these can be among the best, ties included.
            edge = np.partition(got, got.shape[1] - k, axis=1)[:, got.shape[1] - k]
            some = np.flatnonzero((got >= edge[:, None]).any(axis=0))
            got, c = got[:, some], c[some]
        s = np.concatenate([score[q], got], axis=1)
        w = np.concatenate([who[q], np.broadcast_to(ids[c], got.shape)], axis=1)
        order = np.lexsort((w, -s))[:, :k]
        score[q], who[q] = np.take_along_axis(s, order, 1), np.take_along_axis(w, order, 1)

    def bound(a: Node, b: Node) -> float:
        best = float(a.center @ b.center) + a.radius * b.norm + b.radius * a.norm + a.radius * b.radius
        # Radii and norms are rounded; the slack covers it.
        return best + 1e-9 * (abs(best) + a.norm * b.norm + 1)

    todo = [(cover_tree(queries), cover_tree(points))]
    while todo:
        a, b = todo.pop()
        if bound(a, b) < score[a.rows, k - 1].min():
            continue
        if not a.children and not b.children:
            meet(a.rows, b.rows)
        elif a.children and (not b.children or a.radius > b.radius):
            todo += [(x, b) for x in a.children]
        else:
            # The most promising is taken first, so that bounds rise early.
            todo += sorted(((a, y) for y in b.children), key=lambda p: float(p[0].center @ p[1].center))
    return score, who


def _stack(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return np.floor(256 * out)


def _best_of_block(queries: pd.DataFrame, points: pd.DataFrame, k: int) -> pd.DataFrame:
    columns = ["query_id", "vec_id", "score"]
    if not len(queries) or not len(points):
        return pd.DataFrame({c: np.zeros(0, np.int64) for c in columns})
    width = max(max(map(len, queries["v"])), max(map(len, points["v"])))
    q, c = _stack(queries["v"], width), _stack(points["v"], width)
    q_ids, ids = queries["vec_id"].to_numpy(np.int64), points["vec_id"].to_numpy(np.int64)
    if float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * width < _EXACT:
        score, who = dual_tree(q, q_ids, c, ids, k)
        at, rank = np.nonzero(np.isfinite(score))
        return pd.DataFrame({"query_id": q_ids[at], "vec_id": who[at, rank], "score": score[at, rank].astype(np.int64)})
    exact_c = [[int(x) for x in row] for row in c]
    out = []
    for i, row in enumerate(q):
        mine = [int(x) for x in row]
        found = sorted((-sum(a * b for a, b in zip(mine, other)), j) for j, other in zip(ids.tolist(), exact_c) if j != q_ids[i])
        # What exceeds 64 bits stands at their end.
        out += [(q_ids[i], j, max(min(-s, (1 << 63) - 1), -(1 << 63))) for s, j in found[:k]]
    return pd.DataFrame(out, columns=columns)


def top_k(vectors: DataFrame, is_query, k: int = 5, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score; ``vectors`` has vec_id and embedding, ``is_query``
    is a condition on them."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.coalesce(odd, F.lit(False))
    rows = cut_lineage(vectors.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), is_query.alias("asks")))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("q")).first()
    blocks, groups = -(-size["n"] // block_rows) or 1, -(-size["q"] // block_rows) or 1
    # Repeated rows have one place each, so they are spread too.
    place = F.xxhash64("vec_id", F.monotonically_increasing_id())
    points = rows.select("vec_id", "v", F.pmod(place, F.lit(blocks)).alias("block"), F.explode(F.expr(f"sequence(0L, {groups - 1}L)")).alias("grp"))
    asked = rows.where("asks").dropDuplicates(["vec_id", "v"]).select("vec_id", "v", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).alias("grp"))
    asked = asked.select("vec_id", "v", F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")).alias("block"), "grp")
    best = asked.groupBy("block", "grp").cogroup(points.groupBy("block", "grp")).applyInPandas(lambda a, b: _best_of_block(a, b, k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


OP9_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op9_topk", OP9_SQL)
def op9(spark, sf_dir):
    return top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
