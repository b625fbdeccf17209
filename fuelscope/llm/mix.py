"""Mixing sources to target weights by weighted fair queueing.

The documents of a source are shuffled by a hash and queue up behind each other; up
to ``epochs`` rounds of a source follow one another. A copy leaves its queue at the
virtual time ``tokens of its source so far / target of its source``. All copies are
ordered by virtual time and the order is cut where the budget (all tokens) is spent.

No sort of everything is needed. Queues are summed in buckets of the shuffle hash,
virtual time (spread evenly over the tokens by its making) in buckets of time; only
the bucket in which the budget ends is ordered row by row, and the last copy in it
tells every row how many of its copies lie before the cut. The number of buckets
follows the row count, so no window holds a source whole. Sources and slots are as many
as the data has them; their running sums are taken over ranges of them first, then
inside each range.

Null sources form one source, last in order. Null texts have size 0 and are never
copied; repeated rows are documents of their own; an empty table gives an empty mix.
Other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut_lineage
from .common import fresh_name, n_words, query, read

# Rows of one bucket of a queue and of one slot of virtual time, on average.
BUCKET_ROWS = 2_000
SLOT_ROWS = 20_000


def running(rows: DataFrame, order: list, sums: dict[str, str]) -> DataFrame:
    """``rows`` with the sums of columns (by new name) over all rows before each in the
    order, in which no two rows are equal: of ranges of rows, one for each partition,
    then inside a range."""
    # Written, so that the ranges hold.
    rows = cut_lineage(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy("_range").agg(*[F.sum(c).alias(f"_{name}") for name, c in sums.items()])
    ranges = ranges.select(F.col("_range").alias("_of"), *[F.coalesce(F.sum(f"_{name}").over(earlier), F.lit(0)).alias(f"_{name}") for name in sums])
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.join(F.broadcast(ranges), F.col("_range") == F.col("_of"))
    return joined.select(*[c for c in rows.columns if c != "_range"], *[(F.col(f"_{name}") + F.coalesce(F.sum(c).over(within), F.lit(0))).alias(name) for name, c in sums.items()])


def targets(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), epochs: int = 3) -> DataFrame:
    """One row per source of ``docs`` (source, size): its rank, size and target. Sources
    filled to ``epochs`` times their size leave their share to the others by weight: in
    order of size per weight, the filled ones come first, so running sums find them."""
    per = docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")).withColumn("one", F.lit(1))
    per = running(per, [F.col("source").asc_nulls_last()], {"rank": "one"}).withColumn("rank", F.col("rank") + 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int")).cast("long")
    full = F.col("source_size") * epochs
    per = per.withColumn("weight", weight).withColumn("full", full).withColumn("per_weight", F.col("full") / F.col("weight"))
    per = running(per, ["per_weight", "rank"], {"used": "full", "gone": "weight"})
    every = per.agg(F.sum("source_size").alias("total"), F.sum("weight").alias("all_weight"), F.sum("n").alias("rows"))
    filled = F.col("full") * (F.col("all_weight") - F.col("gone")) <= F.col("weight") * (F.col("total") - F.col("used"))
    per = cut_lineage(per.crossJoin(F.broadcast(every)).withColumn("filled", filled))
    given = per.where("filled").agg(F.coalesce(F.sum("full"), F.lit(0)).alias("full_sum"), F.coalesce(F.sum("weight"), F.lit(0)).alias("full_weight"))
    rest, open_weight = F.col("total") - F.col("full_sum"), F.col("all_weight") - F.col("full_weight")
    target = F.when(F.col("filled"), F.col("full").cast("double")).otherwise(F.col("weight") * rest / open_weight)
    return per.crossJoin(F.broadcast(given)).select("source", "rank", "source_size", "total", "rows", "n", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), epochs: int = 3, seed: str = "mix", name: str = "mix") -> DataFrame:
    """``docs`` (doc_id, source, text, ...) with a struct ``name``: size, source_size,
    target, copies, taken and the virtual time of the first copy. It replaces a column
    of that name."""
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs["doc_id"].alias("doc_id"),
        docs["source"].alias("source"),
        n_words(docs["text"]).alias("size"),
        # Rows without an id are told apart by their texts, so that they spread as others do.
        F.md5(F.concat(F.lit(seed), F.coalesce(docs["doc_id"].cast("string"), F.concat(F.lit("-"), F.md5(F.coalesce(docs["text"].cast("string"), F.lit(""))))))).alias("h"),
    )
    narrow = cut_lineage(rows.select("doc_id", "source", "size", "h"))
    sources = cut_lineage(targets(narrow, weights, epochs))

    same = lambda a, b: a["source"].eqNullSafe(b["source"])

    def queued(some: DataFrame) -> DataFrame:
        """Each row with the tokens its source has queued up to and with it."""
        bucketed = some.join(sources.withColumnRenamed("source", "own"), F.col("source").eqNullSafe(F.col("own"))).drop("own")
        place = F.conv(F.substring("h", 1, 8), 16, 10).cast("long") * (1 + F.floor(F.col("n") / BUCKET_ROWS))
        bucketed = bucketed.withColumn("bucket", F.shiftright(place, 32))
        sums = narrow_sums().alias("s")
        joined = bucketed.join(sums, (F.col("s.s_rank") == F.col("rank")) & (F.col("s.s_bucket") == F.col("bucket")))
        within = Window.partitionBy("rank", "bucket").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
        return joined.withColumn("so_far", F.col("s.before") + F.sum("size").over(within)).drop("s_rank", "s_bucket", "before")

    def narrow_sums() -> DataFrame:
        own = narrow.join(sources.withColumnRenamed("source", "own"), F.col("source").eqNullSafe(F.col("own")))
        place = F.conv(F.substring("h", 1, 8), 16, 10).cast("long") * (1 + F.floor(F.col("n") / BUCKET_ROWS))
        sums = own.groupBy(F.col("rank").alias("s_rank"), F.shiftright(place, 32).alias("s_bucket")).agg(F.sum("size").alias("in_bucket"))
        earlier = Window.partitionBy("s_rank").orderBy("s_bucket").rowsBetween(Window.unboundedPreceding, -1)
        return sums.select("s_rank", "s_bucket", F.coalesce(F.sum("in_bucket").over(earlier), F.lit(0)).alias("before"))

    def time(epoch) -> F.Column:
        return (F.col("so_far") + epoch * F.col("source_size")) / F.col("target")

    key = ["time", "rank", "epoch", "h", "doc_id", "size"]
    copies = (
        queued(narrow)
        .where(F.col("size") > 0)
        .select("*", F.explode(F.expr(f"sequence(0L, {epochs - 1}L)")).alias("epoch"))
        .withColumn("time", time(F.col("epoch")))
        # Beyond time 1 every queue is past its target but for the copy at the cut.
        .withColumn("slot", F.floor(F.col("time") * (1 + F.floor(F.col("rows") / SLOT_ROWS))))
    )
    copies = cut_lineage(copies.select("slot", "total", *key))
    slots = copies.groupBy("slot").agg(F.sum("size").alias("in_slot"), F.max("total").alias("total"))
    slots = running(slots, ["slot"], {"before": "in_slot"})
    last = slots.where((F.col("before") <= F.col("total")) & (F.col("before") + F.col("in_slot") > F.col("total"))).select("slot", "before")
    order = Window.partitionBy("slot").orderBy(*key).rowsBetween(Window.unboundedPreceding, 0)
    edge = (
        copies.join(last, "slot")
        .withColumn("spent", F.col("before") + F.sum("size").over(order))
        .where(F.col("spent") > F.col("total"))
        .agg(F.min(F.struct(*key)).alias("edge"))
    )
    # One row: the first copy that no longer fits. It joins as a column of every row.
    ordered = queued(rows).crossJoin(F.broadcast(edge))
    taken = [
        F.when((F.col("size") > 0) & (F.col("edge").isNull() | (F.struct(time(F.lit(e)).alias("time"), "rank", F.lit(e).cast("long").alias("epoch"), "h", "doc_id", "size") < F.col("edge"))), 1).otherwise(0)
        for e in range(epochs)
    ]
    n = sum(taken[1:], taken[0]).cast("long")
    # A source without a word has target 0.
    return ordered.select(
        *[F.col("row")[c].alias(c) for c in docs.columns if c != name],
        F.struct("size", "source_size", "target", n.alias("copies"), (n * F.col("size")).alias("taken"), F.when(F.col("target") > 0, time(F.lit(0))).alias("time")).alias(name),
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row as often as it is taken."""
    name = fresh_name(docs, "mix")
    copies = F.col(name)["copies"]
    out = mix(docs, name=name, **options).where(copies > 0)
    return out.select(*docs.columns, F.explode(F.sequence(F.lit(1), copies.cast("int"))).alias(name)).drop(name)


OP1_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5(concat('mix', coalesce(doc_id::VARCHAR, concat('-', md5(coalesce(text, '')))))) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source),
w AS (SELECT *, (rank - 1) % 3 + 1 AS weight, source_size * 3 AS fill, sum(source_size) OVER ()::BIGINT AS total FROM s),
c AS (SELECT *, sum(weight) OVER ()::BIGINT AS all_weight, coalesce(sum(fill) OVER p, 0)::BIGINT AS used, coalesce(sum(weight) OVER p, 0)::BIGINT AS gone
      FROM w WINDOW p AS (ORDER BY fill / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, fill * (all_weight - gone) <= weight * (total - used) AS filled FROM c),
t AS (SELECT source, rank, source_size, total, CASE WHEN filled THEN fill::DOUBLE ELSE
      (weight * (total - coalesce(sum(fill) FILTER (WHERE filled) OVER (), 0)))::BIGINT::DOUBLE / (all_weight - coalesce(sum(weight) FILTER (WHERE filled) OVER (), 0))::BIGINT::DOUBLE END AS target FROM f),
q AS (SELECT d.doc_id, d.size, d.h, t.rank, t.source_size, t.total, t.target, sum(d.size) OVER (PARTITION BY t.rank ORDER BY d.h, d.doc_id, d.size ROWS UNBOUNDED PRECEDING)::BIGINT AS so_far
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (SELECT q.*, e.epoch, CASE WHEN target > 0 THEN (so_far + e.epoch * source_size)::DOUBLE / target END AS vt FROM q, (SELECT unnest([0, 1, 2]) AS epoch) e),
o AS (SELECT *, sum(size) OVER (ORDER BY vt, rank, epoch, h, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS spent FROM k)
SELECT doc_id, size, source_size, target, sum(CASE WHEN spent <= total THEN size ELSE 0 END)::BIGINT AS taken FROM o GROUP BY ALL
"""


@query("op1_mix", OP1_SQL)
def op1(spark, sf_dir):
    out = mix(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")
