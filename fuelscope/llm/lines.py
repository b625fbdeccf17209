"""Line dedup by site-relative frequency.

A line is boilerplate of a host when more than ``needed(total, ratio)`` of the host's
``total`` pages contain it: ``ratio`` of them, one, and for the chance of few pages a part
that grows with the logarithm of their number. So two pages of two, three of four or
five and eleven of a hundred make boilerplate at the default ratio, a single page never,
and on large hosts the ratio alone counts; there is no least number of pages. Such lines
are dropped from every page of that host. Repeats inside a page count once, blank lines
are never boilerplate, and lines are compared whole without surrounding white space, in
texts of any length. Null hosts form one host; null texts have no lines and stay null;
repeated rows are pages of their own; a page of boilerplate only becomes an empty text;
an empty table gives an empty one. Other columns pass through.

Lines travel as 64-bit hashes and meet partial sums before the shuffle, so a host
with a third of all pages costs no task more than others. The boilerplate of a host
is at most (its distinct lines per page / ratio) lines; it is broadcast only behind a
row count, and joined by shuffle beyond it. Texts are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import broadcast_if_small, cut_lineage
from .common import query, read

RATIO = 0.05


def needed(total: Column, ratio: float = RATIO) -> Column:
    return 1 + ratio * total + (1 - ratio) * F.ln(total)


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(pages: DataFrame, ratio: float = RATIO) -> DataFrame:
    """(host, line) of ``pages`` (host, lines: array of line hashes)."""
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("total"))
    seen = pages.select("host", F.explode("lines").alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("seen")).where(F.col("seen") > 1)
    totals = totals.withColumnRenamed("host", "own")
    return seen.join(totals, F.col("host").eqNullSafe(F.col("own"))).where(F.col("seen") > needed(F.col("total"), ratio)).select("host", "line", "seen", "total")


def drop_boilerplate(docs: DataFrame, text: str = "text", host: Column | None = None, ratio: float = RATIO, name: str = "n_dropped") -> DataFrame:
    """``docs`` without boilerplate lines, and how many went as a long ``name``, which
    replaces a column of that name."""
    host = docs["source"] if host is None else host
    value = docs[text].cast("string")
    hashes = F.array_distinct(F.transform(F.filter(_lines(value), lambda x: _trimmed(x) != ""), lambda x: F.xxhash64(_trimmed(x))))
    # Equal rows need equal answers, so the content stands for the row.
    key = F.xxhash64(value, host)
    pages = docs.select(key.alias("page"), host.alias("host"), F.coalesce(hashes, F.array().cast("array<bigint>")).alias("lines"))
    common = broadcast_if_small(boilerplate(pages, ratio).select(F.col("host").alias("own"), F.col("line").alias("common")))
    hits = (
        pages.select("page", "host", F.explode("lines").alias("line"))
        .join(common, (F.col("line") == F.col("common")) & F.col("host").eqNullSafe(F.col("own")))
        .groupBy("page")
        .agg(F.collect_set("line").alias("gone"))
        .withColumnRenamed("page", "hit_page")
    )
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), value.alias("value"), key.alias("page")).join(hits, F.col("page") == F.col("hit_page"), "left")
    stays = F.filter(_lines(F.col("value")), lambda x: (_trimmed(x) == "") | ~F.array_contains(F.col("gone"), F.xxhash64(_trimmed(x))))
    cut = F.when(F.col("gone").isNull(), F.col("value")).otherwise(F.array_join(stays, "\n"))
    dropped = F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size(_lines(F.col("value"))) - F.size(stays)).cast("long")
    return row.select(*[cut.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns if c != name], dropped.alias(name))


OP10_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text FROM documents),
l AS (SELECT r, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d),
k AS (SELECT r, source, i, line, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t FROM l),
n AS (SELECT source, count(*) AS total FROM d GROUP BY source),
s AS (SELECT source, t, count(DISTINCT r) AS seen FROM k WHERE t <> '' GROUP BY source, t),
b AS (SELECT s.source, s.t FROM s JOIN n ON s.source IS NOT DISTINCT FROM n.source WHERE seen > 1 + 0.05 * total::DOUBLE + 0.95 * ln(total)),
m AS (SELECT k.r, string_agg(k.line, chr(10) ORDER BY k.i) FILTER (WHERE b.t IS NULL) AS kept, count(b.t) AS gone FROM k LEFT JOIN b ON k.t = b.t AND k.source IS NOT DISTINCT FROM b.source GROUP BY k.r)
SELECT d.doc_id, m.gone::BIGINT AS n_dropped, md5(coalesce(m.kept, '')) AS kept_md5 FROM d LEFT JOIN m USING (r)
"""


@query("op10_lines", OP10_SQL)
def op10(spark, sf_dir):
    out = drop_boilerplate(read(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "n_dropped", F.md5(F.coalesce("text", F.lit(""))).alias("kept_md5"))
