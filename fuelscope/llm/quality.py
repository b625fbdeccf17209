"""Quality rules as a short-circuit cascade.

Every rule is timed and counted on a bounded sample; the rules then run in falling
order of rejections per second, and a document leaves at the first rule that rejects
it. The verdict is the same in any order; the order only saves work.

Words are runs of anything but ASCII white space. A null or empty text has no word
and is rejected (it has fewer than 50). Repeated rows are judged alike; an empty
table gives an empty result.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import fresh_name, in_batches, query, read, words

# Rows timed before the rules are ordered, about. It sets the estimate's cost only.
SAMPLE_ROWS = 2_000

_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"


class Facts:
    """What the rules ask about a text, worked out when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.raw = self.text.encode("utf-8", "surrogatepass")

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - len(self.raw) + len(self.raw.translate(None, _SPACE))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, _SYMBOLS))

    @cached_property
    def n_lines(self) -> int:
        return sum(1 for line in self.raw.split(b"\n") if line.strip(_SPACE))

    @cached_property
    def n_dup_lines(self) -> int:
        lines = [line for line in self.raw.split(b"\n") if line.strip(_SPACE)]
        return len(lines) - len(set(lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside three-word windows that occur twice or more."""
        if self.n_words < 4:
            return 0
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in self.words), np.int64, self.n_words)
        pair = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
        _, which, count = np.unique(pair[:-1] * np.int64(len(number)) + ids[2:], return_inverse=True, return_counts=True)
        again = count[which] > 1
        covered = np.zeros(self.n_words, bool)
        for k in range(3):
            covered[k : k + len(again)] |= again
        return int(covered.sum())


# Name -> whether the rule rejects. The first two are the base rules.
RULES: dict[str, Callable[[Facts], bool]] = {
    "few_words": lambda f: f.n_words < 50,
    "repeated_words": lambda f: 100 * f.n_repeat_words > 50 * f.n_words,
    "symbols": lambda f: 4 * f.n_symbols > f.n_words,
    "word_length": lambda f: not 2 * f.n_words <= f.word_chars <= 20 * f.n_words,
    "repeated_lines": lambda f: f.n_dup_lines >= 3 and 2 * f.n_dup_lines > f.n_lines,
}
BASE = ("few_words", "repeated_words")


def ordered_rules(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rules by rejections per second on a sample. One row per rule reaches the driver."""

    def timed(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for name, rejects in RULES.items():
            facts = [Facts(t) for t in frame["text"]]
            start = time.perf_counter()
            rejected = sum(map(rejects, facts))
            out.append((name, time.perf_counter() - start, rejected))
        return pd.DataFrame(out, columns=["rule", "seconds", "rejected"])

    # By hash, so that no task gathers rows of all others.
    share = F.lit(max(docs.count() // sample_rows, 1))
    sample = docs.select(F.col("text").cast("string").alias("text")).where(F.pmod(F.xxhash64("text"), share) == 0)
    cost = sample.mapInPandas(in_batches(timed), "rule string, seconds double, rejected long").groupBy("rule").agg(F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected"))
    gain = {r["rule"]: r["rejected"] / max(r["seconds"], 1e-9) for r in cost.collect()}
    return sorted(RULES, key=lambda name: (-gain.get(name, 0.0), list(RULES).index(name)))


def judge(docs: DataFrame, rules: list[str] | None = None, facts: bool = False, name: str = "quality") -> DataFrame:
    """``docs`` (with a column text) and a struct ``name``: the first rule that
    rejects (null if kept) and, with ``facts``, all counts and the base verdict."""
    rules = ordered_rules(docs) if rules is None else rules
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    @F.pandas_udf("rejected_by string, base_failed boolean, " + ", ".join(f"{c} long" for c in counts) if facts else "rejected_by string")
    def verdict(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            f = Facts(text)
            by = next((name for name in rules if RULES[name](f)), None)
            out.append((by, any(RULES[name](f) for name in BASE), *(getattr(f, c) for c in counts)) if facts else (by,))
        return pd.DataFrame(out, columns=["rejected_by", "base_failed", *counts] if facts else ["rejected_by"])

    return docs.withColumn(name, verdict(F.col("text").cast("string")))


def kept(docs: DataFrame) -> DataFrame:
    name = fresh_name(docs, "quality")
    return judge(docs, name=name).where(F.col(name)["rejected_by"].isNull()).select(*docs.columns)


OP3_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
b AS (SELECT r, doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
      list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
t AS (SELECT r, unnest(generate_series(1, len(w) - 2)) AS i, unnest(list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM d WHERE len(w) >= 3),
a AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM t),
v AS (SELECT r, count(DISTINCT p)::BIGINT AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM a WHERE n > 1) GROUP BY r),
f AS (SELECT b.doc_id, n_words, word_chars, n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines, coalesce(v.n, 0)::BIGINT AS n_repeat_words FROM b LEFT JOIN v USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 4 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR (n_dup_lines >= 3 AND 2 * n_dup_lines > n_lines)) AS kept
FROM f
"""


@query("op3_quality", OP3_SQL)
def op3(spark, sf_dir):
    out = judge(read(spark, sf_dir, "documents").select("doc_id", "text"), facts=True)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return out.select("doc_id", *[f"quality.{c}" for c in counts], "quality.base_failed", F.col("quality.rejected_by").isNull().alias("kept"))
