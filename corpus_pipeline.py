"""A corpus cleaned, balanced and packed, stage by stage.

Each stage reads what the one before kept and calls one operator of ``fuelscope.llm``.
Stages are written to the shared folder and read back, so a lost executor repeats one
stage only. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from fuelscope.llm import lines, mix, near, packing, quality
from fuelscope.llm.common import fresh_name
from fuelscope.session import cut_lineage, prepare

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    prepare(spark)
    return quality.kept(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the boilerplate lines of their source; n_chars follows the text."""
    prepare(spark)
    out = lines.drop_boilerplate(docs, name=fresh_name(docs, "n_dropped")).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    prepare(spark)
    return near.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    prepare(spark)
    return mix.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their ids, each with its sequence and place there.
    Rows with the same doc_id and text are copies, numbered from 1."""
    prepare(spark)
    same = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("doc_id")
    numbered = docs.select("doc_id", "text").withColumn("copy", F.row_number().over(same))
    # Ids stay out of the packing, which needs lengths only.
    pieces = cut_lineage(packing.pieces(numbered, with_ids=True, copy="copy").withColumn("row", F.monotonically_increasing_id()))
    placed = packing.pack(pieces.select("row", "length")).drop("length")
    return pieces.join(placed, "row").drop("row")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("best_fit_packing", packed),
]

# Tokenizing and near-duplicate groups have no SQL form; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
