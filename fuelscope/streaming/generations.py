"""The current row of every key, kept by micro-batches in buckets of the key's hash.

A batch merges into the buckets that its keys fall in, written anew in a folder of the
batch, and then publishes a list that names the folder of every bucket: a generation.
Readers take the newest list, so they touch one row of each key and never see half a
batch. A repeated batch starts from the generation before it and changes nothing. The
two newest generations are kept, for readers that began on the older one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..joins import join_same
from ..session import cut_lineage

BUCKETS = 64
LIST = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("batch", T.LongType())])


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


def _numbers(spark: SparkSession, folder: str, prefix: str, complete: bool) -> list[int]:
    """Numbers of the folders ``prefix=N``; on request only those whose write ended."""
    fs, path = _path(spark, folder)
    if not fs.exists(path):
        return []
    found = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.startswith(f"{prefix}=") and (not complete or fs.exists(_path(spark, f"{folder}/{name}/_SUCCESS")[1])):
            found.append(int(name.split("=")[1]))
    return sorted(found)


def _listed(spark: SparkSession, folder: str, number: int) -> dict[int, int]:
    """Bucket -> batch that wrote it; one small row a bucket."""
    rows = spark.read.schema(LIST).json(f"{folder}/lists/generation={number}").collect()
    return {r["bucket"]: r["batch"] for r in rows}


def merge(batch: DataFrame, number: int, folder: str, keys: list[str], buckets: int = BUCKETS) -> None:
    """Rows of ``batch``, one for each key, replace those stored under the same keys;
    NULL keys are equal. The number of buckets is that of the first batch for good."""
    spark = batch.sparkSession
    before = [n for n in _numbers(spark, f"{folder}/lists", "generation", True) if n < number]
    at = _listed(spark, folder, before[-1]) if before else {}
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    rows = cut_lineage(batch.withColumn("bucket", bucket))
    touched = [r[0] for r in rows.select("bucket").distinct().collect()]
    if not touched:
        return
    stay = [f"{folder}/data/batch={at[b]}/bucket={b}" for b in touched if b in at]
    merged = rows
    if stay:
        old = spark.read.schema(rows.schema).option("basePath", f"{folder}/data").parquet(*stay).select(*rows.columns)
        merged = rows.unionByName(join_same(old, rows.select("bucket", *keys), ["bucket", *keys], "left_anti"))
    target = f"{folder}/data/batch={number}"
    merged.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(target)
    now = {**at, **{b: number for b in touched}}
    listed = spark.createDataFrame(sorted(now.items()), LIST).coalesce(1)
    listed.write.mode("overwrite").json(f"{folder}/lists/generation={number}")
    _clear(spark, folder, before, [at, now])


def _clear(spark: SparkSession, folder: str, older: list[int], kept: list[dict[int, int]]) -> None:
    """Remove what neither of the two newest generations names."""
    named = {pair for at in kept for pair in at.items()}
    for n in _numbers(spark, f"{folder}/data", "batch", False):
        for b in _numbers(spark, f"{folder}/data/batch={n}", "bucket", False):
            if (b, n) not in named:
                fs, path = _path(spark, f"{folder}/data/batch={n}/bucket={b}")
                fs.delete(path, True)
        if n not in {batch for _, batch in named}:
            fs, path = _path(spark, f"{folder}/data/batch={n}")
            fs.delete(path, True)
    for n in older[:-1]:
        fs, path = _path(spark, f"{folder}/lists/generation={n}")
        fs.delete(path, True)


def current(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The newest generation: one row of each key."""
    lists = _numbers(spark, f"{folder}/lists", "generation", True)
    if not lists:
        return spark.createDataFrame([], schema)
    files = [f"{folder}/data/batch={n}/bucket={b}" for b, n in _listed(spark, folder, lists[-1]).items()]
    return spark.read.schema(schema).option("basePath", f"{folder}/data").parquet(*files).select(*schema.names)
