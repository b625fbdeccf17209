"""Token ids in a compact binary format, and back.

Ids are replaced by their rank in the corpus (0 the most frequent), so most take one
byte. Values are coded in one to four little-endian bytes; the byte counts stand
apart, four to a control byte (two bits each, first value lowest). A file row is one
block: ``control`` and ``data`` bytes, the documents in it with their lengths, the
part and the block's place. Blocks stand in rows of Parquet so that any store that
Spark writes to will do. The rank table lies beside them.

Parts are ranges of doc_id in ascending order (null ids first), so a document's start
is the size of the parts before plus its place in its own part: one row per part is
summed, never the documents. Null texts are empty; each document ends with an end id;
repeated rows are written each, in order of their text's hash. Only doc_id and text
are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import cut_lineage, new_folder
from .common import in_batches, query, read
from .tokenize import encoder

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
# Values of one block; a longer document has a block of its own.
BLOCK_IDS = 1 << 19

# Fixed by the format: bytes of the four values of each control byte, and their sum.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
TOTALS = LENGTHS.sum(axis=1)
_KEPT = np.arange(4)[None, :]


def encode(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values; the last group is filled up
    with zeros that have a control entry and a data byte each."""
    padded = np.zeros(-(-len(values) // 4) * 4, "<u4")
    padded[: len(values)] = values
    size = 1 + (padded > 0xFF).astype(np.uint8) + (padded > 0xFFFF) + (padded > 0xFFFFFF)
    control = ((size.reshape(-1, 4) - 1) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8)
    data = padded.view(np.uint8).reshape(-1, 4)[_KEPT < size[:, None]]
    return control.tobytes(), data.tobytes()


def decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The first ``n`` values: the tables give the byte count of every value at once."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()
    out = np.zeros((len(size), 4), np.uint8)
    out[_KEPT < size[:, None]] = np.frombuffer(data, np.uint8)
    return out.reshape(-1).view("<u4")[:n]


def _ids(texts, tokenizer: str, end_id: int) -> list[np.ndarray]:
    end = np.array([end_id], "<u4")
    return [np.concatenate([ids, end]) for ids in encoder(tokenizer, True)(list(texts))]


def encoded(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """(doc_id, h, n, ids): each text encoded once, written compressed, so that the ids
    can be counted first and ranked after that."""

    def found(frame: pd.DataFrame) -> pd.DataFrame:
        press = zstandard.ZstdCompressor(level=1)
        ids = _ids(frame["text"], tokenizer, end_id)
        raw = [press.compress(_planes(x)) for x in ids]
        return pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "h": frame["h"], "n": [len(x) for x in ids], "ids": raw})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return cut_lineage(rows.withColumn("h", F.xxhash64("text")).mapInPandas(in_batches(found), "doc_id long, h long, n long, ids binary"))


def _planes(ids: np.ndarray) -> bytes:
    """All lowest bytes, then all second ones, and so on: these compress well apart."""
    return ids.view(np.uint8).reshape(-1, 4).T.tobytes()


def _opened(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).reshape(-1).view("<u4")


def ranks(ids: DataFrame) -> DataFrame:
    """(id, n, rank) by falling frequency; at most one row per id of the vocabulary."""

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = np.zeros(1, np.int64)
        for frame in frames:
            for at in range(0, len(frame), 128):
                got = np.bincount(np.concatenate([_opened(raw) for raw in frame["ids"].iloc[at : at + 128]]))
                if len(got) > len(count):
                    count = np.concatenate([count, np.zeros(len(got) - len(count), np.int64)])
                count[: len(got)] += got
        used = np.flatnonzero(count)
        yield pd.DataFrame({"id": used, "n": count[used]})

    total = ids.select("ids").mapInPandas(counted, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return total.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "id")) - 1)


def write(docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    spark = docs.sparkSession
    stored = encoded(docs, tokenizer, end_id)
    ranks(stored).write.parquet(f"{folder}/ranks")
    # At most the vocabulary, so it may go to every task.
    table = spark.read.parquet(f"{folder}/ranks").orderBy("rank").select("id").toPandas()["id"].to_numpy(np.int64)
    rank_of = np.zeros(int(table.max()) + 1 if len(table) else 1, np.uint32)
    rank_of[table] = np.arange(len(table))
    shared = spark.sparkContext.broadcast(rank_of)

    def blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[object, np.ndarray]] = []
        number, begins, size = 0, 0, 0

        def block() -> pd.DataFrame:
            control, data = encode(shared.value[np.concatenate([ids for _, ids in held])])
            documents = [{"doc_id": None if pd.isna(d) else int(d), "n_tokens": len(ids)} for d, ids in held]
            return pd.DataFrame({"part": [part], "block": [number], "begins": [begins], "n_ids": [size], "documents": [documents], "control": [control], "data": [data]})

        for frame in frames:
            part = int(frame["part"].iloc[0])
            for doc_id, raw in zip(frame["doc_id"], frame["ids"]):
                ids = _opened(raw)
                held.append((doc_id, ids))
                size += len(ids)
                if size >= block_ids:
                    yield block()
                    held, number, begins, size = [], number + 1, begins + size, 0
        if held:
            yield block()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = stored.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "h").withColumn("part", F.spark_partition_id())
    ordered.mapInPandas(blocks, "part int, block long, begins long, n_ids long, documents array<struct<doc_id:long,n_tokens:long>>, control binary, data binary").write.parquet(f"{folder}/blocks")


def load(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """One row per document, read from the files: doc_id, start, n_tokens, ids_crc32
    and, with ``with_ids``, the ids."""
    table = spark.read.parquet(f"{folder}/ranks").orderBy("rank").select("id").toPandas()["id"].to_numpy("<u4")
    shared = spark.sparkContext.broadcast(table)
    stored = spark.read.parquet(f"{folder}/blocks")

    def documents(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                ids = shared.value[decode(row.control, row.data, row.n_ids)]
                out, at = [], 0
                for d in row.documents:
                    raw = ids[at : at + d["n_tokens"]].tobytes()
                    out.append((row.part, d["doc_id"], row.begins + at, d["n_tokens"], zlib.crc32(raw), raw)[: 6 if with_ids else 5])
                    at += d["n_tokens"]
                names = ["part", "doc_id", "place", "n_tokens", "ids_crc32", "ids"]
                yield pd.DataFrame(out, columns=names[: 6 if with_ids else 5]).astype({"doc_id": "Int64"})

    rows = stored.mapInPandas(documents, "part int, doc_id long, place long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else ""))
    sizes = stored.groupBy(F.col("part").alias("of")).agg(F.sum("n_ids").alias("size"))
    before = F.sum("size").over(Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("of", F.coalesce(before, F.lit(0)).alias("before"))
    # One row per part: as many as shuffle partitions.
    joined = rows.join(F.broadcast(sizes), F.col("part") == F.col("of"))
    return joined.select("doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


@query("op7_tokens")
def op7(spark, sf_dir):
    folder = new_folder(spark, "tokens")
    write(read(spark, sf_dir, "documents"), folder)
    return load(spark, folder)
