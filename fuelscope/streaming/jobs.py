"""Streaming ingest, screen and running aggregates.

Each job, run to the end of its input, equals its batch twin if no row is later than the
watermark. Such rows are an output of their own in the screen; elsewhere they are dropped
and counted in the progress of the query. The batch form has no such rule.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.clock import to_new_york
from ..operators.lookup import insert_if_absent
from ..operators.replay import Series, begin_flags, micros
from ..schema import KEY
from ..session import cut_lineage
from . import generations

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_stream(spark: SparkSession, path: str, schema: T.StructType, pattern: str, files: int = 64) -> DataFrame:
    """Files of a folder in order of arrival, a bounded number per batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    return reader.option("maxFilesPerTrigger", files).parquet(path)


def distinct_ingest(stream: DataFrame, keys: list[str] = KEY, time: str = "scraped_at", delay: str = "7 days") -> DataFrame:
    """First arrival of each key; state is kept for ``delay``."""
    clocked = stream.withColumn("_clock", F.col(time).cast("timestamp")).withWatermark("_clock", delay)
    return clocked.dropDuplicatesWithinWatermark(keys).drop("_clock")


def run_ingest(
    stream: DataFrame, folder: str, keys: list[str] = KEY, order: str = "seq", part: Column | None = None
) -> StreamingQuery:
    """Rows that a unique key lets in, checked against all rows stored, however old.

    The table is laid out by ``part``, a function of the key with few values (the day of
    ``scraped_at`` unless given), and a batch reads the keys of its own parts only. Rows
    without a part have an incomplete key and never conflict. In each part a batch has a
    folder of its own, which a repeated batch overwrites.
    """
    spark, out = stream.sparkSession, f"{folder}/out"
    part = F.to_date("scraped_at").cast("string") if part is None else part.cast("string")
    extra = [T.StructField("part", T.StringType()), T.StructField("batch", T.LongType())]
    shape = T.StructType([*stream.schema.fields, *extra])
    spark.createDataFrame([], shape).write.mode("ignore").partitionBy("part", "batch").parquet(out)

    def write(batch: DataFrame, number: int) -> None:
        rows = cut_lineage(batch.withColumn("part", part))
        # Days (or other parts) of one batch, not rows.
        parts = [r[0] for r in rows.select("part").filter("part is not null").distinct().collect()]
        stored = batch.sparkSession.read.schema(shape).option("basePath", out).parquet(out)
        earlier = stored.filter(F.col("part").isin(parts) & (F.col("batch") < number))
        fresh = insert_if_absent(earlier, rows, keys, order).withColumn("batch", F.lit(number).cast("long"))
        writer = fresh.hint("rebalance", "part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("part", "batch").parquet(out)

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return query


# Held rows are looked at when the watermark passes the end of such a span.
RELEASE_US = 86_400 * 1_000_000
# Groups of keys of the screen, and rows of a group that wait in one piece of its state.
BUCKETS = 256
WAITING_ROWS = 100_000


class Screen(StatefulProcessor):
    """Rows wait until the watermark has passed them and are then judged in order of time
    and tie, whatever the order of arrival. A group is a bucket of keys, so that state is
    read and written for many series at once, as frames: the waiting rows of a batch, and
    the accepted ones that are still references (the newest at least a week old of each
    key and all after it). The old price has no expiry: it stays a reference until a newer
    one is a week old. Rows behind the watermark come out as late, not judged."""

    def __init__(self, row: T.StructType, keys: list[str], time: str, tie: str, limit: float):
        self.row, self.keys, self.time, self.tie, self.limit = row, keys, time, tie, limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        frame = T.StructType([T.StructField("frame", T.BinaryType())])
        self.handle = handle
        self.references = handle.getValueState("references", frame)
        self.waiting = handle.getListState("waiting", frame)
        self.earliest = handle.getValueState("earliest", T.StructType([T.StructField("t", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting, n = [], 0
        for pdf in rows:
            pdf = pdf[self.row.names]
            late = micros(pdf[self.time]) < passed
            if late.any():
                yield pdf[late].assign(accepted=None, late=True)
            if not late.all():
                waiting.append(pdf[~late])
                n += len(waiting[-1])
            if n >= WAITING_ROWS:
                self._wait(waiting)
                waiting, n = [], 0
        if waiting:
            self._wait(waiting)

    def _wait(self, frames: list[pd.DataFrame]) -> None:
        held = pd.concat(frames, ignore_index=True)
        times = micros(held[self.time])
        self.waiting.appendList([(pickle.dumps(held),)])
        least = int(times.min())
        if not self.earliest.exists() or least < int(self.earliest.get()[0]):
            self.earliest.update((least,))
        for span in np.unique(times // RELEASE_US).tolist():
            self.handle.registerTimer((span + 1) * RELEASE_US // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        if not self.earliest.exists() or int(self.earliest.get()[0]) >= passed:
            return
        held = pd.concat([pickle.loads(r[0]) for r in self.waiting.get()], ignore_index=True)
        times = micros(held[self.time])
        due = times < passed
        if due.all():
            self.waiting.clear()
            self.earliest.clear()
        else:
            self.waiting.put([(pickle.dumps(held[~due]),)])
            self.earliest.update((int(times[~due].min()),))
        yield self._judged(held[due].reset_index(drop=True))

    def _judged(self, due: pd.DataFrame) -> pd.DataFrame:
        """References stand in front of the due rows of their key."""
        needed = due[[*self.keys, self.time, self.tie]].assign(_price=pd.to_numeric(due["price"]).astype("float64"), _due=True)
        if self.references.exists():
            needed = pd.concat([needed, pickle.loads(self.references.get()[0])])
        needed = needed.sort_values([*self.keys, "_due", self.time, self.tie])
        flags = np.zeros(len(due), dtype=bool)
        series, accepted, kept = Series(self.limit), [], []
        columns = (needed.index.tolist(), needed["_due"].tolist(), micros(needed[self.time]).tolist(), needed["_price"].tolist())
        for place, (new, row, is_due, t, p) in enumerate(zip(begin_flags(needed, self.keys, None).tolist(), *columns)):
            if new:
                kept += accepted[max(series.week, 0) :]
                accepted = []
                series.begin()
            if is_due:
                flags[row] = fine = series.judge(t, p)
                if not fine:
                    continue
            else:
                series.keep(t, p)
            accepted.append(place)
        kept += accepted[max(series.week, 0) :]
        self.references.update((pickle.dumps(needed.iloc[kept].assign(_due=False)),))
        return due.assign(accepted=flags, late=False)

    def close(self) -> None:
        pass


def screen_stream(
    stream: DataFrame,
    keys: list[str],
    time: str = "scraped_at",
    tie: str = "seq",
    limit: float = 0.50,
    delay: str = "7 days",
    buckets: int = BUCKETS,
) -> DataFrame:
    """``accepted`` and ``late`` for every row: judged in order of time once the watermark,
    ``delay`` behind the newest row, has passed it; rows that come after that are late.
    Rows without a time cannot be ordered and are left out. Keys share ``buckets`` groups,
    a number that a checkpoint keeps; a group must fit one task."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    shape = T.StructType([*stream.schema.fields, T.StructField("accepted", T.BooleanType()), T.StructField("late", T.BooleanType())])
    # The clock is dropped again: a column with a watermark would have late rows removed.
    clocked = stream.where(F.col(time).isNotNull()).withColumn("_clock", F.col(time).cast("timestamp")).withWatermark("_clock", delay)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("_bucket")
    return clocked.select(*stream.columns, bucket).groupBy("_bucket").transformWithStateInPandas(
        statefulProcessor=Screen(stream.schema, keys, time, tie, limit), outputStructType=shape, outputMode="Append", timeMode="EventTime"
    )


def run_screen(stream: DataFrame, folder: str, keys: list[str], time: str = "scraped_at", **rules) -> DataFrame:
    """Judge everything available now, rows still waiting at the end included, and read the
    result back. Judged rows and late rows lie in folders of their own. The end is told by
    a row of the year 2262 (about the last that pandas knows), read after all others; it never comes out."""
    spark = stream.sparkSession
    end = f"{folder}/end"
    spark.createDataFrame([], stream.schema).write.mode("ignore").parquet(end)
    whole = stream.unionByName(read_stream(spark, end, stream.schema, "*.parquet"))
    judged = screen_stream(whole, keys, time, **rules)

    def run() -> None:
        writer = judged.writeStream.format("parquet").partitionBy("late").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state")
        writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()

    run()
    kinds = {f.name: f.dataType for f in stream.schema.fields}
    last = [F.lit("2262-01-01").cast(t).alias(c) if c == time else F.lit(None).cast(t).alias(c) for c, t in kinds.items()]
    spark.range(1).select(*last).write.mode("append").parquet(end)
    run()
    return spark.read.schema(judged.schema).parquet(f"{folder}/out")


def daily_mean_stream(stream: DataFrame, keys: list[str], delay: str = "7 days") -> DataFrame:
    """Mean per New York day."""
    wall = stream.withColumn("_ny", to_new_york(F.col("scraped_at")).cast("timestamp")).withWatermark("_ny", delay)
    days = wall.groupBy(*keys, F.window("_ny", "1 day").alias("_w")).agg(F.avg("price").alias("price"))
    return days.select(*keys, F.to_date("_w.start").alias("date"), "price")


def latest_stream(stream: DataFrame, keys: list[str], tie: str = "seq") -> DataFrame:
    """Newest price per key; the state is one row per key."""
    row = F.max_by(F.struct("price", "scraped_at"), F.struct("scraped_at", tie))
    return stream.groupBy(*keys).agg(row.alias("_r")).select(*keys, "_r.price", "_r.scraped_at")


def run_append(stream: DataFrame, folder: str) -> StreamingQuery:
    """Everything available now into parquet, exactly once."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/state")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def run_update(stream: DataFrame, folder: str, keys: list[str], buckets: int = generations.BUCKETS) -> StreamingQuery:
    """Changed rows of each batch, one for each key, merged into the stored ones."""

    def write(batch: DataFrame, number: int) -> None:
        generations.merge(batch, number, f"{folder}/out", keys, buckets)

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{folder}/state")
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def current_rows(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Newest version of every key that ``run_update`` stored."""
    return generations.current(spark, f"{folder}/out", schema)


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped behind the watermark, over all batches still in the progress."""
    return sum(
        int(op.get("numRowsDroppedByWatermark", 0)) for p in query.recentProgress for op in p["stateOperators"]
    )
