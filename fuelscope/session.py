"""Session helpers: time zone, lineage cuts, size-checked broadcast."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# A broadcast table holds at most this many narrow rows (keys and a few scalars).
BROADCAST_ROWS = 200_000

# An Arrow batch on its way to a Python worker holds about this many bytes at most. Spark
# bounds its rows too, but 10,000 long texts weigh much, in the executor and in the worker.
BATCH_BYTES = 4 << 20
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Call once per session. Text patterns are parsed in the session zone, so it is
    pinned to UTC; the package is sent to the workers, which run its functions. Arrow
    batches are bounded by their bytes, unless the session was started with a bound of its own."""
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC"):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    context = spark.sparkContext
    if not context.getConf().contains(_BATCH_BYTES):
        spark.conf.set(_BATCH_BYTES, str(BATCH_BYTES))
    if context.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.abspath(__file__))
        target = os.path.join(tempfile.mkdtemp(prefix="fuelscope-"), "fuelscope")
        archive = shutil.make_archive(target, "zip", os.path.dirname(package), os.path.basename(package))
        context.addPyFile(archive)
        # A stateful stream first starts a Python process beside the driver, which
        # does not get the files sent to the workers.
        paths = [os.path.dirname(package), context.environment.get("PYTHONPATH", "")]
        context.environment["PYTHONPATH"] = os.pathsep.join(p for p in paths if p)
        _SHIPPED.add(context.applicationId)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``. Only a local
    session may fall back to a temporary folder."""
    context = spark.sparkContext
    named = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
    )
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        named = tempfile.mkdtemp(prefix="fuelscope-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def new_folder(spark: SparkSession, kind: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the frame once to the shared folder and read it back: it is not
    computed again, survives the loss of an executor, and later plans see its true
    size."""
    folder = new_folder(df.sparkSession, "cut")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint behind a count. The frame is cut first, so the check does
    not compute it twice; beyond the bound the join shuffles."""
    df = cut_lineage(df)
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df
