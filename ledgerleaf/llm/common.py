"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset a folder of our own serves, but only if the master is local: a cluster needs the setting.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        path = sc._jsc.sc().getCheckpointDir().getOrElse(None)
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="ledgerleaf-")
        sc.setCheckpointDir(path)
    elif sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(path)
    return path


#: Bytes of a checkpoint that a task reads, where there are more than two tasks a core.
CUT_BYTES = 8 << 20


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: computed once, kept in the shared folder, cleaned by Spark when no plan refers to it.

    It is read by as many tasks as its bytes ask for: each task of the next shuffle leaves files, which stay until the driver collects its garbage.
    """
    shared_dir(df.sparkSession)
    sc, out = df.sparkSession.sparkContext, df.checkpoint(eager=True)
    rdd = out._jdf.queryExecution().logical().rdd()
    path = sc._jvm.org.apache.hadoop.fs.Path(rdd.getCheckpointFile().get())
    size = path.getFileSystem(sc._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    tasks = max(2 * sc.defaultParallelism, -(-size // CUT_BYTES))
    return out.coalesce(tasks) if tasks < rdd.getNumPartitions() else out


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


#: Most bytes of an Arrow batch sent to a Python worker: rows hold whole texts, so a count of rows bounds nothing.
BATCH_BYTES = 16 << 20


def ship(spark: SparkSession) -> None:
    """Bounds the batches sent to Python workers, and lets local ones import this package from any folder."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = str(spark.conf.get(limit)).lower().removesuffix("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(limit, str(BATCH_BYTES))
    env = spark.sparkContext.environment
    had = env.get("PYTHONPATH", "")
    if ROOT not in had.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, had) if x)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that ``new_path`` named."""
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def remove_later(spark: SparkSession, path: str) -> None:
    """Deletes the folder when the driver's Python ends: a lazy result may read it until then."""

    def end() -> None:
        with contextlib.suppress(Exception):  # the session may have ended before
            remove(spark, path)

    atexit.register(end)


def few(df: DataFrame, limit: int = 1_000_000) -> DataFrame:
    """df, to be broadcast if it has at most ``limit`` rows (they are counted); for tables of one or two numbers a row."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_defaults(df: DataFrame, text: str = "text") -> DataFrame:
    """Null texts read as empty."""
    return df.withColumn(text, F.coalesce(F.col(text).cast("string"), F.lit("")))


def trim() -> None:
    """Gives a reused Python worker's free memory back: the next stage's executor memory counts it otherwise."""
    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)
