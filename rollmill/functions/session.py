"""Session helpers shared by every operator: shipping the code, shared scratch space, checked broadcasts."""

from __future__ import annotations

import gc
import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parents[2])

#: Rows of an Arrow batch where nobody has set them: Spark's 10,000 are too many for long texts. It holds for the session's later queries too.
BATCH_ROWS = 1000

#: Rows of a broadcast side may hold at most this many bytes in all; beyond it a shuffle join is used.
BROADCAST_BYTES = 64 << 20


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, and read texts in batches that fit beside others in an executor.

    On a cluster the package is installed or sent with ``--py-files``; a session that was started from
    another folder on one machine finds it through the workers' PYTHONPATH.
    """
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if ROOT not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, have) if x)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if rows not in spark.conf.getAll:  # a value that was asked for stays, whatever it is
        spark.conf.set(rows, str(BATCH_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, else a new one for local runs. A cluster without it is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = folder.get() if folder.isDefined() else None
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffles and checkpoints that nothing refers to any more.

    It does so when garbage of the driver is collected, which rounds of small jobs don't bring about by themselves, so that their files pile up.
    """
    gc.collect()  # Python's references to Spark's objects first
    spark.sparkContext._jvm.java.lang.System.gc()


def small_side(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Mark a side for broadcast when its known row count keeps it under BROADCAST_BYTES; else leave it to a shuffle."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of a folder; what is made of it may use this package in Python workers."""
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")
