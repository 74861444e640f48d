"""Durable outputs: shards, tables that are published whole, stage markers, resumable stages and the snapshot of a run's configuration."""

from __future__ import annotations

import time
from math import ceil

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SHARD_ROWS = 10_000
# Rows of a seed shard at most.
SEED_SHARD_ROWS = 100_000


class Store:
    """Files of the store that a path is in, by the file system that Spark uses for it."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self.make = jvm.org.apache.hadoop.fs.Path
        self.files = self.make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.files.exists(self.make(path))

    def parts(self, path: str) -> bool:
        """Whether a folder holds a Parquet file; hidden files don't count."""
        if not self.exists(path):
            return False
        walk = self.files.listFiles(self.make(path), True)
        while walk.hasNext():
            name = walk.next().getPath().getName()
            if name.endswith(".parquet") and name[0] not in "._":
                return True
        return False

    def move(self, path: str, to: str) -> None:
        if not self.files.rename(self.make(path), self.make(to)):
            raise OSError(f"can't move {path} to {to}")


def write_shards(rows: DataFrame, folder: str, mode: str = "errorifexists") -> None:
    rows.write.mode(mode).option("compression", "zstd").option("maxRecordsPerFile", SHARD_ROWS).parquet(folder)


def seed_shard_rows(n: int, slots: int, shards_per_slot: int) -> int:
    """Rows of a shard, so that each of the slots that work on them gets its number of shards."""
    return min(SEED_SHARD_ROWS, max(1, ceil(n / (slots * shards_per_slot))))


def write_seeds(rows: DataFrame, folder: str, n: int, slots: int, shards_per_slot: int = 4) -> None:
    """n seeds in the order of their ids, in shards of seed_shard_rows."""
    size = seed_shard_rows(n, slots, shards_per_slot)
    rows.repartitionByRange(max(1, ceil(n / size)), "sample_id").write.option("compression", "zstd").option("maxRecordsPerFile", size).parquet(folder)


def block_bytes(target_mb: int) -> dict[str, str]:
    """Settings under which scans and shuffles make partitions of about target_mb."""
    size = str(target_mb << 20)
    return {"spark.sql.files.maxPartitionBytes": size, "spark.sql.adaptive.advisoryPartitionSizeInBytes": size}


def publish(rows: DataFrame, folder: str, least: int = 1, **counts) -> dict[str, int]:  # noqa: ANN003
    """Write rows beside ``folder``, count them in the same pass, and move them there with a marker of the counts; returns these.

    counts are further aggregates by name. Too few rows, or any failure, leave what there is under a name of .incomplete, and the folder as it was.
    """
    spark = rows.sparkSession
    store, stamp = Store(spark, folder), time.time_ns()
    if store.exists(folder):
        raise FileExistsError(folder)
    temporary = f"{folder}.tmp.{stamp}"
    seen = Observation()
    try:
        write_shards(rows.observe(seen, F.count("*").alias("rows"), *(c.alias(k) for k, c in counts.items())), temporary)
        got = {k: int(v or 0) for k, v in seen.get.items()}
        if got["rows"] < least:
            raise ValueError(f"{got['rows']} rows of at least {least}")
        marker = spark.range(1).select(*(F.lit(v).cast("bigint").alias(k) for k, v in got.items()), F.lit(stamp).alias("written"))
        marker.coalesce(1).write.json(f"{temporary}/_counts")
        store.move(temporary, folder)
    except Exception:
        if store.exists(temporary):
            store.move(temporary, f"{folder}.incomplete.{stamp}")
        raise
    return got


def published_counts(spark: SparkSession, folder: str) -> dict[str, int]:
    return spark.read.json(f"{folder}/_counts").first().asDict()


def marker_path(folder: str) -> str:
    return f"{folder}.manifest"


def stage_complete(spark: SparkSession, folder: str, resume: bool = True) -> bool:
    """Whether a stage is marked as done. A marked stage without output is an error; without ``resume`` no stage is done."""
    store = Store(spark, folder)
    if not resume or not store.exists(f"{marker_path(folder)}/_SUCCESS"):
        return False
    if not store.parts(folder):
        raise RuntimeError(f"the stage of {folder} is done but its output is missing")
    return True


def rotate(spark: SparkSession, folder: str) -> str | None:
    """Put an output aside under a name of .incomplete, which is returned."""
    store, to = Store(spark, folder), f"{folder}.incomplete.{time.time_ns()}"
    if not store.exists(folder):
        return None
    store.move(folder, to)
    return to


def mark_stage(spark: SparkSession, folder: str, started: float) -> None:
    """Mark a stage as done, with its times; an output without files is an error."""
    if not Store(spark, folder).parts(folder):
        raise RuntimeError(f"{folder} has no Parquet files")
    now = time.time()
    row = spark.range(1).select(F.lit(folder).alias("output"), F.lit(started).alias("started_at_unix"), F.lit(now).alias("completed_at_unix"), F.lit(now - started).alias("duration_seconds"))
    row.coalesce(1).write.mode("overwrite").json(marker_path(folder))


def run_stage(rows: DataFrame, folder: str, key: str, resume: bool = True) -> DataFrame:
    """Write a stage once and mark it; an unmarked output is completed by the keys it lacks, or put aside without ``resume``."""
    spark = rows.sparkSession
    if not stage_complete(spark, folder, resume):
        started = time.time()
        if not resume:
            rotate(spark, folder)
        if Store(spark, folder).parts(folder):
            rows = rows.join(spark.read.parquet(folder).select(key), key, "left_anti")
        write_shards(rows, folder, "append")
        mark_stage(spark, folder, started)
    return spark.read.parquet(folder)


def snapshot(spark: SparkSession, run_dir: str, resolved: str) -> None:
    """Keep a run's resolved configuration; a different one that is kept already is an error."""
    path = f"{run_dir}/manifests/config"
    if Store(spark, path).exists(f"{path}/_SUCCESS"):
        if spark.read.text(path, wholetext=True).where(F.rtrim(F.regexp_replace("value", r"\n$", "")) == resolved).isEmpty():
            raise RuntimeError(f"{run_dir} has another configuration already")
        return
    spark.range(1).select(F.lit(resolved).alias("value")).coalesce(1).write.mode("overwrite").text(path)
