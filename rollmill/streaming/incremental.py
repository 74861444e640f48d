"""Incremental processing of arriving candidate files: each once, across restarts, in batches that are completed by the keys they lack."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def process_available(
    spark: SparkSession, schema: str, source: str, out: str, checkpoint: str, step: Callable[[DataFrame], DataFrame], files_per_batch: int = 16, key: str | None = None, every_seconds: float | None = None
) -> StreamingQuery:
    """Apply ``step`` to the files of ``source`` that this checkpoint hasn't seen, ``files_per_batch`` at once, and append to ``out``.

    With ``key`` rows that ``out`` has are left out, and of rows that a batch repeats one stays: files may be sent again. Output of batch n is a folder
    of its own, written again when the batch is. Without ``every_seconds`` the query ends with what is there; with it, it goes on at that interval.
    """

    def write(batch: DataFrame, n: int) -> None:
        if key is not None:
            batch = batch.dropDuplicates([key])
            if n:
                # what earlier batches wrote; this batch's own folder may be left from an attempt
                done = spark.read.option("basePath", out).schema(T.StructType([batch.schema[key], T.StructField("batch", T.LongType())])).parquet(out).where(F.col("batch") < n)
                batch = batch.join(done.select(key), key, "left_anti")
        step(batch).write.mode("overwrite").parquet(f"{out}/batch={n}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    query = (writer.trigger(availableNow=True) if every_seconds is None else writer.trigger(processingTime=f"{every_seconds} seconds")).start()
    if every_seconds is None:
        query.awaitTermination()
    return query
