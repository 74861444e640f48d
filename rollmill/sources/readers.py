"""Scans of raw files: with file names, tolerant of broken parts, by the columns there are, out of JSON arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollmill.functions.ranks import first_ranked
from rollmill.sources.arrays import member_texts


def named_rows(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Rows of Parquet files with raw_file, the name of the file that each is from."""
    return spark.read.parquet(*([paths] if isinstance(paths, str) else paths)).withColumn("raw_file", F.col("_metadata.file_name"))


def saved_ids(spark: SparkSession, path: str, key: str = "candidate_id") -> DataFrame:
    """(key) of all rows that can be read below a path; broken and partial files are skipped, hidden ones never read."""
    return spark.read.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true").schema(T.StructType([T.StructField(key, T.StringType())])).parquet(path)


def available(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in their order and types, null where rows has none. Only columns that are there are scanned."""
    have = set(rows.columns)
    return rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema))


def array_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that are one JSON array of objects each, of any size: the members' fields, source_index (place in its file, from 0) and raw_file.

    A member that can't be read has nulls.
    """
    items = member_texts(spark, path).select("raw_file", "source_index", F.from_json("text", f"struct<{schema}>").alias("item"))
    return items.select("item.*", "source_index", "raw_file")


def file_prefix(name: Column) -> Column:
    return F.substring_index(name, "-", 1)


def by_priority(name: Column, order: list[str], other: int = 9) -> tuple[Column, Column]:
    """Sort keys of files: the place of their prefix in ``order``, then the name."""
    place = F.lit(other)
    for k, prefix in enumerate(order):
        place = F.when(file_prefix(name) == prefix, k).otherwise(place)
    return place, name


def first_rows(rows: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows in the given order, with their ordinal from 0; they stay in the ranges that they are sorted in, however many they are."""
    return first_ranked(rows, list(order), n, "ordinal")


def number(x: Column) -> Column:
    """A text as a double, null where it is none."""
    return F.trim(x.cast("string")).try_cast("double")
