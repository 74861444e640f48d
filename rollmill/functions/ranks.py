"""Ranks and numbered rows without a sort in one task: sampled ranges are sorted side by side, and only their counts are added up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollmill.functions.session import checkpointed, small_side

_PLACES = 33  # bits of monotonically_increasing_id below the partition's number


def ranked(df: DataFrame, order: list[Column], group: list[str] | None = None, name: str = "rank") -> DataFrame:
    """df with ``name``, the number of a row (from 0) by ``order`` in its group, or in all rows.

    ``order`` starts with the group's columns, if there are any. Rows that are equal in ``order`` get neighbouring numbers in some order, so an
    order that tells all different rows apart makes the result depend on the rows alone. The sorted rows are written once in
    the shared folder; a row for each range (and group in it) is all that meets in one task, whatever the size of a group.
    """
    group = group or []
    own = (f"{name}_at", f"{name}_range", f"{name}_before")
    at, part, before = own
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id())
    rows = checkpointed(rows.withColumn(part, F.shiftrightunsigned(at, _PLACES)))
    counts = rows.groupBy(part, *group).agg(F.count("*").alias("n"), F.min(at).alias("first"))
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = checkpointed(counts.select(F.col(part).alias("p"), *[F.col(g).alias(f"g{k}") for k, g in enumerate(group)], (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias(before)))
    same = F.col(part) == F.col("p")
    for k, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"g{k}"))
    size = counts.agg(F.count("*").alias("n"), *(F.max(F.octet_length(F.col(f"g{k}").cast("string"))).alias(f"g{k}") for k in range(len(group)))).first()
    out = rows.join(small_side(counts, size.n, 64 + sum(v or 0 for v in size[1:])), same)
    return out.withColumn(name, F.col(at) + F.col(before)).select(*df.columns, name)


def first_ranked(df: DataFrame, order: list[Column], n: int, name: str = "rank") -> DataFrame:
    """The first n rows by ``order`` with their numbers; they stay in the ranges that they were sorted in."""
    return ranked(df, order, name=name).where(F.col(name) < n)
