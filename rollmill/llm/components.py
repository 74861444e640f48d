"""Connected components by alternating star contraction: joins and aggregates only, nothing on the driver but a sum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmill.functions.session import checkpointed, release


def _toward_smaller(links: DataFrame) -> DataFrame:
    """Distinct links (u, v) with u > v."""
    return links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _stars(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step. A hub's links are joined to the hub's minimum, never gathered in one row."""
    both = links.select("u", "v").unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    large = _toward_smaller(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(low.select("u", F.col("m").alias("v")))
    return _toward_smaller(small)


def components(links: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v: bigint) but the roots, which are the smallest node of each component.

    Self links count for nothing and repeated links once; no links give no rows. Each round is checkpointed in the
    shared folder, so that a lost executor costs one round.
    """
    now = checkpointed(_toward_smaller(links))
    mark = None
    for _ in range(max_rounds):
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (seen.n, seen.h) == mark or not seen.n:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = (seen.n, seen.h)
        now = checkpointed(_stars(now))
        release(links.sparkSession)  # of the rounds before
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
