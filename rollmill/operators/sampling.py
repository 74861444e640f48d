"""Stratified mixtures: exact allocation, hash-ranked bottom-k, cross-stratum deduplication."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from math import ceil, floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollmill.functions.ids import rank_key
from rollmill.functions.ranks import first_ranked


def allocate(total: int, weights: Sequence[float]) -> list[int]:
    """Largest remainders, in exact arithmetic; equal remainders keep the weights' order."""
    exact = [Fraction(str(w)) for w in weights]
    if total < 0 or any(w < 0 for w in exact) or (not sum(exact)):
        raise ValueError("weights must not be negative and must have a positive sum")
    shares = [total * w / sum(exact) for w in exact]
    out = [floor(s) for s in shares]
    for k in sorted(range(len(out)), key=lambda k: out[k] - shares[k])[: total - sum(out)]:
        out[k] += 1
    return out


def capacity(target: int, oversample: float = 1.25) -> int:
    return max(target, ceil(target * oversample))


def first_wins(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    """One row for each key: the first in the given order."""
    seen = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(seen)).where("_n = 1").drop("_n")


def bottom_k(rows: DataFrame, stratum: str, seed: int, k: Column | int) -> DataFrame:
    """The k rows of the smallest hash rank in each stratum, with rank_key. Only k rows of each task's strata reach the shuffle."""
    ranked = rows.withColumn("rank_key", rank_key(F.lit(seed), F.col("sample_id")))
    order = Window.partitionBy(stratum).orderBy("rank_key", "sample_id")
    return ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def allocation(strata: DataFrame, total: int) -> DataFrame:
    """strata (stratum, weight bigint, place) with target: largest remainders, equal ones in the order of place; exact in integers.

    There are few strata: the windows run over one row for each.
    """
    whole = Window.partitionBy(F.lit(0))
    rows = strata.withColumn("_all", F.sum("weight").over(whole)).withColumns({"target": F.expr(f"({total} * weight) div _all"), "_rest": F.expr(f"({total} * weight) % _all")})
    rows = rows.withColumn("_left", F.lit(total) - F.sum("target").over(whole))
    place = F.row_number().over(whole.orderBy(F.col("_rest").desc(), "place"))
    return rows.withColumn("target", (F.col("target") + (place <= F.col("_left")).cast("bigint")).cast("bigint")).select("stratum", "weight", "target")


def stride_shard(rows: DataFrame, shard: int, shards: int, size: int) -> DataFrame:
    """Every ``shards``-th of the first size * shards rows by sample_id, from ``shard`` on."""
    return first_ranked(rows, [F.col("sample_id")], size * shards, "ordinal").where(F.col("ordinal") % shards == shard)
