"""Candidates: fan-out, resumption, completeness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmill.functions.ids import stable_id


def fan_out(prompts: DataFrame, n: int, run_seed: int) -> DataFrame:
    out = prompts.withColumn("candidate_index", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))))
    return out.withColumn("candidate_id", stable_id(F.col("sample_id"), F.lit(run_seed), F.col("candidate_index")))


def remaining(candidates: DataFrame, done: DataFrame) -> DataFrame:
    return candidates.join(done.select("candidate_id"), "candidate_id", "left_anti")


def completeness(expected: DataFrame, done: DataFrame) -> DataFrame:
    """(expected, completed, missing, unexpected) counts of distinct candidates."""
    want, have = expected.select("candidate_id").distinct(), done.select("candidate_id").distinct()
    both = want.withColumn("w", F.lit(1)).join(have.withColumn("h", F.lit(1)), "candidate_id", "full")
    return both.agg(
        F.count("w").alias("expected"), F.count("h").alias("completed"),
        F.count_if(F.col("h").isNull()).alias("missing"), F.count_if(F.col("w").isNull()).alias("unexpected"),
    )


def checked(expected: DataFrame, done: DataFrame) -> DataFrame:
    """completeness, which must be full: missing or unexpected candidates are an error."""
    out = completeness(expected, done)
    r = out.first()
    if r.missing or r.unexpected:
        raise ValueError(f"{r.missing} candidates are missing and {r.unexpected} are unexpected, of {r.expected}")
    return out
