"""Comparisons, calibration and reports over saved candidates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollmill.functions.ids import blank
from rollmill.functions.session import checkpointed, small_side


def decision_diff(old: DataFrame, new: DataFrame, columns: list[str]) -> DataFrame:
    """Candidates of which a decision changed, nulls counting as equal: candidate_id, old_*, new_*."""
    a = old.select("candidate_id", *(F.col(c).alias(f"old_{c}") for c in columns))
    b = new.select("candidate_id", *(F.col(c).alias(f"new_{c}") for c in columns))
    changed = F.lit(False)
    for c in columns:
        changed = changed | ~F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}"))
    return a.join(b, "candidate_id").where(changed)


def by_prefix(labels: DataFrame, rows: DataFrame) -> DataFrame:
    """labels (id, prefix) with the rows whose sample_id starts with it, and ``matches``, how many do; labels without any have a row of nulls and 0.

    Prefixes may have any lengths: rows are scanned once, and meet the prefixes that share the first characters of theirs, as many as the shortest has.
    """
    texts = checkpointed(labels.select("prefix").where("prefix is not null").distinct())
    size = texts.agg(F.count("*").alias("n"), F.min(F.length("prefix")).alias("low"), F.sum(F.octet_length("prefix")).alias("bytes")).first()
    start = size.low or 0
    sorted_ = texts.select("prefix", F.left("prefix", F.lit(start)).alias("_start"))
    per_row = (size.bytes or 0) // max(1, size.n) + 64
    near = rows.withColumn("_start", F.left("sample_id", F.lit(start))).join(small_side(sorted_, size.n, 2 * per_row), "_start")
    keyed = near.where(F.startswith("sample_id", "prefix")).drop("_start")
    joined = labels.join(keyed, "prefix", "left")
    return joined.withColumn("matches", F.count("sample_id").over(Window.partitionBy("id")))


def exactly_one(joined: DataFrame) -> DataFrame:
    """by_prefix's rows when each label has one match; otherwise an error that names some labels."""
    wrong = [r.id for r in joined.where("matches <> 1").select("id").distinct().orderBy("id").limit(5).collect()]
    if wrong:
        raise ValueError(f"labels without exactly one match: {wrong}")
    return joined


def calibrated(labels: DataFrame, rows: DataFrame, fields: list[str], observed: Callable[[Column], Column]) -> DataFrame:
    """(category, expected, observed, n) of labels (id, prefix, field, category, expected) on rows (sample_id and the text fields).

    Each prefix must belong to one row, and the field that a label names must not be blank there; otherwise it is an error that names some labels.
    ``observed`` gives a verdict of a text.
    """
    matched = exactly_one(by_prefix(labels.select("id", "prefix").distinct(), rows.select("sample_id", *fields)))
    text = F.lit(None).cast("string")
    for name in fields:
        text = F.when(F.col("field") == name, F.col(name)).otherwise(text)
    pairs = checkpointed(labels.drop("prefix").join(matched.drop("prefix", "matches"), "id").select("id", "category", "expected", text.alias("text")))
    if wrong := [r.id for r in pairs.where(blank(F.col("text"))).select("id").distinct().orderBy("id").limit(5).collect()]:
        raise ValueError(f"labels of a blank text: {wrong}")
    return confusion(pairs.withColumn("observed", observed(F.col("text"))))


def curated(picks: DataFrame, rows: DataFrame) -> DataFrame:
    """picks (id) against rows (id, text, quote): whether each pick is an orphan, repeated, and its quote in its text."""
    counted = picks.groupBy("id").agg(F.count("*").alias("_n"))
    joined = counted.join(rows.withColumn("_there", F.lit(True)), "id", "left")
    quoted = F.coalesce(F.contains("text", "quote"), F.lit(False))
    return joined.select("id", F.col("_there").isNull().alias("orphan"), (F.col("_n") > 1).alias("repeated"), quoted.alias("quoted"))


def confusion(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("category", "expected", "observed").agg(F.count("*").alias("n"))


def phase_metrics(log: DataFrame) -> DataFrame:
    """log (phase, done, seconds, input_tokens, output_tokens, length_stops): sums of each phase, and what is completed in an hour."""
    return log.groupBy("phase").agg(
        F.count("*").alias("requests"), F.count_if("done").alias("completed"), F.sum("seconds").alias("seconds"), (F.count_if("done") * 3600 / F.sum("seconds")).alias("per_hour"),
        F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"), F.sum("length_stops").alias("length_stops"),
    )
