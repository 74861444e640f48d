"""Decisions out of saved candidates: parsing, verification and the decision table are functions of what models have written, and can be run again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollmill.functions.ids import blank
from rollmill.functions.json_text import json_items
from rollmill.functions.session import checkpointed
from rollmill.operators import answers, gate, hygiene, parsing, review
from rollmill.operators.judge import SEMANTIC, judge_scores

DECISIONS = ["verification_status", "quality_score", "productivity_filtered_eligible"]


def count_tokens(text: Column) -> Column:
    """Words between white space; a tokenizer's count can take its place."""
    return F.when(text.isNotNull(), F.regexp_count(text, F.lit(r"(?U)[^\s\x1c-\x1f]+")).cast("bigint"))


def reparsed(rows: DataFrame, tokens=count_tokens) -> DataFrame:  # noqa: ANN001
    """rows (raw_generation, finish_reason) with reasoning, response, their states and numbers of tokens."""
    rows = parsing.generation_state(parsing.split_reasoning(rows))
    return rows.withColumns({"reasoning_num_tokens": tokens(F.col("reasoning")), "response_num_tokens": tokens(F.col("response"))})


def verified(rows: DataFrame, adapter, threshold: float = 1.0) -> DataFrame:  # noqa: ANN001
    """rows with the adapter's score and verification_status; a row without a response is an error of its own."""
    rows = adapter.verify(rows)
    missing = F.col("verifier_available") & blank(F.col("response"))
    rows = rows.withColumn("verifier_error", F.when(missing, "response is missing").otherwise(F.col("verifier_error")))
    status = answers.verification_status(F.col("verifier_available"), F.col("response"), F.col("verifier_score"), F.col("verifier_error"), threshold)
    limit = F.when(F.col("verifier_available"), F.lit(threshold))
    return rows.withColumns({"verification_status": status, "verifier_threshold": limit.cast("double")})


_FOUND = "struct<category: string, verdict: string, method: string, evidence: array<string>, explanation: string, error: string>"


def saved_findings(rows: DataFrame) -> DataFrame:
    """(candidate_id, category, verdict) of the models' findings in hygiene_findings_json; what can't be read isn't there."""
    found = rows.select("candidate_id", F.explode(json_items(F.col("hygiene_findings_json"))).alias("raw")).select("candidate_id", F.from_json("raw", _FOUND).alias("f"))
    return found.where(F.col("f.method") == "model").where(F.col("f.category").isin(SEMANTIC)).select("candidate_id", "f.category", "f.verdict")


def finalized(rows: DataFrame, judge_enabled: bool = True) -> DataFrame:
    """rows (verified candidates) with the decision: scores out of judge_raw_output, hygiene out of saved findings, confirmations and the row itself.

    What a model has written is read again; a generation error of the judge comes before an error of reading.
    """
    rows = rows.withColumn("_j", judge_scores(F.when(F.lit(judge_enabled), F.col("judge_raw_output"))))
    status = F.get_json_object("answer_json", "$.status")
    rows = rows.withColumns({
        "judge_enabled": F.lit(judge_enabled), "judge_verdict": F.col("_j.verdict"), "judge_confidence": F.col("_j.confidence"), "reasoning_score": F.col("_j.reasoning_score"), "response_score": F.col("_j.response_score"),
        "reasoning_issues": F.col("_j.reasoning_issues"), "response_issues": F.col("_j.response_issues"), "answer_status": status,
        "judge_error": F.when(F.lit(judge_enabled), F.coalesce("judge_generation_error", "_j.error")),
    })
    # what is read of each text is used three times below: read it once
    rows = checkpointed(hygiene.with_repeated_span(rows, "reasoning", "_span"))
    own = rows.select("candidate_id", F.array_compact(F.array(
        hygiene.repetition_finding(F.col("_span")),
        hygiene.finding("reasoning_limit_stop", hygiene.stop_verdict(F.col("finish_reason")), F.array().cast("array<string>"), "how the generation ended"),
        hygiene.finding("final_answer_missing_or_malformed", hygiene.answer_verdict(F.col("response"), F.col("answer_status")), F.array().cast("array<string>"), "what the extraction says"),
    )).alias("own"))
    listed = own.select("candidate_id", F.posexplode("own").alias("place", "f")).select("candidate_id", "f.category", "f.verdict", "f.error", "place")
    if judge_enabled:
        confirmations = rows.select("candidate_id", F.explode("_j.confirmations").alias("c")).select("candidate_id", "c.category", "c.verdict")
        merged = hygiene.merged_findings(rows, saved_findings(rows), confirmations)
        place = F.array_position(F.array(*map(F.lit, SEMANTIC)), F.col("category")).cast("int") + 10
        listed = listed.unionByName(merged.withColumn("place", place))
    state = hygiene.hygiene_status(listed, judge_enabled).toDF("candidate_id", "hygiene_status", "hygiene_failures", "hygiene_errors")
    rows = gate.decide(rows.drop("hygiene_status").join(state, "candidate_id", "left"))
    return rows.withColumn("exclusion_reasons_json", gate.reasons_json(F.col("exclusion_reasons"))).drop("_j", "_span")


def reverified(saved: DataFrame, adapter, threshold: float = 1.0, judge_enabled: bool = True) -> tuple[DataFrame, DataFrame]:  # noqa: ANN001
    """Saved candidates with parsing, verification and decision made again, models' outputs as they are; and one row of (rows, errors_before, errors_after, changed)."""
    again = finalized(verified(reparsed(saved.drop("reasoning", "response", "reasoning_parsed")), adapter, threshold), judge_enabled)
    old = saved.select("candidate_id", *(F.col(c).alias(f"_old_{c}") for c in DECISIONS))
    both = again.join(old, "candidate_id")
    same = F.lit(True)
    for c in DECISIONS:
        same = same & F.col(c).eqNullSafe(F.col(f"_old_{c}"))
    report = both.agg(
        F.count("*").alias("rows"), F.count_if(F.col("_old_verification_status") == "error").alias("errors_before"), F.count_if(F.col("verification_status") == "error").alias("errors_after"), F.count_if(~same).alias("changed")
    )
    return again, report


def rejudged(saved: DataFrame, judged: DataFrame, adapter, threshold: float = 1.0) -> tuple[DataFrame, DataFrame]:  # noqa: ANN001
    """Saved candidates under a judge's new outputs, and what changed in score or selection.

    judged is (candidate_id, judge_raw_output, hygiene_findings_json); the fields of an earlier judgement are void, for rows without new outputs too.
    """
    from rollmill.operators.schemas import without_judgement

    # of several judgements of a candidate the smallest counts, by both texts
    one = judged.groupBy("candidate_id").agg(F.min(F.struct("judge_raw_output", "hygiene_findings_json")).alias("_new"))
    rows = without_judgement(saved).join(one, "candidate_id", "left")
    rows = rows.withColumns({"judge_raw_output": F.col("_new.judge_raw_output"), "hygiene_findings_json": F.col("_new.hygiene_findings_json")}).drop("_new")
    again = finalized(verified(rows, adapter, threshold))
    return again, review.decision_diff(saved, again, ["quality_score", "productivity_filtered_eligible"])


def rejudge_saved(spark: SparkSession, saved: str, judged: DataFrame, out: str, adapter, threshold: float = 1.0) -> dict[str, int]:  # noqa: ANN001
    """rejudged over a saved table, published with its changes below ``out``, and counts of both. A folder that is there already is an error, and stays as it is."""
    from rollmill.operators.schemas import CANDIDATE
    from rollmill.sources.sinks import Store, publish

    if Store(spark, out).exists(out):
        raise FileExistsError(out)
    again, changes = rejudged(spark.read.parquet(saved), judged, adapter, threshold)
    again = checkpointed(again.select(*(c for c in again.columns if c in CANDIDATE.names)))
    rows = publish(again, f"{out}/candidates")["rows"]
    return {"rows": rows, "changed": publish(changes, f"{out}/changes", least=0)["rows"]}
