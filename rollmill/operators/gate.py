"""The quality decision table: verdicts, caps, eligibility and exclusion reasons, all as CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Issue codes that cap a score.
MATERIAL_REASONING = ["absent", "incomplete", "factual_or_logical_error", "unsupported_step", "missing_critical_step", "contradiction", "meandering", "repetition", "unverifiable"]
MATERIAL_RESPONSE = ["incorrect", "incomplete", "instruction_violation", "format_violation", "irrelevant", "oververbose", "unsupported_claim"]


def correctness_verdict(status: Column, verdict: Column, confidence: Column) -> Column:
    """status: of the verifier; verdict and confidence: of the judge, null without parsed scores."""
    passed, high = F.coalesce(status == "passed", F.lit(False)), F.coalesce(confidence == "high", F.lit(False))
    return (
        F.when(verdict.isNull(), "indeterminate")
        .when(passed, F.when(verdict == "correct", "verified").otherwise("conflict"))
        .when(verdict == "incorrect", F.when(high, "incorrect").otherwise("indeterminate"))
        .when(verdict == "reference_conflict", "conflict")
        .when(F.coalesce(status == "failed", F.lit(False)), F.when(verdict == "correct", "conflict").otherwise("indeterminate"))
        .when((verdict == "correct") & high, "supported")
        .otherwise("indeterminate")
    )


def decide(rows: DataFrame) -> DataFrame:
    """Adds the decision to rows of

    generation_complete, verification_status, verifier_available, judge_enabled, judge_error, judge_verdict, judge_confidence,
    reasoning_score, response_score, reasoning_issues, response_issues, answer_status, hygiene_status, hygiene_failures, hygiene_errors.
    """
    c = F.col
    rows = rows.withColumn("correctness_verdict", correctness_verdict(c("verification_status"), c("judge_verdict"), c("judge_confidence")))
    rows = rows.withColumn("raw_score", F.when(c("reasoning_score").isNotNull() & c("response_score").isNotNull(), F.least("reasoning_score", "response_score")))
    v, hygiene = c("correctness_verdict"), c("hygiene_status")
    listed = lambda *pairs: F.array_compact(F.array(*(F.when(on, F.lit(name)) for on, name in pairs)))
    broken = c("judge_enabled") & (c("judge_error").isNotNull() | c("raw_score").isNull())
    rows = rows.withColumn("zero_reasons", listed((~c("generation_complete"), "generation_incomplete"), (v == "incorrect", "answer_incorrect"), (broken, "judge_error")))
    zeroed = F.size("zero_reasons") > 0
    material = F.coalesce(F.arrays_overlap("reasoning_issues", F.array(*map(F.lit, MATERIAL_REASONING))), F.lit(False)) | F.coalesce(F.arrays_overlap("response_issues", F.array(*map(F.lit, MATERIAL_RESPONSE))), F.lit(False))
    unsure = (v == "indeterminate") & c("verifier_available")
    caps = listed((v == "conflict", "correctness_conflict"), (unsure, "correctness_indeterminate"), (material, "material_judge_issue"), (hygiene == "failed", "hygiene_defect"), (hygiene == "indeterminate", "hygiene_uncertain"))
    rows = rows.withColumn("cap_reasons", F.when(zeroed, F.array().cast("array<string>")).otherwise(caps))
    cap = F.when(F.array_contains("cap_reasons", "hygiene_defect"), 2).when(F.size("cap_reasons") > 0, 3).otherwise(5)
    rows = rows.withColumn("quality_score", F.when(zeroed, 0).when(c("raw_score").isNotNull(), F.least(c("raw_score"), cap)).cast("bigint"))
    right = c("generation_complete") & v.isin("verified", "supported") & F.coalesce(c("answer_status").isin("extracted", "conditional"), F.lit(False)) & c("judge_error").isNull()
    rows = rows.withColumn("correctness_only_eligible", right)
    high = F.coalesce(c("quality_score") >= 4, F.lit(False))
    rows = rows.withColumn("productivity_filtered_eligible", right & F.coalesce(hygiene == "passed", F.lit(False)) & high)
    answered = F.coalesce(c("answer_status").isin("extracted", "conditional"), F.lit(False))
    why = F.concat(
        listed(
            (~c("generation_complete"), "generation_incomplete"),
        ),
        F.when(v.isin("verified", "supported"), F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("correctness_"), v))),
        listed((~answered, "final_answer_unavailable"), (c("judge_error").isNotNull(), "judge_error"), (F.size("hygiene_errors") > 0, "hygiene_error"), (~high, "quality_below_4")),
        F.when(F.coalesce(hygiene == "passed", F.lit(False)), F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("hygiene_"), hygiene))),
        F.transform("hygiene_failures", lambda x: F.concat(F.lit("hygiene_"), x)),
    )
    status = F.when(~c("judge_enabled"), "disabled").when(broken, "error").otherwise("passed")
    return rows.withColumns({"exclusion_reasons": why, "judge_status": status})


def reasons_json(x: Column) -> Column:
    return F.when(F.size(x) == 0, "[]").otherwise(F.concat(F.lit('["'), F.array_join(x, '", "'), F.lit('"]')))
