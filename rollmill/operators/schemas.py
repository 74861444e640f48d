"""The durable tables: candidates, the projection for training, and the JSON Schema of quality details."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollmill.operators import judge

# Names and types of the fields of candidates, by what they are about; and the columns for training.
_FIELDS = """
    sample_id string, candidate_id string, candidate_index bigint, source string, model string, provenance_json string, system_prompt string, user_prompt string,
    draft_generation string, draft_finish_reason string, draft_num_input_tokens bigint, draft_num_generated_tokens bigint,
    raw_generation string, finish_reason string, num_input_tokens bigint, num_generated_tokens bigint, generation_error string, batch_generation_error string,
    reasoning string, response string, reasoning_parsed boolean, response_present boolean, generation_complete boolean, generation_status string, reasoning_num_tokens bigint, response_num_tokens bigint,
    answer_json string, candidate_answer_raw_output string, candidate_answer_method string, candidate_answer_error string,
    reference_answer_json string, reference_answer_raw_output string, reference_answer_method string, reference_answer_error string,
    verification_json string, verifier_name string, verifier_available boolean, verifier_score double, verifier_threshold double, verifier_error string, verifier_details_json string, verification_status string,
    critic_analyses_json string, judge_raw_output string, judge_first_raw_output string, judge_retry_count bigint, judge_finish_reason string, judge_num_generated_tokens bigint,
    judge_generation_error string, batch_judge_generation_error string, judge_status string,
    hygiene_findings_json string, hygiene_raw_outputs_json string, hygiene_status string,
    correctness_verdict string, quality_score bigint, quality_details_json string, correctness_only_eligible boolean, productivity_filtered_eligible boolean, exclusion_reasons_json string
"""
_KINDS = {"string": T.StringType(), "bigint": T.LongType(), "boolean": T.BooleanType(), "double": T.DoubleType()}
CANDIDATE = T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in (field.split() for field in _FIELDS.split(","))])
SFT_COLUMNS = [
    "sample_id", "candidate_id", "candidate_index", "system_prompt", "user_prompt", "reasoning", "response", "reasoning_num_tokens", "response_num_tokens", "answer_json",
    "correctness_verdict", "source", "model", "quality_score", "quality_details_json", "hygiene_status", "correctness_only_eligible", "productivity_filtered_eligible",
    "exclusion_reasons_json", "provenance_json",
]
# Fields of a judge's work, void before it judges again.
JUDGED = ["judge_generation_error", "batch_judge_generation_error", "critic_analyses_json", "judge_raw_output", "judge_first_raw_output", "judge_finish_reason", "judge_num_generated_tokens", "judge_retry_count", "hygiene_findings_json", "hygiene_raw_outputs_json"]


def unknown_fields(rows: DataFrame) -> list[str]:
    return sorted(set(rows.columns) - set(CANDIDATE.names))


def as_candidates(rows: DataFrame) -> DataFrame:
    """rows with all fields of candidates, in order and type, null where there is none; other fields are an error."""
    if extra := unknown_fields(rows):
        raise ValueError(f"no fields of candidates: {', '.join(extra)}")
    have = set(rows.columns)
    return rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in CANDIDATE))


def for_training(candidates: DataFrame) -> DataFrame:
    return candidates.select(SFT_COLUMNS)


def without_judgement(candidates: DataFrame) -> DataFrame:
    """candidates with the fields of a judge's work null."""
    return candidates.withColumns({c: F.lit(None).cast(CANDIDATE[c].dataType) for c in JUDGED if c in candidates.columns})


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Rows of tables with different columns; what a table lacks is null."""
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def quality_schema() -> dict:
    """JSON Schema of quality_details_json, out of the values that judge.py allows."""

    def one(values: list[str]) -> dict:
        return {"enum": values}

    def obj(**fields) -> dict:  # noqa: ANN003
        return {"type": "object", "additionalProperties": False, "properties": fields}

    def listed(of: dict) -> dict:
        return {"type": "array", "items": of}

    def optional(of: dict) -> dict:
        return {"anyOf": [of, {"type": "null"}]}

    text, score = {"type": "string"}, {"type": "integer", "minimum": 1, "maximum": 5}
    graded = lambda issues: obj(score=score, issues=listed(one(issues)), feedback={"type": "string", "minLength": 1, "maxLength": 300})
    return obj(
        correctness=optional(obj(verdict=one(judge.VERDICTS), confidence=one(judge.CONFIDENCES), feedback={"type": "string", "minLength": 1, "maxLength": 500})),
        reasoning=optional(graded(judge.REASONING_ISSUES)), response=optional(graded(judge.RESPONSE_ISSUES)),
        verification=obj(status=one(["passed", "failed", "indeterminate", "error", "unavailable"]), score=optional({"type": "number", "minimum": 0, "maximum": 1})),
        answer=optional(obj(status=one(judge.STATUSES), answer_type=one(judge.ANSWER_TYPES), value=optional(text), values=listed(text), unit=optional(text))),
        hygiene=obj(status=one(["passed", "failed", "indeterminate", "not_run"]), findings=listed(obj(category=text, verdict=one(judge.FINDINGS), method=one(["deterministic", "model"]), evidence=listed(text))), failure_categories=listed(text), errors=listed(text)),
        decision=obj(quality_score=optional({"type": "integer", "minimum": 0, "maximum": 5}), cap_reasons=listed(text), zero_reasons=listed(text), exclusion_reasons=listed(text)),
    )
