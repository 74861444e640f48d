"""Outputs of models read strictly: judge scores, answer extractions, hygiene assessments. All are expressions over JSON texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollmill.functions.binding import bound
from rollmill.functions.ids import fold_case, strip
from rollmill.functions.json_text import json_block, only_keys, unfenced, whole_number

# What each field may hold.
VERDICTS = ["correct", "incorrect", "indeterminate", "reference_conflict"]
CONFIDENCES = ["high", "medium", "low"]
REASONING_ISSUES = ["absent", "incomplete", "factual_or_logical_error", "unsupported_step", "missing_critical_step", "contradiction", "meandering", "repetition", "meta_commentary", "poor_structure", "unverifiable"]
RESPONSE_ISSUES = ["incorrect", "incomplete", "instruction_violation", "format_violation", "irrelevant", "unclear", "oververbose", "unsupported_claim", "meta_commentary"]
SEMANTIC = ["repetition", "circular_rechecking", "no_new_progress", "unresolved_branch"]
CONFIRMATIONS = ["confirmed_defect", "rejected", "uncertain"]
STATUSES = ["extracted", "conditional", "no_answer", "ambiguous"]
ANSWER_TYPES = ["number", "expression", "equation", "set", "interval", "boolean", "choice", "text", "code", "proof", "other"]
FINDINGS = ["defect", "clear", "uncertain"]
# Feedback that contradicts a verdict.
SAYS_CORRECT = r"candidate(?:'s)? (?:final )?answer [^.!?;\n]{0,120}?\b(?:is|was) (?:mathematically )?correct\b"
SAYS_INCORRECT = r"candidate(?:'s)? (?:final )?answer [^.!?;\n]{0,120}?\b(?:is|was) incorrect\b"
REJECTS_REFERENCE = r"(?:reference|source)(?: answer)? [^.!?;\n]{0,120}?\b(?:is|was) (?:demonstrably )?(?:incorrect|wrong|false)\b"

_PART = "struct<score: string, issues: array<string>, feedback: string>"
_SCORES = f"correctness struct<verdict: string, confidence: string, feedback: string>, reasoning {_PART}, response {_PART}, hygiene_confirmations array<struct<category: string, verdict: string, feedback: string>>"


def _first(*rules: tuple[Column, str]) -> Column:
    """The name of the first rule that isn't kept; a rule that can't be told isn't."""
    out = F.lit(None).cast("string")
    for kept, name in reversed(rules):
        out = F.when(~F.coalesce(kept, F.lit(False)), name).otherwise(out)
    return out


def _among(x: Column, values: list[str]) -> Column:
    return x.isin(values)


def _all_among(x: Column, values: list[str]) -> Column:
    return F.forall(x, lambda v: F.coalesce(v.isin(values), F.lit(False)))


def _sized(x: Column, most: int) -> Column:
    return F.length(x).between(1, most)


def judge_scores(raw: Column) -> Column:
    """struct<verdict, confidence, reasoning_score, response_score, reasoning_issues, response_issues, confirmations, error> of a judge's output.

    error names the rule that the output breaks, and the rest is null then; issues are distinct, in order.
    """
    return bound(F.struct(raw.alias("raw"), json_block(raw).alias("block")), lambda r: bound(F.from_json(r["block"], _SCORES), lambda x: _judge_scores(r["raw"], r["block"], x)))


def _judge_scores(raw: Column, block: Column, x: Column) -> Column:
    correctness, confirmations = x["correctness"], F.coalesce(x["hygiene_confirmations"], F.from_json(F.lit("[]"), "array<struct<category: string, verdict: string, feedback: string>>"))
    scores = {k: whole_number(x[k]["score"]) for k in ("reasoning", "response")}
    issues = {k: F.array_distinct(x[k]["issues"]) for k in ("reasoning", "response")}
    verdict, said = correctness["verdict"], fold_case(correctness["feedback"])
    part = lambda k: F.get_json_object(block, f"$.{k}")
    known = only_keys(block, ["correctness", "reasoning", "response", "hygiene_confirmations"]) & only_keys(part("correctness"), ["verdict", "confidence", "feedback"])
    for k in ("reasoning", "response"):
        known = known & only_keys(part(k), ["score", "issues", "feedback"])
    rules = [
        (F.coalesce(raw, F.lit("")) != "", "empty"), (block != "", "no_object"), (known, "fields"),
        (_among(verdict, VERDICTS) & _among(correctness["confidence"], CONFIDENCES) & _sized(correctness["feedback"], 500), "correctness"),
        ((verdict != "incorrect") | ~said.rlike(SAYS_CORRECT), "feedback_says_correct"),
        (~verdict.isin("correct", "reference_conflict") | ~said.rlike(SAYS_INCORRECT), "feedback_says_incorrect"),
        ((verdict != "correct") | ~said.rlike(REJECTS_REFERENCE), "feedback_rejects_reference"),
    ]
    for k, allowed in (("reasoning", REASONING_ISSUES), ("response", RESPONSE_ISSUES)):
        rules.append((scores[k].between(1, 5) & _all_among(issues[k], allowed) & _sized(x[k]["feedback"], 300), k))
        rules.append(((scores[k] < 5) == (F.size(issues[k]) > 0), f"{k}_issues"))
    names = F.transform(confirmations, lambda c: c["category"])
    each = F.forall(confirmations, lambda c: F.coalesce(c["category"].isin(SEMANTIC) & c["verdict"].isin(CONFIRMATIONS) & F.length(c["feedback"]).between(1, 300), F.lit(False)))
    rules += [
        ((F.size(confirmations) <= 4) & each & (F.size(names) == F.size(F.array_distinct(names))), "hygiene_confirmations"),
        (~verdict.isin("incorrect", "indeterminate") | (scores["response"] <= 3), "response_too_good"),
        (~verdict.isin("correct", "reference_conflict") | ~F.array_contains(issues["response"], "incorrect"), "correct_with_issue"),
    ]
    fields = {
        "verdict": verdict, "confidence": correctness["confidence"], "reasoning_score": scores["reasoning"], "response_score": scores["response"],
        "reasoning_issues": issues["reasoning"], "response_issues": issues["response"], "confirmations": confirmations,
    }
    return _read(fields, _first(*rules), "verdict string, confidence string, reasoning_score bigint, response_score bigint, reasoning_issues array<string>, response_issues array<string>, confirmations array<struct<category: string, verdict: string, feedback: string>>")


def _read(fields: dict[str, Column], error: Column, schema: str) -> Column:
    """The fields without an error, or nulls with it."""
    nulls = F.from_json(F.lit("{}"), schema)
    return bound(error, lambda e: F.when(e.isNull(), F.struct(*(x.alias(k) for k, x in fields.items()), F.lit(None).cast("string").alias("error"))).otherwise(F.struct(*(nulls[k].alias(k) for k in fields), e.alias("error"))))


_EXTRACTION = "status string, answer_type string, value string, values array<string>, unit string, evidence string"


def answer_extraction(raw: Column) -> Column:
    """struct<status, answer_type, value, values, unit, evidence, error> of an extractor's output; error names the broken rule."""
    return bound(F.struct(raw.alias("raw"), json_block(raw).alias("block")), lambda r: bound(F.from_json(r["block"], _EXTRACTION), lambda x: _answer_extraction(r["raw"], r["block"], x)))


def _answer_extraction(raw: Column, block: Column, x: Column) -> Column:
    values = F.coalesce(x["values"], F.array().cast("array<string>"))
    given, listed = F.coalesce(x["value"], F.lit("")) != "", F.size(values) > 0
    error = _first(
        (F.coalesce(raw, F.lit("")) != "", "empty"), (block != "", "no_object"), (only_keys(block, ["status", "answer_type", "value", "values", "unit", "evidence"]), "fields"),
        (_among(x["status"], STATUSES) & _among(x["answer_type"], ANSWER_TYPES) & (F.length(F.coalesce(x["evidence"], F.lit(""))) <= 500), "values"),
        ((x["status"] != "extracted") | given | listed, "extracted_without_value"),
        ((x["status"] != "conditional") | ((x["answer_type"] == "text") & given & ~listed), "conditional_form"),
    )
    return _read({k: values if k == "values" else x[k] for k in ("status", "answer_type", "value", "values", "unit", "evidence")}, error, _EXTRACTION)


def assessment(raw: Column, category: Column, reasoning: Column, response: Column, truncated: Column, anchored) -> Column:  # noqa: ANN001
    """struct<category, verdict, method, evidence, explanation, error>: a model's finding, uncertain where it isn't complete or proven.

    ``anchored`` is phases.anchoring: it tells whether excerpts occur, and whether they occur often enough.
    """
    given = F.struct(raw.alias("raw"), unfenced(raw).alias("text"), category.alias("category"), truncated.alias("truncated"), reasoning.alias("reasoning"), response.alias("response"))
    form = "verdict string, evidence array<string>, explanation string"
    return bound(given, lambda g: bound(F.from_json(g["text"], form), lambda x: _assessment(g, x, anchored)))


def _assessment(g: Column, x: Column, anchored) -> Column:  # noqa: ANN001
    raw, category, truncated, reasoning, response = (g[c] for c in ("raw", "category", "truncated", "reasoning", "response"))
    well = only_keys(g["text"], ["verdict", "evidence", "explanation"]) & x["verdict"].isin(FINDINGS) & (F.size(x["evidence"]) <= 2) & x["evidence"].isNotNull() & _sized(x["explanation"], 240)
    well = F.coalesce(well & ((x["verdict"] != "defect") | (F.size(x["evidence"]) > 0)), F.lit(False))
    evidence = F.filter(F.transform(x["evidence"], strip), lambda e: e != "")
    there, often = anchored(evidence, reasoning, response, category)
    none = F.array().cast("array<string>")

    def unsure(why: str, error: str | None) -> Column:
        return F.struct(category.alias("category"), F.lit("uncertain").alias("verdict"), F.lit("model").alias("method"), none.alias("evidence"), F.lit(why).alias("explanation"), F.lit(error).cast("string").alias("error"))

    defect = x["verdict"] == "defect"
    return (
        F.when(F.coalesce(raw, F.lit("")) == "", unsure("no assessment came back", "empty model output"))
        .when(~well, unsure("the assessment could not be read", "unreadable assessment"))
        .when(defect & ~there, unsure("the evidence is no excerpt of the stored trace", "unanchored evidence"))
        .when(defect & ~often, unsure("two occurrences were not shown", None))
        .when((x["verdict"] == "clear") & F.coalesce(truncated, F.lit(False)), unsure("the trace was cut before this check", None))
        .otherwise(F.struct(category.alias("category"), x["verdict"].alias("verdict"), F.lit("model").alias("method"), evidence.alias("evidence"), x["explanation"].alias("explanation"), F.lit(None).cast("string").alias("error")))
    )


def seed_error(sample_id: Column, prompt: Column, source: Column, provenance: Column, verification: Column) -> Column:
    """The first rule that a seed row breaks: ids, prompt and source aren't empty, provenance and verification are JSON objects (or null)."""
    from rollmill.functions.json_text import is_object

    full = lambda x: F.length(x) > 0
    return _first((full(sample_id), "sample_id"), (full(prompt), "user_prompt"), (full(source), "source"), (is_object(provenance), "provenance_json"), (verification.isNull() | is_object(verification), "verification_json"))
