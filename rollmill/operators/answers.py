"""Final answers: candidate spans, literal fallbacks, typed comparison and the verification status, all as expressions."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmill.functions.algebra import item_keys
from rollmill.functions.ids import answer_text, strip

# Answer types, the mark of an arbitrary constant, the words of a boolean, and the form of a bare number with currency, exponent, percent and unit.
EXACT_TYPES = ["boolean", "choice"]
MATH_TYPES = ["number", "expression", "equation", "set", "interval"]
SCALAR_TYPES = ["number", "expression", "equation", "boolean", "choice"]
FAMILY = "C_"
BOOLEAN_WORDS = ["true", "false", "yes", "no"]
BARE_NUMBER = r"^[$€£]?\s*[+-]?(?:\d{1,3}(?:,\d{3})+|\d+|\d*\.\d+)(?:[eE][+-]?\d+)?%?\s*(?:[A-Za-z°]+)?$"

#: Items of more characters are left to the judge.
LONGEST_ITEM = 512


def _short(x: Column, chars: int) -> Column:
    return (x != "") & (F.length(x) <= chars) & (F.size(F.split(x, r"\r\n|\r|\n")) <= 2)


def literal_answer(response: Column, status: Column) -> Column:
    """struct<answer_type, value> of a response of at most 120 characters that extraction called no_answer; else null."""
    whole = strip(F.coalesce(response, F.lit("")))
    bare = F.regexp_replace(whole, r"^[` ]+|[` ]+$", "")
    kind = (
        F.when(bare.rlike(BARE_NUMBER), "number").when(F.lower(bare).isin(BOOLEAN_WORDS), "boolean")
        .when(bare.rlike("^[A-Ea-e]$"), "choice").otherwise("text")
    )
    return F.when((status == "no_answer") & _short(whole, 120), F.struct(kind.alias("answer_type"), bare.alias("value")))


def literal_reference(reference: Column, reference_status: Column, status: Column, answer_type: Column) -> Column:
    """The source's own short answer, of the candidate's type, where extraction found none in it; else null."""
    whole = strip(F.coalesce(reference, F.lit("")))
    usable = (reference_status == "no_answer") & (status == "extracted") & answer_type.isin(SCALAR_TYPES)
    return F.when(usable & _short(whole, 200), F.struct(answer_type.alias("answer_type"), whole.alias("value")))


# The brackets of a set, and the space that may follow a comma.
SET_BRACKETS = [(r"\left\{", r"\right\}"), (r"\{", r"\}"), ("{", "}")]
COMMA_SPACE = "\\ "
_MARK = re.compile(r"[{(\[\])},]")


def split_commas(value: str) -> list[str]:
    """Parts between commas outside of all brackets, without blank ones."""
    parts, depth, begin = [], 0, 0
    for m in _MARK.finditer(value):
        c = m[0]
        depth += (c in "{([") - (c in "})]")
        if c == "," and not depth:
            parts.append(value[begin : m.start()])
            begin = m.end()
    parts = [p.strip().removeprefix(COMMA_SPACE).strip() for p in (*parts, value[begin:])]
    return [p for p in parts if p]


def _set_members(values: pd.Series) -> pd.Series:
    def members(x: str | None) -> list[str]:
        x = (x or "").strip()
        for a, b in SET_BRACKETS:
            if x.startswith(a) and x.endswith(b):
                x = x[len(a) : len(x) - len(b)].strip()
                break
        found = split_commas(x)
        return found if len(found) > 1 else [x] if x else []

    return values.map(members)


def answer_items(answer_type: Column, value: Column, values: Column) -> Column:
    """The members of a list of values; else those of a set, with or without its brackets, split at outer commas; else the value alone."""
    listed = F.filter(F.transform(values, strip), lambda v: v != "")
    alone = strip(F.coalesce(value, F.lit("")))
    single = F.when(alone == "", F.array().cast("array<string>")).otherwise(F.array(alone))
    return F.when(F.size(F.coalesce(values, F.array().cast("array<string>"))) > 0, listed).when(F.coalesce(answer_type == "set", F.lit(False)), F.pandas_udf(_set_members, "array<string>")(F.when(answer_type == "set", value))).otherwise(single)


def typed_score(gold: Column, answer: Column) -> Column:
    """1 or 0 where the two answers can be compared, null where a judge has to.

    Both are struct<answer_type, value, values array<string>, unit>. The items of both sides are matched one to one by the keys of their values,
    however they are written: numbers of any length, expressions, roots, intervals, tuples, sets. An item that can't be read, one whose key
    tells only equal writings apart, or a family of solutions with constants (C_) that doesn't match, is left to the judge.
    """
    a, b = (answer_items(x["answer_type"], x["value"], x["values"]) for x in (gold, answer))
    by_value = _by_value(gold, answer, a, b)
    return _typed_score(gold, answer, a, b, item_keys(F.when(by_value, a)), item_keys(F.when(by_value, b)))


def with_typed_score(rows: DataFrame, gold: Column, answer: Column, to: str) -> DataFrame:
    """rows with typed_score of gold and answer; each step of it is a column of its own, which is planned and worked out once."""
    g, x, a, b, m = (f"_{to}_{k}" for k in ("gold", "answer", "a", "b", "compared"))
    rows = rows.withColumns({g: gold, x: answer})
    rows = rows.withColumns({k: answer_items(F.col(f"{y}.answer_type"), F.col(f"{y}.value"), F.col(f"{y}.values")) for k, y in ((a, g), (b, x))})
    rows = rows.withColumn(m, _by_value(F.col(g), F.col(x), F.col(a), F.col(b)))
    rows = rows.withColumns({f"{k}k": item_keys(F.when(F.col(m), F.col(k))) for k in (a, b)})
    return rows.withColumn(to, _typed_score(F.col(g), F.col(x), F.col(a), F.col(b), F.col(f"{a}k"), F.col(f"{b}k"))).drop(a, b, m, f"{a}k", f"{b}k", g, x)


def _opaque(a: Column, b: Column) -> Column:
    return F.exists(F.concat(a, b), lambda v: F.contains(v, F.lit("=")) | v.rlike(r"\\(sum|int|prod)") | (F.length(v) > LONGEST_ITEM))


def _by_value(gold: Column, answer: Column, a: Column, b: Column) -> Column:
    return F.coalesce(gold["answer_type"].isin(MATH_TYPES) & answer["answer_type"].isin(MATH_TYPES) & (F.size(a) == F.size(b)) & ~_opaque(a, b), F.lit(False))


def _typed_score(gold: Column, answer: Column, a: Column, b: Column, *read: Column) -> Column:
    gold_type, type_ = gold["answer_type"], answer["answer_type"]
    want, have = (answer_text(F.coalesce(x["unit"], F.lit(""))) for x in (gold, answer))
    both, opaque = F.concat(a, b), _opaque(a, b)
    keys = [F.sort_array(F.transform(side, lambda v: v["key"])) for side in read]
    unread = F.exists(F.concat(*read), lambda v: v.isNull())
    unsure = F.exists(F.concat(*read), lambda v: ~v["sure"]) | F.exists(both, lambda v: F.contains(v, F.lit(FAMILY)))
    plain = [answer_text(F.coalesce(x["value"], F.lit(""))) for x in (gold, answer)]
    return (
        F.when(gold_type.isin(EXACT_TYPES) & type_.isin(EXACT_TYPES), (plain[0] == plain[1]).cast("double"))
        .when(~F.coalesce(gold_type.isin(MATH_TYPES) & type_.isin(MATH_TYPES), F.lit(False)), None)
        .when(gold_type.isin("equation", "expression") & type_.isin("equation", "expression") & (gold_type != type_), None)
        .when((want != "") & (have == ""), None)
        .when((want != "") & (want != have), 0.0)
        .when((F.size(a) == 0) | (F.size(b) == 0) | opaque, None)
        .when(F.size(a) != F.size(b), 0.0)
        .when(unread, None)
        .when(keys[0] == keys[1], 1.0)
        .when(unsure, None)
        .otherwise(0.0)
    )


ANSWER = "status string, answer_type string, value string, values array<string>, unit string"


def extracted(raw: Column) -> Column:
    """The answer in a JSON object whose status is extracted, as struct; else null."""
    found = F.from_json(raw, ANSWER)
    return F.when(found["status"] == "extracted", found)


def verify_pooled(rows: DataFrame, to: str, native: Column | None = None) -> DataFrame:
    """rows (verification_json, answer_json, reference_answer_json) with ``to``, struct<score, reason>: its source's answer, the candidate's and the reference's extracted answers.

    ``native`` is the score of a source with a scorer of its own; exactly equal answers raise it to 1.
    """
    mine, gold, typed = (f"_{to}_{k}" for k in ("mine", "theirs", "typed"))
    rows = rows.withColumns({mine: extracted(F.col("answer_json")), gold: extracted(F.col("reference_answer_json"))})
    rows = with_typed_score(rows, F.col(gold), F.col(mine), typed)
    verification, null = F.col("verification_json"), F.lit(None)
    own = F.get_json_object(verification, "$.source_dataset").isNotNull()
    there = strip(F.coalesce(F.get_json_object(verification, "$.entry.answer"), F.lit(""))) != ""

    def row(score: Column, reason: str | None) -> Column:
        return F.struct(score.cast("double").alias("score"), F.lit(reason).cast("string").alias("reason"))

    kinds = [F.col(f"{x}.answer_type") for x in (gold, mine)]
    by_type = F.coalesce(kinds[0].isin(MATH_TYPES) & kinds[1].isin(MATH_TYPES), F.lit(False)) | F.coalesce(kinds[0].isin(EXACT_TYPES) & kinds[1].isin(EXACT_TYPES), F.lit(False))
    both = F.col(mine).isNotNull() & F.col(gold).isNotNull()
    score = F.when(both, F.col(typed))
    found = (
        F.when(verification.isNull(), row(null, None))
        .when(own, row(F.when(score == 1, 1.0).otherwise(native if native is not None else null), None))
        .when(~there, row(null, None))
        .when(~both, row(null, "structured_answer_unavailable"))
        .when(~by_type, row(null, "answer_type_requires_model_review"))
        .otherwise(row(score, None))
    )
    return rows.withColumn(to, found).drop(mine, gold, typed)


def answer_candidates(answer: Column) -> Column:
    """The texts of an extracted answer (JSON) that a source's scorer may be asked about: the value, the values, and these joined by spaces."""
    found = extracted(answer)
    values = F.transform(F.coalesce(found["values"], F.array().cast("array<string>")), strip)
    every = F.concat(F.array(strip(F.coalesce(found["value"], F.lit("")))), values, F.array(F.array_join(values, " ")))
    return F.when(found.isNull(), F.array().cast("array<string>")).otherwise(F.filter(every, lambda v: v != ""))


def best_score(candidates: Column, score) -> Column:  # noqa: ANN001
    """The largest score of any candidate, between 0 and 1; ``score`` maps a Column to a Column."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.array_max(F.transform(candidates, score))))


def reference_text(verification: Column) -> Column:
    """The source's answer of a row's verification JSON, numbers as they are written there; null where there is none."""
    return F.get_json_object(verification, "$.entry.answer")


# What a judge is told where there is no reference answer.
NO_REFERENCE = "(no reference answer is available)"
NO_TEXT = "(the source provides a verifier but no textual reference answer)"
UNREADABLE = "(reference metadata could not be decoded; rely on the problem itself)"


def reference_answer(verification: Column) -> Column:
    """The same for a judge: JSON text of the answer, or why there is none."""
    answer = F.variant_get(F.try_parse_json(verification), "$.entry.answer", "variant")
    return (
        F.when(F.coalesce(verification, F.lit("")) == "", NO_REFERENCE).when(~F.coalesce(F.schema_of_variant(F.try_parse_json(verification)).startswith("OBJECT"), F.lit(False)), UNREADABLE)
        .when(answer.isNull() | F.is_variant_null(answer), NO_TEXT).otherwise(F.to_json(answer))
    )


def verification_status(available: Column, response: Column, score: Column, error: Column, threshold: float) -> Column:
    """unavailable, error (a missing response is one), indeterminate, passed from the threshold on, or failed."""
    return (
        F.when(~F.coalesce(available, F.lit(False)), "unavailable").when(response.isNull() | error.isNotNull(), "error")
        .when(score.isNull(), "indeterminate").when(score >= threshold, "passed").otherwise("failed")
    )


# The forms in which a final answer is looked for.
BOXED, FRACTION, SAID, LAST_NUMBER = r"\\boxed\{([^{}]+)\}", r"\\d?frac\{[^{}]+\}\{[^{}]+\}", r"(?i)answer\s*(?:is|:)\s*([^\n]+)", r"[-+]?\d+(?:\.\d+)?(?:/\d+)?"


def answer_spans(response: Column) -> Column:
    """Distinct spans that may be the final answer, in the order in which they are looked for."""
    text = strip(F.coalesce(response, F.lit("")))
    plain = F.regexp_replace(F.regexp_replace(text, r"[*_`#$]", ""), r"\\[()]", "")
    boxed = F.regexp_extract_all(text, F.lit(BOXED), F.lit(1))
    ratios = F.transform(F.regexp_extract_all(text, F.lit(FRACTION), F.lit(0)), lambda m: F.regexp_replace(m, r"^.*?\{([^{}]+)\}\{([^{}]+)\}$", "$1/$2"))
    said = F.transform(F.regexp_extract_all(plain, F.lit(SAID), F.lit(1)), strip)
    lines = F.filter(F.transform(F.split(text, "\n"), strip), lambda v: v != "")
    last = strip(F.regexp_replace(F.try_element_at(lines, F.lit(-1)), r"[*_`#]", ""))
    right = F.when(F.contains(last, F.lit("=")), F.regexp_replace(strip(F.substring_index(last, "=", -1)), r"\.+$", ""))
    number = F.try_element_at(F.regexp_extract_all(F.replace(last, F.lit(",")), F.lit(LAST_NUMBER), F.lit(0)), F.lit(-1))
    whole = number.try_cast("decimal(38,9)")
    integer = F.when(whole == F.floor(whole), whole.cast("decimal(29,0)").cast("string"))
    found = F.concat(F.array(text, plain), boxed, ratios, said, F.array(last, right, number, integer))
    return F.array_distinct(F.filter(found, lambda v: v.isNotNull() & (v != "")))
