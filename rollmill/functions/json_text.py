"""JSON texts: canonical form, objects and lists out of strings, fences of code."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from rollmill.functions.ids import strip


def _canonical(raw: pd.Series) -> pd.Series:
    def one(x: str | None) -> str | None:
        try:
            return None if x is None else json.dumps(json.loads(x), ensure_ascii=False, sort_keys=True, separators=(",", ":"))
        except ValueError:
            return None

    return raw.map(one)


def canonical_json(raw: Column) -> Column:
    """Keys sorted, no spaces, characters as they are; null for what isn't JSON. Whole numbers and fractions stay apart (1 and 1.0), which variants don't keep."""
    return F.pandas_udf(_canonical, "string")(raw)


def is_object(raw: Column) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_parse_json(raw)).startswith("OBJECT"), F.lit(False))


def json_object(raw: Column) -> Column:
    """The canonical object of a JSON text, an empty one for null; null for what is no object."""
    return F.when(raw.isNull(), "{}").when(is_object(raw), canonical_json(raw))


def json_items(raw: Column) -> Column:
    """The members of a JSON list, each as JSON text; none of anything else."""
    found = F.try_variant_get(F.try_parse_json(raw), "$", "array<variant>")
    return F.coalesce(F.transform(found, lambda v: F.to_json(v)), F.array().cast("array<string>"))


def json_strings(raw: Column) -> Column:
    """The members of a JSON list as texts, strings without their quotes; none of anything else."""
    return F.coalesce(F.from_json(F.when(strip(raw).startswith("["), raw), "array<string>"), F.array().cast("array<string>"))


def json_block(raw: Column) -> Column:
    """From the first opening brace to the last closing one; empty where there is none."""
    return F.regexp_extract(raw, r"(?s)\{.*\}", 0)


def unfenced(raw: Column) -> Column:
    """Without the fence of a code block around it."""
    return strip(F.regexp_replace(F.regexp_replace(strip(raw), r"^```(json)?", ""), r"```$", ""))


def whole_number(raw: Column) -> Column:
    """An integer, or the text of one, with or without a zero fraction; null for anything else."""
    return F.when(raw.rlike(r"^\s*[+-]?\d{1,18}(\.0+)?\s*$"), F.trim(F.regexp_replace(raw, r"\.0+\s*$", "")).cast("bigint"))


def only_keys(raw: Column, allowed: list[str]) -> Column:
    """Whether a JSON object has no other keys."""
    return F.coalesce(F.size(F.array_except(F.json_object_keys(raw), F.array(*map(F.lit, allowed)))) == 0, F.lit(False))
