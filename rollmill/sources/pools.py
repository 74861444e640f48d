"""Prompt and reference rows from raw source tables."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmill.functions.ids import blank, stable_id, strip
from rollmill.operators.parsing import after, before


# Columns of prompts and references, in order.
PROMPT_COLUMNS = ["sample_id", "user_prompt", "source", "provenance_json", "system_prompt", "verification_json", "difficulty_band", "difficulty_value", "subset", "domain"]
REFERENCE_COLUMNS = ["sample_id", "reference_id", "reasoning", "response", "source_model", "source", "provenance_json"]


def prompt_rows(raw: DataFrame, repo: str, revision: str, *, prompt: Column, source: Column, answer: Column, band: Column, difficulty: Column, subset: Column, domain: Column, metadata: Column) -> DataFrame:
    """raw with PROMPT_COLUMNS and the answer as _answer. Ids don't depend on the revision; verification is there only for an answer that isn't blank.

    metadata is a struct whose fields come in the order of their names; nulls are written.
    """
    text = answer.cast("string")
    keep = {"ignoreNullFields": "false"}
    provenance = F.struct(
        F.lit("pool").alias("adapter"), F.lit(repo).alias("dataset"), F.lit(revision).alias("dataset_revision"), band.alias("difficulty_band"),
        difficulty.cast("double").alias("difficulty_value"), domain.alias("domain"), metadata.alias("metadata"), subset.alias("subset"),
    )
    entry = F.to_json(F.struct(F.struct(answer.alias("answer")).alias("entry"), F.lit("reference_answer").alias("type")))
    return raw.withColumns({
        "sample_id": stable_id(F.lit("source_pool"), F.lit(repo), prompt), "user_prompt": prompt, "source": source, "provenance_json": F.to_json(provenance, keep), "system_prompt": F.lit(None).cast("string"),
        "verification_json": F.when(~blank(text), entry), "difficulty_band": band, "difficulty_value": difficulty.cast("double"), "subset": subset, "domain": domain, "_answer": text,
    })


def reference_rows(prompts: DataFrame, columns: list[str], model: str, source: Column | None = None) -> DataFrame:
    """REFERENCE_COLUMNS and raw: one row for each solution that isn't blank, of prompts with sample_id and, for the response, _answer.

    Each column's name, or ``source``, is the source of its solutions; repeated prompts keep all of theirs.
    """
    each = F.array(*(F.struct(F.lit(c).alias("source"), F.lit(k).alias("k"), F.col(c).alias("raw")) for k, c in enumerate(columns, 1)))
    own = source if source is not None else F.lit(None).cast("string")
    stacked = prompts.select("sample_id", "_answer", own.alias("_source"), F.explode(each).alias("s")).where(~blank(F.col("s.raw")))
    name = F.coalesce("_source", "s.source")
    reasoning, response = split_response(F.col("s.raw"), F.col("_answer"))
    return stacked.select(
        "sample_id", stable_id(F.col("sample_id"), name, F.lit(model), F.col("s.raw")).alias("reference_id"), reasoning.alias("reasoning"), response.alias("response"),
        F.lit(model).alias("source_model"), name.alias("source"), F.to_json(F.struct(F.col("s.k").alias("solution_index"))).alias("provenance_json"), F.col("s.raw").alias("raw"),
    )


def split_response(raw: Column, answer: Column) -> tuple[Column, Column]:
    """<think>...</think> gives reasoning and the rest, or the answer; other texts are reasoning with the answer as response. Blank parts are null."""
    text, said = strip(raw), F.when(~blank(answer), strip(answer))
    tagged = F.contains(text, F.lit("<think>")) & F.contains(text, F.lit("</think>"))
    inner = strip(before(after(text, "<think>"), "</think>"))
    rest = strip(after(text, "</think>"))
    full = lambda x: F.when(x != "", x)
    return F.when(tagged, full(inner)).otherwise(text), F.when(tagged, F.coalesce(full(rest), strip(answer))).otherwise(said)


def graded_band(x: Column) -> Column:
    return F.when(x.isNull(), "unknown").when(x <= 4, "easy").when(x <= 6.5, "medium").otherwise("hard")


def pass_rate_band(x: Column) -> Column:
    return F.when(x.isNull(), "unknown").when(x >= 0.75, "easy").when(x > 0.25, "medium").otherwise("hard")


def level_band(x: Column) -> Column:
    return F.when(x.isNull(), "unknown").when(x <= 6, "easy").when(x <= 8, "medium").otherwise("hard")


def first_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, user_prompt, response) of the first user and first assistant turn; conversations without a user are left out."""
    first = lambda role: F.min_by(F.when(F.col("role") == role, F.col("text")), F.when(F.col("role") == role, F.col("turn")))
    return conversations.groupBy("conv_id").agg(first("user").alias("user_prompt"), first("assistant").alias("response")).where("user_prompt is not null")


_TOKEN = re.compile(r"\\(boxed|fbox)\{|(?<!\\)[{}]")


def last_boxed(text: str | None) -> str | None:
    """The last \\boxed{...}, or rather \\fbox{...}, that is closed and not blank. Braces after a backslash don't count."""
    found: dict[str, tuple[int, str]] = {}
    open_: list[tuple[str | None, int]] = []
    for m in _TOKEN.finditer(text or ""):
        if m[0] != "}":
            open_.append((m[1], m.end()))
        elif open_:
            kind, at = open_.pop()
            value = text[at : m.start()].strip() if kind else ""
            if value and found.get(kind, (-1, ""))[0] < at:
                found[kind] = at, value
    return found.get("fbox", found.get("boxed", (0, None)))[1]


def _boxed(texts: pd.Series) -> pd.Series:
    return texts.map(last_boxed)


def boxed_value(text: Column) -> Column:
    """last_boxed of a column; only texts with a marker are looked at."""
    return F.pandas_udf(_boxed, "string")(F.when(text.rlike(r"\\(boxed|fbox)\{"), text))
