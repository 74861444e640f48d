"""Reasoning and response out of raw generations, and the state of a generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmill.functions.ids import strip


def before(x: Column, tag: str) -> Column:
    return F.substring_index(x, tag, 1)


def after(x: Column, tag: str) -> Column:
    """What follows the first occurrence of the tag, which is there."""
    return F.substring(x, F.locate(tag, x) + len(tag), F.length(x))


def split_reasoning(rows: DataFrame, raw: str = "raw_generation") -> DataFrame:
    """Adds reasoning, response and reasoning_parsed.

    In order: both pairs of tags; a reasoning tag that is malformed or missing its start; an open response (not parsed); reasoning
    alone; a JSON object with both texts; <think> with and without its end; </think> alone; plain text as the response.
    """
    x = F.col(raw)
    has = lambda t: F.contains(x, F.lit(t))
    json_ = F.from_json(F.regexp_replace(F.regexp_replace(strip(x), r"^```(?:json)?\s*", ""), r"\s*```$", ""), "struct<reasoning string, response string>")
    closed, pair = has("</reasoning>"), has("<response>") & has("</response>")
    inside = before(after(x, "<response>"), "</response>")
    null = F.lit(None).cast("string")

    def row(reasoning: Column, response: Column, parsed: bool) -> Column:
        return F.struct(reasoning.alias("a"), response.alias("b"), F.lit(parsed).alias("p"))

    out = (
        F.when(F.coalesce(x, F.lit("")) == "", row(null, null, False))
        .when(has("<reasoning>") & closed & pair, row(strip(before(after(x, "<reasoning>"), "</reasoning>")), strip(inside), True))
        .when(closed & pair, row(strip(F.regexp_replace(before(x, "</reasoning>"), r"(?i)^<reasoning>?\s*", "")), strip(inside), True))
        .when(has("<reasoning>") & has("<response>"), row(strip(F.regexp_replace(strip(before(after(x, "<reasoning>"), "<response>")), r"</think>$", "")), strip(after(x, "<response>")), False))
        .when(has("<reasoning>"), row(strip(before(after(x, "<reasoning>"), "</reasoning>")), null, False))
        .when(json_.getField("reasoning").isNotNull() & json_.getField("response").isNotNull(), row(strip(json_.getField("reasoning")), strip(json_.getField("response")), True))
        .when(has("<think>") & ~has("</think>"), row(strip(after(x, "<think>")), null, False))
        .when(has("<think>"), row(strip(before(after(x, "<think>"), "</think>")), strip(after(x, "</think>")), True))
        .when(has("</think>"), row(strip(before(x, "</think>")), strip(after(x, "</think>")), True))
        .otherwise(row(null, strip(x), False))
    )
    rows = rows.withColumn("_s", out)
    return rows.withColumns({"reasoning": F.col("_s.a"), "response": F.col("_s.b"), "reasoning_parsed": F.col("_s.p")}).drop("_s")


def generation_state(rows: DataFrame) -> DataFrame:
    """Adds response_present, generation_complete and generation_status from the parsed columns and finish_reason."""
    present = F.col("response").isNotNull()
    cut = F.coalesce(F.col("finish_reason").isin("length", "abort"), F.lit(False))
    complete = F.col("reasoning_parsed") & (F.coalesce(F.col("response"), F.lit("")) != "") & ~cut
    status = F.when(F.col("raw_generation").isNull(), "failed").when(complete, "ok").otherwise("incomplete")
    return rows.withColumns({"response_present": present, "generation_complete": complete, "generation_status": status})
