"""Model phases as joins: requests out, responses in, retries, evidence checks and what fits a prompt.

A provider is any job that answers a table of requests with a table of responses; it is not part of this package.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmill.functions.ids import blank, collapse, phase_seed, strip

MARKER = "\n\n[cut]\n\n"

# Categories whose evidence must occur twice, and that whose evidence may be in the response.
TWICE = ["repetition", "circular_rechecking"]
IN_RESPONSE = "unresolved_branch"
# Categories whose traces are shown in two parts, from so many characters on, and where the later part starts.
IN_PARTS, PART_CHARS, PART_AT = ["circular_rechecking", "no_new_progress"], 4000, 0.65


def sample_requests(rows: DataFrame, key: str, samples: int) -> DataFrame:
    """(key, sample_index): a request for each row and sample."""
    return rows.select(key, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(samples - 1).cast("bigint"))).alias("sample_index"))


def regroup(requests: DataFrame, responses: DataFrame, key: str, text: str) -> DataFrame:
    """(key, texts in order of sample_index, missing): answers to requests by a left join; what wasn't answered is counted, never dropped.

    A request that is answered twice keeps the smaller text. Responses without a request are ignored.
    """
    one = responses.groupBy(key, "sample_index").agg(F.min(text).alias(text))
    both = requests.join(one, [key, "sample_index"], "left").groupBy(key)
    pairs = F.array_sort(F.collect_list(F.when(F.col(text).isNotNull(), F.struct("sample_index", text))))
    return both.agg(F.transform(pairs, lambda s: s[text]).alias("texts"), F.count_if(F.col(text).isNull()).alias("missing"))


def with_retry(rows: DataFrame, again: DataFrame, key: str, valid: str, output: str, attempt: int = 1) -> DataFrame:
    """Attempt 1 or 2 where the output so far isn't valid: retry_count says how often a row was asked again, first_output keeps what came first.

    A retry without an answer leaves what there is; of several answers to one row the smallest counts.
    """
    retried = again.groupBy(key).agg(F.min(output).alias("_again"))
    joined = rows.join(retried, key, "left")
    failed = ~F.coalesce(F.col(valid), F.lit(False))
    first = F.col("first_output") if "first_output" in rows.columns else F.col(output)
    count = F.when(failed, F.lit(attempt)).otherwise(F.col("retry_count") if "retry_count" in rows.columns else F.lit(0)).cast("bigint")
    return joined.withColumns({"first_output": first, "retry_count": count, output: F.when(failed, F.coalesce("_again", output)).otherwise(F.col(output))}).drop("_again")


def retry_requests(rows: DataFrame, key: str, valid: str, output: str, attempt: int) -> DataFrame:
    """(key, kind) of the rows to ask again: the first time to repair an output that has scores, or to ask anew; the second time without a form."""
    kind = F.when(F.contains(F.coalesce(output, F.lit("")), F.lit('"response"')), "repair").otherwise("ask") if attempt == 1 else F.lit("free")
    return rows.where(~F.coalesce(F.col(valid), F.lit(False))).select(key, kind.alias("kind"))


def generation_requests(rows: DataFrame, mode: str) -> DataFrame:
    """rows with phase, and what a failed polish leaves: draft_polish asks for a draft; direct and direct_polish ask for the answer itself."""
    if mode not in ("draft_polish", "direct", "direct_polish"):
        raise ValueError(f"unknown mode {mode}")
    return rows.withColumn("phase", F.lit("draft" if mode == "draft_polish" else "direct"))


def polished(rows: DataFrame, answers: DataFrame, mode: str, polish: bool = True) -> DataFrame:
    """rows (candidate_id, draft_generation) with raw_generation: the polished text; direct modes, and no polish, keep the draft where none came.

    Rows without a draft aren't polished.
    """
    one = answers.groupBy("candidate_id").agg(F.min("text").alias("_text"))
    joined = rows.join(one, "candidate_id", "left")
    drafted = ~blank(F.col("draft_generation"))
    keep = F.when(drafted, F.col("draft_generation")) if mode != "draft_polish" or not polish else F.lit(None).cast("string")
    return joined.withColumn("raw_generation", F.coalesce(F.when(drafted, F.col("_text")) if polish else F.lit(None).cast("string"), keep)).drop("_text")


def extraction_requests(rows: DataFrame) -> DataFrame:
    """(candidate_id, target, text): the response, and the source's answer where there is one."""
    both = F.array(F.struct(F.lit("candidate").alias("target"), F.col("response").alias("text")), F.struct(F.lit("reference").alias("target"), F.col("reference_text").alias("text")))
    out = rows.select("candidate_id", F.explode(both).alias("r")).select("candidate_id", "r.target", "r.text")
    return out.where((F.col("target") == "candidate") | F.col("text").isNotNull())


def critique_kind(sample_index: Column) -> Column:
    """Even samples judge the whole, odd ones look at steps."""
    return F.when(sample_index % 2 == 0, "critique_global").otherwise("critique_local")


def settled(requests: DataFrame, answers: DataFrame, keys: list[str], answer: str = "text") -> DataFrame:
    """requests with the answer to each and an error: the answer's own, or that there is none. One failed request concerns no other."""
    one = answers.groupBy(*keys).agg(F.min(F.struct(F.coalesce("error", F.lit("")).alias("e"), F.col(answer).alias("t"))).alias("_a"))
    joined = requests.join(one, keys, "left")
    error = F.when(F.col("_a").isNull(), "no response").when(F.col("_a.e") != "", F.col("_a.e"))
    return joined.withColumns({answer: F.when(error.isNull(), F.col("_a.t")), "error": error}).drop("_a")


def error_column(phase: Column) -> Column:
    """The column that takes a phase's error: those of judging phases don't spoil a generation."""
    judging = phase.startswith("critique") | phase.startswith("arbitration") | phase.isin("hygiene", "retry")
    return F.when(judging, "judge_generation_error").otherwise("generation_error")


def unfinished(raw: Column, finish_reason: Column) -> Column:
    """A text of thoughts alone that was cut stays open, so that parsing sees no response."""
    return F.when((finish_reason == "length") & ~F.contains(raw, F.lit("</think>")) & ~raw.startswith("<think>"), F.concat(F.lit("<think>"), raw)).otherwise(raw)


def sampling_columns(rows: DataFrame, phase: str, temperature: float, max_tokens: int, structured: bool = False) -> DataFrame:
    """rows with the phase's parameters: a seed of its own for each candidate; structured outputs have temperature 0."""
    return rows.withColumns({"phase": F.lit(phase), "seed": phase_seed(F.col("candidate_id"), F.lit(phase)), "temperature": F.lit(0.0 if structured else temperature), "max_tokens": F.lit(max_tokens)})


def occurrences(text: Column, part: Column) -> Column:
    return F.when(part != "", ((F.length(text) - F.length(F.replace(text, part, F.lit("")))) / F.length(part)).cast("bigint")).otherwise(0)


def anchoring(evidence: Column, reasoning: Column, response: Column, category: Column) -> tuple[Column, Column]:
    """Whether all excerpts occur, white space aside, each in one of the texts; and whether often enough: two excerpts, or one at two places of the reasoning."""
    trace, answer = collapse(F.coalesce(reasoning, F.lit(""))), collapse(F.coalesce(response, F.lit("")))
    parts = F.transform(evidence, collapse)
    there = F.forall(parts, lambda e: F.contains(trace, e) | ((category == IN_RESPONSE) & F.contains(answer, e)))
    twice = (F.size(parts) > 1) | ((F.size(parts) == 1) & F.coalesce(occurrences(trace, F.try_element_at(parts, F.lit(1))) > 1, F.lit(False)))
    return F.coalesce(there, F.lit(False)), F.coalesce(~category.isin(TWICE) | twice, F.lit(False))


def anchored(evidence: Column, reasoning: Column, response: Column, category: Column) -> Column:
    """Whether there are excerpts that aren't blank, all of them occur, and often enough."""
    there, often = anchoring(evidence, reasoning, response, category)
    return F.coalesce((F.size(evidence) > 0) & F.forall(evidence, lambda e: collapse(e) != ""), F.lit(False)) & there & often


def fit_words(text: Column, budget: int) -> Column:
    """A text of more than ``budget`` words as two fifths from its start, a marker and three fifths from its end, with the white space between them as it is."""
    words = F.regexp_extract_all(text, F.lit(r"(?U)[^\s\x1c-\x1f]+[\s\x1c-\x1f]*"), F.lit(0))  # each with what follows it
    keep = max(0, budget - len(MARKER.split()))
    left = keep * 2 // 5
    tail = F.array_join(F.slice(words, -(keep - left), keep - left), "") if keep > left else F.lit("")
    return F.when(F.size(words) <= budget, text).otherwise(F.concat(strip(F.array_join(F.slice(words, 1, left), "")), F.lit(MARKER), strip(tail)))


def late_part_at(reasoning: Column, category: Column, least: int = PART_CHARS) -> Column:
    """Where the late part of a long trace starts: the first blank line from 65 hundredths on, or that place; null for others."""
    at = F.floor(F.length(reasoning) * F.lit(PART_AT)).cast("int")
    blank_line = F.call_function("locate", F.lit("\n\n"), reasoning, at + 1)
    long = category.isin(IN_PARTS) & (F.length(reasoning) >= least)
    return F.when(long, F.when(blank_line > 0, blank_line - 1).otherwise(at)).cast("bigint")


def shown_trace(reasoning: Column, category: Column) -> Column:
    """The trace as a reviewer of the category sees it: long ones in an earlier and a later part, a missing one marked."""
    at = late_part_at(reasoning, category)
    early, late = F.left(reasoning, at.cast("int")), F.substring(reasoning, at.cast("int") + 1, F.length(reasoning))
    parts = F.concat(F.lit("EARLIER PART (where a result may first be found):\n"), early, F.lit("\n\nLATER PART (was more work needed after the result?):\n"), late)
    return F.when(F.coalesce(reasoning, F.lit("")) == "", "(missing)").when(at.isNotNull(), parts).otherwise(reasoning)
