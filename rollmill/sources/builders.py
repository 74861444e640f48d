"""Raw sources as pools: each builder gives prompts and references; pools are deduplicated by id in the order of reading."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmill.functions.ids import fold_case, strip
from rollmill.operators.sampling import first_wins
from rollmill.sources import pools
from rollmill.sources.readers import by_priority, file_prefix, number

# The order of file prefixes, sources of word problems, limits of their texts and marks of proofs.
PREFIXES = ["cot", "tir", "genselect", "additional_problems"]
WORD_SOURCES, PROBLEM_CHARS, SOLUTION_CHARS = ["gsm8k", "orca_math", "synthetic_math"], 4000, 12000
PROOF_MARKS = ["prove that", "show that", "provide a proof", "demonstrate that"]

Pool = tuple[DataFrame, DataFrame]


def _split(rows: DataFrame, refs: DataFrame, order: list[Column]) -> Pool:
    """Prompts once for each sample_id, the first in order; references of all rows, repeated prompts' too."""
    return first_wins(rows, "sample_id", *order).select(pools.PROMPT_COLUMNS), refs.select(pools.REFERENCE_COLUMNS)


def array_pool(rows: DataFrame, repo: str, revision: str) -> Pool:
    """rows (problem, answer, solution, source_index) of a JSON array."""
    own = pools.prompt_rows(
        rows, repo, revision, prompt=F.col("problem"), source=F.lit(f"{repo}:train"), answer=F.col("answer"), band=F.lit("unknown"), difficulty=F.lit(None),
        subset=F.lit("train"), domain=F.lit("math"), metadata=F.struct("source_index"),
    )
    return _split(own, pools.reference_rows(own, ["solution"], "official"), [F.col("source_index")])


def graded_pool(rows: DataFrame, repo: str, revision: str, model: str) -> Pool:
    """rows (question, final_answer, difficulty, topic, r1_solution_1..3, raw_file): a graded source with up to three solutions."""
    level = number(F.col("difficulty"))
    own = pools.prompt_rows(
        rows, repo, revision, prompt=F.col("question"), source=F.lit(f"{repo}:train"), answer=F.col("final_answer"), band=pools.graded_band(level), difficulty=level,
        subset=F.lit("train"), domain=F.lit("math"), metadata=F.struct("raw_file", "topic"),
    )
    return _split(own, pools.reference_rows(own, [f"r1_solution_{k}" for k in (1, 2, 3)], model), [F.col("raw_file"), F.col("question"), F.col("final_answer")])


def word_problems(rows: DataFrame, sources: list[str] = WORD_SOURCES, boxed: bool = True, marks: list[str] = PROOF_MARKS) -> DataFrame:
    """rows (source, problem, solution) that are word problems with an answer: problem and solution without outer white space, and boxed.

    Kept are allowed sources, texts that aren't blank and within their limits, problems without a mark of a proof, solutions with a boxed value.
    """
    own = rows.where(F.col("source").isin(sources)).withColumns({"problem": strip(F.coalesce("problem", F.lit(""))), "solution": strip(F.coalesce("solution", F.lit("")))})
    own = own.where(F.length("problem").between(1, PROBLEM_CHARS) & F.length("solution").between(1, SOLUTION_CHARS))
    folded = fold_case(F.col("problem"))
    for mark in marks:
        own = own.where(~F.contains(folded, F.lit(mark)))
    own = own.withColumn("boxed", pools.boxed_value(F.col("solution")))
    return own.where("boxed is not null") if boxed else own


def word_problem_pool(rows: DataFrame, repo: str, revision: str, **options) -> Pool:  # noqa: ANN003
    """rows (source, problem, solution, raw_file); see word_problems."""
    own = pools.prompt_rows(
        word_problems(rows, **options), repo, revision, prompt=F.col("problem"), source=F.concat(F.lit(f"{repo}:"), "source"), answer=F.col("boxed"), band=F.lit("unknown"),
        difficulty=F.lit(None), subset=F.col("source"), domain=F.lit("math"), metadata=F.struct("raw_file"),
    )
    return _split(own, pools.reference_rows(own, ["solution"], "source"), [F.col("raw_file"), F.col("problem"), F.col("solution")])


def prefixed_pool(rows: DataFrame, repo: str, revision: str, model: str) -> Pool:
    """rows (problem, expected_answer, pass_rate, problem_source, generated_solution, raw_file): the subset is the file's prefix, and decides what is read first."""
    subset, rate = file_prefix(F.col("raw_file")), number(F.col("pass_rate"))
    own = pools.prompt_rows(
        rows, repo, revision, prompt=F.col("problem"), source=F.concat(F.lit(f"{repo}:"), F.coalesce(F.when(F.col("problem_source") != "", F.col("problem_source")), subset)), answer=F.col("expected_answer"),
        band=pools.pass_rate_band(rate), difficulty=rate, subset=subset, domain=F.lit("math"), metadata=F.struct("problem_source", "raw_file"),
    )
    return _split(own, pools.reference_rows(own, ["generated_solution"], model, subset), [*by_priority(F.col("raw_file"), PREFIXES), F.col("generated_solution")])


def turn_of(conversations: Column, role: str) -> Column:
    """The value of the first item from a role in array<struct<from, value>>."""
    return F.try_element_at(F.filter(conversations, lambda c: c["from"] == role), F.lit(1))["value"]


def conversation_pool(rows: DataFrame, repo: str, revision: str, model: str) -> Pool:
    """rows (conversations array<struct<from, value>>, source, domain, difficulty, raw_file): the first human and gpt items; rows without a human text are left out."""
    level = number(F.col("difficulty"))
    rows = rows.withColumns({"_user": turn_of(F.col("conversations"), "human"), "conversation": turn_of(F.col("conversations"), "gpt")}).where("_user <> ''")
    named = lambda c: F.coalesce(F.col(c), F.lit("None"))
    subset, domain = named("source"), named("domain")
    own = pools.prompt_rows(
        rows, repo, revision, prompt=F.col("_user"), source=F.concat(F.lit(f"{repo}:"), subset), answer=F.lit(None).cast("string"), band=pools.level_band(level), difficulty=level,
        subset=subset, domain=domain, metadata=F.struct("raw_file", F.col("source").alias("source")),
    )
    return _split(own, pools.reference_rows(own, ["conversation"], model), [F.col("raw_file"), F.col("conversation")])


#: Builders by the kind of source.
BUILDERS: dict[str, Callable[..., Pool]] = {"array": array_pool, "graded": graded_pool, "word_problems": word_problem_pool, "prefixed": prefixed_pool, "conversations": conversation_pool}


def with_references(prompts: DataFrame, references: DataFrame) -> DataFrame:
    """Each prompt with its references, one row for each; prompts without any stay."""
    return prompts.join(references.select("sample_id", "reference_id", "reasoning", "response", "source_model"), "sample_id", "left")


def pool_counts(prompts: DataFrame, references: DataFrame) -> DataFrame:
    """(subset, prompts, with_answer, reference_rows): what a build has made."""
    own = prompts.groupBy("sample_id").agg(F.first("subset").alias("subset"), F.count("verification_json").alias("answers"))
    refs = references.groupBy("sample_id").agg(F.count("*").alias("refs"))
    joined = own.join(refs, "sample_id", "left")
    return joined.groupBy("subset").agg(F.count("*").alias("prompts"), F.sum("answers").alias("with_answer"), F.coalesce(F.sum("refs"), F.lit(0)).alias("reference_rows"))
