"""A run over candidates as a graph of phases: each is a durable table, its requests are tables, and so are the answers to them.

A phase reads columns of the phases before it and writes columns of its own, so what depends on what follows from their names. Answers are kept as they come, in
waves of a share of the requests each; a run that was stopped goes on with what was not answered, and with the phases that were not done.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollmill.functions.ids import blank
from rollmill.operators import answers, hygiene, judge, phases, rescoring, rollouts, schemas
from rollmill.sources.adapters import create_adapter
from rollmill.sources.builds import prepare
from rollmill.sources.config import RunConfig, resolved
from rollmill.sources.sinks import Store, block_bytes, mark_stage, rotate, run_stage, snapshot, stage_complete, write_shards

#: Answers a table of requests: (phase, requests) to a table of the requests' keys, text and, where there is one, error, finish_reason, num_generated_tokens and prompt_truncated.
Provider = Callable[[str, DataFrame], DataFrame]
Ask = Callable[[DataFrame, list[str]], DataFrame]

ANSWER = {"text": "string", "error": "string", "finish_reason": "string", "num_generated_tokens": "bigint", "prompt_truncated": "boolean"}
KEY = "candidate_id"

# How an answer was found.
BY_MODEL, BY_RESPONSE, BY_SOURCE = "model", "atomic_response_fallback", "atomic_source_fallback"


@dataclass(frozen=True)
class Phase:
    """step takes rows (candidate_id and the columns of ``reads``) and a function that asks; it returns candidate_id and the columns of ``writes``."""

    name: str
    reads: tuple[str, ...]
    writes: tuple[str, ...]
    step: Callable[[DataFrame, Ask], DataFrame]


class Run:
    """Phases over candidates in a folder that all executors reach."""

    def __init__(self, spark: SparkSession, folder: str, provider: Provider, waves: int = 4, resume: bool = True) -> None:
        self.spark, self.folder, self.provider, self.waves, self.resume = spark, folder.rstrip("/"), provider, waves, resume

    def ask(self, name: str, requests: DataFrame, keys: list[str]) -> DataFrame:
        """requests (distinct keys) with ANSWER's columns; a request that nothing came back for has an error of its own."""
        folder = f"{self.folder}/answers/{name}"
        if not stage_complete(self.spark, folder, self.resume):
            started = time.time()
            if not self.resume:
                rotate(self.spark, folder)
            for wave in range(self.waves):
                todo = requests.where(F.pmod(F.xxhash64(*keys), F.lit(self.waves)) == wave)
                if Store(self.spark, folder).parts(folder):
                    todo = todo.join(self.spark.read.parquet(folder).select(*keys), keys, "left_anti")
                came = self.provider(name, todo)
                have = set(came.columns)
                write_shards(came.select(*keys, *(F.col(c).cast(t).alias(c) if c in have else F.lit(None).cast(t).alias(c) for c, t in ANSWER.items())), folder, "append")
            mark_stage(self.spark, folder, started)
        one = self.spark.read.parquet(folder).groupBy(*keys).agg(F.min(F.struct(F.coalesce("error", F.lit("")).alias("e"), *ANSWER)).alias("_a"))
        joined = requests.join(one, keys, "left")
        error = F.when(F.col("_a").isNull(), "no response").when(F.col("_a.e") != "", F.col("_a.e"))
        return joined.withColumns({c: error if c == "error" else F.when(error.isNull(), F.col(f"_a.{c}")) for c in ANSWER}).drop("_a")

    def through(self, rows: DataFrame, graph: list[Phase]) -> dict[str, DataFrame]:
        """The table of each phase, by name, with that of the candidates under ''. A phase that reads what none before it writes is an error."""
        tables, owner = {"": rows}, dict.fromkeys(rows.columns, "")
        for phase in graph:
            if lacking := [c for c in phase.reads if c not in owner]:
                raise ValueError(f"{phase.name} reads {', '.join(lacking)}, which no phase before it writes")
            folder = f"{self.folder}/phases/{phase.name}"
            if not stage_complete(self.spark, folder, self.resume):
                out = phase.step(joined(tables, owner, phase.reads), lambda requests, keys, name=phase.name: self.ask(name, requests, keys))
                run_stage(out.select(KEY, *phase.writes), folder, KEY, self.resume)
            tables[phase.name] = self.spark.read.parquet(folder)
            owner |= dict.fromkeys(phase.writes, phase.name)
        self.owner = owner
        return tables

    def gathered(self, tables: dict[str, DataFrame], columns: list[str]) -> DataFrame:
        """candidate_id and these columns, each from the last phase that writes it."""
        return joined(tables, self.owner, [c for c in columns if c != KEY])


def joined(tables: dict[str, DataFrame], owner: dict[str, str], columns: tuple[str, ...] | list[str]) -> DataFrame:
    """candidate_id of the candidates with columns of the tables that own them; a table of which nothing is wanted isn't read."""
    by: dict[str, list[str]] = {}
    for c in columns:
        by.setdefault(owner[c], []).append(c)
    out = tables[""].select(KEY, *by.pop("", []))
    for name, wanted in by.items():
        out = out.join(tables[name].select(KEY, *wanted), KEY, "left")
    return out


def _parse(rows: DataFrame, ask: Ask) -> DataFrame:
    return rescoring.reparsed(rows)


_EXTRACTED = "status answer_type value values unit evidence".split()


def _extract(rows: DataFrame, ask: Ask) -> DataFrame:
    """Answers of the candidate and of its source, with what short literal texts give where the extraction found none."""
    rows = rows.withColumn("reference_text", answers.reference_text(F.col("verification_json")))
    told = ask(phases.extraction_requests(rows), [KEY, "target"]).withColumn("x", judge.answer_extraction(F.col("text")))
    found = F.struct(F.col("text").alias("raw"), F.coalesce("error", "x.error").alias("error"), F.when(F.col("error").isNull() & F.col("x.error").isNull(), F.struct(*(f"x.{c}" for c in _EXTRACTED))).alias("x"))
    both = told.groupBy(KEY).agg(*(F.max_by(F.when(F.col("target") == t, found), F.when(F.col("target") == t, 1)).alias(t) for t in ("candidate", "reference")))
    rows = rows.join(both, KEY, "left")
    literal = answers.literal_answer(F.col("response"), F.col("candidate.x.status"))

    def literal_json(x: Column) -> Column:
        given = {"status": F.lit("extracted"), "answer_type": x["answer_type"], "value": x["value"], "values": F.array().cast("array<string>"), "unit": F.lit(None).cast("string"), "evidence": F.lit(None).cast("string")}
        return F.struct(*(given[c].alias(c) for c in _EXTRACTED))

    mine = F.when(literal.isNotNull(), literal_json(literal)).otherwise(F.col("candidate.x"))
    rows = rows.withColumns({"_mine": mine, "candidate_answer_method": F.when(literal.isNotNull(), BY_RESPONSE).when(F.col("candidate.x").isNotNull(), BY_MODEL)})
    alone = F.col("_mine.value").isNotNull() & (F.size(F.coalesce("_mine.values", F.array().cast("array<string>"))) == 0)
    own = F.when(alone, answers.literal_reference(F.col("reference_text"), F.col("reference.x.status"), F.col("_mine.status"), F.col("_mine.answer_type")))
    gold = F.when(own.isNotNull(), literal_json(own)).otherwise(F.col("reference.x"))
    return rows.withColumns({
        "answer_json": F.to_json("_mine"), "reference_answer_json": F.to_json(gold), "reference_answer_method": F.when(own.isNotNull(), BY_SOURCE).when(F.col("reference.x").isNotNull(), BY_MODEL),
        **{f"{t}_answer_raw_output": F.col(f"{t}.raw") for t in ("candidate", "reference")}, **{f"{t}_answer_error": F.col(f"{t}.error") for t in ("candidate", "reference")},
    })


def _critique(samples: int) -> Callable[[DataFrame, Ask], DataFrame]:
    def step(rows: DataFrame, ask: Ask) -> DataFrame:
        asked = phases.sample_requests(rows, KEY, samples)
        told = ask(asked.withColumn("kind", phases.critique_kind(F.col("sample_index"))), [KEY, "sample_index"])
        found = phases.regroup(asked, told.where("error is null"), KEY, "text")
        some = F.concat(F.lit("received "), (F.lit(samples) - F.col("missing")).cast("string"), F.lit(f" of {samples} critical analyses"))
        return found.select(KEY, F.to_json("texts").alias("critic_analyses_json"), F.when(F.col("missing") > 0, some).alias("judge_generation_error"))

    return step


def by_category(findings: DataFrame) -> DataFrame:
    """(candidate_id, hygiene_findings_json, hygiene_raw_outputs_json) of findings (candidate_id, category, f, ANSWER's columns).

    Findings are listed in the order of the categories, outputs are a map by category. Of several rows of a category the one of the smallest text
    counts; a request that failed has neither.
    """
    raw = F.struct("text", "finish_reason", "num_generated_tokens", F.coalesce("prompt_truncated", F.lit(False)).alias("prompt_truncated"))
    one = findings.where("error is null").groupBy(KEY, "category").agg(F.min_by(F.struct(F.col("f"), raw.alias("raw")), F.coalesce("text", F.lit(""))).alias("a"))
    place = F.array_position(F.array(*map(F.lit, judge.SEMANTIC)), F.col("category"))
    listed = one.groupBy(KEY).agg(F.array_sort(F.collect_list(F.struct(place.alias("place"), "category", F.col("a.f").alias("f"), F.col("a.raw").alias("raw")))).alias("all"))  # a row for each category
    outputs = F.map_from_entries(F.transform("all", lambda x: F.struct(x["category"], x["raw"])))
    return listed.select(KEY, F.to_json(F.transform("all", lambda x: x["f"])).alias("hygiene_findings_json"), F.to_json(outputs).alias("hygiene_raw_outputs_json"))


def _hygiene(rows: DataFrame, ask: Ask) -> DataFrame:
    told = ask(hygiene.requests_with_signals(rows, "reasoning").select(KEY, "category", "signal"), [KEY, "category"]).join(rows, KEY)
    found = told.withColumn("f", judge.assessment(F.col("text"), F.col("category"), F.col("reasoning"), F.col("response"), F.col("prompt_truncated"), phases.anchoring))
    return rows.select(KEY).join(by_category(found), KEY, "left")


def _arbitrate(rows: DataFrame, ask: Ask) -> DataFrame:
    told = ask(rows.select(KEY, F.col("critic_analyses_json").alias("analyses")), [KEY])
    told = told.select(KEY, "error", F.col("text").alias("judge_raw_output"), F.col("finish_reason").alias("judge_finish_reason"), F.col("num_generated_tokens").alias("judge_num_generated_tokens"))
    out = rows.select(KEY, F.col("judge_generation_error").alias("before")).join(told, KEY, "left")
    return out.withColumns({"judge_generation_error": F.coalesce("before", "error"), "judge_retry_count": F.lit(0).cast("bigint"), "judge_first_raw_output": F.lit(None).cast("string")})


def _retry(attempt: int) -> Callable[[DataFrame, Ask], DataFrame]:
    def step(rows: DataFrame, ask: Ask) -> DataFrame:
        raw = F.col("judge_raw_output")
        rows = rows.select(KEY, "judge_raw_output", F.col("judge_retry_count").alias("retry_count"), F.coalesce("judge_first_raw_output", raw).alias("first_output"), judge.judge_scores(raw)["error"].isNull().alias("valid"))
        again = ask(phases.retry_requests(rows, KEY, "valid", "judge_raw_output", attempt), [KEY])
        out = phases.with_retry(rows, again.where("error is null").select(KEY, F.col("text").alias("judge_raw_output")), KEY, "valid", "judge_raw_output", attempt)
        return out.withColumns({"judge_retry_count": F.col("retry_count"), "judge_first_raw_output": F.when(F.col("retry_count") > 0, F.coalesce("first_output", F.lit("")))})

    return step


_READ = ("reasoning", "response", "reasoning_parsed", "response_present", "generation_complete", "generation_status", "reasoning_num_tokens", "response_num_tokens")
_VERIFIED = ("verifier_available", "verifier_score", "verifier_error", "verification_status", "verifier_threshold")
_FOUND = ("answer_json", "reference_answer_json")
_EXTRACTION = tuple(f"{t}_answer_{x}" for t in ("candidate", "reference") for x in ("method", "raw_output", "error"))
_JUDGED = ("judge_raw_output", "judge_retry_count", "judge_first_raw_output")
_DECIDED = ("correctness_verdict", "quality_score", "hygiene_status", "correctness_only_eligible", "productivity_filtered_eligible", "exclusion_reasons_json")


def _generate(mode: str) -> Callable[[DataFrame, Ask], DataFrame]:
    def step(rows: DataFrame, ask: Ask) -> DataFrame:
        told = ask(phases.generation_requests(rows, mode), [KEY])
        done = told.select(KEY, F.col("text").alias("draft_generation"), F.col("finish_reason").alias("draft_finish_reason"), F.col("num_generated_tokens").alias("draft_num_generated_tokens"), F.col("error").alias("generation_error"))
        return done

    return step


def _polish(mode: str) -> Callable[[DataFrame, Ask], DataFrame]:
    wanted = mode != "direct"

    def step(rows: DataFrame, ask: Ask) -> DataFrame:
        drafted = rows.where(~blank(F.col("draft_generation")))
        told = ask(drafted.select(KEY, "draft_generation"), [KEY]).where("error is null") if wanted else drafted.limit(0).withColumn("text", F.lit(""))
        out = phases.polished(rows, told.select(KEY, "text"), mode, wanted)
        if wanted:
            out = out.join(told.select(KEY, F.col("finish_reason").alias("_finish"), F.col("num_generated_tokens").alias("_n")), KEY, "left")
        else:
            out = out.withColumns({"_finish": F.lit(None).cast("string"), "_n": F.lit(None).cast("bigint")})
        there = F.col("raw_generation").isNotNull()
        finish = F.when(there, F.coalesce("_finish", "draft_finish_reason"))
        return out.withColumns({"finish_reason": finish, "num_generated_tokens": F.when(there, F.coalesce("_n", "draft_num_generated_tokens")), "raw_generation": phases.unfinished(F.col("raw_generation"), F.coalesce(finish, F.lit("")))})

    return step


def generation_graph(mode: str = "direct") -> list[Phase]:
    """From prompts to raw generations: direct, direct_polish (a failed polish keeps the draft) or draft_polish."""
    drafts = ("draft_generation", "draft_finish_reason", "draft_num_generated_tokens")
    return [Phase("generate", ("user_prompt", "system_prompt"), (*drafts, "generation_error"), _generate(mode)), Phase("polish", drafts, ("raw_generation", "finish_reason", "num_generated_tokens"), _polish(mode))]


def whole_run(spark: SparkSession, config: RunConfig, provider: Provider, mode: str = "direct", model: str = "model", slots: int = 1, waves: int = 4) -> str:
    """Seeds, candidates, generations, decisions and the table for training below the run's folder, whose path it returns; each is written once.

    A run that was stopped goes on where it was; another configuration in the same folder is an error. As many candidates as seeds and rollouts say must be there.
    """
    snapshot(spark, config.run_dir, resolved(config))
    sizes = block_bytes(config.parquet_target_mb)
    before = {name: spark.conf.get(name) for name in sizes}
    try:
        for name, size in sizes.items():
            spark.conf.set(name, size)
        return _whole_run(spark, config, provider, mode, model, slots, waves)
    finally:
        for name, size in before.items():
            spark.conf.set(name, size)


def _whole_run(spark: SparkSession, config: RunConfig, provider: Provider, mode: str, model: str, slots: int, waves: int) -> str:
    seeds = spark.read.parquet(prepare(spark, config, slots=slots))
    rows = rollouts.fan_out(seeds, config.rollouts_per_prompt, config.seed).withColumn("model", F.lit(model))
    run = Run(spark, config.run_dir, provider, waves, config.resume)
    tables = run.through(rows, [*generation_graph(mode), *decision_graph(create_adapter(config.adapter, **config.params), config.verifier_threshold, config.analysis_samples)])
    rollouts.checked(rows, tables["finalize"])
    done = run_stage(schemas.as_candidates(run.gathered(tables, [c for c in run.owner if c in schemas.CANDIDATE.names])), f"{config.run_dir}/candidates", KEY, config.resume)
    run_stage(schemas.for_training(done), f"{config.run_dir}/sft", KEY, config.resume)
    return f"{config.run_dir}/sft"


def decision_graph(adapter, threshold: float = 1.0, samples: int = 2) -> list[Phase]:  # noqa: ANN001
    """The phases from raw generations to decisions, in order; extraction, critiques, hygiene, arbitration and its retries ask a provider."""
    return [
        Phase("parse", ("raw_generation", "finish_reason"), _READ, _parse),
        Phase("extract", ("response", "verification_json"), (*_FOUND, *_EXTRACTION), _extract),
        Phase("verify", ("response", "verification_json", *_FOUND), _VERIFIED, lambda rows, ask: rescoring.verified(rows, adapter, threshold)),
        Phase("critique", (), ("critic_analyses_json", "judge_generation_error"), _critique(samples)),
        Phase("hygiene", ("reasoning", "response"), ("hygiene_findings_json", "hygiene_raw_outputs_json"), _hygiene),
        Phase("arbitrate", ("critic_analyses_json", "judge_generation_error"), (*_JUDGED, "judge_generation_error", "judge_finish_reason", "judge_num_generated_tokens"), _arbitrate),
        Phase("retry_1", _JUDGED, _JUDGED, _retry(1)),
        Phase("retry_2", _JUDGED, _JUDGED, _retry(2)),
        Phase("finalize", ("finish_reason", "judge_raw_output", "judge_generation_error", "hygiene_findings_json", "answer_json", *_READ, *_VERIFIED), _DECIDED, lambda rows, ask: rescoring.finalized(rows)),
    ]


def saved_answers(answers: DataFrame) -> Provider:
    """A provider that knows the answers already: a table of phase, the requests' keys and ANSWER's columns; keys that a phase doesn't have are ignored."""

    def provide(name: str, requests: DataFrame) -> DataFrame:
        keys = [k for k in (KEY, "target", "sample_index", "category") if k in requests.columns]
        have = [c for c in ANSWER if c in answers.columns]
        return requests.select(*keys).join(answers.where(F.col("phase") == name).select(*keys, *have), keys)

    return provide
