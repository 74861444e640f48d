"""Puzzles as a source: weighted tasks in bands of difficulty, made in chunks that are seeds of their own, and scored by their makers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollmill.functions.ids import stable_id
from rollmill.operators import answers, puzzles
from rollmill.sources.adapters import BAND_WEIGHTS, SEED_COLUMNS, register_adapter


@dataclass
class PuzzleAdapter:
    """Tasks by name with their weights; each has the bands of difficulty by theirs, and is made in chunks of ``chunk`` rows.

    A row depends on the run's seed, its task, band, chunk and place alone, so any number of partitions gives the same rows. Shares are by largest
    remainders: counts are exact.
    """

    tasks: Mapping[str, float] = field(default_factory=lambda: dict.fromkeys(puzzles.TASKS, 1.0))
    bands: Mapping[str, float] = field(default_factory=lambda: dict(BAND_WEIGHTS))
    chunk: int = 1000
    verifier_name: str | None = "puzzles"

    def __post_init__(self) -> None:
        if not self.tasks or any(w <= 0 for w in self.tasks.values()):
            raise ValueError("tasks need names and positive weights")
        if unknown := set(self.tasks) - set(puzzles.TASKS):
            raise ValueError(f"no task {', '.join(sorted(unknown))}; there are {', '.join(puzzles.TASKS)}")
        if unknown := set(self.bands) - set(puzzles.BAND_SHARE):
            raise ValueError(f"no band {', '.join(sorted(unknown))}")

    def rows(self, spark: SparkSession, num_samples: int, seed: int) -> DataFrame:
        """(task, band, chunk, place, seed, level, question, answer, metadata) of each puzzle."""
        names, bands = list(self.tasks), list(self.bands)
        shares = puzzles.chunked_counts(num_samples, list(self.tasks.values()), list(self.bands.values()))
        # a task's number is its place among all tasks there are, so that it doesn't depend on which others are wanted
        counts = [(puzzles.TASKS.index(names[t]), list(puzzles.BAND_SHARE).index(bands[b]), n) for (t, b), n in shares.items() if n]
        made = puzzles.chunks(spark.createDataFrame(counts, "task bigint, band bigint, n bigint"), self.chunk, seed)
        rows = made.repartition(F.col("task"), F.col("band"), F.col("chunk")).withColumn("place", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("rows") - 1)))
        rows = rows.withColumns({"seed": F.col("seed") * puzzles.PLACE_STEP + F.col("place"), "task": F.get(F.array(*map(F.lit, puzzles.TASKS)), F.col("task").cast("int")), "band": F.get(F.array(*map(F.lit, puzzles.BAND_SHARE)), F.col("band").cast("int"))})
        return puzzles.task_rows(rows)

    def prepare(self, spark: SparkSession, num_samples: int, seed: int, system_prompt: str | None = None) -> DataFrame:
        rows = self.rows(spark, num_samples, seed)
        metadata = F.from_json("metadata", "struct<puzzle: array<array<bigint>>, numbers: array<bigint>>")
        entry = F.struct(F.col("question"), F.col("answer"), metadata.alias("metadata"))
        made = rows.select(
            stable_id(F.lit("puzzles"), F.lit(seed), F.col("task"), F.col("band"), F.col("seed"), F.col("question")).alias("sample_id"), F.col("question").alias("user_prompt"), F.concat(F.lit("puzzles:"), "task").alias("source"),
            F.to_json(F.struct(F.lit("puzzles").alias("adapter"), "band", "chunk", F.col("task").alias("dataset"), F.col("seed").alias("dataset_seed"), "level", "place")).alias("provenance_json"), F.lit(system_prompt).cast("string").alias("system_prompt"),
            F.to_json(F.struct(entry.alias("entry"), F.col("task").alias("source_dataset"))).alias("verification_json"),
        )
        return made.select(SEED_COLUMNS)

    def verify(self, rows: DataFrame) -> DataFrame:
        """The best score of any text of the extracted answer by the task's own scorer; an answer that equals the reference's scores 1."""
        entry = F.from_json("verification_json", "struct<entry: struct<answer: string, metadata: struct<puzzle: array<array<bigint>>, numbers: array<bigint>>>, source_dataset: string>")
        rows = rows.withColumn("_e", entry)
        rows = rows.withColumn("_s", answers.best_score(answers.answer_candidates(F.col("answer_json")), lambda x: puzzles.native_score(F.col("_e.source_dataset"), F.col("_e.entry.answer"), F.col("_e.entry.metadata"), x)))
        rows = answers.verify_pooled(rows, "_v", F.when(F.size(answers.answer_candidates(F.col("answer_json"))) > 0, F.col("_s")))
        return rows.withColumns({"verifier_available": F.col("verification_json").isNotNull(), "verifier_score": F.col("_v.score"), "verifier_error": F.lit(None).cast("string"), "verifier_reason": F.col("_v.reason")}).drop("_e", "_s", "_v")


def weighted(tasks: Sequence[Mapping]) -> dict[str, float]:
    """Tasks of a configuration, [{name, weight}], as a mapping; a missing weight is 1."""
    return {str(t["name"]): float(t.get("weight", 1.0)) for t in tasks}


def _make(tasks: Mapping[str, float] | Sequence[Mapping] | None = None, **params) -> PuzzleAdapter:  # noqa: ANN003
    if tasks is not None:
        params["tasks"] = tasks if isinstance(tasks, Mapping) else weighted(tasks)
    return PuzzleAdapter(**params)


register_adapter("puzzles", _make)
