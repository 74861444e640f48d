"""Adapters that turn sources into seeds: a contract, a registry, one for any Parquet table and one for mixtures of pools."""

from __future__ import annotations

import importlib
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollmill.functions.ids import prompt_key, rank_key, stable_id
from rollmill.functions.json_text import json_object
from rollmill.functions.session import checkpointed, small_side
from rollmill.operators import answers, sampling
from rollmill.sources.config import expand

# Columns of seeds, in order, and the shares of the bands.
SEED_COLUMNS = ["sample_id", "user_prompt", "source", "provenance_json", "system_prompt", "verification_json"]
BAND_WEIGHTS = {"hard": 0.5, "medium": 0.35, "easy": 0.15}


class SourceAdapter(Protocol):
    """Gives seeds, and says how their answers are verified."""

    verifier_name: str | None

    def prepare(self, spark: SparkSession, num_samples: int, seed: int, system_prompt: str | None = None) -> DataFrame:
        """At most num_samples rows of SEED_COLUMNS."""

    def verify(self, rows: DataFrame) -> DataFrame:
        """rows (verification_json, answer_json, reference_answer_json) with verifier_available, verifier_score, verifier_error and verifier_reason."""


def _unverified(rows: DataFrame) -> DataFrame:
    text = F.lit(None).cast("string")
    return rows.withColumns({"verifier_available": F.lit(False), "verifier_score": F.lit(None).cast("double"), "verifier_error": text, "verifier_reason": text})


@dataclass
class ParquetAdapter:
    """Seeds without answers from any table: the first rows in the order of ``order_fields`` (the prompt, without any)."""

    path: str
    prompt_field: str = "user_prompt"
    id_field: str | None = None
    system_field: str | None = None
    provenance_field: str | None = None
    provenance_fields: Sequence[str] = ()
    order_fields: Sequence[str] = ()
    source: str | None = None
    verifier_name: str | None = None

    def prepare(self, spark: SparkSession, num_samples: int, seed: int, system_prompt: str | None = None) -> DataFrame:
        path = expand(self.path)
        return self.seeds(spark.read.parquet(path), path, num_samples, seed, system_prompt)

    def seeds(self, rows: DataFrame, path: str, num_samples: int, seed: int, system_prompt: str | None = None) -> DataFrame:
        from rollmill.sources.readers import first_rows

        wanted = [c for c in dict.fromkeys([self.prompt_field, self.id_field, self.system_field, self.provenance_field, *self.provenance_fields, *self.order_fields]) if c]
        rows = first_rows(rows.select(wanted), num_samples, *map(F.col, [*self.order_fields, self.prompt_field]))
        prompt = F.coalesce(F.col(self.prompt_field).cast("string"), F.lit("None"))
        made = stable_id(F.lit("parquet"), F.lit(path), F.lit(seed), F.col("ordinal"), prompt)
        parts = {c: F.col(c) for c in self.provenance_fields} | {"adapter": F.lit("parquet"), "input_path": F.lit(path)}
        given = F.to_json(F.struct(*(parts[c].alias(c) for c in sorted(parts))), {"ignoreNullFields": "false"})
        if self.provenance_field:
            own = F.from_json(json_object(F.col(self.provenance_field)), "map<string, string>")
            given = F.when(F.col(self.provenance_field).isNull(), given).otherwise(_with_defaults(json_object(F.col(self.provenance_field)), own, path))
        return rows.select(
            (F.coalesce(F.col(self.id_field).cast("string"), made) if self.id_field else made).alias("sample_id"), prompt.alias("user_prompt"),
            F.lit(self.source or f"parquet:{path.rstrip('/').rsplit('/', 1)[-1]}").alias("source"), given.alias("provenance_json"),
            (F.coalesce(F.col(self.system_field).cast("string"), F.lit(system_prompt)) if self.system_field else F.lit(system_prompt).cast("string")).alias("system_prompt"),
            F.lit(None).cast("string").alias("verification_json"),
        )

    def verify(self, rows: DataFrame) -> DataFrame:
        return _unverified(rows)


def _with_defaults(text: Column, own: Column, path: str) -> Column:
    """A JSON object with adapter and input_path where it lacks them, canonical."""
    from rollmill.functions.json_text import canonical_json

    more = F.concat_ws(",", *(F.when(own[k].isNull(), F.concat(F.lit(f'"{k}":'), F.to_json(F.array(F.lit(v))).substr(F.lit(2), F.length(F.to_json(F.array(F.lit(v)))) - 2))) for k, v in (("adapter", "parquet"), ("input_path", path))))
    inner = F.substring(text, F.lit(2), F.length(text) - 2)
    return canonical_json(F.concat(F.lit("{"), F.concat_ws(",", F.when(inner != "", inner), F.when(more != "", more)), F.lit("}")))


@dataclass
class PoolSource:
    """One pool of a mixture: its share, the shares of its bands, and what of it is wanted (an empty list: all)."""

    path: str
    weight: float = 1.0
    bands: Mapping[str, float] = field(default_factory=lambda: dict(BAND_WEIGHTS))
    subsets: Sequence[str] = ()
    domains: Sequence[str] = ()
    oversample: float = 1.25


def eligible(rows: DataFrame, source: PoolSource) -> DataFrame:
    """Rows of the wanted bands, subsets and domains; a null is the text None, a missing band is unknown."""
    have = set(rows.columns)
    text = lambda c, other: F.coalesce(F.col(c).cast("string"), F.lit("None")) if c in have else F.lit(other)
    rows = rows.withColumn("difficulty_band", text("difficulty_band", "unknown")).where(F.col("difficulty_band").isin(list(source.bands)))
    for column, wanted in (("subset", source.subsets), ("domain", source.domains)):
        if wanted:
            rows = rows.where(text(column, "").isin([str(w) for w in wanted]))
    return rows


#: Rows of a step that are counted in one task of the mixture.
BLOCK = 4096


def _first_free(top: DataFrame, targets: list[int]) -> DataFrame:
    """Of top (step, rank, key, ...; a key once in a step) each step's first rows whose keys no earlier step has taken, ``targets`` of them.

    All steps choose at once and give up what an earlier one has; the first is right after one round, each next one a round later at most, and a
    round that changes nothing ends it: keys that are wanted twice are few.
    """
    limit = F.get(F.array(*map(F.lit, targets)), F.col("step"))
    taken, mark = None, None
    for _ in range(len(targets) + 1):
        free = top
        if taken is not None:
            earliest = taken.groupBy("key").agg(F.min("step").alias("_by"))
            free = top.join(earliest, "key", "left").where(F.col("_by").isNull() | (F.col("_by") >= F.col("step"))).drop("_by")
        free = free.withColumn("block", F.floor(F.col("rank") / BLOCK))
        before = F.sum("n").over(Window.partitionBy("step").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
        blocks = free.groupBy("step", "block").agg(F.count("*").alias("n")).select("step", "block", F.coalesce(before, F.lit(0)).alias("before"))
        place = F.row_number().over(Window.partitionBy("step", "block").orderBy("rank")) + F.col("before")
        taken = checkpointed(free.join(blocks, ["step", "block"]).where(F.col("before") < limit).withColumn("place", place).where(F.col("place") <= limit).drop("block", "before", "place"))
        now = taken.agg(F.count("*"), F.sum(F.xxhash64("step", "sample_id").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return taken


def mixture(pools: list[tuple[PoolSource, DataFrame]], num_samples: int, seed: int) -> DataFrame:
    """Pools filled in order, each band by band: the largest remainders share out the samples among pools, then among bands.

    In a band the ``oversample`` times as many rows of the smallest rank are looked at; a prompt that an earlier band or pool has taken is skipped,
    what isn't taken blocks nothing. A band with too few rows, or too few new prompts, is an error. The result, with rank_key, is in the order of rank.
    Each pool is read once for ids, ranks and 128-bit hashes of prompts, which are written once; texts join the chosen ids at the end.
    """
    if not pools:
        raise ValueError("a mixture needs pools")
    steps: list[tuple[int, str, int]] = []
    slim: DataFrame | None = None
    limit = F.lit(0)
    for k, ((source, rows), share) in enumerate(zip(pools, sampling.allocate(num_samples, [s.weight for s, _ in pools]), strict=True)):
        if not share:
            continue
        step = F.lit(-1)
        for band, target in zip(source.bands, sampling.allocate(share, list(source.bands.values())), strict=True):
            if target:
                step = F.when(F.col("difficulty_band") == band, len(steps)).otherwise(step)
                limit = F.when(F.col("step") == len(steps), sampling.capacity(target, source.oversample)).otherwise(limit)
                steps.append((k, band, target))
        own = eligible(rows, source).select("sample_id", step.alias("step"), F.md5(prompt_key(F.col("user_prompt"))).alias("key")).where("step >= 0")
        slim = own if slim is None else slim.unionByName(own)
    if slim is None:
        raise ValueError("a mixture needs samples")
    top = checkpointed(sampling.bottom_k(slim, "step", seed, limit))
    have = {r.step: r.n for r in top.groupBy("step").agg(F.count("*").alias("n")).collect()}
    for n, (k, band, target) in enumerate(steps):
        if have.get(n, 0) < target:
            raise ValueError(f"pool {pools[k][0].path} has {have.get(n, 0)} eligible rows of band {band}, {target} are wanted")
    once = top.groupBy("step", "key").agg(F.min(F.struct("rank", "sample_id", "rank_key")).alias("r")).select("step", "key", "r.*")
    taken = _first_free(checkpointed(once), [t for *_, t in steps])
    have = {r.step: r.n for r in taken.groupBy("step").agg(F.count("*").alias("n")).collect()}
    for n, (k, band, target) in enumerate(steps):
        if have.get(n, 0) < target:
            raise ValueError(f"pool {pools[k][0].path} gave {have.get(n, 0)} new prompts of band {band}, {target} are wanted")
    out: DataFrame | None = None
    for k, (_, rows) in enumerate(pools):
        own = [n for n, (pool, *_) in enumerate(steps) if pool == k]
        if not own:
            continue
        # ids may be repeated in a pool: one row of each, the smallest
        picked = small_side(taken.where(F.col("step").isin(own)).select("sample_id", "rank_key"), sum(steps[n][2] for n in own), 160)
        full = sampling.first_wins(rows.join(picked, "sample_id").withColumn("_hash", F.xxhash64(*rows.columns)), "sample_id", F.col("_hash")).drop("_hash")
        out = full if out is None else out.unionByName(full, allowMissingColumns=True)
    return out.orderBy("rank_key", "sample_id")


@dataclass
class PoolAdapter:
    """A mixture of pools as seeds; their answers are verified by exact comparison."""

    sources: Sequence[PoolSource | Mapping]
    verifier_name: str | None = "pool"

    def __post_init__(self) -> None:
        self.sources = [s if isinstance(s, PoolSource) else PoolSource(**s) for s in self.sources]

    def prepare(self, spark: SparkSession, num_samples: int, seed: int, system_prompt: str | None = None) -> DataFrame:
        mixed = mixture([(s, spark.read.parquet(expand(s.path))) for s in self.sources], num_samples, seed)
        if system_prompt is not None:
            mixed = mixed.withColumn("system_prompt", F.lit(system_prompt))
        have = set(mixed.columns)
        return mixed.select(*(F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in SEED_COLUMNS))

    def verify(self, rows: DataFrame) -> DataFrame:
        rows = answers.verify_pooled(rows, "_v")
        return rows.withColumns({
            "verifier_available": F.col("verification_json").isNotNull(), "verifier_score": F.col("_v.score"), "verifier_error": F.lit(None).cast("string"), "verifier_reason": F.col("_v.reason"),
        }).drop("_v")


_adapters: dict[str, Callable[..., SourceAdapter]] = {}


def register_adapter(name: str, make: Callable[..., SourceAdapter]) -> None:
    if name in _adapters:
        raise ValueError(f"there is an adapter {name} already")
    _adapters[name] = make


def create_adapter(name: str, **params) -> SourceAdapter:  # noqa: ANN003
    if name not in _adapters and name in _MODULES:
        importlib.import_module(_MODULES[name])
    if name not in _adapters:
        raise ValueError(f"no adapter {name}; there are {', '.join(sorted(_adapters))}")
    return _adapters[name](**params)


#: Adapters that are registered when they are asked for.
_MODULES = {"puzzles": "rollmill.sources.puzzle_adapter"}
register_adapter("parquet", ParquetAdapter)
register_adapter("pool", PoolAdapter)
