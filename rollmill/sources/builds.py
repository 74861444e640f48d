"""Builds from configurations: pools out of raw files, and a run's seeds; each is published whole with a marker of what made it and exact counts."""

from __future__ import annotations

import hashlib
import json
import os
import time
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rollmill.sources import builders
from rollmill.sources.adapters import create_adapter
from rollmill.sources.config import RunConfig, anchored_path, read_tree
from rollmill.sources.readers import array_rows, named_rows
from rollmill.sources.sinks import Store, rotate, seed_shard_rows, write_shards

_MARKER = "_build"


@dataclass
class PoolSpec:
    """One source of a pool configuration: its raw files below ``raw``, the kind that reads them, and the builder's options."""

    name: str
    kind: str
    repo: str
    revision: str
    raw: str
    files: str = "*.parquet"
    fields: str | None = None  # of a JSON array's members
    options: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.kind not in builders.BUILDERS:
            raise ValueError(f"no kind {self.kind}; there are {', '.join(sorted(builders.BUILDERS))}")
        if self.kind == "array" and not self.fields:
            raise ValueError(f"{self.name}: an array needs the fields of its members")

    def fingerprint(self) -> str:
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True).encode()).hexdigest()


def load_pools(config: str | dict) -> tuple[str, list[PoolSpec]]:
    """The folder of the pools and their sources, from a JSON or YAML file, or its tree: output, raw (output/raw) and sources; relative paths start at the file's folder."""
    tree, here = (config, os.getcwd()) if isinstance(config, dict) else (read_tree(config), os.path.dirname(os.path.abspath(config)))
    if not isinstance(tree, dict) or not isinstance(tree.get("sources"), list):
        raise ValueError("a pool configuration has a list of sources")
    output = anchored_path(str(tree.get("output", "pools")), here).rstrip("/")
    raw = anchored_path(str(tree.get("raw", f"{output}/raw")), here).rstrip("/")
    specs = []
    for source in tree["sources"]:
        if unknown := set(source) - set(PoolSpec.__dataclass_fields__):
            raise ValueError(f"unknown fields: {', '.join(sorted(unknown))}")
        specs.append(PoolSpec(**{**source, "raw": anchored_path(str(source.get("raw", source["name"])), raw)}))
    if len({s.name for s in specs}) < len(specs):
        raise ValueError("a source's name comes twice")
    return output, specs


def chosen(specs: list[PoolSpec], names: list[str] | None) -> list[PoolSpec]:
    """The sources of these names, in the configuration's order; all without names. An unknown name is an error."""
    if names is None:
        return specs
    if unknown := set(names) - {s.name for s in specs}:
        raise ValueError(f"no source {', '.join(sorted(unknown))}")
    return [s for s in specs if s.name in names]


def built(spark: SparkSession, folder: str) -> dict | None:
    """What a published build's marker says; null where there is no build."""
    if not Store(spark, folder).exists(f"{folder}/{_MARKER}/_SUCCESS"):
        return None
    return json.loads(spark.read.text(f"{folder}/{_MARKER}").first().value)


def publish_build(spark: SparkSession, folder: str, tables: dict[str, DataFrame], least: dict[str, int], **marks) -> dict:  # noqa: ANN003
    """Write tables below a temporary name, counting each in the pass that writes it, and move them to ``folder`` with a marker; returns it.

    least: rows of a table at least. Too few, or any failure, leave what there is under a name of .incomplete, and no build.
    """
    store, stamp = Store(spark, folder), time.time_ns()
    temporary = f"{folder}.tmp.{stamp}"
    try:
        for name, rows in tables.items():
            seen = Observation()
            write_shards(rows.observe(seen, F.count("*").alias("n")), f"{temporary}/{name}" if name else temporary, "append")
            marks[name or "rows"] = int(seen.get["n"])
            if marks[name or "rows"] < least.get(name, 0):
                raise ValueError(f"{marks[name or 'rows']} rows of {name or folder}, at least {least[name]} are wanted")
        spark.range(1).select(F.lit(json.dumps(marks, sort_keys=True)).alias("value")).coalesce(1).write.text(f"{temporary}/{_MARKER}")
        store.move(temporary, folder)
    except Exception:
        if store.exists(temporary):
            store.move(temporary, f"{folder}.incomplete.{stamp}")
        raise
    return marks


def raw_rows(spark: SparkSession, spec: PoolSpec) -> DataFrame:
    path = f"{spec.raw}/{spec.files}"
    return array_rows(spark, path, spec.fields) if spec.kind == "array" else named_rows(spark, path)


def build_pools(spark: SparkSession, config: str | dict, names: list[str] | None = None) -> dict[str, dict]:
    """Build the pools of a configuration that aren't there yet, or those of ``names``; returns each one's marker (prompts, references, repo, revision).

    A pool that was built by another configuration is an error; it is never replaced. A source without prompts is an error.
    """
    output, specs = load_pools(config)
    out = {}
    for spec in chosen(specs, names):
        folder = f"{output}/{spec.name}"
        if (mark := built(spark, folder)) is not None:
            if mark["fingerprint"] != spec.fingerprint():
                raise RuntimeError(f"{folder} was built by another configuration")
            out[spec.name] = mark
            continue
        rotate(spark, folder)
        prompts, references = builders.BUILDERS[spec.kind](raw_rows(spark, spec), spec.repo, spec.revision, **spec.options)
        out[spec.name] = publish_build(spark, folder, {"prompts": prompts, "references": references}, {"prompts": 1}, repo=spec.repo, revision=spec.revision, fingerprint=spec.fingerprint())
    return out


def prepare(spark: SparkSession, config: RunConfig, force: bool = False, slots: int = 1) -> str:
    """Publish a run's seeds, exactly num_samples, in shards for ``slots`` workers; returns their folder.

    Seeds that are there are kept if the configuration that made them is this one (as far as it decides seeds), an error otherwise; ``force`` puts them aside.
    """
    folder = f"{config.run_dir}/seeds"
    mark = None if force else built(spark, folder)
    if mark is not None:
        if mark["fingerprint"] != config.fingerprint():
            raise RuntimeError(f"{folder} was prepared by another configuration; use force, or another run_id")
        return folder
    rotate(spark, folder)
    rows = create_adapter(config.adapter, **config.params).prepare(spark, config.num_samples, config.seed)
    size = seed_shard_rows(config.num_samples, slots, config.shards_per_slot)
    shards = rows.repartitionByRange(max(1, -(-config.num_samples // size)), "sample_id")
    mark = publish_build(spark, folder, {"": shards}, {"": config.num_samples}, fingerprint=config.fingerprint())
    if mark["rows"] != config.num_samples:
        rotate(spark, folder)
        raise ValueError(f"the adapter gave {mark['rows']} seeds, {config.num_samples} are wanted")
    return folder
