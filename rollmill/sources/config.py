"""Run configurations: YAML or JSON files with environment variables and relative paths, checked, and kept beside a run."""

from __future__ import annotations

import hashlib
import json
import os
import re
from dataclasses import asdict, dataclass, field
from pathlib import Path

# The form of a run's id.
RUN_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")
_DURATION = re.compile(r"(?:(\d+)-)?(?:(\d+):)?(\d+):(\d+)")


def expand(path: str) -> str:
    return os.path.expanduser(os.path.expandvars(path))


def anchored_path(path: str, folder: str) -> str:
    """A path with variables expanded; a relative one starts at ``folder``, a URI stays."""
    path = expand(path)
    return path if re.match(r"[a-z][a-z0-9+.-]*:", path) or os.path.isabs(path) else os.path.join(folder, path)


def duration_seconds(text: str) -> int:
    """[D-]HH:MM:SS or MM:SS."""
    m = _DURATION.fullmatch(text.strip())
    if m is None or (m[1] and not m[2]):
        raise ValueError(f"no duration: {text}")
    days, hours, minutes, seconds = (int(x or 0) for x in m.groups())
    return ((days * 24 + hours) * 60 + minutes) * 60 + seconds


@dataclass
class RunConfig:
    run_id: str
    output: str
    adapter: str
    params: dict = field(default_factory=dict)
    seed: int = 0
    resume: bool = True
    num_samples: int = 1
    rollouts_per_prompt: int = 1
    verifier_threshold: float = 1.0
    judge: bool = True
    analysis_samples: int = 1
    parquet_target_mb: int = 128
    shards_per_slot: int = 4

    def __post_init__(self) -> None:
        checks = [
            (bool(RUN_ID.fullmatch(self.run_id)), "run_id"), (self.num_samples >= 1, "num_samples"), (self.rollouts_per_prompt >= 1, "rollouts_per_prompt"),
            (0 <= self.verifier_threshold <= 1, "verifier_threshold"), (1 <= self.analysis_samples <= 4, "analysis_samples"), (self.parquet_target_mb >= 1, "parquet_target_mb"),
            (self.shards_per_slot >= 1, "shards_per_slot"),
        ]
        for kept, name in checks:
            if not kept:
                raise ValueError(f"bad value of {name}")

    @property
    def run_dir(self) -> str:
        return f"{self.output.rstrip('/')}/{self.run_id}"

    def fingerprint(self) -> str:
        """Of what decides the seeds."""
        return hashlib.sha256(json.dumps([self.seed, self.num_samples, self.adapter, self.params], sort_keys=True).encode()).hexdigest()


def read_tree(path: str) -> dict:
    """A configuration file as a tree: JSON, or YAML where a reader of it is installed."""
    text = Path(expand(path)).read_text(encoding="utf-8")
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("reading YAML needs PyYAML; JSON needs nothing") from e
    return yaml.safe_load(text)


def load_config(path: str) -> RunConfig:
    """Unknown fields are an error; output and the paths in params start at the file's folder."""
    tree, folder = read_tree(path), os.path.dirname(os.path.abspath(expand(path)))
    unknown = set(tree) - set(RunConfig.__dataclass_fields__)
    if unknown:
        raise ValueError(f"unknown fields: {', '.join(sorted(unknown))}")

    def moved(x):  # noqa: ANN001, ANN202
        if isinstance(x, dict):
            return {k: anchored_path(v, folder) if k == "path" else moved(v) for k, v in x.items()}
        return [moved(v) for v in x] if isinstance(x, list) else x

    tree = {**tree, "output": anchored_path(tree["output"], folder), "params": moved(tree.get("params", {}))}
    return RunConfig(**tree)


def resolved(config: RunConfig) -> str:
    return json.dumps(asdict(config), sort_keys=True, ensure_ascii=False)
