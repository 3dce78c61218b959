"""Configuration: vocabularies, negative prompts and run settings from YAML (or JSON, which is YAML too)."""

from __future__ import annotations

import dataclasses
import hashlib
import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

try:
    import yaml
except ModuleNotFoundError:
    yaml = None

# The parts that a vocabulary has.
COMPONENTS = ("subject", "face_shape", "eyes", "nose", "mouth", "hair_color", "hair_style", "expression", "accessories", "style_modifiers", "lighting", "background")


def load(path: str | Path):
    text = Path(path).read_text(encoding="utf-8")
    if yaml:
        return yaml.safe_load(text)
    return json.loads(text)


def check_vocabulary(vocabulary: dict) -> dict:
    """SRC-1: raises ValueError for a missing component, one without options, and one whose options are empty."""
    if not isinstance(vocabulary, dict):
        raise ValueError("a vocabulary maps components to options")
    for name in COMPONENTS:
        if name not in vocabulary:
            raise ValueError(f"missing component: {name}")
        if not isinstance(vocabulary[name], dict) or "options" not in vocabulary[name]:
            raise ValueError(f"component {name} has no options")
        if not vocabulary[name]["options"]:
            raise ValueError(f"component {name} has empty options")
    return vocabulary


def load_vocabulary(folder: str | Path) -> dict:
    return check_vocabulary(load(Path(folder) / "vocab.yaml"))


def load_negatives(folder: str | Path) -> dict:
    """SRC-2."""
    return load(Path(folder) / "negative_prompts.yaml")


def options(vocabulary: dict, component: str) -> list[tuple[str, float]]:
    return [(str(o["value"]), float(o["weight"])) for o in vocabulary[component]["options"]]


def vocabulary_table(spark: SparkSession, vocabulary: dict) -> DataFrame:
    """(component, ord, value, weight)."""
    rows = [(c, i, v, w) for c in COMPONENTS for i, (v, w) in enumerate(options(vocabulary, c))]
    return spark.createDataFrame(rows, "component string, ord int, value string, weight double")


def digest(*configs) -> str:
    """PRJ-6: 16 hexadecimal digits over the given settings; what isn't JSON counts by its text."""
    return hashlib.sha256(json.dumps(configs[0] if len(configs) == 1 else configs, sort_keys=True, default=str).encode()).hexdigest()[:16]


@dataclasses.dataclass
class RunConfig:
    """SRC-4: settings of an image run."""

    model_id: str = "stub"
    prompts_path: str = "output/prompts"
    workspace_dir: str = "output/images/workspace"
    shards_dir: str = "output/images/shards"
    report_dir: str = "output/images"
    batch_size: int = 4
    shard_size: int = 1000
    target_count: int = 100_000
    num_inference_steps: int = 28
    guidance_scale: float = 7.0
    scheduler: str = "EulerAncestralDiscreteScheduler"
    resolution: int = 1024
    checkpoint_path: str = ""

    @classmethod
    def load(cls, path: str | Path | None) -> RunConfig:
        """Defaults without a path; unknown keys are ignored."""
        found = (load(path) or {}) if path else {}
        return cls(**{f.name: found[f.name] for f in dataclasses.fields(cls) if f.name in found})

    def manifest(self, spark: SparkSession, timestamp: str) -> dict:
        """SNK-6."""
        import platform

        return {"config": dataclasses.asdict(self), "config_hash": digest(dataclasses.asdict(self)), "versions": {"python": platform.python_version(), "spark": spark.version}, "timestamp": timestamp}
