"""The image run: plan, generate, package, validate, report, each stage over tables, resumable."""

from __future__ import annotations

import dataclasses
import datetime
import json
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveworks.functions import text
from sieveworks.operators import gates, inference, shards
from sieveworks.sources import jsonl, progress, tar
from sieveworks.sources.config import RunConfig


class PlanError(ValueError):
    """The first violation that a line-by-line validation would meet."""


def _save(folder: str, name: str, value: dict) -> None:
    Path(folder).mkdir(parents=True, exist_ok=True)
    (Path(folder) / name).write_text(json.dumps(value, indent=2))


def _now() -> str:
    return datetime.datetime.now(datetime.UTC).isoformat()


def records(spark: SparkSession, c: RunConfig) -> DataFrame:
    rows = jsonl.read_records(spark, c.prompts_path, c.target_count)
    # Its place in the shard, as the id has it.
    return rows.withColumn("idx", F.regexp_extract("id", r"-r(\d+)$", 1).try_cast("long"))


def plan(spark: SparkSession, c: RunConfig) -> dict:
    """STR-7, AGG-8, SNK-5: raises PlanError; else writes and returns the sample manifest."""
    rows = records(spark, c)
    message = shards.first_violation(shards.plan_violations(rows, c.target_count, c.shard_size))
    if message:
        raise PlanError(message)
    m = shards.manifest(rows, c.shard_size).first().asDict()
    out = {k: m[k] for k in ("total_samples", "shard_count", "shard_size", "shard_ids")} | {"seed_range": [m["min_seed"], m["max_seed"]], "sample_id_range": [m["first_id"], m["last_id"]]}
    _save(c.report_dir, "sample_manifest.json", out)
    return out


def trimmed(rows: DataFrame, counters: list) -> DataFrame:
    """PRJ-9, AGG-16: positive_prompt cut to the limits of all counters, with trimmed, tokens_before and tokens_after."""
    if not counters:
        return rows.withColumn("trimmed", F.lit(False))

    def most(column: str):
        counts = [count(F.col(column)) for count, _ in counters]
        return F.greatest(*counts) if len(counts) > 1 else counts[0]

    cut = rows.withColumn("tokens_before", most("positive_prompt")).withColumn("cut", text.trim(F.col("positive_prompt"), counters))
    return cut.withColumn("positive_prompt", F.col("cut.text")).withColumn("trimmed", F.col("cut.trimmed")).withColumn("tokens_after", most("positive_prompt")).drop("cut")


def generate(spark: SparkSession, c: RunConfig, model: Callable = inference.stub, counters: list = ()) -> None:
    """STR-3, STR-4, FLT-7: samples that aren't in the workspace yet are appended to it, in one atomic commit each run."""
    done = workspace(spark, c)
    rows = records(spark, c)
    if done is not None:
        rows = rows.join(done.select(F.col("id").alias("_done")), rows.id == F.col("_done"), "left_anti")
    made = inference.generate(trimmed(rows, list(counters)), dataclasses.asdict(c), model)
    made.write.mode("append").partitionBy("shard_id").parquet(c.workspace_dir)


def workspace(spark: SparkSession, c: RunConfig) -> DataFrame | None:
    """SRC-7: the samples that are there, or None."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema("idx long, id string, png binary, json string, shard_id long").parquet(c.workspace_dir)
    except AnalysisException:
        return None


def package(spark: SparkSession, c: RunConfig) -> list[int]:
    """SNK-8, FLT-8, FLT-9: writes the shards that are whole, not marked and not on disk; returns those that aren't whole.

    An archive that stands under its name counts as done, whatever is in it, and is marked.
    """
    marks = f"{c.report_dir}/progress"
    samples = workspace(spark, c)
    wanted = shards.packed(spark, c.target_count, c.shard_size)
    if samples is None:
        return [r["shard_id"] for r in wanted.orderBy("shard_id").collect()]
    found = samples.where(f"idx < {c.shard_size}").dropDuplicates(["id"])
    whole = found.groupBy("shard_id").agg(F.count("*").alias("n")).join(wanted, "shard_id").where("n = wanted")
    todo = progress.pending(whole.select(F.col("shard_id").alias("todo")), progress.load(spark, marks), "shard", "todo")
    there = tar.present(spark, c.shards_dir).distinct()
    progress.append(progress.pending(there.select(F.col("shard_id").alias("id")), progress.load(spark, marks), "shard"), "shard", marks)
    todo = todo.join(there, F.col("todo") == there.shard_id, "left_anti")
    written = tar.write(found.join(F.broadcast(todo), F.col("shard_id") == F.col("todo"), "left_semi"), c.shards_dir)  # a row a shard
    progress.append(written.select(F.col("shard_id").alias("id")), "shard", marks)
    return [r["shard_id"] for r in wanted.join(whole, "shard_id", "left_anti").orderBy("shard_id").collect()]


def validate(spark: SparkSession, c: RunConfig) -> list[dict]:
    """SRC-5, AGG-9..13, SNK-10."""
    found = gates.validate(tar.samples(spark, c.shards_dir), c.target_count, c.shard_size, c.resolution)
    out = [{"name": r["name"], "passed": r["passed"], "details": r["details"], "failures": list(r["failures"])} for r in found.collect()]
    _save(c.report_dir, "validation_report.json", {"passed": all(g["passed"] for g in out), "gates": out})
    return out


def run(spark: SparkSession, c: RunConfig, model: Callable = inference.stub, counters: list = ()) -> dict:
    """STR-5: all stages; a failed validation is told in the report."""
    plan(spark, c)
    _save(c.report_dir, "run_manifest.json", c.manifest(spark, _now()))
    began = time.time()
    generate(spark, c, model, counters)
    elapsed = time.time() - began
    package(spark, c)
    report = gates.run_report(validate(spark, c), c.target_count, c.shard_size, c.model_id, _now(), elapsed)
    _save(c.report_dir, "run_report.json", report)
    return report
