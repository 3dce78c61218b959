"""Batch inference with a pluggable function, resume, and smaller batches where memory runs out."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveworks.functions import png

# Largest batch below each amount of GiB, by least resolution; the last is for any amount.
TIERS = (
    (1024, ((11, 1), (14, 2), (20, 3), (None, 4))),
    (768, ((8, 1), (12, 2), (20, 4), (None, 6))),
    (0, ((6, 1), (8, 2), (12, 4), (None, 8))),
)
OUT_OF_MEMORY = ("out of memory",)


def batch_cap(resolution: Column, gib: Column, fused: Column) -> Column:
    """PRJ-11: one less without fused attention, one at least."""
    out = None
    for least, steps in TIERS:
        size = None
        for below, n in steps:
            if below is not None:
                size = F.when(gib < below, n) if size is None else size.when(gib < below, n)
            else:
                size = size.otherwise(n)
        out = F.when(resolution >= least, size) if out is None else out.when(resolution >= least, size)
    return F.greatest(F.lit(1), out - F.when(fused, 0).otherwise(1))


def micro_batches(rows: DataFrame, size: int, number: str) -> DataFrame:
    """STR-1: batch (row number div size) and slot of every row; number counts rows from 0."""
    return rows.withColumn("batch", F.expr(f"`{number}` div {size}")).withColumn("slot", F.col(number) % size)


def is_out_of_memory(error: BaseException) -> bool:
    return isinstance(error, MemoryError) or any(x in str(error).lower() for x in OUT_OF_MEMORY)


def in_batches(rows: list, size: int, call: Callable[[list], list]) -> Iterator[tuple[list, list]]:
    """STR-2: (rows, results); a batch that runs out of memory is halved, and stays so; at one row, or for another error, it raises."""
    at = 0
    while at < len(rows):
        part = rows[at : at + size]
        try:
            results = call(part)
        except Exception as e:
            if not is_out_of_memory(e) or size == 1:
                raise
            size = max(1, size // 2)
            continue
        if len(results) != len(part):
            raise ValueError(f"{len(part)} rows gave {len(results)} results")
        yield part, results
        at += len(part)


def stub(rows: list[dict], settings: dict) -> list[bytes]:
    """UDF-2: stands in for a model: images that depend on prompt and seed only."""
    return [png.render(r["positive_prompt"], r["seed"], settings["resolution"]) for r in rows]


def generate(records: DataFrame, settings: dict, model: Callable[[list[dict], dict], list[bytes]] = stub) -> DataFrame:
    """(shard_id, idx, id, png, json) of records (id, positive_prompt, negative_prompt, shard_id, idx, seed).

    model(rows, settings) gives a payload a row, in order; it may keep what it
    loads in a global of its own.  Batches change nothing about a row's result.
    """
    size = settings["batch_size"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, images in in_batches(batch.to_pylist(), size, lambda rows: model(rows, settings)):
                meta = [json.dumps({"prompt": r["positive_prompt"], "negative_prompt": r["negative_prompt"], "seed": r["seed"], **{k: settings[k] for k in ("model_id", "num_inference_steps", "guidance_scale", "scheduler", "resolution")}}) for r in part]
                yield pa.RecordBatch.from_arrays([pa.array([r["shard_id"] for r in part], pa.int64()), pa.array([r["idx"] for r in part], pa.int64()), pa.array([r["id"] for r in part], pa.string()), pa.array(images, pa.binary()), pa.array(meta, pa.string())], ["shard_id", "idx", "id", "png", "json"])

    rows = records.select(F.col("shard_id").cast("long").alias("shard_id"), F.col("idx").cast("long").alias("idx"), "id", "positive_prompt", "negative_prompt", F.col("seed").cast("long").alias("seed"))
    return rows.mapInArrow(run, "shard_id long, idx long, id string, png binary, json string")


def attention_allowed(math: bool, flash: bool, efficient: bool) -> bool:
    """INF-3: the slow kernel is off, and a fast one is on."""
    return not math and (flash or efficient)
