"""Quality gates over extracted samples, and the reports made of them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveworks.functions import png
from sieveworks.operators import shards
from sieveworks.session import written

# What a sample's metadata has.
METADATA = ("prompt", "negative_prompt", "seed", "model_id", "num_inference_steps", "guidance_scale", "scheduler", "resolution")
LISTED, SHOWN = 100, 20


def keys_missing(text: Column, required=METADATA) -> Column:
    """SET-1, AGG-11: the required keys that a JSON object lacks, sorted; null for a null text, all for what is no object."""
    wanted = F.array(*[F.lit(k) for k in sorted(required)])
    return F.when(text.isNotNull(), F.array_except(wanted, F.coalesce(F.json_object_keys(text), F.array().cast("array<string>"))))


def _gate(name: str, passed: Column, details: Column, failures: Column) -> list[Column]:
    return [F.lit(name).alias("name"), passed.alias("passed"), details.alias("details"), failures.alias("failures")]


def _together(*ones: DataFrame) -> DataFrame:
    """Frames of one row each as one row with all their columns."""
    rows = ones[0]
    for x in ones[1:]:
        rows = rows.unionByName(x, allowMissingColumns=True)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])


def first_failures(rows: DataFrame, message: str, key: str, most: int = LISTED) -> DataFrame:
    """LIM-2: one row (n, failures): the number of messages, and the first of them by key.

    The first ones are found by a limit in every partition, so that no task
    gathers all.
    """
    bad = rows.where(F.col(message).isNotNull())
    top = bad.orderBy(key, message).limit(most).agg(F.transform(F.array_sort(F.collect_list(F.struct(key, message))), lambda x: x[message]).alias("failures"))
    return _together(bad.agg(F.count("*").alias("n")), top)


def count_gate(samples: DataFrame, target: int) -> DataFrame:
    """AGG-9."""
    n = F.col("n")
    failure = F.concat(F.lit("Count mismatch: "), n.cast("string"), F.lit(f" != {target}"))
    return samples.agg(F.count_distinct("id").alias("n")).select(*_gate("count", n == target, F.concat(F.lit("Found "), n.cast("string"), F.lit(f" samples, expected {target}")), F.when(n == target, F.array().cast("array<string>")).otherwise(F.array(failure))))


def image_problems(samples: DataFrame, resolution: int) -> DataFrame:
    """(id, problem) of every sample (id, png), and its other columns: null if it decodes to the wanted size.

    Bytes are checked where they are read; nothing but the verdict leaves the task.
    """
    rows = samples.withColumn("id", F.col("id").cast("string"))
    others = [f for f in rows.schema if f.name not in ("png", "problem")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for data in batch.column("png").to_pylist():
                what = png.problem(data)
                if what is None:
                    w, h = int.from_bytes(data[16:20], "big"), int.from_bytes(data[20:24], "big")
                    what = None if w == h == resolution else f"size {w}x{h}, expected {resolution}x{resolution}"
                found.append(what)
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in others), pa.array(found, pa.string())], [*(f.name for f in others), "problem"])

    return rows.mapInArrow(run, T.StructType([*others, T.StructField("problem", T.StringType())]))


def _failing_gate(name: str, rows: DataFrame, what: str) -> DataFrame:
    """A gate that fails if any row (id, problem) has a problem."""
    told = rows.select("id", F.when(F.col("problem").isNotNull(), F.concat_ws(": ", "id", "problem")).alias("message"))
    n = told.agg(F.count("*").alias("total"))
    found = _together(first_failures(told, "message", "id"), n)
    details = F.concat(F.lit("Checked "), F.col("total").cast("string"), F.lit(f" {what}, "), F.col("n").cast("string"), F.lit(" failures"))
    return found.select(*_gate(name, F.col("n") == 0, details, F.coalesce("failures", F.array().cast("array<string>"))))


def image_gate(samples: DataFrame, resolution: int) -> DataFrame:
    """AGG-10."""
    return _failing_gate("image_integrity", image_problems(samples.select("id", "png"), resolution), "images")


def metadata_gate(samples: DataFrame) -> DataFrame:
    """AGG-11: samples (id, json)."""
    return _failing_gate("metadata", samples.select("id", metadata_problem(F.col("json")).alias("problem")), "metadata files")


def metadata_problem(text: Column) -> Column:
    lacking = keys_missing(text)
    return F.when(text.isNull(), "missing metadata JSON").when(F.size(lacking) > 0, F.concat(F.lit("missing fields "), F.array_join(lacking, ", ")))


def coverage_gate(samples: DataFrame, target: int, size: int) -> DataFrame:
    """AGG-12."""
    found = shards.gaps(shards.lattice(samples.sparkSession, target, size), samples)
    none = F.array().cast("array<string>")
    parts = []
    for kind in ("missing", "extra"):
        mine = found.where(F.col("kind") == kind).select("id", F.col("id").alias("message"))
        line = F.concat(F.lit(f"{kind.capitalize()} "), F.col("n").cast("string"), F.lit(" samples: "), F.array_join("failures", ", "))
        parts.append(first_failures(mine, "message", "id", SHOWN).select(F.when(F.col("n") > 0, F.array(line)).otherwise(none).alias(kind)))
    actual = samples.agg(F.count_distinct("id").alias("actual"))
    both = _together(*parts, actual)
    failures = F.concat("missing", "extra")
    return both.select(*_gate("coverage", F.size(failures) == 0, F.concat(F.lit(f"Expected {target} IDs, found "), F.col("actual").cast("string")), failures))


def repeats_gate(samples: DataFrame) -> DataFrame:
    """Stricter than a listing by id, which hides repeats: fails if an id is in more than one archive or place."""
    twice = samples.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id", F.concat_ws(" ", F.col("n").cast("string"), F.lit("times")).alias("problem"))
    return _failing_gate("repeated_ids", twice, "repeated ids")


def completed(gates: DataFrame) -> DataFrame:
    """AGG-13: the gates and `completion`, which passes if all of them do."""
    names = F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("name"))))
    last = gates.agg(F.bool_and("passed").alias("ok"), names.alias("bad")).select(*_gate("completion", F.col("ok"), F.when(F.col("ok"), "All gates passed").otherwise(F.concat(F.lit("Failed: "), F.array_join("bad", ", "))), F.array().cast("array<string>")))
    return gates.unionByName(last)


def validate(samples: DataFrame, target: int, size: int, resolution: int) -> DataFrame:
    """All gates over samples (id, png, json), one row an id.

    Samples are read once: their verdicts are written, and the gates are made of these.
    """
    checked = samples.select("id", "png", metadata_problem(F.col("json")).alias("metadata"))
    checked = written(image_problems(checked, resolution), "verdicts")
    images, metadata = checked.select("id", "problem"), checked.select("id", F.col("metadata").alias("problem"))
    found = count_gate(checked, target).unionByName(_failing_gate("image_integrity", images, "images"))
    return completed(found.unionByName(_failing_gate("metadata", metadata, "metadata files")).unionByName(coverage_gate(checked, target, size)))


def failure_breakdown(gates: DataFrame) -> DataFrame:
    """AGG-15: (name, failures) of failing gates that list any."""
    return gates.where("NOT passed AND size(failures) > 0").select("name", "failures")


def run_report(gates: list[dict], target: int, size: int, model_id: str, timestamp: str, elapsed: float | None = None) -> dict:
    """SNK-11, AGG-14: the report of a run; throughput if it took any time, failures if validation failed."""
    passed = all(g["passed"] for g in gates)
    out = {
        "timestamp": timestamp,
        "target_count": target,
        "shard_count": -(-target // size),
        "shard_size": size,
        "model_id": model_id,
        "validation_passed": passed,
        "validation_summary": {g["name"]: {"passed": g["passed"], "details": g["details"]} for g in gates},
    }
    if elapsed is not None and elapsed > 0:
        out |= {"elapsed_seconds": round(elapsed, 2), "throughput_samples_per_sec": round(target / elapsed, 2)}
    if not passed:
        out["failure_breakdown"] = {g["name"]: g["failures"] for g in gates if not g["passed"] and g["failures"]}
    return out
