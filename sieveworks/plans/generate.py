"""Generation of prompts: candidates, rejection, sequential dedup, records, reports, guarded publishing."""

from __future__ import annotations

import dataclasses
import datetime
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveworks.functions import draws, text
from sieveworks.operators import dedup, diversity, rules, shards
from sieveworks.session import written
from sieveworks.sources import config, jsonl

VERSION = "0.1.0"


class FinalizationError(RuntimeError):
    """A run that may not be published: a wrong count, or too little diversity."""


@dataclasses.dataclass
class Run:
    """What a generation run gives."""

    records: DataFrame  # shard_id, record_idx, id, positive_prompt, negative_prompt, seed and the components
    rejected: DataFrame  # reason, n
    exhausted: DataFrame  # shard_id, exhausted


def with_components(rows: DataFrame, vocabulary: dict) -> DataFrame:
    """GEN-8: every part of a record, drawn from the row's seed alone."""
    single = [c for c in config.COMPONENTS if c != "style_modifiers"]
    key = {c: F.concat_ws(":", F.col("seed"), F.lit(c)) for c in config.COMPONENTS}
    drawn = rows.select("*", *[draws.uniform(key[c]).alias(f"_u_{c}") for c in single])
    styles = config.options(vocabulary, "style_modifiers")
    high = min(draws.STYLE_SIZES[1], len({v for v, w in styles if w > 0}))
    subset = draws.weighted_subset(key["style_modifiers"], styles, (min(draws.STYLE_SIZES[0], high), high))
    made = {c: draws.weighted_at(F.col(f"_u_{c}"), config.options(vocabulary, c)) for c in single} | {"style_modifiers": subset}
    return drawn.select(*rows.columns, *[made[c].alias(c) for c in config.COMPONENTS])


def candidates(spark: SparkSession, vocabulary: dict, negatives: dict, seed: int, n_shards: int, attempts: int) -> DataFrame:
    """Every shard's first attempts, with prompts, the reason of rejection (null: none) and the canonical hash."""
    grid = spark.range(n_shards * attempts).select(F.expr(f"id div {attempts}").alias("shard_id"), (F.col("id") % attempts).alias("attempt"))
    drawn = grid.withColumn("seed", draws.sub_seed(F.lit(seed), F.col("shard_id"), F.col("attempt")))
    drawn = with_components(drawn, vocabulary)
    made = drawn.withColumn("positive_prompt", text.positive()).withColumn("negative_prompt", text.negative(negatives)).withColumn("tokens", text.tokens(F.col("positive_prompt")))
    reason = rules.first_reason(
        {
            "incompatible": rules.incompatible(vocabulary.get("compatibility_exclusions") or [], [c for c in config.COMPONENTS if c != "style_modifiers"]),
            "lint_components": F.size(rules.component_lint()) > 0,
            "lint_positive": F.size(rules.positive_lint(F.col("tokens"))) > 0,
            "lint_semantic": F.size(rules.semantic_lint(F.col("tokens"))) > 0,
        }
    )
    return made.withColumn("reason", reason).withColumn("hash", F.when(F.col("reason").isNull(), text.hash_of(F.col("tokens")))).drop("tokens")


def generate(spark: SparkSession, vocabulary: dict, negatives: dict, seed: int, count: int, n_shards: int) -> Run:
    """FLT-10: `count` records over shards, as a sequential run over shards and attempts would accept them.

    Only (shard, attempt, reason, hash) is stored; texts are drawn again for the
    accepted rows, because a row is a function of its place.  Raises RuntimeError
    if a shard gives up ten slots for each record it wants.
    """
    config.check_vocabulary(vocabulary)
    plan = shards.balanced(spark, count, n_shards)
    most = -(-count // n_shards)
    attempts = int(1.2 * most) + 32
    limit = (dedup.MAX_FAILED * most + 1) * dedup.MAX_ATTEMPTS + most
    while True:
        made = written(candidates(spark, vocabulary, negatives, seed, n_shards, attempts).select("shard_id", "attempt", "reason", "hash"), "candidates")
        cuts, accepted = dedup.consumed(made, plan)
        if cuts is not None:
            break
        if attempts >= limit:
            raise RuntimeError(f"unable to fill all shards in {attempts} attempts each")
        attempts = min(4 * attempts, limit)
    accepted = written(accepted, "accepted")
    exhausted = dedup.exhausted_slots(accepted)
    failed = exhausted.join(plan, "shard_id").where(F.col("exhausted") >= dedup.MAX_FAILED * F.col("wanted")).orderBy("shard_id").first()
    if failed:
        raise RuntimeError(f"unable to fill shard {failed['shard_id']} after {failed['exhausted']} failed slots")
    used = made.join(cuts, "shard_id").where("attempt <= cut").join(accepted.select("shard_id", "attempt", "record_idx"), ["shard_id", "attempt"], "left")
    told = used.withColumn("reason", F.when(F.col("reason").isNull() & F.col("record_idx").isNull(), "duplicate").otherwise(F.col("reason")))
    counts = told.where("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n"))
    given_up = exhausted.agg(F.coalesce(F.sum("exhausted"), F.lit(0)).alias("n")).where("n > 0").select(F.lit("exhausted").alias("reason"), "n")
    rejected = written(counts.unionByName(given_up), "rejected").orderBy(F.desc("n"), "reason")
    seeded = accepted.withColumn("seed", draws.sub_seed(F.lit(seed), F.col("shard_id"), F.col("attempt"))).select("shard_id", "record_idx", "seed")
    records = with_components(seeded, vocabulary).withColumn("id", shards.sample_id(F.col("shard_id"), F.col("record_idx"))).withColumn("positive_prompt", text.positive()).withColumn("negative_prompt", text.negative(negatives))
    return Run(records, rejected, exhausted)


def diversity_report(records: DataFrame, thresholds: dict[str, int] | None = None) -> dict:
    """SNK-4: thresholds, counts, results and distributions; values are bounded by the vocabulary."""
    wanted = thresholds or diversity.THRESHOLDS
    checked = {r["feature"]: r for r in diversity.check(records, wanted).collect()}
    seen = [f for f in wanted if f in records.columns]
    rows = diversity.histogram(records, seen, ["shard_id", "record_idx"]).orderBy("feature", "place").collect() if seen else []
    spread: dict[str, dict] = {}
    for r in rows:
        spread.setdefault(r["feature"], {})[r["value"]] = r["n"]
    return {
        "thresholds": dict(wanted),
        "unique_counts": {f: checked[f]["n_unique"] for f in wanted},
        "threshold_results": {f: {"passed": checked[f]["passed"], "unique": checked[f]["n_unique"], "required": checked[f]["required"]} for f in wanted},
        "per_feature_distribution": spread,
    }


def publish(run: Run, folder: str, seed: int, requested: int, settings: list, save: Callable[[str, str], None], thresholds: dict[str, int] | None = None, now: str | None = None) -> dict:
    """STR-6, SNK-1..4: records and the diversity report, then, if the guard lets it pass, the manifest.

    save(name, text) stores a report.  Raises FinalizationError without a manifest
    if the count is wrong or a threshold isn't met.
    """
    records = written(run.records, "records")
    jsonl.write_records(records, f"{folder}/prompts.jsonl")
    report = diversity_report(records, thresholds)
    save("diversity_report.json", json.dumps(report, indent=2))
    n, digest = jsonl.digest(records).first()
    if n != requested:
        raise FinalizationError(f"Record count mismatch: generated={n}, requested={requested}")
    short = {f: {"unique": r["unique"], "required": r["required"]} for f, r in report["threshold_results"].items() if not r["passed"]}
    if short:
        raise FinalizationError(f"Diversity thresholds not met: {short}")
    rejected = {r["reason"]: r["n"] for r in run.rejected.collect()}
    manifest = {
        "version": VERSION,
        "seed": seed,
        "config_hash": config.digest(*settings),
        "total_records": n,
        "total_requested": requested,
        "output_file": "prompts.jsonl",
        "output_hash": digest,
        "rejection_counts": rejected,
        "rejection_total": sum(rejected.values()),
        "timestamp": now or datetime.datetime.now(datetime.UTC).isoformat(),
    }
    save("manifest.json", json.dumps(manifest, indent=2))
    return manifest
