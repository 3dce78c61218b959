"""Shard plans, the lattice of expected ids, plan validation, coverage and manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveworks.operators.rules import FIELDS


def balanced(spark: SparkSession, count: int, shards: int) -> DataFrame:
    """GEN-1: (shard_id, wanted): an equal share each, the remainder one by one to the first shards."""
    if shards <= 0:
        raise ZeroDivisionError("a plan needs a shard at least")
    return spark.range(shards).select(F.col("id").alias("shard_id"), (F.lit(count // shards) + F.when(F.col("id") < count % shards, 1).otherwise(0)).cast("long").alias("wanted"))


def packed(spark: SparkSession, target: int, size: int) -> DataFrame:
    """GEN-2: (shard_id, wanted): full shards, then one with the remainder."""
    shards = -(-target // size)
    return spark.range(shards).select(F.col("id").alias("shard_id"), F.least(F.lit(size), F.lit(target) - F.col("id") * size).cast("long").alias("wanted"))


def sample_id(shard_id: Column, idx: Column) -> Column:
    """GEN-9: at least four digits each, more if need be."""
    return F.format_string("s%04d-r%04d", shard_id.cast("long"), idx.cast("long"))


def lattice(spark: SparkSession, target: int, size: int) -> DataFrame:
    """GEN-3: (shard_id, idx, id) of every expected sample."""
    rows = spark.range(target).select(F.expr(f"id div {size}").alias("shard_id"), (F.col("id") % size).alias("idx"))
    return rows.withColumn("id", sample_id(F.col("shard_id"), F.col("idx")))


def gaps(expected: DataFrame, actual: DataFrame, key: str = "id") -> DataFrame:
    """SET-2, JON-5: (key, kind): missing from actual, or extra there."""
    e = expected.select(F.col(key).alias("e")).distinct()
    a = actual.select(F.col(key).alias("a")).distinct()
    return e.join(a, F.col("e") == F.col("a"), "full_outer").where("e IS NULL OR a IS NULL").select(F.coalesce("e", "a").alias(key), F.when(F.col("a").isNull(), "missing").otherwise("extra").alias("kind"))


def shard_counts(rows: DataFrame) -> DataFrame:
    """AGG-6."""
    return rows.groupBy("shard_id").agg(F.count("*").alias("n"))


def plan_violations(rows: DataFrame, target: int, size: int) -> DataFrame:
    """STR-7: every violation as (priority, line_no, check_no, message).

    rows: line_no, keys (array of the fields a line has), id, seed, shard_id.  A
    repeat is told at the later line.  The first by (priority, line_no, check_no) is the
    one that a line-by-line validation stops at; see first_violation.
    """
    spark = rows.sparkSession
    total = rows.agg(F.count("*").alias("n")).where(F.col("n") != target).select(F.lit(0).alias("priority"), F.lit(-1).cast("long").alias("line_no"), F.lit(0).alias("check_no"), F.concat(F.lit(f"Expected {target} records, got "), F.col("n").cast("string")).alias("message"))
    absent = F.array_sort(F.array_except(F.array(*[F.lit(f) for f in FIELDS]), F.col("keys")))
    missing = rows.where(F.size(absent) > 0).select(F.lit(1).alias("priority"), "line_no", F.lit(1).alias("check_no"), F.concat(F.lit("Record "), F.col("line_no").cast("string"), F.lit(" missing fields: "), F.array_join(absent, ", ")).alias("message"))

    def repeats(column: str, check_no: int, message: Column) -> DataFrame:
        # Lines after the first of their value; the first is aggregated before the shuffle.
        firsts = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("of")).agg(F.min("line_no").alias("first"), F.count("*").alias("n")).where("n > 1")
        return rows.join(firsts, F.col(column) == F.col("of")).where("line_no > first").select(F.lit(1).alias("priority"), "line_no", F.lit(check_no).alias("check_no"), message.alias("message"))

    ids = repeats("id", 2, F.concat(F.lit("Duplicate sample ID: "), F.col("id")))
    seeds = repeats("seed", 3, F.concat(F.lit("Duplicate seed at record "), F.col("line_no").cast("string"), F.lit(": "), F.col("seed").cast("string")))
    plan = packed(spark, target, size)
    counted = shard_counts(rows)
    expected = -(-target // size)
    number = counted.agg(F.count("*").alias("n")).where(F.col("n") != expected).select(F.lit(2).alias("priority"), F.lit(-1).cast("long").alias("line_no"), F.lit(0).alias("check_no"), F.concat(F.lit(f"Expected {expected} shards, found "), F.col("n").cast("string")).alias("message"))
    uneven = plan.join(counted, "shard_id", "left").withColumn("n", F.coalesce("n", F.lit(0))).where("n <> wanted").select(F.lit(3).alias("priority"), F.col("shard_id").alias("line_no"), F.lit(0).alias("check_no"), F.concat(F.lit("Shard "), F.col("shard_id").cast("string"), F.lit(": expected "), F.col("wanted").cast("string"), F.lit(" records, got "), F.col("n").cast("string")).alias("message"))
    return total.unionByName(missing).unionByName(ids).unionByName(seeds).unionByName(number).unionByName(uneven)


def first_violation(found: DataFrame) -> str | None:
    """The message that a line-by-line validation raises, or None."""
    return found.agg(F.min_by("message", F.struct("priority", "line_no", "check_no"))).first()[0]


def manifest(rows: DataFrame, size: int) -> DataFrame:
    """AGG-8: one row; the first and last id are by line, not by name.  Shard ids are bounded by the plan."""
    return rows.agg(
        F.count("*").alias("total_samples"),
        F.count_distinct("shard_id").alias("shard_count"),
        F.lit(size).cast("long").alias("shard_size"),
        F.array_sort(F.collect_set("shard_id")).alias("shard_ids"),
        F.min("seed").alias("min_seed"),
        F.max("seed").alias("max_seed"),
        F.min_by("id", "line_no").alias("first_id"),
        F.max_by("id", "line_no").alias("last_id"),
    )
