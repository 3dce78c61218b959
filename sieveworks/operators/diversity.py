"""Diversity: distinct values, histograms, thresholds, cross-tabulations and quotas."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Distinct values that a publishable run has, by feature.
THRESHOLDS = {"eyes": 20, "hair_color": 10, "hair_style": 10, "expression": 8, "accessories": 5}
ONLY_FILLED = ("accessories",)


def long(rows: DataFrame, features: list[str], only_filled=ONLY_FILLED, order: list[str] | None = None) -> DataFrame:
    """(feature, value[, seq]) of every row; empty values of the features in only_filled are left out."""
    stacked = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("value")) for f in features])).alias("x")
    seq = [F.struct(*order).alias("seq")] if order else []
    out = rows.select(stacked, *seq).select("x.*", *(["seq"] if order else []))
    return out.where(~(F.col("feature").isin(*only_filled) & (F.coalesce("value", F.lit("")) == ""))) if only_filled else out


def distinct_values(rows: DataFrame, features: list[str], only_filled=ONLY_FILLED) -> DataFrame:
    """AGG-1: (feature, n_unique), exact because publishing depends on it."""
    return long(rows, features, only_filled).groupBy("feature").agg(F.count_distinct("value").alias("n_unique"))


def histogram(rows: DataFrame, features: list[str], order: list[str], only_filled=ONLY_FILLED) -> DataFrame:
    """AGG-2, SRT-2: (feature, value, n, place); ties stand as first seen in `order`."""
    counted = long(rows, features, only_filled, order).groupBy("feature", "value").agg(F.count("*").alias("n"), F.min("seq").alias("first"))
    place = F.row_number().over(Window.partitionBy("feature").orderBy(F.desc("n"), "first"))
    return counted.select("feature", "value", "n", place.cast("long").alias("place"))


def check(rows: DataFrame, thresholds: dict[str, int] | None = None, only_filled=ONLY_FILLED) -> DataFrame:
    """AGG-3: (feature, passed, n_unique, required); a feature never seen has 0; no thresholds means the default ones."""
    wanted = thresholds or THRESHOLDS
    table = rows.sparkSession.createDataFrame(list(wanted.items()), "feature string, required int")
    seen = [f for f in wanted if f in rows.columns]
    found = distinct_values(rows, seen, only_filled) if seen else table.select("feature", F.lit(0).cast("long").alias("n_unique")).limit(0)
    joined = table.join(found, "feature", "left").withColumn("n_unique", F.coalesce("n_unique", F.lit(0)))
    return joined.select("feature", (F.col("n_unique") >= F.col("required")).alias("passed"), "n_unique", "required")


def all_met(checked: DataFrame) -> DataFrame:
    """AGG-4: one row (all_met)."""
    return checked.agg(F.coalesce(F.bool_and("passed"), F.lit(True)).alias("all_met"))


def cross_table(rows: DataFrame, a: str, b: str) -> DataFrame:
    """AGG-17: counts by pair of values, with totals of each value and of all (grouping_id 0, 1, 2, 3)."""
    return rows.cube(a, b).agg(F.count("*").alias("n"), F.grouping_id().cast("long").alias("level"))


def within_quota(rows: DataFrame, combination: list[str], order: list[str], quota: int) -> DataFrame:
    """AGG-18: at most `quota` rows of each combination, the first in order.

    Spark limits each partition's groups before the shuffle, so that a frequent
    combination sends `quota` rows a task.
    """
    place = F.row_number().over(Window.partitionBy(*combination).orderBy(*order))
    return rows.withColumn("_n", place).where(F.col("_n") <= quota).drop("_n")
