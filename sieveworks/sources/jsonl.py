"""JSON lines: reading in file order up to a target, and writing ordered lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveworks.functions import text

RECORD = "id string, positive_prompt string, negative_prompt string, shard_id long, seed long"
ORDER = ("id", "positive_prompt", "negative_prompt", "shard_id", "seed")


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, line): the lines that aren't blank, numbered in order of file name and place.

    Spark splits large files, so a line's place is its split's first byte, then its
    place in the split; counts of splits, not lines, are added up on the way.
    """
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("m"))
    lines = lines.where(text.strip(F.col("line")) != "")
    # Within a split the id counts up by one a line; what is left out makes no difference to the order.
    splits = lines.groupBy("file", "block").agg(F.count("*").alias("n")).collect()
    offsets, at = [], 0
    for r in sorted(splits, key=lambda r: (r["file"], r["block"])):
        offsets.append((r["file"], r["block"], at))
        at += r["n"]
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("file", "block").orderBy("m")) - 1
    table = spark.createDataFrame(offsets, "file string, block long, before long")
    return lines.withColumn("place", place).join(F.broadcast(table), ["file", "block"]).select((F.col("before") + F.col("place")).cast("long").alias("line_no"), "line")  # a row a split


def read_records(spark: SparkSession, path: str, target: int | None = None) -> DataFrame:
    """SRC-3: line_no, the record's fields, and keys (the fields that the line has).

    Lines from number `target` on are not parsed, so that damage there isn't seen;
    damage before raises an error.
    """
    lines = numbered(spark, path)
    if target is not None:
        lines = lines.where(F.col("line_no") < target)
    parsed = F.from_json("line", RECORD, {"mode": "FAILFAST"})
    if target is not None:  # the test stays with the parser wherever the optimizer moves it
        parsed = F.when(F.col("line_no") < target, parsed)
    return lines.select("line_no", parsed.alias("r"), F.json_object_keys("line").alias("keys")).select("line_no", "keys", "r.*")


def write_records(records: DataFrame, path: str, order: list[str] = ["shard_id", "record_idx"]) -> None:  # noqa: B006
    """SNK-1, SNK-2: ordered lines, overwriting what is there; parts come in order of their names."""
    line = text.json_line(list(ORDER[:3]), list(ORDER[3:]), list(ORDER))
    records.orderBy(*order).select(line.alias("value")).write.mode("overwrite").text(path)


def digest(records: DataFrame) -> DataFrame:
    """SNK-3: one row (n, digest): a digest of the records that doesn't depend on their order."""
    return records.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*[F.col(c) for c in ORDER]).cast("decimal(38,0)")).cast("string").alias("digest"))


def ordered_digest(lines: DataFrame, line: str, order: list[str], block: str) -> DataFrame:
    """SNK-3: one row (n, digest): SHA-256 over the lines in order, as a tree of two levels.

    A block's digest is of its lines' digests in order, the whole digest of the
    blocks' digests in order of block.  block: a column that orders and cuts the
    lines into parts that a task can hold.
    """
    leaf = F.struct(*order, F.sha2(F.col(line), 256).alias("_d"))
    blocks = lines.groupBy(F.col(block).alias("_b")).agg(F.count("*").alias("n"), F.array_sort(F.collect_list(leaf)).alias("leaves"))
    blocks = blocks.select("_b", "n", F.sha2(F.array_join(F.transform("leaves", lambda x: x["_d"]), ""), 256).alias("d"))
    ordered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_b", "d"))), lambda x: x["d"]), "")
    return blocks.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n"), F.sha2(ordered, 256).alias("digest"))
