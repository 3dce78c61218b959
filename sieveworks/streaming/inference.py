"""Inference over a stream of prompts: each micro-batch is written once, under its number."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sieveworks.operators import inference
from sieveworks.sources.jsonl import RECORD


def start(spark: SparkSession, prompts: str, output: str, checkpoint: str, settings: dict, model: Callable = inference.stub, files: int = 16) -> StreamingQuery:
    """STR-3, STR-4: reads JSON lines that arrive in `prompts`, writes samples to output/batch=N.

    A batch that is run again after a crash overwrites its own folder, so that no
    sample is there twice.  Runs until all that is there has been read.
    """

    def one(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("idx", F.regexp_extract("id", r"-r(\d+)$", 1).try_cast("long")).dropDuplicates(["id"])
        inference.generate(rows, settings, model).write.mode("overwrite").parquet(f"{output}/batch={number}")

    stream = spark.readStream.schema(RECORD).option("maxFilesPerTrigger", files).json(prompts)
    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
