"""Progress as append-only rows (kind, id): nothing is rewritten, and repeats do no harm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

SCHEMA = "kind string, id string"


def load(spark: SparkSession, path: str) -> DataFrame:
    """SRC-6: different rows; none if there is no progress yet."""
    try:
        return spark.read.schema(SCHEMA).parquet(path).distinct()
    except AnalysisException:
        return spark.createDataFrame([], SCHEMA)


def append(done: DataFrame, kind: str, path: str) -> None:
    """SNK-9: marks the ids of done."""
    done.select(F.lit(kind).alias("kind"), F.col("id").cast("string").alias("id")).write.mode("append").parquet(path)


def pending(rows: DataFrame, progress: DataFrame, kind: str, key: str = "id") -> DataFrame:
    """FLT-7, FLT-8, JON-3: rows that aren't marked."""
    marked = progress.where(F.col("kind") == kind).select(F.col("id").alias("_marked"))
    return rows.join(marked, rows[key].cast("string") == F.col("_marked"), "left_anti")
