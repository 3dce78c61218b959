"""The session and the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "sieveworks", **conf: str) -> SparkSession:
    """A session with the settings that the engine relies on; master and sizes come from the environment or conf."""
    builder = SparkSession.builder.appName(name)
    for k, v in {**CONF, **conf}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; checkpoints go there too.

    Where it is unset, a temporary folder that goes with the process, and only
    on a local master: executors elsewhere couldn't see it, so that raises
    RuntimeError.
    """
    context = spark.sparkContext._jsc.sc()
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not context.getCheckpointDir().isDefined():
        if not root:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            root = tempfile.mkdtemp(prefix="sieveworks-")
            atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(root)
    return (root or context.getCheckpointDir().get()).rstrip("/")


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/sieveworks/{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as Parquet in the shared folder: computed once, and safe when executors are lost.  cleanup() deletes it."""
    spark = df.sparkSession
    path = f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cleanup(spark: SparkSession) -> None:
    """Deletes all tables that this application has written to the shared folder; results not yet read or written elsewhere go with them."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
