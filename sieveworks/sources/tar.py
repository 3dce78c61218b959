"""Tar shards: a sink that writes each shard to a temporary name and then renames it, and a streaming source."""

from __future__ import annotations

import io
import re
import tarfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PREFIX = "anime-face"  # fixed value: how archives are named unless the caller says otherwise


def shard_name(shard_id: int, prefix: str = PREFIX) -> str:
    return f"{prefix}-{shard_id:06d}.tar"


def _opened(path: str):
    """(file system, path there); paths without a scheme are local."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if re.match(r"\w+:/", path) else (fs.LocalFileSystem(), path)


def write(samples: DataFrame, folder: str, prefix: str = PREFIX) -> DataFrame:
    """SNK-8: samples (shard_id, idx, id, png, json) as a tar a shard; returns (shard_id, file, n, bytes).

    Rows are dealt by shard and sorted by place, so a task streams one shard after
    another; the members of a sample are its image and then its JSON.  A file shows
    under its name only when it is whole.  Missing parts are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _opened(folder)
        system.create_dir(root, recursive=True)
        now, done = None, []

        def close():
            if now:
                now[2].close()
                now[1].close()
                system.move(now[3], f"{root}/{shard_name(now[0], prefix)}")
                done.append((now[0], shard_name(now[0], prefix), now[4], now[5]))

        for batch in batches:
            for row in batch.to_pylist():
                if now is None or now[0] != row["shard_id"]:
                    close()
                    temporary = f"{root}/.{uuid.uuid4().hex}.tmp"
                    out = system.open_output_stream(temporary)
                    now = [row["shard_id"], out, tarfile.open(fileobj=out, mode="w|"), temporary, 0, 0]
                for ext, data in (("png", row["png"]), ("json", row["json"] and row["json"].encode())):
                    if data is not None:
                        info = tarfile.TarInfo(f"{row['id']}.{ext}")
                        info.size = len(data)
                        now[2].addfile(info, io.BytesIO(data))
                        now[5] += len(data)
                now[4] += 1
        close()
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
        columns = list(zip(*done)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["shard_id", "file", "n", "bytes"])

    rows = samples.select(F.col("shard_id").cast("long").alias("shard_id"), F.col("idx").cast("long").alias("idx"), F.col("id").cast("string").alias("id"), F.col("png").cast("binary").alias("png"), F.col("json").cast("string").alias("json"))
    return rows.repartition("shard_id").sortWithinPartitions("shard_id", "idx").mapInArrow(run, "shard_id long, file string, n long, bytes long")


def present(spark: SparkSession, folder: str, prefix: str = PREFIX) -> DataFrame:
    """SRC-7: shard_id of the archives that stand under their names; listed, not read.  No folder: none."""
    try:
        paths = spark.read.format("binaryFile").option("pathGlobFilter", f"{prefix}-*.tar").load(folder).select("path")
    except AnalysisException:
        return spark.createDataFrame([], "shard_id long")
    return paths.select(F.regexp_extract("path", r"-([0-9]+)\.tar$", 1).try_cast("long").alias("shard_id")).where("shard_id IS NOT NULL")


def members(spark: SparkSession, folder: str, prefix: str = PREFIX) -> DataFrame:
    """(shard, id, ext, data) of every file of the archives; they are streamed, however large they are."""
    paths = spark.read.format("binaryFile").option("pathGlobFilter", f"{prefix}-*.tar").load(folder).select("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, at = _opened(path)
                with system.open_input_stream(at) as f, tarfile.open(fileobj=f, mode="r|") as archive:
                    for m in archive:
                        if m.isfile():
                            name, _, ext = m.name.rpartition(".")
                            rows = ([path.rsplit("/", 1)[-1]], [name or m.name], [ext if name else ""], [archive.extractfile(m).read()])
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, (pa.string(), pa.string(), pa.string(), pa.binary()))], ["shard", "id", "ext", "data"])

    return paths.mapInArrow(run, "shard string, id string, ext string, data binary")


def samples(spark: SparkSession, folder: str, last_wins: bool = True, prefix: str = PREFIX) -> DataFrame:
    """SRC-5: (id, png, json, shard): images with the JSON of the same archive and name.

    A JSON without an image is no sample.  With last_wins an id that is in several
    archives is taken from the last by name; else all are returned.
    """
    found = members(spark, folder, prefix).where("ext IN ('png', 'json')")
    paired = found.groupBy("shard", "id").agg(F.max(F.when(F.col("ext") == "png", F.col("data"))).alias("png"), F.max(F.when(F.col("ext") == "json", F.col("data"))).cast("string").alias("json")).where("png IS NOT NULL")
    if last_wins:
        place = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("shard")))
        paired = paired.withColumn("_n", place).where("_n = 1").drop("_n")
    return paired.select("id", "png", "json", "shard")
