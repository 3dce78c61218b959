"""The corpus pipeline: five operators one after another, each over all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sieveworks.llm import decontam, langid, packing, pii, simhash
from sieveworks.llm.common import materialize, pick
from sieveworks.llm.queries import tokenizer_path

KINDS = {"doc_id": "long", "text": "string", "lang": "string", "source": "string", "n_chars": "long"}
COLUMNS = tuple(KINDS)


def _keep(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of docs whose doc_id is among ids; a null doc_id equals a null one."""
    ids = ids.select(F.col("doc_id").alias("of")).hint("shuffle_hash")
    return docs.join(ids, docs.doc_id.eqNullSafe(ids["of"]), "left_semi").select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts of no language, or within a narrow margin of two, go; lang becomes the predicted one.

    Null, empty and letterless texts are of no language.  Every row has its own
    verdict, also where doc_ids repeat or are null.
    """
    docs = pick(docs, **KINDS)
    model = langid.train(docs.where(~langid.held_out()))
    return langid.annotate(docs, model, "lang").where(f"lang <> '{langid.UNKNOWN}' AND score >= {langid.MIN_MARGIN}").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each component stays, and nothing else.

    A null doc_id counts as larger than any.  Where several rows of a component
    share its smallest doc_id, the first by text, lang, source and n_chars stays;
    rows of different components that share a doc_id, or have none, all stay.
    """
    docs = pick(docs, **KINDS)
    found = materialize(simhash.near_duplicates(docs), "near-duplicates")
    smallest = F.col("doc_id").eqNullSafe(F.col("component_id"))
    ids = found.groupBy("doc_id").agg(F.count("*").alias("n"), F.max(smallest).alias("kept")).where("kept")
    kept = _keep(docs, ids)
    if not ids.where("n > 1").limit(1).count():
        return kept
    # A doc_id alone doesn't name a row here: fingerprints tell whose rows are whose.
    firsts = found.where(smallest).select(F.col("doc_id").alias("of"), F.col("fp").alias("of_fp"), "root").distinct()
    rows = simhash.annotate(kept)
    rows = rows.join(firsts, rows.doc_id.eqNullSafe(firsts["of"]) & (rows.fp == firsts.of_fp))
    order = Window.partitionBy("root").orderBy("text", "lang", "source", "n_chars")
    return rows.withColumn("n", F.row_number().over(order)).where("n = 1").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a copy or paraphrase of a benchmark item go.

    Rows are named by a hash of doc_id and text, so that a clean text stays where
    another with its doc_id, or with none, goes.  Null and empty texts stay.
    """
    docs = pick(docs, **KINDS)
    name = F.xxhash64(F.col("doc_id"), F.col("text"))
    leaks = decontam.find(docs.select(name.alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    leaks = leaks.select(F.col("doc_id").alias("of")).distinct().hint("shuffle_hash")
    return docs.join(leaks, name == F.col("of"), "left_anti").select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and credentials are replaced by their kind in brackets; n_chars follows.

    Every row stays; a null text stays null, and its n_chars is null.
    """
    docs = pick(docs, **KINDS)
    return pii.redact(docs, pii.train(docs)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def online_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences with their token ids, as in packing.pack; a null or empty text is the end id alone."""
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("online_packing", online_packing),
]

#: Compression sizes, SimHash, singular vectors, trained classifiers and tokenizers are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written before the next begins; the rows of the last.

    Nulls in any column, empty and very long texts, repeated rows and an empty
    table are handled as the stages say.  Extra columns are left out, also ones
    whose names differ from those of documents by case only.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
