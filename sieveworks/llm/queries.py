"""Queries of the ten operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveworks.llm import decontam, langid, licenses, packing, pii, quality, simhash, substrings, urls, warc
from sieveworks.llm.common import pick, scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """Where the public tokenizer of the packing query lies."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_ngram_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"))


def op2_online_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path()).drop("ids")


def op3_debruijn_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("kept", "kept_sha256")


def op4_compression_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = pick(_table(spark, sf_dir, "documents"), doc_id="long", text="string", lang="string")
    model = langid.train(documents.where(~langid.held_out()))
    return langid.classify(documents, model).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages"), urls.fit(urls.builtin_labels(spark)))


def op6_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op7_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _of_kind(kind: str) -> Column:
    return F.filter("spans", lambda s: s["kind"] == kind)


def op8_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    found = pii.find(documents, pii.train(documents)).select("doc_id", "spans")
    counts = [F.size(_of_kind(kind)).cast("long").alias(f"n_{kind}") for kind in pii.KINDS[:4]]
    base = F.filter("spans", lambda s: s["kind"] != "secret")
    return found.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def op9_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch(spark)}/sieveworks/warc-{uuid.uuid4().hex}"
    warc.write(_table(spark, sf_dir, "pages"), path)
    return warc.captures(spark, path)


def op10_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_perplexity,
        op2_online_packing,
        op3_debruijn_dedup,
        op4_compression_langid,
        op5_url_filter,
        op6_license_templates,
        op7_simhash_golay,
        op8_weak_supervision_pii,
        op9_warc_transactions,
        op10_latent_decontamination,
    )
}


def _op3_sql() -> str:
    n = substrings.WINDOW
    return rf"""
    WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    g AS (SELECT doc_id, i, array_to_string(ws[i:i + {n - 1}], ' ') AS g FROM w, unnest(range(1, len(ws) - {n - 2})) AS t(i)),
    lows AS (SELECT g, min(doc_id) AS low FROM g GROUP BY g),
    covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + {n})) AS p FROM g JOIN lows USING (g) WHERE doc_id > low),
    p AS (SELECT doc_id, p, ws[p] AS word FROM w, unnest(range(1, len(ws) + 1)) AS t(p)),
    kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS kept FROM p ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id)
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM w LEFT JOIN kept USING (doc_id)
    """


def _op6_sql() -> str:
    places, base, found = [], [], []
    for phrase, label in licenses.PHRASES:
        words = [w.decode() for w in licenses.re.findall(licenses.WORD, phrase.encode())]
        test = " AND ".join(f"ws[i + {k}] = '{w}'" for k, w in enumerate(words))
        here = f"list_filter(range(1, len(ws) + 1), lambda i: {test})"
        places.append(here)
        base.append(f"CASE WHEN len({here}) > 0 THEN ['{label}'] ELSE [] END")
    for label, template in licenses.TEMPLATES:
        found.append(f"CASE WHEN regexp_matches(line, '{licenses.pattern(template)}') THEN ['{label}'] ELSE [] END")
    fold = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
    WITH w AS (SELECT doc_id, regexp_extract_all({fold}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
    l AS (SELECT doc_id, ws, ' ' || array_to_string(ws, ' ') || ' ' AS line FROM w),
    f AS (SELECT doc_id, ws, flatten([{', '.join(places)}]) AS places, flatten([{', '.join(base)}]) AS base, flatten([{', '.join(found)}]) AS found FROM l)
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base,
      CAST(list_min(places) - 1 AS BIGINT) AS first_word, CAST(list_max(places) - 1 AS BIGINT) AS last_word,
      array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
      array_to_string(list_sort(list_distinct(list_concat(base, found))), ',') AS labels,
      CASE WHEN len(found) > 0 THEN 1.0 WHEN len(base) > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS score
    FROM f
    """


OP9_SQL = f"""
WITH h AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (SELECT page_id, strlen(html) AS n, array_to_string(list_transform(range(0, 32), lambda i: substr('{warc.ALPHABET}',
  1 + ((CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS INTEGER), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1)), '') AS digest FROM h),
f AS (SELECT digest, min(page_id) AS first_id FROM d GROUP BY digest)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d JOIN f USING (digest)
"""

ORACLES: dict[str, str] = {"op3_debruijn_dedup": _op3_sql(), "op6_license_templates": _op6_sql(), "op9_warc_transactions": OP9_SQL}
