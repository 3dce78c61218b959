import zlib

import pytest

from sieveworks.llm import langid
from sieveworks.llm.queries import op4_compression_langid


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op4_compression_langid(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(lang)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.lang_pred in {*lang.values(), "und"}
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, t * 5, lang) for i, (t, lang) in enumerate([("the cat and the dog with this ", "en"), ("der hund und die katze nicht ", "de")] * 5)]
    return langid.train(spark.createDataFrame([*rows, (None, None, "fr"), (98, "123", "fr"), (99, "x y", None)], "doc_id long, text string, lang string"))


def test_odd_rows(spark, model):
    assert [m[0] for m in model] == ["de", "en"]
    rows = [(1, None), (2, ""), (3, "12 34 !?"), (None, "the dog and the cat"), (4, "die katze und der hund"), (4, "die katze und der hund"), (5, "the cat with the dog " * 4000), (6, "Ⅷ²½"), (7, "q")]
    df = spark.createDataFrame([(*r, "zz", 1) for r in rows], "doc_id long, text string, Text string, score int")
    got = [(r.doc_id, r.lang_pred) for r in langid.classify(df, model).orderBy("doc_id").collect()]
    assert got[:4] == [(None, "en"), (1, "und"), (2, "und"), (3, "und")]
    assert got[4:] == [(4, "de"), (4, "de"), (5, "en"), (6, "und"), (7, got[-1][1])] and got[-1][1] in ("de", "en")
    assert langid.classify(df.limit(0), model).count() == 0
    assert {r.lang_pred for r in langid.classify(df, []).collect()} == {"und"}


def test_training_is_bounded(spark):
    df = spark.createDataFrame([(i, "abc " * 1000, "xx") for i in range(50)], "doc_id long, text string, lang string")
    [(name, content)] = langid.train(df, documents=3, chars=100)
    assert name == "xx" and len(content) <= 3 * 101


def test_query_against_brute_force(spark, sf):
    """Sample, dictionaries, sizes, ties and margins computed anew from the definition."""
    import re

    import zstandard
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("h", F.xxhash64("doc_id")).collect()
    reduced = lambda t: b" ".join(re.sub(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]", b" ", t.lower().encode()).split())
    learned = [r for r in docs if zlib.crc32(str(r.doc_id).encode()) % 5 and r.lang is not None and r.text and any(c.isalpha() for c in r.text)]
    names = sorted({r.lang for r in learned}, key=lambda x: (-sum(r.lang == x for r in learned), x))
    best = {x: sorted((r for r in learned if r.lang == x), key=lambda r: (r.h, r.text))[:128] for x in names}
    words = [zstandard.ZstdCompressionDict(reduced("\n".join(r.text for r in best[x][::-1])), dict_type=zstandard.DICT_TYPE_RAWCONTENT) for x in names]

    def sizes(data, level):
        parts = [data[i : i + 4096] for i in range(0, len(data), 4096)]
        return [sum(len(zstandard.ZstdCompressor(level=level, dict_data=w, write_content_size=False, write_dict_id=False).compress(p)) for p in parts) for w in words]

    want = {}
    for r in docs:
        data = reduced(r.text or "")
        if not any(c.isalpha() for c in r.text or ""):
            want[r.doc_id] = ("und", 0.0)
            continue
        if len(data) < 96:
            data = b" ".join([data] * (96 // max(len(data), 1) + 1))
        first = sizes(data, 3)
        tied = [i for i, n in enumerate(first) if n == min(first)]
        if len(tied) > 1:
            finer = sizes(data, 9)
            want[r.doc_id] = (names[min(tied, key=lambda i: (finer[i], i))], 0.0)
        else:
            second = sorted(first)[1]
            want[r.doc_id] = (names[tied[0]], (second - min(first)) / second)
    got = {r.doc_id: (r.lang_pred, r.score) for r in op4_compression_langid(spark, sf).collect()}
    assert {d: x[0] for d, x in got.items()} == {d: x[0] for d, x in want.items()}
    assert all(got[d][1] == pytest.approx(want[d][1]) for d in want)


def test_many_languages_share_the_sample(spark):
    rows = [(i, f"text of document {i} in its language", f"l{i % 40}") for i in range(400)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), total=80)
    assert len(model) == 40 and all(content.count(b"text") == 2 for _, content in model)


def test_annotate_keeps_columns(spark, model):
    df = spark.createDataFrame([(1, "the cat", "zz", 5)], "doc_id long, text string, lang string, n int")
    [r] = langid.annotate(df, model, "lang").collect()
    assert (r.doc_id, r.text, r.lang, r.n) == (1, "the cat", "en", 5)
