import zlib

import pytest

import corpus_pipeline
from sieveworks.llm import langid


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    sf, root = "/root/testdata/sf0.001", tmp_path_factory.mktemp("stages")
    docs = [spark.read.parquet(f"{sf}/documents.parquet")]
    for name, f in corpus_pipeline.STAGES:
        f(spark, docs[-1], sf).write.parquet(str(root / name))
        docs.append(spark.read.parquet(str(root / name)))
    return docs


def test_each_stage_against_its_input(spark, stages):
    from tests.llm.test_decontam import words
    from tests.llm.test_pii import brute as spans
    from tests.llm.test_simhash import brute_components, brute_fingerprint

    source, langs, unique, clean, redacted, packed = [{r.doc_id: r for r in d.collect()} if "text" in d.columns else d.collect() for d in stages]
    for a, b in zip(stages[:4], stages[1:5]):
        assert a.columns == b.columns
    assert 0.97 * len(source) < len(langs) <= len(source)
    assert all(r.text == source[d].text and r.lang != langid.UNKNOWN for d, r in langs.items())
    roots = brute_components({d: brute_fingerprint(r.text) for d, r in langs.items()})
    assert set(unique) == set(roots.values())
    items = [words(r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    leaks = {d for d, r in unique.items() if any(" " + " ".join(w) + " " in " " + " ".join(words(r.text)) + " " for w in items)}
    assert leaks and set(clean) == set(unique) - leaks
    assert set(redacted) == set(clean)
    for d, r in redacted.items():
        assert r.n_chars == len(r.text)
        assert not spans(r.text) and ("[" in r.text or r.text == clean[d].text)
    assert {r.doc_id for r in packed} == set(redacted)


def test_run_gives_the_last_stage(spark, stages):
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    total = corpus_pipeline.run(spark, "/root/testdata/sf0.001").groupBy().sum("length").first()[0]
    assert total == stages[-1].groupBy().sum("length").first()[0] and set(key) < set(stages[-1].columns)


def test_empty_and_odd_documents(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text = "the cat and the dog went home with this and that and all of the other animals of the farm"
    rows = [(None, None, None, None, None), (1, text, "en", None, 5), (1, text, "en", None, 5), (2, "", "en", "x", 0), (3, text + " a@b.cc", None, "x", 0), (None, text + " other", "en", "x", 0)]
    bench = tmp_path / "benchmark.parquet"
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(bench))
    for n in (0, len(rows)):
        docs = spark.createDataFrame(rows[:n], schema)
        for _, f in corpus_pipeline.STAGES:
            docs = f(spark, docs, str(tmp_path))
        assert (docs.count() > 0) == bool(n)


def test_clashing_columns(spark, tmp_path):
    """Columns whose names differ by case only stand beside those of documents; each stage gives what it gives without them."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(i, f"the cat and the dog went home with number {i} and all of the other animals", "en", "x", 5) for i in range(4)]
    bench = tmp_path / "benchmark.parquet"
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(bench))
    plain = spark.createDataFrame(rows, schema)
    odd = spark.createDataFrame([(*r, "y", 1, 2, 3) for r in rows], schema + ", Text string, DOC_ID long, Lang int, fp long")
    for _, f in corpus_pipeline.STAGES:
        want, got = f(spark, plain, str(tmp_path)), f(spark, odd, str(tmp_path))
        assert got.columns == want.columns and got.count() == want.count() > 0


def test_repeated_and_missing_ids_go_by_row(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    a, b, c = ("the cat and the dog went home with this", "rain falls on seven green hills far away from here", "nobody counted the small lamps along our quiet street")
    rows = [(5, a), (5, a), (5, b), (3, b), (None, c), (None, c), (None, a), (None, "one more line of plain words that nobody else has"), (7, None)]
    docs = spark.createDataFrame([(d, t, "en", None, 1) for d, t in rows], schema)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert sorted(got, key=str) == sorted([(5, a), (3, b), (None, c), (None, rows[7][1]), (7, None)], key=str)
    bench = tmp_path / "benchmark.parquet"
    spark.createDataFrame([(1, c)], "item_id long, text string").write.parquet(str(bench))
    same = spark.createDataFrame([(d, t, "en", None, 1) for d, t in [(5, a), (5, c), (None, b), (None, c), (None, None), (6, "")]], schema)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.decontamination(spark, same, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted([(5, a), (None, b), (None, None), (6, "")], key=str)


def test_packed_sequences_can_be_read(stages):
    """The last stage's rows hold the token ids, whose checksums and lengths are theirs."""
    rows = stages[-1].collect()
    assert rows and all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in rows)
