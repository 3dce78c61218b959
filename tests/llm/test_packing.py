import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from sieveworks.llm import packing
from sieveworks.llm.queries import op2_online_packing, tokenizer_path


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(tokenizer_path())


def check(rows, texts, whole, size=packing.WINDOW):
    """Every id lies in one piece, sequences have no gaps, and only powers of two are short."""
    ids = {d: [*whole.encode(t or "", add_special_tokens=False).ids, packing.END_ID] for d, t in texts.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == set(ids)
    for d, found in pieces.items():
        at = 0
        for r in sorted(found, key=lambda r: r["start"]):
            part = np.array(ids[d][r["start"] : r["start"] + r["length"]], "<u4").tobytes()
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids[d]), zlib.crc32(part))
            at += r["length"]
        assert at == len(ids[d])
    padding = 0
    for found in sequences.values():
        at = 0
        for r in sorted(found, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    assert padding == 0


def test_query_on_whole_table(spark, sf, whole):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = [r.asDict() for r in op2_online_packing(spark, sf).collect()]
    check(rows, docs, whole)


def test_odd_rows(spark, whole):
    texts = {1: None, 2: "", 3: "a <|endoftext|> b", 4: "É é é İ ΑΣ \x1c x\x85y ​’s 中文", 5: "word " * 9000, 6: "it's 12 can't--!!'s", 7: "x" * 5000, 8: "µ² ½ ª º Ŀ"}
    df = spark.createDataFrame([(k, t, "en", 1) for k, t in texts.items()], "doc_id long, text string, TEXT string, ids int").repartition(3)
    rows = [r.asDict() for r in packing.pack(df, tokenizer_path()).collect()]
    check(rows, texts, whole)
    for r in rows:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"]


def test_many_partitions_and_levels(spark, whole, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 4)
    texts = {k: f"doc number {k} " * (k % 7 + 1) for k in range(300)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(40)
    rows = [r.asDict() for r in packing.pack(df, tokenizer_path(), window=64, open_windows=3).collect()]
    check(rows, texts, whole, 64)


def test_empty_null_and_repeated(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(df, tokenizer_path()).count() == 0
    df = spark.createDataFrame([(None, None), (1, "a b"), (1, "a b")], "doc_id long, text string")
    rows = packing.pack(df, tokenizer_path()).collect()
    assert sum(r["length"] for r in rows) == 1 + 3 + 3


def test_best_fit_and_fullest():
    p = packing.Packer(10, 2)
    ids = lambda n: b"abcd" * n
    p.add("a", 6, ids(6))
    p.add("b", 7, ids(7))
    p.add("c", 3, ids(3))  # fills the window of b, the best fit
    assert [w[0] for w in p.done] == [10] and [w[0] for w in p.open] == [6]
    p.add("d", 7, ids(7))
    p.add("e", 5, ids(5))  # fits none: tops up the fullest with 3, the rest goes to the other
    assert [w[0] for w in p.done] == [10, 10] and [w[0] for w in p.open] == [8]
