import re

import numpy as np
import pytest
import xxhash

from sieveworks.llm import simhash
from sieveworks.llm.queries import op7_simhash_golay


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def brute_components(fps):
    """Of {id: fingerprint}."""
    root = {d: d for d in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(fps)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in fps}


def test_query_against_brute_force(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    fps = {d: brute_fingerprint(t) for d, t in docs.items()}
    want = brute_components(fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op7_simhash_golay(spark, sf).collect()}
    assert got == {d: (f"{fps[d]:016x}", want[d]) for d in docs}


def test_every_pattern_of_four_errors_shares_a_key():
    rng = np.random.default_rng(1)
    patterns = simhash.error_patterns()
    for _ in range(3000):
        x = int(rng.integers(0, 2**64, dtype=np.uint64))
        y = x
        for b in rng.choice(64, rng.integers(0, 5), replace=False).tolist():
            y ^= 1 << b
        keys, rows = simhash.keys_of(np.array([x, y], np.uint64), patterns)
        assert set(keys[rows == 0].tolist()) & set(keys[rows == 1].tolist())


def test_golay_code_is_perfect():
    every = simhash.syndromes(np.arange(1 << 23))
    assert np.bincount(every).tolist() == [4096] * 2048
    patterns = simhash.error_patterns()
    assert (simhash.syndromes(patterns) == np.arange(2048)[:, None]).all()


@pytest.mark.parametrize("seed", [3, 4])
def test_linked_against_brute_force(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, 4, dtype=np.uint64)
    fps = np.unique(np.concatenate([b ^ (np.uint64(1) << rng.integers(0, 64, 30, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 30, dtype=np.uint64)) for b in base]))
    want = brute_components({int(f): int(f) for f in fps})
    got = {int(f): int(f) for f in fps} | {int(a): int(b) for a, b in zip(*simhash.linked(fps, 4))}
    assert got == want


def test_chain_over_many_rounds(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {101: 100}


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n", "x"), (4, "One two", "x"), (5, "one TWO", "x"), (None, "one two", "x"), (5, "one TWO", "x"), (6, "a b c d e f " * 5000, "x"), (7, "É é", "x"), (8, "é é", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, Doc_ID string")
    got = simhash.near_duplicates(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[1].fp == 0 and {by[k].component_id for k in (1, 2, 3)} == {1}
    assert {r.component_id for r in got if r.doc_id in (4, 5, None)} == {4}
    assert by[7].fp != by[8].fp
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_hot_keys_are_split_and_lose_no_link(spark, monkeypatch):
    """Fingerprints that share many key bits: split once and twice, the components are those of brute force."""
    rng = np.random.default_rng(4)
    base = int(rng.integers(0, 2**63))
    fps = {}
    for i in range(600):
        x = base ^ int(rng.integers(0, 2**14)) << int(rng.choice([0, 25, 45]))
        fps[i] = x if i % 3 or not i else fps[i - 1] ^ 1 << int(rng.integers(0, 64)) ^ 1 << int(rng.integers(0, 64))
    distinct = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in set(fps.values())], "fp long").repartition(3)
    keys = distinct.mapInArrow(simhash._keys, "key long, fp long")
    want = brute_components({x: x for x in fps.values()})
    for hot in (1 << 14, 40, 3):
        monkeypatch.setattr(simhash, "HOT", hot)
        split = simhash.split_keys(keys)
        edges = split.repartition(3, "key").sortWithinPartitions("key").mapInArrow(simhash._links, "a long, b long").collect()
        root = {x: x for x in want}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in edges:
            x, y = sorted((find(a % (1 << 64)), find(b % (1 << 64))))
            root[y] = x
        groups = lambda of: sorted(sorted(x for x in want if of(x) == r) for r in {of(x) for x in want})
        assert groups(find) == groups(want.get)
        if hot < 1 << 14:
            assert split.groupBy("key").count().agg({"count": "max"}).first()[0] < keys.groupBy("key").count().agg({"count": "max"}).first()[0]
