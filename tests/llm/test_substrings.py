import hashlib
import random
import re

import duckdb
import pytest

from sieveworks.llm import substrings
from sieveworks.llm.queries import ORACLES, op3_debruijn_dedup


def brute(rows, n):
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    low = {}
    key = lambda d: substrings.LAST if d is None else d
    for d, w in words:
        for i in range(len(w) - n + 1):
            g = tuple(w[i : i + n])
            low[g] = min(low.get(g, key(d)), key(d))
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - n + 1):
            if low[tuple(w[i : i + n])] < key(d):
                gone |= set(range(i, i + n))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def run(spark, rows, n, parts=3):
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, KEPT string").repartition(parts)
    return sorted(map(tuple, substrings.remove_repeats(df, n).collect()), key=str)


def test_query_against_sql(spark, sf):
    got = sorted(map(tuple, op3_debruijn_dedup(spark, sf).collect()))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert got == sorted(db.sql(ORACLES["op3_debruijn_dedup"]).fetchall())


@pytest.mark.parametrize("seed, alphabet", [(1, 2), (2, 3), (3, 30)])
def test_random_texts_with_branches(spark, seed, alphabet):
    """Few words give many repeats, branches, ties of minimizers and cycles."""
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCD"[:alphabet]) for _ in range(rng.randrange(0, 90)))) for i in range(40)]
    long = rows[5][1] + " " + rows[7][1]
    rows += [(50, long), (51, "q " + long + " r"), (52, long + " z " + long)]
    assert run(spark, rows, 6) == brute(rows, 6)
    assert run(spark, rows, 13) == brute(rows, 13)


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(3, None), (4, ""), (5, " \t\n"), (6, "only a few words"), (7, text), (7, text), (8, "x\t" + text.replace(" ", "\n\n") + " y"), (None, text), (9, "a " * 30000), (10, "a " * 30), (11, text.upper())]
    assert run(spark, rows, 13) == brute(rows, 13)


def test_empty_table_and_digest(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.remove_repeats(df).count() == 0
    df = spark.createDataFrame([(1, "é  b")], "doc_id long, text string")
    assert substrings.remove_repeats(df, digest=True).first().kept == hashlib.sha256("é b".encode()).hexdigest()
    with pytest.raises(ValueError):
        substrings.remove_repeats(df, 4).count()


def thue_morse(n, letters):
    return "".join(letters[i.bit_count() & 1] for i in range(n))


def test_words_that_linear_hashes_confuse(spark):
    """Long words of two letters in Thue-Morse order and its complement are different words."""
    rest = " ".join(f"w{i}" for i in range(12))
    for n in (64, 1024, 4096):
        rows = [(1, thue_morse(n, "ab") + " " + rest), (2, thue_morse(n, "ba") + " " + rest), (3, thue_morse(n, "ab") + " " + rest)]
        got = run(spark, rows, 13)
        assert got == brute(rows, 13) and [r[2] for r in got] == [0, 0, 13]


def test_largest_and_missing_ids(spark):
    """A null doc_id is larger than any, also than the largest long; rows that share a doc_id keep their own words."""
    text = " ".join(f"w{i}" for i in range(30))
    for rows in (
        [((1 << 63) - 1, text), (None, text + " end"), (None, "other " + text)],
        [((1 << 63) - 1, text), (-(1 << 63), "x " + text), (None, text)],
        [(5, text + " a"), (5, "b " + text), (6, text), (6, "only " * 20)],
        [(None, text), (None, text)],
    ):
        assert run(spark, rows, 13) == brute(rows, 13)
