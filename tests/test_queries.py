import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from sieveworks import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in os.listdir(SF):
        if f.endswith(".parquet"):
            path = f"{SF}/{f}/*.parquet" if os.path.isdir(f"{SF}/{f}") else f"{SF}/{f}"
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{path}'")
    return con


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = []
    for r in found:
        out.append(tuple(round(v, 9) if isinstance(v, float) and math.isfinite(v) else v for v in (r[i] for i in order)))
    return sorted(columns), sorted(out, key=repr)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, db, name):
    df = queries.QUERIES[name](spark, SF)
    want = db.sql(queries.ORACLES[name])
    assert rows(df.columns, map(tuple, df.collect())) == rows(want.columns, want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(queries.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_image_inference(spark):
    got = queries.image_inference(spark, SF).collect()
    assert got and all((r.width, r.height, r.n_missing) == (16, 16, 0) for r in got)
