import base64
import gzip
import hashlib

import duckdb
import pytest

from sieveworks.llm import warc
from sieveworks.llm.queries import ORACLES, op9_warc_transactions


def test_query_against_sql(spark, sf):
    got = sorted(map(tuple, op9_warc_transactions(spark, sf).collect()), key=str)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    assert got == sorted(db.sql(ORACLES["op9_warc_transactions"]).fetchall(), key=str)


ROWS = [
    (1, "http://a/ b\r\n", "x\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\ny"),
    (2, None, None),
    (3, "u", ""),
    (4, "u", "same é"),
    (5, "u", "same é"),
    (None, "u", "same é"),
    (6, "u", "z" * 300_000),
    (7, "u", "twice"),
    (7, "v", "twice"),
    (8, "u", "\x00\n\n\r"),
]


def digest(t):
    return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(*r, 0) for r in ROWS], "page_id long, url string, html string, URL int").repartition(4)
    warc.write(df, str(tmp_path / "w"))
    got = sorted(map(tuple, warc.captures(spark, str(tmp_path / "w")).collect()), key=str)
    first = {}
    for p, _, h in ROWS:
        if p is not None:
            first[h or ""] = min(first.get(h or "", p), p)
    want = [(p, len((h or "").encode()), digest(h), "response" if p == first[h or ""] else "revisit", None if p == first[h or ""] else first[h or ""]) for p, _, h in ROWS]
    assert got == sorted(want, key=str)
    nested = {r.metadata.fields[0].value: r for r in warc.assemble(warc.read(spark, str(tmp_path / "w"))).collect()}
    assert nested["1"].response.payload.decode() == ROWS[0][2] and nested["1"].request.target_uri == "http://a/%20b%0D%0A"
    assert nested["5"].revisit.refers_to == nested["4"].response.record_id and nested["5"].response is None


def test_smaller_payloads_are_all_responses(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    warc.write(df, str(tmp_path / "w"), min_bytes=3)
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.captures(spark, str(tmp_path / "w")).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3)}


def test_empty_table(spark, tmp_path):
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "w"))
    assert warc.captures(spark, str(tmp_path / "w")).count() == 0


def record(block, **headers):
    lines = ["WARC/1.0", *(f"{k.replace('_', '-')}: {v}" for k, v in headers.items()), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_parse_plain_members_and_damage():
    one, two = record(b"abc", WARC_Type="response"), record(b"", WARC_Type="request")
    for data in (one + two, gzip.compress(one) + gzip.compress(two), gzip.compress(one + two)):
        assert [(h["warc-type"], b) for h, b in warc.parse(data)] == [("response", b"abc"), ("request", b"")]
    with pytest.raises(ValueError):
        list(warc.parse(one[:-6]))
    with pytest.raises(ValueError):
        list(warc.parse(b"HTTP/1.1 200 OK\r\n\r\n"))
    assert list(warc.parse(b"")) == []


def test_missing_parts(spark, tmp_path):
    (tmp_path / "w").mkdir()
    (tmp_path / "w/a.warc").write_bytes(record(b"GET", WARC_Type="request", WARC_Record_ID="<r>", WARC_Concurrent_To="<a>") + record(b"H\r\n\r\nbody", WARC_Type="response", WARC_Record_ID="<b>") + record(b"x", WARC_Type="warcinfo"))
    rows = {r.capture_id: r for r in warc.assemble(warc.read(spark, str(tmp_path / "w"))).collect()}
    assert set(rows) == {"<a>", "<b>"} and rows["<a>"].response is None and rows["<b>"].response.payload == b"body"


def test_every_concurrent_to_counts(spark, tmp_path):
    """Repeated headers, chains of records and several records of a type end in one capture, whichever record names which."""
    (tmp_path / "w").mkdir()
    two = b"WARC/1.1\r\nWARC-Type: metadata\r\nWARC-Record-ID: <m1>\r\nWARC-Concurrent-To: <r1>\r\nWARC-Concurrent-To: <q1>\r\nContent-Length: 1\r\n\r\nx\r\n\r\n"
    data = record(b"GET", WARC_Type="request", WARC_Record_ID="<q1>", WARC_Concurrent_To="<r1>") + record(b"GET", WARC_Type="request", WARC_Record_ID="<q2>", WARC_Concurrent_To="<q1>")
    data += record(b"H\r\n\r\none", WARC_Type="response", WARC_Record_ID="<r1>") + two + record(b"a: b", WARC_Type="metadata", WARC_Record_ID="<m2>", WARC_Concurrent_To="<q2>")
    data += record(b"GET", WARC_Type="request", WARC_Record_ID="<q9>") + record(b"H\r\n\r\nnine", WARC_Type="response", WARC_Record_ID="<r9>", WARC_Concurrent_To="<q9>")
    data += record(b"H\r\n\r\nalone", WARC_Type="response", WARC_Record_ID="<z>") + record(b"GET", WARC_Type="request", WARC_Concurrent_To="<z>")
    (tmp_path / "w/a.warc").write_bytes(data)
    read = warc.read(spark, str(tmp_path / "w"))
    assert {r.record_id: r.concurrent_to for r in read.collect()}["<m1>"] == ["<r1>", "<q1>"]
    rows = {r.capture_id: r for r in warc.assemble(read).collect()}
    assert {c: [x.record_id for x in r.records] for c, r in rows.items()} == {"<r1>": ["<m1>", "<m2>", "<q1>", "<q2>", "<r1>"], "<r9>": ["<q9>", "<r9>"], "<z>": [None, "<z>"]}
    assert [rows[c].response.payload for c in ("<r1>", "<r9>", "<z>")] == [b"one", b"nine", b"alone"]


def test_transactions_carry_payloads(spark, tmp_path):
    """A response's payload comes out of its archive whole; a revisit has none of its own."""
    pages = [(1, "http://a.example/", "<p>one</p>"), (2, "http://a.example/2", "<p>two é\x00\r\n\r\n</p>" * 1000), (3, "http://a.example/3", "<p>one</p>")]
    warc.write(spark.createDataFrame(pages, "page_id long, url string, html string"), str(tmp_path / "w"))
    got = {r.page_id: (r.record_type, r.payload and bytes(r.payload).decode()) for r in warc.transactions(spark, str(tmp_path / "w")).collect()}
    assert got == {1: ("response", pages[0][2]), 2: ("response", pages[1][2]), 3: ("revisit", None)}
