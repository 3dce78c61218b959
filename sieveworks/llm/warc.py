"""WARC archives: writing captures as transactions, reading them back, joining their records.

A capture is a request, a response (or a revisit of an earlier response with the
same payload) and a metadata record.  Request and metadata name the response in
WARC-Concurrent-To.  Archives are written by Spark's text writer with its commit
protocol, to any file system that Spark knows; they are read by content length.
"""

from __future__ import annotations

import base64
import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveworks.llm.common import materialize, pick
from sieveworks.llm.simhash import components

VERSION = "WARC/1.1"
EOL = "\r\n"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REPEATED = "warc-concurrent-to"
DATE = "2024-01-01T00:00:00Z"
RECORD = "record_type string, record_id string, concurrent_to array<string>, refers_to string, target_uri string, payload_digest string, payload_bytes long, payload binary, fields map<string,string>"


def sha1_base32(payload: Column) -> Column:
    """The bare upper-case base32 SHA-1 of a string's UTF-8 bytes; a null counts as empty."""
    digits = F.sha1(F.coalesce(payload, F.lit("")))
    out = []
    for group in range(8):
        value = F.conv(F.substring(digits, 5 * group + 1, 5), 16, 10).cast("int")
        out += [F.lit(ALPHABET).substr(F.shiftright(value, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def _id(kind: str, page_id: Column, digest: Column) -> Column:
    return F.concat(F.lit("<urn:capture:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(":"), digest, F.lit(f":{kind}>"))


def _record(headers: dict[str, Column | str | None], block: Column) -> Column:
    """A record's text without the last line end, which the text writer adds.  Headers that are null are left out."""
    lines = [F.lit(VERSION)]
    for name, value in headers.items():
        value = F.lit(value) if isinstance(value, str) else value
        lines.append(F.concat(F.lit(f"{name}: "), value))
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws(EOL, *lines), F.lit(EOL * 2), block, F.lit(EOL))


def write(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Writes pages (page_id, url, html) as gzipped WARC files in the folder `path`.

    Of pages with equal payloads (html in UTF-8; null: empty) of at least
    min_bytes, the one with the smallest page_id is a response and the others
    revisit it; a null page_id counts as larger than any.  Pages that repeat a
    page_id and a payload are all of the same type.  White space in a url
    is percent-encoded; a null url has no header.  An empty
    table writes no records.  Extra columns are ignored.

    Only (digest, smallest page_id) is aggregated, with partial sums first, and
    written; the payloads are joined to that table, where Spark can split a
    frequent digest, since no aggregation is tied to the join's partitions.
    """
    rows = pick(pages, page_id="long", url="string", html="string")
    rows = rows.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("digest", sha1_base32(F.col("html")))
    firsts = materialize(rows.groupBy(F.col("digest").alias("of")).agg(F.min("page_id").alias("first_id")), "payloads")
    page = rows.join(firsts.hint("shuffle_hash"), rows.digest == firsts.of)
    revisit = (F.octet_length("html") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    uri = F.col("url")
    for code in (0x09, 0x0A, 0x0D, 0x20):
        uri = F.replace(uri, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    me = _id("response", F.col("page_id"), F.col("digest"))
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "), F.octet_length("html").cast("string"), F.lit(EOL * 2))
    common = {"WARC-Date": DATE, "WARC-Target-URI": uri}
    request = _record({"WARC-Type": "request", "WARC-Record-ID": _id("request", F.col("page_id"), F.col("digest")), **common, "WARC-Concurrent-To": me, "Content-Type": "application/http; msgtype=request"}, F.lit(f"GET / HTTP/1.1{EOL * 2}"))
    answer = {"WARC-Record-ID": me, **common, "WARC-Payload-Digest": digest, "Content-Type": "application/http; msgtype=response"}
    response = _record({"WARC-Type": "response", **answer}, F.concat(http, "html"))
    again = _record({"WARC-Type": "revisit", **answer, "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": _id("response", F.col("first_id"), F.col("digest"))}, http)
    fields = F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(EOL))
    metadata = _record({"WARC-Type": "metadata", "WARC-Record-ID": _id("metadata", F.col("page_id"), F.col("digest")), **common, "WARC-Concurrent-To": me, "Content-Type": "application/warc-fields"}, fields)
    page.select(F.explode(F.array(request, F.when(revisit, again).otherwise(response), metadata)).alias("value")).write.option("lineSep", EOL).option("compression", "gzip").text(path)


class _Inflated(io.RawIOBase):
    """Bytes of a gzip file of one or more members, inflated as they are read."""

    def __init__(self, data: bytes):
        self.data, self.at, self.one, self.held = memoryview(data), 0, zlib.decompressobj(31), b""

    def readable(self) -> bool:
        return True

    def readinto(self, out) -> int:
        while not self.held and self.at < len(self.data):
            part = self.data[self.at : self.at + 65536]
            self.held = self.one.decompress(part)
            self.at += len(part) - len(self.one.unused_data)
            if self.one.eof:
                self.one = zlib.decompressobj(31)
        n = min(len(out), len(self.held))
        out[:n], self.held = self.held[:n], self.held[n:]
        return n


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of every record of a plain or gzipped archive, by content length.

    WARC-Concurrent-To may be repeated: its values stand on lines of their own.
    Raises ValueError where a record is cut short or doesn't begin with a version line.
    """
    stream = io.BufferedReader(_Inflated(data), 1 << 16) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        headers: dict[str, str] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8").partition(":")
            name, value = name.strip().lower(), value.strip()
            headers[name] = f"{headers[name]}\n{value}" if name == REPEATED and name in headers else value
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("a WARC record is cut short")
        yield headers, block


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row per record of the archives under `path`, columns as in RECORD.

    payload is what follows the HTTP headers of a response (null for other types,
    or if not payloads); its digest and size are taken from the bytes, and a
    response whose digest header says otherwise raises ValueError.  fields has
    the lines of a metadata block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, pa.list_(pa.string()) if n == "concurrent_to" else pa.string()) for n in ("record_type", "record_id", "concurrent_to", "refers_to", "target_uri", "payload_digest")] + [("payload_bytes", pa.int64()), ("payload", pa.binary()), ("fields", pa.map_(pa.string(), pa.string()))])
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for headers, block in parse(content.as_py()):
                    kind, digest = headers.get("warc-type"), headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    payload, fields = None, None
                    if kind == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if digest not in (None, found):
                            raise ValueError(f"the payload of {headers.get('warc-record-id')} has the digest {found}, its header says {digest}")
                        digest = found
                    elif kind == "metadata":
                        fields = [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in block.decode("utf-8").splitlines() if x)]
                    rows.append((kind, headers.get("warc-record-id"), headers[REPEATED].split("\n") if REPEATED in headers else None, headers.get("warc-refers-to"), headers.get("warc-target-uri"), digest, None if payload is None else len(payload), payload if payloads else None, fields))
                    held += len(block) if payloads else 200
                    if held > 4_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, RECORD)


def capture_ids(records: DataFrame) -> DataFrame | None:
    """(record_id, capture) of the records that name others or are named, over all their concurrent-to identifiers.

    Records that name each other, in any direction and over any number of steps,
    are of one capture, which has the name of its smallest response or revisit, or
    else of its smallest identifier.  None where every record names one other at
    most, which names none itself, as archives mostly have it: that one names the
    capture, and no components need be sought.
    """
    named = records.where("record_id IS NOT NULL").select("record_id", F.explode("concurrent_to").alias("to")).where("to <> record_id")
    # 64-bit hashes, not identifiers, tell whether components have to be sought.
    pairs = materialize(named.select(F.xxhash64("record_id").alias("a"), F.xxhash64("to").alias("b")).distinct(), "concurrent")
    several = pairs.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a")
    onward = pairs.join(pairs.select(F.col("a").alias("of")), F.col("b") == F.col("of"), "left_semi").select("a")
    if not several.unionAll(onward).limit(1).count():
        return None
    links = materialize(named.distinct(), "links")
    found = materialize(components(links.select(F.col("record_id").alias("a"), F.col("to").alias("b"))), "linked")
    every = found.unionAll(found.select(F.col("root").alias("node"), "root").distinct())
    answers = records.where("record_type IN ('response', 'revisit')").select(F.col("record_id").alias("answer"))
    captures = every.join(answers, every.node == answers.answer, "left").groupBy(F.col("root").alias("of")).agg(F.coalesce(F.min("answer"), F.first("root")).alias("capture"))
    captures = materialize(captures, "named")
    return every.join(captures, every.root == captures.of).select(F.col("node").alias("of"), "capture")


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: capture_id, the structs request, response, revisit, metadata, each null if it is missing, and records.

    Records are joined through all their concurrent-to identifiers (capture_ids).
    records: every record of the capture without its payload, sorted by type and
    identifier; where a type is there several times, its struct is the largest.
    The capture comes back as often as its response or revisit is there, once at
    least.  A record without an identifier goes with the first that it names, and
    is left out if it names none.
    """
    told = ["record_id", "target_uri", "refers_to", "payload_digest", "payload_bytes"]
    fields = F.map_entries("fields").alias("fields")
    body = F.struct(*told, "payload", fields)
    named = F.get("concurrent_to", F.lit(0))
    ids = capture_ids(records)
    if ids is None:
        records = records.withColumn("capture_id", F.coalesce(named, "record_id"))
    else:
        records = records.join(ids, F.coalesce("record_id", named) == F.col("of"), "left").withColumn("capture_id", F.coalesce("capture", "record_id", named))
    kinds = ("request", "response", "revisit", "metadata")
    grouped = records.where("capture_id IS NOT NULL").groupBy("capture_id").agg(
        *[F.max(F.when(F.col("record_type") == k, body)).alias(k) for k in kinds],
        F.array_sort(F.collect_list(F.struct("record_type", *told, fields))).alias("records"),
        F.count_if(F.col("record_type").isin("response", "revisit")).alias("n"),
    )
    return grouped.withColumn("n", F.explode(F.sequence(F.lit(1), F.greatest(F.col("n"), F.lit(1)).cast("int")))).drop("n")


def transactions(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to and payload of every capture of the archives under `path`.

    Sizes and page ids of a revisit come from the response that it refers to;
    its payload is null, as that response's row has it.
    """
    rows = assemble(read(spark, path)).select(
        F.get(F.filter("metadata.fields", lambda x: x["key"] == "page-id"), 0)["value"].alias("page"),
        F.coalesce("response", "revisit").alias("answer"),
        F.when(F.col("response").isNotNull(), "response").otherwise("revisit").alias("record_type"),
    )
    rows = rows.select(F.expr("try_cast(page AS BIGINT)").alias("page_id"), "record_type", F.col("answer.record_id").alias("id"), F.col("answer.payload_digest").alias("payload_digest"), F.col("answer.payload_bytes").alias("own_bytes"), F.col("answer.refers_to").alias("to"), F.col("answer.payload").alias("payload"))
    rows = materialize(rows, "captures")
    original = rows.where("record_type = 'response'").select(F.col("id").alias("original"), F.col("page_id").alias("original_page"), F.col("own_bytes").alias("original_bytes"))
    original = materialize(original.groupBy("original").agg(F.min("original_page").alias("original_page"), F.min("original_bytes").alias("original_bytes")), "originals")
    return rows.join(original, F.col("to") == F.col("original"), "left").select("page_id", F.coalesce("own_bytes", "original_bytes").alias("payload_bytes"), "payload_digest", "record_type", F.col("original_page").alias("refers_to"), "payload")


def captures(spark: SparkSession, path: str) -> DataFrame:
    """The transactions under `path` without their payloads."""
    return transactions(spark, path).drop("payload")
