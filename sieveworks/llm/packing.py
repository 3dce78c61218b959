"""Bounded-space online packing of tokenised documents into training windows.

Each partition keeps a fixed number of open windows.  A piece goes into the
open window that it fills best; if it fits none, a new window opens while there
is space for one, and otherwise the fullest is topped up with the head of the
piece and emitted.  What stays open at the end of a partition is merged: into
full windows there, and the rest (less than one window a partition) with the
rests of other partitions, GROUP at a time, until one rest is left.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveworks.llm.common import materialize, pick

WINDOW = 4096
OPEN_WINDOWS = 16
END_ID = 2
GROUP = 256  # rests that one task merges
CACHED = 400_000  # chunks of text whose ids a task remembers

PIECES = "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
RESTS = "unit long, doc_id array<long>, start array<long>, length array<long>, doc_tokens array<long>, ids binary"

# The normaliser and the splitting pattern that the quick path below reproduces.
KNOWN_NORMALIZER = ["NFC", "Replace", "Lowercase"]
KNOWN_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Encoder:
    """Token ids of a text as little-endian unsigned 32-bit bytes, equal to those of the tokenizer file.

    For tokenizers that split at white space, ids of white-space-free chunks
    are remembered.  Texts with anything but plain ASCII and Latin-1 text, and
    texts that may hold special tokens, take the tokenizer's own whole path.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        norm, pre = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
        parts = pre.get("pretokenizers", [])
        self.quick = (
            [x.get("type") for x in norm.get("normalizers", [])] == KNOWN_NORMALIZER
            and [x.get("type") for x in parts] == ["Split", "ByteLevel"]
            and parts[0]["pattern"].get("Regex") == KNOWN_SPLIT
            and not spec.get("post_processor")
        )
        self.model = self.whole.model
        self.bytelevel = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters, digits = "a-zªµºß-öø-ÿ", "0-9²³¹¼-¾"
        self.split = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^{letters}{digits}]+").findall
        self.odd = re.compile(r"[^\t\n\r\x20-\x7e\xa1-\xff]").search
        self.marks = [x["content"] for x in spec.get("added_tokens", [])]
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def word(self, w: str) -> bytes:
        got = self.words.get(w)
        if got is None:
            mapped = w if w.isascii() else self.bytelevel.pre_tokenize_str(w)[0][0]
            got = np.array([t.id for t in self.model.tokenize(mapped)], "<u4").tobytes()
            if len(self.words) >= CACHED:
                self.words.clear()
            self.words[w] = got
        return got

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.quick or any(m in text for m in self.marks):
            return self.slow(text)
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        if self.odd(text):
            return self.slow(text)
        seen, found = self.chunks, text.lower().split()
        try:
            return b"".join([seen[c] for c in found])
        except KeyError:
            pass
        if len(seen) >= CACHED:
            seen.clear()
        for c in found:
            if c not in seen:
                seen[c] = b"".join([self.word(w) for w in self.split(c)])
        return b"".join([seen[c] for c in found])

    def slow(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


class Packer:
    """Open windows of one unit of work.  A window is [fill, [(doc_id, start, doc_tokens, ids), ...]]."""

    def __init__(self, size: int, most: int):
        self.size, self.most, self.open, self.done = size, most, [], []

    def add(self, doc_id, doc_tokens: int, ids: bytes, start: int = 0) -> None:
        """Places the ids that start at token `start` of a document; full windows go to self.done."""
        at, end = 0, len(ids) // 4
        while end - at >= self.size:
            self.done.append([self.size, [(doc_id, start + at, doc_tokens, ids[4 * at : 4 * (at + self.size)])]])
            at += self.size
        while at < end:
            need = end - at
            fits = [w for w in self.open if self.size - w[0] >= need]
            if fits:
                window = max(fits, key=lambda w: w[0])
            elif len(self.open) < self.most:
                self.open.append(window := [0, []])
            else:
                window = max(self.open, key=lambda w: w[0])
            take = min(need, self.size - window[0])
            window[1].append((doc_id, start + at, doc_tokens, ids[4 * at : 4 * (at + take)]))
            window[0] += take
            at += take
            if window[0] == self.size:
                self.open.remove(window)
                self.done.append(window)

    def merge(self) -> list | None:
        """Merges the open windows, fullest first, into full ones in self.done; returns the rest, or None."""
        left, self.open = sorted(self.open, key=lambda w: -w[0]), []
        rest = [0, []]
        for window in left:
            for doc_id, start, doc_tokens, ids in window[1]:
                at, end = 0, len(ids) // 4
                while at < end:
                    take = min(end - at, self.size - rest[0])
                    rest[1].append((doc_id, start + at, doc_tokens, ids[4 * at : 4 * (at + take)]))
                    rest[0] += take
                    at += take
                    if rest[0] == self.size:
                        self.done.append(rest)
                        rest = [0, []]
        return rest if rest[0] else None


def powers(rest: list) -> list[list]:
    """The last rest cut at the powers of two of its length, which need no padding."""
    out, todo = [], [list(x) for x in rest[1]]
    for bit in range(rest[0].bit_length() - 1, -1, -1):
        want = rest[0] & 1 << bit
        window = [want, []]
        while want:
            doc_id, start, doc_tokens, ids = todo[0]
            take = min(want, len(ids) // 4)
            window[1].append((doc_id, start, doc_tokens, ids[: 4 * take]))
            todo[0] = [doc_id, start + take, doc_tokens, ids[4 * take :]]
            want -= take
            if not todo[0][3]:
                todo.pop(0)
        if window[1]:
            out.append(window)
    return out


def _rows(windows: list, first: int, keep_ids: bool) -> dict[str, list]:
    out: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset")}
    for n, (_, pieces) in enumerate(windows):
        offset = 0
        for doc_id, start, doc_tokens, ids in pieces:
            values = (doc_id, start, len(ids) // 4, ids if keep_ids else None, zlib.crc32(ids), doc_tokens, first + n, offset)
            for column, v in zip(out.values(), values):
                column.append(v)
            offset += len(ids) // 4
    return out


PIECES_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
REST_FIELDS = [("unit", pa.int64()), ("rest_doc_id", pa.list_(pa.int64())), ("rest_start", pa.list_(pa.int64())), ("rest_length", pa.list_(pa.int64())), ("rest_doc_tokens", pa.list_(pa.int64())), ("rest_ids", pa.binary())]
MIXED_ARROW = pa.schema([*PIECES_ARROW, *REST_FIELDS])
MIXED = PIECES + ", unit long, rest_doc_id array<long>, rest_start array<long>, rest_length array<long>, rest_doc_tokens array<long>, rest_ids binary"


def _mixed(windows: list, first: int, keep_ids: bool, unit: int | None, rest: list | None) -> pa.RecordBatch:
    """Rows of pieces, and one row with the rest if there is one."""
    columns = _rows(windows, first, keep_ids)
    n = len(columns["doc_id"])
    for name, _ in REST_FIELDS:
        columns[name] = [None] * n
    if rest:
        for name in PIECES_ARROW.names:
            columns[name].append(None)
        for (name, _), v in zip(REST_FIELDS, (unit, [x[0] for x in rest[1]], [x[1] for x in rest[1]], [len(x[3]) // 4 for x in rest[1]], [x[2] for x in rest[1]], b"".join(x[3] for x in rest[1]))):
            columns[name].append(v)
    return pa.RecordBatch.from_pydict(columns, schema=MIXED_ARROW)


def pack(documents: DataFrame, tokenizer_path: str, window: int = WINDOW, open_windows: int = OPEN_WINDOWS, end_id: int = END_ID, keep_ids: bool = True) -> DataFrame:
    """Pieces of tokenised documents, placed in windows of `window` tokens.

    documents: doc_id, text.  Returns a row per piece: doc_id, start (token of
    the document), length, ids (little-endian unsigned 32-bit; null if not
    keep_ids), ids_crc32, doc_tokens (with the end id), sequence_id, offset.

    Every window is full but those of the very last rest, whose lengths are
    powers of two.  A null or empty text is the end id alone; a null doc_id
    stays null; repeated rows are packed each; an empty table gives no rows;
    texts of any length are cut at window ends; extra columns are ignored.
    """

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = Encoder(tokenizer_path), Packer(window, open_windows)
        end, unit, n = np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId(), 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "") + end
                packer.add(doc_id, len(ids) // 4, ids)
                if len(packer.done) >= 500:
                    yield _mixed(packer.done, (unit << 32) + n, keep_ids, None, None)
                    n += len(packer.done)
                    packer.done = []
        rest = packer.merge()
        yield _mixed(packer.done, (unit << 32) + n, keep_ids, unit, rest)

    mixed = materialize(pick(documents, doc_id="long", text="string").mapInArrow(first_pass, MIXED), "packed")
    out = [mixed.where("unit IS NULL").select(*PIECES_ARROW.names)]
    rests, level = mixed.where("unit IS NOT NULL").select(*[n for n, _ in REST_FIELDS]), 0
    units = rests.agg(F.count("*"), F.max("unit")).first()
    count = units[1] + 1 if units[0] else 0
    while count:
        level, last = level + 1, count <= GROUP

        def merge_pass(batches: Iterator[pa.RecordBatch], level=level, last=last) -> Iterator[pa.RecordBatch]:
            groups: dict[int, list] = {}
            for batch in batches:
                for row in batch.to_pylist():
                    groups.setdefault(row["unit"] // GROUP, []).append(row)
            for unit, rows in sorted(groups.items()):
                packer = Packer(window, open_windows)
                for row in sorted(rows, key=lambda r: r["unit"]):
                    at, pieces = 0, []
                    for doc_id, start, length, doc_tokens in zip(row["rest_doc_id"], row["rest_start"], row["rest_length"], row["rest_doc_tokens"]):
                        pieces.append((doc_id, start, doc_tokens, row["rest_ids"][4 * at : 4 * (at + length)]))
                        at += length
                    packer.open.append([at, pieces])
                rest = packer.merge()
                if last and rest:
                    packer.done += powers(rest)
                    rest = None
                yield _mixed(packer.done, (1 << 62) + (level << 56) + (unit << 24), keep_ids, unit, rest)

        tasks = -(-count // GROUP)
        merged = materialize(rests.repartition(tasks, F.expr(f"unit div {GROUP}")).mapInArrow(merge_pass, MIXED), "packed-rests")
        out.append(merged.where("unit IS NULL").select(*PIECES_ARROW.names))
        rests = merged.where("unit IS NOT NULL").select(*[n for n, _ in REST_FIELDS])
        count = 0 if last else tasks
    done = out[0]
    for x in out[1:]:
        done = done.unionAll(x)
    return done
