"""Substring dedup on a compacted de Bruijn graph of words.

Nodes are sequences of 12 words, edges are windows of 13.  The graph is never
written edge by edge: consecutive edges of a document that share their smallest
4-word hash, the minimizer, make one path, as in minimizer-based compaction, so
equal windows always lie in paths of the same minimizer and at the same place
of it.  A path record has the minimizer, a hash of all its words, and its source
coordinates (document, first word, number of edges).

Records meet by minimizer in a Spark aggregation with partial sums and a join:

- one document only: nothing repeats, the record goes;
- equal records: each repeats the whole path of the smallest document that has
  it, and all its words from the coordinates on are covered;
- different records (paths branch there): of each, that of the smallest document
  is taken apart into its edges, which meet by 128-bit hash, again in an
  aggregation and a join.

Spans so found come back to their documents by their coordinates.

Words are hashed by two independent families that are not linear in the bytes.
Paths are equal if their minimizers (first family) and all their words (second
family) are, edges if both families say so of all 13 words: 128 bits each, which
takes the place of comparing the words once more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveworks.llm.common import materialize, pick
from sieveworks.llm.words import SpanHash, Texts, byte_hashes, chunks

WINDOW = 13
MINIMIZER = 4
LAST = 1 << 63  # where a null doc_id stands in the order: beyond any other
U = np.uint64


class Paths:
    """Windows and minimizers of the texts of a chunk."""

    def __init__(self, window: int):
        self.window = window
        self.short = min(MINIMIZER, window)
        self.words = [SpanHash(seed) for seed in (15, 16, 17)]

    def hashes(self, texts: Texts):
        """Two hashes of every word, the words' texts, the first word of each text, and every window's first word."""
        starts, ends, owner = texts.words()
        values = [byte_hashes(texts.data, starts, ends, seed) for seed in (11, 12)]
        first = np.searchsorted(owner, np.arange(len(texts)))
        at = np.arange(max(len(starts) - self.window + 1, 0))
        return values, owner, first, at[owner[at] == owner[at + self.window - 1]]

    def minimizers(self, values: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each window: its smallest MINIMIZER-word hash and the word that begins it, the first of equals."""
        at = np.arange(max(len(values) - self.short + 1, 0))
        hashed = self.words[0](values, at, at + self.short)
        best, place = hashed[windows], windows.copy()
        for step in range(1, self.window - self.short + 1):
            other = hashed[windows + step]
            less = other < best
            best = np.where(less, other, best)
            place = np.where(less, windows + step, place)
        return best, place

    def records(self, texts: Texts):
        """By path: text, minimizer, hash, first word, minimizer's distance, edges but one."""
        (one, two), owner, first, windows = self.hashes(texts)
        best, place = self.minimizers(one, windows)
        new = np.ones(len(windows), bool)
        new[1:] = (place[1:] != place[:-1]) | (windows[1:] != windows[:-1] + 1) | (owner[windows[1:]] != owner[windows[:-1]])
        a = np.flatnonzero(new)
        b = np.concatenate([a[1:], [len(windows)]]) - 1 if len(a) else a
        start, more, distance = windows[a], b - a, place[a] - windows[a]
        whole = self.words[1](two, start, start + more + self.window) * U(31) + (distance * 64 + more).astype(U)
        text = owner[start]
        return text, best[a], whole, start - first[text], distance, more

    def edges(self, texts: Texts):
        """Two hashes of every window, its text and its first word there."""
        (one, two), owner, first, windows = self.hashes(texts)
        text = owner[windows]
        return self.words[1](one, windows, windows + self.window), self.words[2](two, windows, windows + self.window), text, windows - first[text]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(U).view(np.int64))


def repeated_spans(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """(key, whole, parts) of documents that have spans to remove, from rows (key, doc, text).

    whole: arrays of first word << 8 | edges but one, all of whose words repeat.
    parts: first words of single windows that repeat.  Both may be null.
    """
    if not 1 <= window - MINIMIZER < 64:
        raise ValueError("windows have 5 to 67 words")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths = Paths(window)
        for batch in batches:
            for first, texts in chunks(batch.column(2)):
                text, minimizer, whole, start, _, more = paths.records(texts)
                at = pa.array(text + first)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), _signed(minimizer), _signed(whole), pa.array(start << 8 | more)], ["key", "doc", "m", "x", "at"])

    kind = documents.schema["doc"].dataType.simpleString()
    found = documents.select("key", "doc", "text").mapInArrow(records, f"key long, doc {kind}, m long, x long, at long")
    shared = found.groupBy(F.col("m").alias("of")).agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.min("x").alias("xl"), F.max("x").alias("xh")).where("low < high").select("of", "low", (F.col("xl") == F.col("xh")).alias("plain"))
    # Tables to join with are written, so that no aggregation is tied to the join's partitions and Spark can split a frequent minimizer.
    shared = materialize(shared, "shared").hint("shuffle_hash")
    met = materialize(found.join(shared, F.col("m") == F.col("of")).where("NOT plain OR doc > low").select("key", "doc", "m", "x", "at", "plain"), "met")
    # Where paths branch, equal ones repeat that of the smallest document; only that one is taken apart.
    branching = met.where("NOT plain")
    lows = materialize(branching.groupBy(F.col("m").alias("of"), F.col("x").alias("ox")).agg(F.min("doc").alias("low")), "lows").hint("shuffle_hash")
    decided = branching.join(lows, (F.col("m") == F.col("of")) & (F.col("x") == F.col("ox"))).select("key", "at", (F.col("doc") > F.col("low")).alias("repeats"))
    decided = decided.unionAll(met.where("plain").select("key", "at", F.lit(True)))
    # A document's own records: no more than its words.
    owned = materialize(decided.groupBy("key").agg(F.collect_list(F.when(F.col("repeats"), F.col("at"))).alias("whole"), F.collect_list(F.when(~F.col("repeats"), F.col("at"))).alias("branch")), "paths")

    def taken_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths = Paths(window)
        for batch in batches:
            branch = batch.column(3)
            for first, texts in chunks(batch.column(2)):
                one, two, text, start = paths.edges(texts)
                begin = np.searchsorted(text, np.arange(len(texts) + 1))
                wanted = np.zeros(len(text), bool)
                for i in range(len(texts)):
                    at = np.array(branch[first + i].values.to_numpy(zero_copy_only=False), np.int64)
                    size = begin[i + 1] - begin[i]
                    edge = np.bincount(at >> 8, minlength=size + 1) - np.bincount((at >> 8) + (at & 255) + 1, minlength=size + 1)
                    wanted[begin[i] : begin[i + 1]] = np.cumsum(edge)[:size] > 0
                keep = np.flatnonzero(wanted)
                at = pa.array(text[keep] + first)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), _signed(one[keep]), _signed(two[keep]), pa.array(start[keep])], ["key", "doc", "e1", "e2", "at"])

    branching = owned.where("size(branch) > 0").select(F.col("key").alias("k"), "branch").hint("shuffle_hash")
    apart = documents.join(branching, F.col("key") == F.col("k")).select("key", "doc", "text", "branch").mapInArrow(taken_apart, f"key long, doc {kind}, e1 long, e2 long, at long")
    apart = materialize(apart, "edges")
    edges = apart.groupBy(F.col("e1").alias("f1"), F.col("e2").alias("f2")).agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("f1", "f2", "low")
    edges = materialize(edges, "repeated-edges").hint("shuffle_hash")
    parts = apart.join(edges, (F.col("e1") == F.col("f1")) & (F.col("e2") == F.col("f2"))).where("doc > low").groupBy(F.col("key").alias("k")).agg(F.collect_list("at").alias("parts"))
    return owned.where("size(whole) > 0").select("key", "whole").join(parts, F.col("key") == F.col("k"), "full_outer").select(F.coalesce("key", "k").alias("key"), "whole", "parts")


def keyed(documents: DataFrame) -> DataFrame:
    """(key, doc_id, doc, text): key names the row, doc orders documents, with a null doc_id beyond any other.

    Where doc_ids are unique and none is null they are both.  Else rows are
    written and numbered there, and null is the number after the largest doc_id;
    if that number is beyond a long, doc is a decimal.
    """
    rows = pick(documents, doc_id="long", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    n, ids, most = rows.agg(F.count("*"), F.count("doc_id"), F.max("doc_id")).first()
    if n == ids and not rows.groupBy("doc_id").count().where("count > 1").limit(1).count():
        return rows.select(F.col("doc_id").alias("key"), "doc_id", F.col("doc_id").alias("doc"), "text")
    rows = materialize(rows.withColumn("key", F.monotonically_increasing_id()), "numbered")
    doc = F.coalesce("doc_id", F.lit((most or 0) + 1)) if (most or 0) + 1 < LAST else F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit(str(LAST)).cast("decimal(20,0)"))
    return rows.select("key", "doc_id", doc.alias("doc"), "text")


RESULT = "doc_id long, n_words long, n_removed long, kept string"


def remove_repeats(documents: DataFrame, window: int = WINDOW, digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept of every row of documents (doc_id, text).

    Every word is removed that is covered by a window of `window` consecutive
    words whose sequence also starts in a document with a smaller doc_id, judged
    on the texts as they come in.  kept: the other words, joined by one space;
    with digest their lower-case hexadecimal SHA-256 instead.

    A null or empty text has no words and an empty rest.  A null doc_id counts
    as larger than any.  Rows that repeat a doc_id come back each and remove
    nothing from each other.  Texts shorter than a window keep all words.  An
    empty table gives no rows; texts are read whole; extra columns are ignored.
    """
    rows = keyed(documents)
    spans = repeated_spans(rows, window).select(F.col("key").alias("k"), "whole", "parts").hint("shuffle_hash")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list = [[], [], []]
            whole, parts = batch.column(2), batch.column(3)
            for i, text in enumerate(batch.column(1).cast(pa.binary())):
                words = text.as_py().split()
                n = len(words)
                edge = np.zeros(n + 1, np.int64)
                if whole[i].is_valid:
                    at = np.asarray(whole[i].values, np.int64)
                    edge += np.bincount(at >> 8, minlength=n + 1) - np.bincount((at >> 8) + (at & 255) + window, minlength=n + 1)
                if parts[i].is_valid:
                    at = np.asarray(parts[i].values, np.int64)
                    edge += np.bincount(at, minlength=n + 1) - np.bincount(at + window, minlength=n + 1)
                gone = np.cumsum(edge)[:n] > 0
                removed = int(gone.sum())
                if removed:
                    words = [words[j] for j in np.flatnonzero(~gone).tolist()]
                kept = b" ".join(words)
                for column, v in zip(out, (n, removed, hashlib.sha256(kept).hexdigest() if digest else kept.decode())):
                    column.append(v)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    return rows.join(spans, F.col("key") == F.col("k"), "left").select("doc_id", "text", "whole", "parts").mapInArrow(remove, RESULT)
