"""Near duplicates by SimHash, with candidate keys from the binary Golay code.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits, each
padded to 23.  The perfect Golay code has one codeword within 3 bits of any
23-bit word; the codewords within 4 bits are one or six.  Two words that differ
in at most 2 bits share one of them: the codeword nearest to a word between
the two is within 4 of both.

Of two fingerprints that differ in at most 4 bits, either some segment is equal
and another differs in at most 2 bits (key: that segment, and a codeword index
of the other), or all three differ, two of them in exactly one bit, so that
each of the two has an equal half, and the third in at most 2 (key: the two
halves, and a codeword index of the third).  So keys lose no link.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveworks.llm.common import materialize, pick, scratch
from sieveworks.llm.words import mixed

GENERATOR = 0b101011100011  # of the (23, 12) Golay code
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and width
MAX_DISTANCE = 4
HOT = 1 << 14  # fingerprints of a key, beyond which the key is split


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator polynomial."""
    out = words.astype(np.int64)
    for bit in range(22, 10, -1):
        out ^= np.where(out >> bit & 1, GENERATOR << bit - 11, 0)
    return out


def error_patterns() -> np.ndarray:
    """Patterns of at most 4 errors by syndrome: 2048 rows of 6, filled up with the first."""
    found: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(5):
        patterns = np.array([sum(1 << b for b in c) for c in combinations(range(23), weight)])
        for s, p in zip(syndromes(patterns).tolist(), patterns.tolist()):
            found[s].append(p)
    return np.array([(x + [x[0]] * 6)[:6] for x in found])


def keys_of(fingerprints: np.ndarray, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidate keys (int64) of unsigned 64-bit fingerprints, and the row that each belongs to; repeats are gone."""
    fp = fingerprints.astype(np.uint64)
    rows = np.arange(len(fp))
    segment = [(fp >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    near = [((s[:, None] ^ patterns[syndromes(s)]) >> 11) for s in segment]  # indices: a codeword's upper 12 bits
    fresh = [np.concatenate([np.ones((len(fp), 1), bool), n[:, 1:] != n[:, :1]], axis=1) for n in near]
    halves = [(s & 0x7FF, s >> 11) for s in segment]
    keys, owners, tag = [], [], 0
    for third in range(3):
        i, j = (x for x in range(3) if x != third)
        exact = [segment[i], segment[j]] + [a << 11 | b for a in halves[i] for b in halves[j]]
        for part in exact:
            key = tag << 34 | part[:, None] << 12 | near[third]
            keys.append(key[fresh[third]])
            owners.append(np.broadcast_to(rows[:, None], key.shape)[fresh[third]])
            tag += 1
    return np.concatenate(keys), np.concatenate(owners)


def fingerprint(text: bytes, words: int = 4, seed: int = 42) -> int:
    """SimHash of a UTF-8 text: a bit is 1 if set in over half of its shingles' XXH64."""
    import xxhash

    found = text.lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    n, hash64 = max(1, len(found) - words + 1), xxhash.xxh64_intdigest
    if n == 1:
        hashes = [hash64(joined, seed)]
    else:
        starts = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
        hashes = [hash64(joined[a:b], seed) for a, b in zip(starts, ends[words - 1 :].tolist())]
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], "<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(t.as_py() or b"") for t in batch.column(1).cast(pa.binary())], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])


def annotate(rows: DataFrame) -> DataFrame:
    """All rows and columns, with the fingerprint of the column text added as fp (long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py() or b"") for t in batch.column("text").cast(pa.binary())], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.view(np.int64))], [*batch.schema.names, "fp"])

    return rows.mapInArrow(run, T.StructType([*rows.schema, T.StructField("fp", T.LongType())]))


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    patterns = error_patterns()
    for batch in batches:
        fps = batch.column(0).to_numpy()
        for at in range(0, len(fps), 4096):
            part = fps[at : at + 4096]
            keys, rows = keys_of(part.view(np.uint64), patterns)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[rows])], ["key", "fp"])


def linked(fps: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Of one bucket: each fingerprint that is not the smallest of its component, and that smallest.

    Grows a component from a seed: what is near goes from the unseen into the
    component, so dense groups cost about their size, not its square.
    """
    unseen, members, roots = np.sort(fps), [], []
    while len(unseen) > 1:
        group, todo, unseen = [unseen[0]], [unseen[0]], unseen[1:]
        while todo and len(unseen):
            near = np.bitwise_count(unseen ^ todo.pop()) <= most
            if near.any():
                found = unseen[near]
                group.extend(found)
                todo.extend(found)
                unseen = unseen[~near]
        members.extend(group[1:])
        roots.extend([group[0]] * (len(group) - 1))
    return np.array(members, np.uint64), np.array(roots, np.uint64)


def _finer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, fp, varying) to rows (key, fp) with finer keys: the bits that vary among a key's fingerprints are cut
    into MAX_DISTANCE + 1 parts, of which fingerprints within MAX_DISTANCE bits have one in common."""
    for batch in batches:
        keys, fps, varying = (batch.column(i).to_numpy().view(np.uint64) for i in range(3))
        for mask in np.unique(varying):
            bits = [b for b in range(64) if int(mask) >> b & 1]
            here = varying == mask
            for n in range(MAX_DISTANCE + 1):
                part = np.uint64(sum(1 << b for b in bits[n :: MAX_DISTANCE + 1]))
                key = mixed(mixed(keys[here] + np.uint64(n + 1)) ^ (fps[here] & part))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(fps[here].view(np.int64))], ["key", "fp"])


def split_keys(keys: DataFrame, rounds: int = 3) -> DataFrame:
    """keys (key, fp), those of more than HOT fingerprints split, and again where that isn't enough; no link is lost.

    Keys are counted with partial sums; the hot ones are written, and Spark
    broadcasts them if they are few, or splits the join where one is frequent.
    """
    done = None
    for _ in range(rounds):
        counted = keys.groupBy(F.col("key").alias("hot")).agg(F.count("*").alias("n"), F.bit_and("fp").alias("all"), F.bit_or("fp").alias("any"))
        hot = materialize(counted.where(F.col("n") > HOT).select("hot", F.col("all").bitwiseXOR(F.col("any")).alias("varying")), "hot-keys")
        if not hot.limit(1).count():
            break
        cool = keys.join(hot, keys.key == hot.hot, "left_anti")
        done = cool if done is None else done.unionAll(cool)
        keys = keys.join(hot, keys.key == hot.hot).select("key", "fp", "varying").mapInArrow(_finer, "key long, fp long")
    return keys if done is None else done.unionAll(keys)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key.  Buckets of two are compared at once, larger ones by growing components."""

    def of(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        cut = np.flatnonzero(np.diff(keys)) + 1
        starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(keys)]])
        sizes = ends - starts
        at = starts[sizes == 2]
        a, b = fps[at], fps[at + 1]
        near = np.bitwise_count(a ^ b) <= MAX_DISTANCE
        high, low = [np.maximum(a, b)[near]], [np.minimum(a, b)[near]]
        for s, e in zip(starts[sizes > 2].tolist(), ends[sizes > 2].tolist()):
            members, roots = linked(fps[s:e], MAX_DISTANCE)
            high.append(members)
            low.append(roots)
        pairs = np.unique(np.stack([np.concatenate(high), np.concatenate(low)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in np.ascontiguousarray(pairs)], ["a", "b"])

    kept_keys, kept_fps = [], []
    for batch in batches:
        keys, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
        if len(keys) and kept_keys and kept_keys[0][0] != keys[-1]:
            last = int(np.searchsorted(keys == keys[-1], True))
            kept_keys.append(keys[:last])
            kept_fps.append(fps[:last])
            yield of(np.concatenate(kept_keys), np.concatenate(kept_fps))
            kept_keys, kept_fps, keys, fps = [], [], keys[last:], fps[last:]
        if len(keys):
            kept_keys.append(keys)
            kept_fps.append(fps)
    if kept_keys:
        yield of(np.concatenate(kept_keys), np.concatenate(kept_fps))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of edges (a, b): root is the smallest node reachable.

    Alternates large-star and small-star steps (Kiveris et al. 2014), each a
    partial aggregation and a join, until the edges stay as they are.
    """
    scratch(edges.sparkSession)
    edges = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().checkpoint()
    told = None
    while True:
        around = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = around.join(least, around.a == least.n).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        center = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
        small = large.join(center, large.a == center.n).select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").where("a != b").distinct()
        edges = small.checkpoint()
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == told:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        told = now


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, fp (long with the fingerprint's bits), component_id, root of every row of documents (doc_id, text).

    Fingerprints link at MAX_DISTANCE or fewer differing bits; component_id is
    the smallest doc_id reachable over links, root a fingerprint that names the
    component also where doc_ids repeat.  Work on links is done once for
    each distinct fingerprint, so copies cost one row each.

    A null, empty or wordless text has the fingerprint zero and links as any
    other.  Repeated rows come back each; a null doc_id stays null and never
    names a component unless all its doc_ids are null.  An empty table gives no
    rows; texts of any length are read whole; extra columns are ignored.
    """
    spark = documents.sparkSession
    docs = materialize(pick(documents, doc_id="long", text="string").mapInArrow(_fingerprints, "doc_id long, fp long"), "fingerprints")
    distinct = materialize(docs.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    keys = split_keys(distinct.select("fp").mapInArrow(_keys, "key long, fp long"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    links = keys.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_links, "a long, b long")
    roots = components(links)
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    # Written, so that the aggregation isn't tied to the join's partitions and Spark can split a giant component.
    rooted = materialize(rooted, "rooted")
    smallest = materialize(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "components")
    named = rooted.join(smallest, "root").select(F.col("fp").alias("of"), "component_id", "root")
    return docs.join(named, docs.fp == named.of).select("doc_id", "fp", "component_id", "root")
