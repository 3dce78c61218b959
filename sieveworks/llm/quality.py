"""Quality rules: base statistics of words, and word N-gram perplexity within bands of the language.

The model is an interpolated modified Kneser-Ney model of word bigrams.  Words
are hashed, with the language, to 2**20 symbols, so that a bigram's hash is 40
bits and tells its two symbols.  Spark counts all bigrams of all whole texts:
tasks send sorted arrays of hashes, packed by differences, to parts of the hash
range, and nothing but a part is ever in one place.  What goes to all tasks are
three numbers a symbol (how often it stands as a context, its weight of backing
off, its lower-order probability): 12 MB, whatever the corpus and the number of
languages; the bigrams grow with it.

A document is scored where its bigrams are counted, by the same sorted arrays,
with its own occurrences taken out of the counts, since a text that only it has
must not look likely.  Its sum comes back as one number a part.  A document's
perplexity has to lie in its language's band.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from sieveworks.llm.common import materialize, pick
from sieveworks.llm.words import SPACES, SpanHash, Texts, byte_hashes, byte_table, chunks, mapped, mixed, sums

SYMBOL_BITS = 20
SYMBOLS_OF_MODEL, ALL_KEYS = 1 << SYMBOL_BITS, 1 << 2 * SYMBOL_BITS
SPREAD = 0x9E3779B97F | 1  # odd, so that it can be undone modulo ALL_KEYS
UNIT_WORDS, UNIT_DOCS = 1 << 21, 50_000  # of which a task sends the bigrams at once, about
PART_WORDS = 1 << 21  # of a part of the hash range, about
MOST_TASKS = 4096  # that count; each has some parts
SLICES = 64  # of the symbols, as which their numbers are summed up
REPEAT_WINDOW = 8
MIN_WORDS, MAX_REPEATED = 20, 30  # per cent
REACH = 3.0  # interquartile ranges that a band reaches beyond the quartiles
LEAST = 0.005  # of a language's documents that the lower limit leaves below it at most
SHORT = 6.0  # nats by the square root of the number of words, which a band is wider by
BIN = 0.005  # nats; the quartiles are taken of so rounded values
SYMBOLS = byte_table(b"#*$%&|<>")
LETTERS = np.array([not SPACES[b] and b & 0xC0 != 0x80 for b in range(256)])  # first bytes of what words are made of
FOLDED = np.frombuffer(bytes(range(256)).lower(), np.uint8)
U = np.uint64


def packed(keys: np.ndarray, docs: np.ndarray, times: np.ndarray) -> bytes:
    """Sorted keys, their documents' numbers and counts, byte by byte of all differences, compressed."""
    import zstandard

    steps = np.diff(keys, prepend=U(0)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
    columns = (steps, docs.astype("<u2").view(np.uint8).reshape(-1, 2), times.astype("<u4").view(np.uint8).reshape(-1, 4))
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(c.T).tobytes() for c in columns))


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(11, -1)
    wide = np.zeros((raw.shape[1], 8), np.uint8)
    wide[:, :5] = raw[:5].T
    docs, times = (np.ascontiguousarray(raw[a:b].T).view(kind).ravel() for a, b, kind in ((5, 7, "<u2"), (7, 11, "<u4")))
    return np.cumsum(wide.view("<u8").ravel(), dtype=U), docs.astype(np.int64), times.astype(np.int64)


def language_salt(lang: str | None) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(b"\xff" if lang is None else lang.encode(), 4)


def bigrams(texts: Texts, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray, salts: np.ndarray) -> np.ndarray:
    """The hash of the bigram that ends at each word, A-Z lower-cased; before a text's first word stands its language's beginning."""
    symbol = lambda x: mixed(x) >> U(64 - SYMBOL_BITS)
    words = symbol(byte_hashes(mapped(texts.data, FOLDED), starts, ends, 5) ^ salts[owner])
    before = np.concatenate([np.zeros(min(len(words), 1), U), words[:-1]])
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    before[first] = symbol(salts + U(1))[owner[first]]
    return ((before << U(SYMBOL_BITS) | words) * U(SPREAD)) & U(ALL_KEYS - 1)


def symbols_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Context and word of bigram hashes."""
    plain = (keys * U(pow(SPREAD, -1, ALL_KEYS))) & U(ALL_KEYS - 1)
    return (plain >> U(SYMBOL_BITS)).astype(np.int64), (plain & U(SYMBOLS_OF_MODEL - 1)).astype(np.int64)


STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class Statistics:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of the texts of a chunk, as arrays."""

    def __init__(self):
        self.window = SpanHash(3)

    def __call__(self, texts: Texts, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray, word_hash: np.ndarray) -> list[np.ndarray]:
        n, data = len(texts), texts.data
        salt = mixed(np.arange(1, n + 1, dtype=U))
        n_words = np.bincount(owner, minlength=n)
        chars = sums(mapped(data, LETTERS).astype(np.int64), texts.starts, texts.ends)
        symbols = sums(mapped(data, SYMBOLS).astype(np.int64), texts.starts, texts.ends)
        breaks = np.flatnonzero(data == 10)
        of_break = np.searchsorted(texts.ends, breaks, side="right")
        line_starts, owner_s = np.concatenate([texts.starts, breaks + 1]), np.concatenate([np.arange(n), of_break])
        line_stops, owner_e = np.concatenate([breaks, texts.ends]), np.concatenate([of_break, np.arange(n)])
        order = np.lexsort((line_starts, owner_s))
        line_starts, line_owner = line_starts[order], owner_s[order]
        line_stops = line_stops[np.lexsort((line_stops, owner_e))]
        worded = np.searchsorted(starts, line_stops, side="left") > np.searchsorted(starts, line_starts, side="left")
        line_starts, line_stops, line_owner = line_starts[worded], line_stops[worded], line_owner[worded]
        line_hash = mixed(byte_hashes(data, line_starts, line_stops, 2) ^ salt[line_owner])
        dup_lines = np.bincount(line_owner, minlength=n) - np.bincount(line_owner[np.unique(line_hash, return_index=True)[1]], minlength=n)

        first = np.arange(max(len(starts) - REPEAT_WINDOW + 1, 0))
        first = first[owner[first] == owner[first + REPEAT_WINDOW - 1]]
        window_hash = mixed(self.window(word_hash, first, first + REPEAT_WINDOW) ^ salt[owner[first]])
        _, back, times = np.unique(window_hash, return_inverse=True, return_counts=True)
        again = first[times[back] > 1]
        edge = np.bincount(again, minlength=len(starts) + 1) - np.bincount(again + REPEAT_WINDOW, minlength=len(starts) + 1)
        covered = np.cumsum(edge)[: len(starts)] > 0
        repeated = np.bincount(owner[covered], minlength=n)
        return [n_words, chars, symbols, dup_lines, repeated]


def _sent(parts: int):
    """For mapInArrow over (doc_id, lang, text): rows (p, unit, blob), and one row (p, unit, stats) a unit of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        statistics, salts, unit = Statistics(), {}, TaskContext.get().partitionId() << 24
        keys, told, n, words = [], [], 0, 0

        def row(p: int, blob: bytes | None, stats: bytes | None) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([unit], pa.int64()), pa.array([blob], pa.binary()), pa.array([stats], pa.binary())], ["p", "unit", "blob", "stats"])

        def flush() -> Iterator[pa.RecordBatch]:
            every = np.sort(np.concatenate(keys))
            first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, int)
            times, found = np.diff(np.append(first, len(every))), every[first]
            key, doc = found >> U(16), found & U(0xFFFF)
            cuts = np.searchsorted(key * U(parts) >> U(2 * SYMBOL_BITS), np.arange(parts + 1, dtype=U))
            for p in np.flatnonzero(np.diff(cuts)).tolist():
                a, b = cuts[p], cuts[p + 1]
                yield row(p, packed(key[a:b], doc[a:b], times[a:b]), None)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, told[0].schema) as stream:
                for x in told:
                    stream.write_batch(x)
            yield row(unit % parts, None, sink.getvalue().to_pybytes())

        for batch in batches:
            langs = batch.column(1).to_pylist()
            mine = np.array([salts.setdefault(x, language_salt(x)) if x not in salts else salts[x] for x in langs], U)
            for first, texts in chunks(batch.column(2)):
                if told and (words >= UNIT_WORDS or n + len(texts) > UNIT_DOCS):
                    yield from flush()
                    keys, told, n, words, unit = [], [], 0, 0, unit + 1
                starts, ends, owner = texts.words()
                stats = statistics(texts, starts, ends, owner, byte_hashes(texts.data, starts, ends, 1))
                keys.append(bigrams(texts, starts, ends, owner, mine[first : first + len(texts)]) << U(16) | (owner + n).astype(U))
                whole = byte_hashes(texts.data, texts.starts, texts.ends, 6).view(np.int64)
                columns = [batch.column(i)[first : first + len(texts)] for i in (0, 1)] + [pa.array(x.astype(np.int64)) for x in (*stats, whole)]
                told.append(pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", *STATISTICS, "text_hash"]))
                n, words = n + len(texts), words + len(starts)
        if told:
            yield from flush()

    return run


class Part:
    """All occurrences of a part of the hash range: the sorted array of its bigrams, their counts, and which each occurrence has."""

    def __init__(self, blobs: list[bytes]):
        found = [unpacked(b) for b in blobs]
        self.sizes = [len(f[0]) for f in found]
        keys, self.docs, self.times = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(keys, kind="stable")
        sorted_keys = keys[order]
        new = np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])
        self.keys, self.counts = sorted_keys[new], np.add.reduceat(self.times[order], np.flatnonzero(new))
        self.which = np.empty(len(keys), np.int64)
        self.which[order] = np.cumsum(new) - 1


def _by_part(rows: Iterator[Row]) -> tuple[dict[int, list[tuple[int, bytes]]], list[Row]]:
    blobs: dict[int, list] = {}
    others = []
    for r in rows:
        if r.blob is None:
            others.append(r)
        else:
            blobs.setdefault(r.p, []).append((r.unit, bytes(r.blob)))
    return blobs, others


def _squeezed(x: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes())


def _numbers(data: bytes) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(raw.T).view("<i8").ravel()


def _counted(rows: Iterator[Row]) -> Iterator[tuple[int, bytes]]:
    """(slice, numbers): by symbol the occurrences as a context, its bigrams with counts of 1, 2 and more, and its
    bigrams as a word; under -1 the counts of counts of 1 to 4."""
    table, few = np.zeros((5, SYMBOLS_OF_MODEL), np.int64), np.zeros(4, np.int64)
    for _, blobs in sorted(_by_part(rows)[0].items()):
        part = Part([b for _, b in blobs])
        context, word = symbols_of(part.keys)
        table[0] += np.bincount(context, part.counts, SYMBOLS_OF_MODEL).astype(np.int64)
        for i in (1, 2, 3):
            table[i] += np.bincount(context[np.minimum(part.counts, 3) == i], minlength=SYMBOLS_OF_MODEL)
        table[4] += np.bincount(word, minlength=SYMBOLS_OF_MODEL)
        few += [int((part.counts == i).sum()) for i in (1, 2, 3, 4)]
    if few.any() or table[0].any():
        for i, part_of in enumerate(np.split(table, SLICES, axis=1)):
            yield i, _squeezed(part_of.ravel())
        yield -1, _squeezed(few)


def discounts(few: np.ndarray) -> np.ndarray:
    """What modified Kneser-Ney takes from counts of 0, 1, 2 and more, from the counts of counts of 1 to 4."""
    n1, n2, n3, n4 = (max(int(n), 1) for n in few)
    y = n1 / (n1 + 2 * n2)
    return np.concatenate([[0.0], np.clip([1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], 0.1, [0.9, 1.8, 2.7])])


class Model:
    """By symbol: occurrences as a context, weight of backing off, and lower-order probability; and the bigrams' discounts.

    The lower order has the number of different contexts of a word, discounted
    likewise, over one share for all symbols.
    """

    def __init__(self, table: np.ndarray, few: np.ndarray):
        self.discounts = discounts(few)
        self.contexts = np.maximum(table[0], 1).astype(np.float32)
        self.back = np.where(table[0] > 0, self.discounts[1:] @ table[1:4] / self.contexts, 1.0).astype(np.float32)
        kinds, total = table[4], max(int(table[4].sum()), 1)
        taken = np.minimum(discounts(np.array([(kinds == i).sum() for i in (1, 2, 3, 4)]))[np.minimum(kinds, 3)], 0.9 * kinds)
        left = taken.sum() / total if kinds.any() else 1.0
        self.lower = ((kinds - taken) / total + left / SYMBOLS_OF_MODEL).astype(np.float32)

    def log_probability(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Natural logarithms for bigrams with such counts (0: unseen)."""
        context, word = symbols_of(keys)
        seen = np.maximum(counts - self.discounts[np.minimum(counts, 3)], 0) / self.contexts[context]
        return np.log(seen + self.back[context].astype(float) * self.lower[word])


def _scored(rows: Iterator[Row], model: Model) -> Iterator[tuple]:
    """Rows (unit, stats, sums) of a task's parts: by unit the documents' numbers and sums of log probabilities."""
    blobs, others = _by_part(rows)
    for r in others:
        yield r.unit, bytes(r.stats), None
    for _, found in sorted(blobs.items()):
        part = Part([b for _, b in found])
        own = model.log_probability(part.keys[part.which], part.counts[part.which] - part.times) * part.times
        at = 0
        for (unit, _), size in zip(found, part.sizes):
            docs, here = np.unique(part.docs[at : at + size], return_inverse=True)
            total = np.bincount(here, own[at : at + size]).astype("<f4")
            yield unit, None, docs.astype("<u2").tobytes() + total.tobytes()
            at += size


SCORED = "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, text_hash long, log_perplexity double"


def _joined(table: pa.Table) -> pa.Table:
    """Of one unit: the documents' statistics with the sums of all parts."""
    stats = next(x for x in table.column("stats").to_pylist() if x is not None)
    out = pa.ipc.open_stream(stats).read_all()
    total, words = np.zeros(out.num_rows), out.column("n_words").to_numpy()
    for x in table.column("sums"):
        if x.is_valid:
            data, n = x.as_py(), len(x.as_py()) // 6
            total[np.frombuffer(data, "<u2", n)] += np.frombuffer(data, "<f4", n, 2 * n)
    told = pa.array(-total / np.maximum(words, 1), pa.float64(), mask=words == 0)
    return out.append_column("log_perplexity", told)


def train(shuffled) -> Model:
    """The model of what _sent sent, summed up by slices of symbols."""
    sums_of = shuffled.mapPartitions(_counted).reduceByKey(lambda a, b: _squeezed(_numbers(a) + _numbers(b)), SLICES).collect()  # a slice a row
    found = {k: _numbers(v) for k, v in sums_of}
    if -1 not in found:
        return Model(np.zeros((5, SYMBOLS_OF_MODEL), np.int64), np.zeros(4, np.int64))
    return Model(np.concatenate([found[i].reshape(5, -1) for i in range(SLICES)], axis=1), found[-1])


def sent(documents: DataFrame):
    """The bigrams and statistics of all rows (doc_id, lang, text), each part of the hash range in one partition of an RDD.

    An RDD, because two passes read the same shuffle: Spark keeps its files, and
    runs again what a lost executor had of them.
    """
    rows = pick(documents, doc_id="long", lang="string", text="string")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // (6 * PART_WORDS)))
    tasks = -(-parts // -(-parts // MOST_TASKS))
    found = rows.mapInArrow(_sent(parts), "p int, unit long, blob binary, stats binary")
    return found.repartitionById(tasks, F.pmod("p", F.lit(tasks)).cast("int")).rdd


def score(documents: DataFrame) -> DataFrame:
    """Base statistics and log_perplexity (nats a word; null for a text without words) of all rows (doc_id, lang, text)."""
    spark = documents.sparkSession
    shuffled = sent(documents)
    model = spark.sparkContext.broadcast(train(shuffled))  # 12 MB
    found = spark.createDataFrame(shuffled.mapPartitions(lambda rows: _scored(rows, model.value)), "unit long, stats binary, sums binary", verifySchema=False)
    return materialize(found.groupBy("unit").applyInArrow(_joined, SCORED), "perplexity")


def bands(scored: DataFrame, reach: float = REACH) -> DataFrame:
    """(of, low, high): lower and upper log perplexity by language, over all documents, equal texts counted once.

    The quartiles and `reach` quartile distances beyond, the distance taken as BIN
    at least.  The lower limit leaves at most LEAST of the documents below it, as
    copies, which tell each other's words, are likely without being poor.
    """
    told = scored.where("log_perplexity IS NOT NULL").select("lang", "log_perplexity", "text_hash").distinct()
    bins = told.groupBy("lang", F.floor(F.col("log_perplexity") / BIN).alias("b")).agg(F.count("*").alias("n"))
    by_lang = Window.partitionBy("lang")
    bins = bins.withColumn("upto", F.sum("n").over(by_lang.orderBy("b"))).withColumn("total", F.sum("n").over(by_lang))
    at = {q: (F.min(F.when(F.col("upto") >= F.col("total") * q, F.col("b"))) + 0.5) * BIN for q in (0.25, 0.75, LEAST)}
    limits = bins.groupBy(F.col("lang").alias("of")).agg(*[at[q].alias(name) for q, name in ((0.25, "q1"), (0.75, "q3"), (LEAST, "least"))])
    wide = F.greatest(F.col("q3") - F.col("q1"), F.lit(BIN)) * reach
    return limits.select("of", F.least(F.col("q1") - wide, "least").alias("low"), (F.col("q3") + wide).alias("high"))


def judge(documents: DataFrame) -> DataFrame:
    """Statistics and verdict of every row of documents (doc_id, text, lang).

    base_failed: under 20 words, or over 30 per cent of words in repeated
    windows.  kept: false if base_failed, and else whether the perplexity lies in
    the band of the document's language, which is wider for short texts.
    log_perplexity is in nats a word.

    A null text counts as empty: no words, base_failed.  A null lang is a
    language of its own.  Repeated rows come back each, null doc_ids stay null,
    an empty table gives no rows, texts are read whole, extra columns are ignored.
    """
    scored = score(documents)
    band = materialize(bands(scored), "bands")
    rows = scored.join(band, F.col("lang").eqNullSafe(F.col("of")), "left")
    slack = F.lit(SHORT) / F.sqrt(F.greatest("n_words", F.lit(1)))
    inside = F.coalesce(F.col("log_perplexity").between(F.col("low") - slack, F.col("high") + slack), F.lit(True))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return rows.select("doc_id", *STATISTICS, failed.alias("base_failed"), (~failed & inside).alias("kept"), "log_perplexity", "lang")
