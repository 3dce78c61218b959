"""Benchmark decontamination by latent semantic retrieval.

Words are hashed to features.  One pass over all documents counts, by passage of
PASSAGE words, in how many passages each feature stands, and multiplies the
passage-by-feature matrix T with random signs: T'(T signs), all in integers, so
that the sums do not depend on their order.  From that the driver, which sees
FEATURES rows only, has the inverse document frequencies and by the Nystrom form
of the randomised singular value decomposition the leading right singular
vectors and values of the TF-IDF matrix.

A second pass searches windows of consecutive blocks of words, a block longer
than each benchmark item.  Two conditions are necessary for a leak and cheap to
look up: a paraphrase's window holds the item's last words, its answer, and a
copy's window holds enough of the item's rarest words.  Windows without either,
nearly all, go.  The others are searched in the latent space: items are indexed
by length, and where a length has many, in cells around centroids, of which only
those in a window's direction are searched.  A window w is a candidate for an
item q where their cosine is MIN_COSINE or more and not below
MIN_SHARE * |q| / |w|, that is, where w holds so much of q in q's direction.
A cosine is no bound of the decision (half of a short item's window may be
foreign text), so pairs that the lookups name are decided also where the cosine
missed them: nothing is lost, and each leak tells whether the cosine found it.

What is left is decided on the words themselves: by the longest common
subsequence, and for paraphrases also by the answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveworks.llm.common import materialize, pick
from sieveworks.llm.words import SpanHash, Texts, byte_hashes, byte_table, chunks, mapped, splitmix

FEATURES = 2048  # hashed words
PASSAGE = 64  # words
RANK, EXTRA = 64, 8
BLOCK = 8  # words projected together
SAME = 0.8  # of an item's words in the common subsequence: a copy
PARAPHRASE = 0.6  # and the answer there: a paraphrase
ANSWER = 5  # last words of an item, at most a third of it
MIN_COSINE = 0.35
MIN_SHARE = 0.3  # of an item's squared length that a window holds in its direction
CELL = 256  # items of a cell, about
SLACK = 2 / RANK**0.5  # of a window's length: two deviations of its cosine with an unrelated direction
RARE = 3  # of an item's rarest words that a copy's window must hold
AT_ONCE = 1 << 12  # windows searched at once
SHORT = 8  # items with fewer words are looked up as sequences
ITEM_BYTES = 16 << 20  # of benchmark text that a task holds; a larger benchmark is searched in parts, one after another
U = np.uint64

SEPARATORS = ~byte_table(bytes([b for b in range(256) if b >= 128 or chr(b).isalnum()]))
FOLDED = np.frombuffer(bytes(range(256)).lower(), np.uint8)


class Hashed:
    """64-bit hashes of the words of a chunk, without case and punctuation, and their texts."""

    def __call__(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        starts, ends, owner = texts.words(SEPARATORS)
        return byte_hashes(mapped(texts.data, FOLDED), starts, ends, 21), owner


def places(owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First word of each text, and each word's place in its text."""
    first = np.searchsorted(owner, np.arange(n + 1))
    return first, np.arange(len(owner)) - first[owner]


def signs() -> np.ndarray:
    bits = np.unpackbits(splitmix(23, FEATURES * (RANK + EXTRA) // 64 + 1).view(np.uint8))[: FEATURES * (RANK + EXTRA)]
    return (2.0 * bits - 1).astype(np.float32).reshape(FEATURES, RANK + EXTRA)


def sketch(documents: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of passages, document frequency by feature, and T'(T signs), over all rows (text)."""
    width = RANK + EXTRA

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, random = Hashed(), signs()
        seen, frequency, product = 0, np.zeros(FEATURES, np.int64), np.zeros((FEATURES, width), np.int64)
        for batch in batches:
            for _, texts in chunks(batch.column(0)):
                words, owner = hashed(texts)
                if not len(words):
                    continue
                _, place = places(owner, len(texts))
                passage = np.cumsum(place % PASSAGE == 0) - 1
                feature = (words % U(FEATURES)).astype(np.int64)
                for at in range(0, int(passage[-1]) + 1, 1024):
                    a, b = np.searchsorted(passage, [at, at + 1024])
                    n = int(passage[b - 1]) + 1 - at
                    cells = np.sort((passage[a:b] - at) * FEATURES + feature[a:b])
                    first = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
                    table = np.zeros(n * FEATURES, np.float32)
                    table[cells[first]] = np.diff(np.append(first, len(cells)))
                    table = table.reshape(n, FEATURES)
                    seen += n
                    frequency += np.bincount(cells[first] % FEATURES, minlength=FEATURES)
                    product += ((table @ random).T @ table).T.astype(np.int64)  # exact: below 2**24
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(FEATURES)), pa.array(np.full(FEATURES, seen)), pa.array(frequency), *(pa.array(np.ascontiguousarray(c)) for c in product.T)], ["f", "seen", "df", *(f"p{i}" for i in range(width))])

    columns = ["seen", "df", *(f"p{i}" for i in range(width))]
    parts = pick(documents, text="string").mapInArrow(run, "f long, " + ", ".join(f"{c} long" for c in columns))
    found = parts.groupBy("f").agg(*[F.sum(c).alias(c) for c in columns]).toArrow()
    table = np.zeros((FEATURES, len(columns)), np.int64)
    if found.num_rows:
        table[found.column("f").to_numpy()] = np.stack([found.column(c).to_numpy() for c in columns], axis=1)
    return int(table[:, 0].max(initial=0)), table[:, 1], table[:, 2:]


def projection(passages: int, frequency: np.ndarray, product: np.ndarray) -> np.ndarray:
    """Features by RANK: inverse document frequency times the leading right singular vectors, divided by the
    squares of the singular values, which takes weight from what all passages share."""
    idf = np.log((passages + 1) / (frequency + 1.0)) + 0.1
    random = signs().astype(np.float64)
    right = idf[:, None] * product  # A'A (random / idf), with A the TF-IDF matrix
    core = random.T @ product
    core = (core + core.T) / 2
    core += np.eye(len(core)) * max(np.trace(core) / len(core), 1.0) * 1e-6
    half = np.linalg.solve(np.linalg.cholesky(core), right.T).T
    vectors, values, _ = np.linalg.svd(half, full_matrices=False)
    vectors, values = vectors[:, :RANK], values[:RANK]
    told = values[values > values[0] * 1e-6]
    floor = np.quantile(told, 0.9) if len(told) else 1.0  # the few strongest directions weigh less, the others alike
    return (idf[:, None] * vectors / np.maximum(values, floor) ** 2 * floor**2).astype(np.float32)


def common_subsequence(item: list[int], passage: list[int]) -> int:
    """Length of the longest common subsequence, a row of bits at a time (Hyyro 2004)."""
    where: dict[int, int] = {}
    for i, w in enumerate(item):
        where[w] = where.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for w in passage:
        if m := where.get(w):
            u = row & m
            row = (row + u | row - u) & full
    return len(item) - row.bit_count()


def cells_of(vectors: np.ndarray, size: int = CELL) -> list[tuple[np.ndarray, float, np.ndarray]]:
    """Cells of about `size` items around centroids (spherical k-means): centroid, the projection on it that a window needs, items.

    The items' vectors are rows.  A window that holds MIN_SHARE of an item holds
    about that share of the item's own projection on the centroid, give or take
    what the foreign text in it adds (SLACK).
    """
    n = -(-len(vectors) // size)
    unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-30)
    centers = unit[np.linspace(0, len(unit) - 1, n).astype(int)]
    for _ in range(8 if n > 1 else 1):
        nearest = np.argmax(unit @ centers.T, axis=1)
        centers = np.stack([unit[nearest == c].sum(axis=0) if (nearest == c).any() else centers[c] for c in range(n)])
        centers /= np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-30)
    out = []
    for c in range(n):
        members = np.flatnonzero(nearest == c)
        if len(members):
            out.append((centers[c], MIN_SHARE * float((vectors[members] @ centers[c]).min()) if n > 1 else -np.inf, members))
    return out


class Class:
    """Items of one window length: their numbers and sizes, latent vectors and cells, and how often each has each of their words."""

    def __init__(self, blocks: int, members: list[int], words: list[np.ndarray], vectors: np.ndarray, vocabulary: np.ndarray):
        self.blocks, self.members, self.vectors = blocks, members, vectors
        self.sizes = np.array([len(w) for w in words])
        self.enough, self.some = (np.ceil(share * self.sizes - 1e-9).astype(int) for share in (SAME, PARAPHRASE))
        self.must = np.minimum(RARE, self.enough)
        self.squares = np.maximum(np.einsum("ij,ij->i", vectors, vectors), 1e-30)
        self.cells = [(center, gate, at, np.ascontiguousarray(vectors[at].T), (MIN_SHARE * self.squares[at]).astype(np.float32)) for center, gate, at in cells_of(vectors)]
        of = np.repeat(np.arange(len(words)), self.sizes)
        own, row = np.unique(np.searchsorted(vocabulary, np.concatenate(words)), return_inverse=True)
        pairs, self.times = np.unique(row * len(words) + of, return_counts=True)
        self.pairs = pairs
        self.rows = np.full(len(vocabulary) + 1, len(own), np.int32)
        self.rows[own] = np.arange(len(own))

    def near(self, windows: np.ndarray) -> np.ndarray:
        """Rows (window, item) of the candidates of windows: cells first, then shares, then cosines."""
        out = [np.zeros((0, 2), np.int64)]
        sizes = np.sqrt(np.einsum("ij,ij->i", windows, windows))
        for center, gate, at, vectors, least in self.cells:
            rows = np.flatnonzero(windows @ center >= gate - SLACK * sizes) if gate > -np.inf else np.arange(len(windows))
            dots = windows[rows] @ vectors
            hit, k = np.nonzero(dots >= least)
            long = dots[hit, k] >= MIN_COSINE * sizes[rows[hit]] * np.sqrt(self.squares[at[k]])
            out.append(np.stack([rows[hit[long]], at[k[long]]], axis=1))
        return np.concatenate(out)

    def in_common(self, numbers: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Size of the common multiset of words of each window (a row of numbers of words) and its item."""
        out = []
        for at in range(0, len(numbers), 1 << 13):
            rows = np.sort(self.rows[numbers[at : at + (1 << 13)]], axis=1)
            place = np.broadcast_to(np.arange(rows.shape[1]), rows.shape)
            begins = np.concatenate([np.zeros((len(rows), 1), np.int64), np.where(rows[:, 1:] != rows[:, :-1], place[:, 1:], 0)], axis=1)
            pair = rows.astype(np.int64) * len(self.members) + item[at : at + (1 << 13), None]
            found = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            times = np.where(self.pairs[found] == pair, self.times[found], 0)
            out.append((times > place - np.maximum.accumulate(begins, axis=1)).sum(axis=1))
        return np.concatenate(out)


class Items:
    """Benchmark items as word hashes; those of SHORT words and more also by class, answer and rarest words."""

    def __init__(self, rows: list[tuple[int, str]], latent: np.ndarray, frequency: np.ndarray):
        hashed = Hashed()
        self.words: list[tuple[int, np.ndarray]] = []
        texts = pa.array([t or "" for _, t in rows], pa.string())
        for first, part in chunks(texts):
            words, owner = hashed(part)
            begin, _ = places(owner, len(part))
            self.words += [(rows[first + i][0], words[begin[i] : begin[i + 1]]) for i in range(len(part))]
        self.short: dict[int, dict[int, list[int]]] = {}
        by: dict[int, list[int]] = {}
        span = SpanHash(24)
        for i, (_, words) in enumerate(self.words):
            if len(words) >= SHORT:
                by.setdefault(-(-len(words) // BLOCK) + 1, []).append(i)
            elif len(words):
                key = int(span(words, np.array([0]), np.array([len(words)]))[0])
                self.short.setdefault(len(words), {}).setdefault(key, []).append(i)
        self.vocabulary = np.unique(np.concatenate([self.words[i][1] for m in by.values() for i in m])) if by else np.zeros(0, U)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.vocabulary & U(0xFFFFF)] = True
        n = len(self.vocabulary) + 1
        self.classes, self.answers, rare = [], {}, []  # answers: length, then first word's number, then items and answers
        for blocks, members in sorted(by.items()):
            words = [self.words[i][1] for i in members]
            c, made = len(self.classes), Class(blocks, members, words, np.stack([latent[(w % U(FEATURES)).astype(np.int64)].sum(axis=0) for w in words]), self.vocabulary)
            self.classes.append(made)
            for k, w in enumerate(words):
                numbers = np.searchsorted(self.vocabulary, w)
                answer = numbers[len(w) - answer_length(len(w)) :]
                self.answers.setdefault(len(answer), {}).setdefault(tuple(answer.tolist()), []).append((c, k))
                rarest = np.argsort(frequency[(w % U(FEATURES)).astype(np.int64)], kind="stable")[: len(w) - made.enough[k] + made.must[k]]
                rare += [(x, c, k) for x in set(numbers[rarest].tolist())]
        self.salt = splitmix(26, n)
        self.keys = {length: np.unique(self._keys(np.array(list(found)), length)) for length, found in self.answers.items()}
        self.firsts = {length: np.isin(np.arange(n), [a[0] for a in found]) for length, found in self.answers.items()}
        rare.sort()
        self.rare = np.array(rare, np.int64).reshape(-1, 3)
        self.rare_from = np.searchsorted(self.rare[:, 0], np.arange(n + 1))

    def numbers(self, words: np.ndarray) -> np.ndarray:
        """Each word's number in the vocabulary, or the vocabulary's size."""
        out = np.full(len(words), len(self.vocabulary))
        at = np.flatnonzero(self.maybe[(words & U(0xFFFFF)).view(np.int64)])
        number = np.searchsorted(self.vocabulary, words[at])
        known = number < len(self.vocabulary)
        at, number = at[known], number[known]
        known = self.vocabulary[number] == words[at]
        out[at[known]] = number[known]
        return out

    def _keys(self, sequences: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros(len(sequences), U)
        for i in range(n):
            out = out * U(0x9E3779B97F4A7C15) + self.salt[sequences[:, i]]
        return out

    def answered(self, numbers: np.ndarray, owner: np.ndarray, block: np.ndarray, low: np.ndarray) -> list[np.ndarray]:
        """By class, rows (window's first block, item) of the windows that hold an item's answer.

        block: each word's block; low: the first block of each word's text."""
        out: list[list[tuple[int, int]]] = [[] for _ in self.classes]
        for n, wanted in self.answers.items():
            at = np.flatnonzero(self.firsts[n][numbers])
            at = at[at + n <= len(owner)]
            at = at[owner[at] == owner[at + n - 1]]
            sequences = numbers[at[:, None] + np.arange(n)]
            hit = np.isin(self._keys(sequences, n), self.keys[n])
            for p, sequence in zip(at[hit].tolist(), map(tuple, sequences[hit].tolist())):
                for c, k in wanted.get(sequence, ()):
                    out[c] += [(b, k) for b in range(max(int(low[p]), int(block[p + n - 1]) - self.classes[c].blocks + 1), int(block[p]) + 1)]
        return [np.array(x, np.int64).reshape(-1, 2) for x in out]

    def with_rare(self, numbers: np.ndarray, block: np.ndarray, low: np.ndarray) -> list[np.ndarray]:
        """By class, rows (window's first block, item) of the windows that hold as many of the item's rarest words as a copy must."""
        times = (self.rare_from[1:] - self.rare_from[:-1])[numbers]
        at = np.flatnonzero(times)
        times = times[at]
        which = np.repeat(self.rare_from[numbers[at]], times) + np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        at, c, k = np.repeat(at, times), self.rare[which, 1], self.rare[which, 2]
        out = []
        for i, one in enumerate(self.classes):
            mine = c == i
            start = block[at[mine], None] - np.arange(one.blocks)
            there = start >= low[at[mine], None]
            key, n = np.unique((start * len(one.members) + k[mine, None])[there], return_counts=True)
            window, item = np.divmod(key, len(one.members))
            kept = n >= one.must[item]
            out.append(np.stack([window[kept], item[kept]], axis=1))
        return out


def answer_length(n: int) -> int:
    return max(1, min(ANSWER, n // 3))


def judged(item: list[int], passage: list[int]) -> tuple[float, bool]:
    """Share of the item's words in the common subsequence, and whether its answer stands in the passage."""
    answer = item[-answer_length(len(item)) :]
    n = len(answer)
    there = any(passage[i : i + n] == answer for i in range(len(passage) - n + 1))
    return common_subsequence(item, passage) / len(item), there


RESULT = "doc_id long, item_id long, kind string, common double, answer boolean, cosine double, first_word long, by_cosine boolean"


def find(documents: DataFrame, benchmark: DataFrame, latent: tuple[np.ndarray, np.ndarray] | None = None, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """Leaks of benchmark (item_id, text) in documents (doc_id, text): a row per row of documents and item found there.

    kind: copy (at least SAME of the item's words stand in a passage in the same
    order), paraphrase (at least PARAPHRASE, and the item's last words stand there
    together), or sequence (an item of fewer than SHORT words stands there whole).
    The best passage counts, the first of equals; first_word is where it begins,
    in words without punctuation; by_cosine tells whether the cosine search found
    that passage (a sequence: false).  Clean documents have no row.

    Null and empty texts match nothing, on either side.  Repeated rows and items
    come back each; null ids stay null; empty tables give no rows; texts are read
    whole; extra columns are ignored.  The benchmark is the query set and goes to
    every task; one of more than item_bytes is searched in parts of about that
    size, each part over all documents and written before the next.  latent: a
    projection and feature frequencies, as latent_space gives them.
    """
    items = pick(benchmark, item_id="long", text="string")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // item_bytes))
    if latent is None:
        latent = latent_space(documents)
    part = F.pmod(F.xxhash64(F.lit(25), F.col("item_id"), F.col("text")), F.lit(parts))
    found = None
    for i in range(parts):
        rows = sorted(((r["item_id"], r["text"]) for r in (items.where(part == i) if parts > 1 else items).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
        leaks = _leaks(documents, rows, *latent)
        if parts > 1:
            leaks = materialize(leaks, "leaks")
        found = leaks if found is None else found.unionAll(leaks)
    return found


def latent_space(documents: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The projection of features, and their frequencies, over all rows (text)."""
    seen, frequency, product = sketch(documents)
    return projection(seen, frequency, product), frequency


def _leaks(documents: DataFrame, rows: list[tuple[int, str]], latent: np.ndarray, frequency: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, hashed, span = Items(rows, latent, frequency), Hashed(), SpanHash(24)
        directions = np.concatenate([latent, np.zeros((1, latent.shape[1]), np.float32)])
        for batch in batches:
            out: list[tuple] = []
            for start, texts in chunks(batch.column(1)):
                words, owner = hashed(texts)
                if not len(words):
                    continue
                begin, place = places(owner, len(texts))
                best: dict[tuple[int, int], tuple] = {}

                def keep(text: int, i: int, kind: str, common: float, answer: bool, cosine: float | None, at: int, near: bool = False) -> None:
                    old = best.get((text, i))
                    if old is None or (common, -at) > (old[1], -old[4]):
                        best[text, i] = (kind, common, answer, cosine, at, near)

                cut = np.flatnonzero(place % BLOCK == 0)
                block = np.cumsum(place % BLOCK == 0) - 1
                low = np.searchsorted(owner[cut], owner)
                numbers = np.append(held.numbers(words), len(held.vocabulary))
                features = np.append((words % U(FEATURES)).astype(np.int64), FEATURES)
                answers = held.answered(numbers[:-1], owner, block, low)
                rare = held.with_rare(numbers[:-1], block, low)
                for one, answered, some in zip(held.classes, answers, rare):
                    n = len(one.members)
                    answered = np.unique(answered @ [n, 1])
                    pairs = np.union1d(answered, some @ [n, 1])
                    firsts = np.unique(pairs // n)
                    for at in range(0, len(firsts), AT_ONCE):
                        first = firsts[at : at + AT_ONCE]
                        inside = cut[first, None] + np.arange(one.blocks * BLOCK)
                        inside = np.where(inside < begin[owner[cut[first]] + 1, None], inside, len(words))
                        windows = directions[features[inside]].sum(axis=1)
                        found = one.near(windows)
                        found = first[found[:, 0]] * n + found[:, 1]
                        a, z = np.searchsorted(pairs, [first[0] * n, (first[-1] + 1) * n])
                        w, k = np.divmod(pairs[a:z], n)
                        row = np.searchsorted(first, w)
                        # No common subsequence is longer than the number of the window's words that the item has.
                        most = one.in_common(numbers[inside[row]], k)
                        open_ = most >= np.where(np.isin(pairs[a:z], answered), one.some[k], one.enough[k])
                        near = np.isin(pairs[a:z], found)
                        for j in np.flatnonzero(open_).tolist():
                            i, window, begins = one.members[k[j]], windows[row[j]], int(cut[w[j]])
                            text = int(owner[begins])
                            common, answer = judged(held.words[i][1].tolist(), words[begins : min(begins + one.blocks * BLOCK, int(begin[text + 1]))].tolist())
                            if common >= SAME or common >= PARAPHRASE and answer:
                                cosine = window @ one.vectors[k[j]] / np.sqrt(max(float(window @ window), 1e-30) * one.squares[k[j]])
                                keep(text, i, "copy" if common >= SAME else "paraphrase", common, answer, float(cosine), begins - int(begin[text]), bool(near[j]))
                for n, wanted in held.short.items():
                    at = np.arange(max(len(words) - n + 1, 0))
                    at = at[owner[at] == owner[at + n - 1]]
                    keys = span(words, at, at + n)
                    for j in np.flatnonzero(np.isin(keys, np.fromiter(wanted, U))).tolist():
                        for i in wanted[int(keys[j])]:
                            keep(int(owner[at[j]]), i, "sequence", 1.0, True, None, int(place[at[j]]))
                ids = batch.column(0)
                out += [(ids[start + text].as_py(), held.words[i][0], *v) for (text, i), v in sorted(best.items())]
            if out:
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.bool_(), pa.float64(), pa.int64(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], [c.split()[0] for c in RESULT.split(", ")])

    return pick(documents, doc_id="long", text="string").mapInArrow(run, RESULT)
