"""Language identification by compression.

Each learned language has a zstandard dictionary of raw content, taken from a
bounded sample of labelled documents.  A text is reduced to lower-case
letters and cut into chunks, every chunk is compressed with every dictionary, and the language whose dictionary leaves
the fewest bytes wins.  The margin to the next language is the score; a narrow
one means that the text is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveworks.llm.common import pick

SAMPLED_DOCUMENTS = 128  # a language, at most
SAMPLED_ROWS = 1 << 14  # of all languages together, about: with more than 128 languages each has fewer
CHUNK = 4096  # bytes compressed at once, so that the dictionary counts in every part of a long text
SHORT = 96  # bytes; shorter texts are repeated up to that
LEVELS = (3, 9)  # the second decides ties of the first
MIN_MARGIN = 0.002  # pipelines reject texts below it
UNKNOWN = "und"


MARKS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def letters(text: str) -> bytes:
    """The text in lower case, with one space for each run of ASCII that isn't letters."""
    return b" ".join(text.lower().encode().translate(MARKS).split())


def train(labelled: DataFrame, documents: int = SAMPLED_DOCUMENTS, total: int = SAMPLED_ROWS, chars: int | None = None) -> list[tuple[str, bytes]]:
    """(language, dictionary content), the most frequent language first, from rows (doc_id, text, lang).

    The sample is of bounded rows: of each language the `documents` rows with
    letters whose doc_ids hash lowest, fewer (one at least) where there are so
    many languages that they would be over `total`.  Their texts are taken whole,
    unless a caller bounds them to `chars` characters.
    Frequencies are over all rows.  Rows without a language, a text or a letter
    teach nothing.
    """
    rows = pick(labelled, doc_id="long", text="string", lang="string").where("lang IS NOT NULL AND text RLIKE '\\\\p{L}'")
    rows = rows.select("lang", (F.substring("text", 1, chars) if chars else F.col("text")).alias("text"), F.xxhash64("doc_id").alias("h"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    documents = max(1, min(documents, total // max(len(counts), 1)))
    order = Window.partitionBy("lang").orderBy("h", "text")
    chosen = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= documents).collect()
    texts: dict[str, list] = {}
    for r in sorted(chosen, key=lambda r: -r["n"]):  # the content nearest to the end is cheapest to refer to
        texts.setdefault(r["lang"], []).append(r["text"])
    return [(lang, letters("\n".join(texts[lang]))) for lang in sorted(texts, key=lambda x: (-counts[x], x))]


class Classifier:
    def __init__(self, model: list[tuple[str, bytes]]):
        import regex
        import zstandard

        self.names = [lang for lang, _ in model]
        self.levels = []
        for level in LEVELS:
            compressors = []
            for _, content in model:
                words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                words.precompute_compress(level=level)
                compressors.append(zstandard.ZstdCompressor(level=level, dict_data=words, write_content_size=False, write_dict_id=False).compress)
            self.levels.append(compressors)
        self.letter = regex.compile(r"\p{L}").search

    def __call__(self, text: str | None) -> tuple[str, float]:
        if not self.names or text is None or not self.letter(text):
            return UNKNOWN, 0.0
        data = letters(text)
        if len(data) < SHORT:  # else stored as it is, with the same size under every dictionary
            data = b" ".join([data] * (SHORT // max(len(data), 1) + 1))
        chunks = [data[i : i + CHUNK] for i in range(0, len(data), CHUNK)]
        sizes = [sum(len(c(x)) for x in chunks) for c in self.levels[0]]
        best = min(sizes)
        tied = [i for i, s in enumerate(sizes) if s == best]
        if len(tied) > 1:
            finer = {i: sum(len(self.levels[1][i](x)) for x in chunks) for i in tied}
            return self.names[min(tied, key=lambda i: (finer[i], i))], 0.0
        others = [s for s in sizes if s != best]
        return self.names[tied[0]], (min(others) - best) / min(others) if others else 1.0


def classify(documents: DataFrame, model: list[tuple[str, bytes]]) -> DataFrame:
    """doc_id, lang_pred, score (0 to 1: the margin as a share of the runner-up's size) of every row of (doc_id, text).

    A null text, one without a letter, and any text under an empty model give
    `und` with score 0.  Ties of compressed sizes score 0 and go to the smaller
    size at the second level, then to the more frequent language.  A model of
    one language gives it with score 1.  Repeated rows come back each, null
    doc_ids stay null, texts are read whole, extra columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(model)
        for batch in batches:
            found = [classifier(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    return pick(documents, doc_id="long", text="string").mapInArrow(run, "doc_id long, lang_pred string, score double")


def annotate(rows: DataFrame, model: list[tuple[str, bytes]], into: str) -> DataFrame:
    """All rows and columns, with the prediction in the column `into` and score added; the text is read from column text."""
    schema = rows.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(model)
        for batch in batches:
            found = [classifier(t.as_py()) for t in batch.column("text")]
            names = [n for n in batch.schema.names if n != into]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], [*names, into, "score"])

    kept = T.StructType([f for f in schema if f.name != into] + [T.StructField(into, T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, kept)


def held_out() -> F.Column:
    """Whether a document is kept from training: crc32 of doc_id as text is a multiple of 5; null: false."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
