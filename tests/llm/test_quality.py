import functools
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from sieveworks.llm import quality
from sieveworks.llm.queries import op1_ngram_perplexity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = defaultdict(list)
    for i in range(len(words) - 7):
        seen[tuple(words[i : i + 8])].append(i)
    covered = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_query_base_against_brute_force(spark, sf):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op1_ngram_perplexity(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        want = brute(docs[r.doc_id].text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)
    passed = [r for r in rows if not r.base_failed]
    assert sum(r.kept for r in passed) > 0.95 * len(passed)


def brute_scores(docs):
    """Interpolated modified Kneser-Ney of bigrams over dictionaries, each document's own occurrences taken out: nats a word."""

    def symbol(lang, word):  # words of one symbol are one word to the model
        salt = np.array([quality.language_salt(lang) + (word is None)], np.uint64)
        data = np.frombuffer(word or b"", np.uint8)
        hashed = salt if word is None else quality.byte_hashes(data, np.array([0]), np.array([len(data)]), 5) ^ salt
        return int(quality.mixed(hashed)[0]) >> 44

    symbol = functools.cache(symbol)

    def grams(text, lang):
        words = [symbol(lang, w.encode().lower()) for w in WORD.findall(text)]  # bytes: A-Z only
        return list(zip([symbol(lang, None), *words], words))

    def taken(few):
        n = [max(x, 1) for x in few]
        y = n[0] / (n[0] + 2 * n[1])
        cut = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]]
        return [0, *(min(max(a, 0.1), top) for a, top in zip(cut, (0.9, 1.8, 2.7)))]

    counts = Counter(g for text, lang in docs for g in grams(text, lang))
    cut = taken([sum(v == i for v in counts.values()) for i in (1, 2, 3, 4)])
    contexts, back, kinds = Counter(), Counter(), Counter()
    for (a, b), n in counts.items():
        contexts[a] += n
        back[a] += cut[min(n, 3)]
        kinds[b] += 1
    low = taken([sum(v == i for v in kinds.values()) for i in (1, 2, 3, 4)])
    gone, total = {w: min(low[min(n, 3)], 0.9 * n) for w, n in kinds.items()}, sum(kinds.values())
    lower = {w: (n - gone[w]) / total + sum(gone.values()) / total / quality.SYMBOLS_OF_MODEL for w, n in kinds.items()}
    out = []
    for text, lang in docs:
        own = Counter(grams(text, lang))
        log_p = 0.0
        for (a, b), n in own.items():
            left = counts[a, b] - n
            log_p += n * math.log(max(left - cut[min(left, 3)], 0) / contexts[a] + back[a] / contexts[a] * lower[b])
        out.append(-log_p / sum(own.values()) if own else None)
    return out


def test_kneser_ney_against_brute_force(spark, sf, monkeypatch):
    """Every score of every document, also where units and parts are many."""
    rows = [(r.doc_id, r.text or "", r.lang) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows += [(-1, "The cat  sat\ton the mat the cat sat", "en"), (-2, "the CAT sat on a dog", "en"), (-3, "the cat sat on a dog", None), (-4, "", "en"), (-5, " one ", "xx")]
    want = dict(zip((r[0] for r in rows), brute_scores([(t, lang) for _, t, lang in rows])))
    for unit, part in ((1 << 21, 1 << 21), (500, 2000)):
        monkeypatch.setattr(quality, "UNIT_WORDS", unit)
        monkeypatch.setattr(quality, "PART_WORDS", part)
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
        got = {r.doc_id: r.log_perplexity for r in quality.score(df).collect()}
        assert set(got) == set(want)
        for d, x in want.items():
            assert got[d] is None if x is None else got[d] == pytest.approx(x, rel=1e-4), d


def test_model_sums_to_one(spark):
    df = spark.createDataFrame([(1, "a b a c a b d " * 4, "en"), (2, "a e f", "en")], "doc_id long, text string, lang string")
    shuffled = quality.sent(df)
    model, part = quality.train(shuffled), quality.Part([bytes(r.blob) for r in shuffled.collect() if r.blob is not None])
    context, word = quality.symbols_of(part.keys)
    assert model.lower.sum(dtype=float) == pytest.approx(1, rel=1e-4)
    for c in set(context.tolist()):
        mine = context == c
        seen = np.exp(model.log_probability(part.keys[mine], part.counts[mine])).sum()
        assert seen + model.back[c] * (1 - model.lower[word[mine]].sum(dtype=float)) == pytest.approx(1, rel=1e-4)


def test_packing_round_trip():
    rng = np.random.default_rng(2)
    keys = np.sort(rng.integers(0, quality.ALL_KEYS, 5000).astype(np.uint64))
    docs, times = rng.integers(0, 1 << 16, 5000), rng.integers(1, 1 << 31, 5000)
    for a, b in zip(quality.unpacked(quality.packed(keys, docs, times)), (keys, docs, times)):
        assert (a == b).all()


def test_shuffled_words_are_rejected(spark):
    """Texts of a grammar, and the same words in random order: the first stay, the others go."""
    import random

    rng = random.Random(6)
    nouns, verbs, places = ([f"{k}{i}" for i in range(25)] for k in ("noun", "verb", "place"))
    said = lambda: f"the {rng.choice(nouns)} has {rng.choice(verbs)} to an old {rng.choice(places)} because nobody {rng.choice(verbs)} in their {rng.choice(nouns)} ."
    plain = [" ".join(said() for _ in range(rng.randrange(5, 12))) for _ in range(400)]
    mixed = [" ".join(rng.sample(w, len(w))) for w in (t.split() for t in (" ".join(said() for _ in range(8)) for _ in range(20)))]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(plain + mixed)], "doc_id long, text string, lang string").repartition(4)
    kept = {r.doc_id for r in quality.judge(df).collect() if r.kept}
    assert len(kept & set(range(400))) >= 396 and not kept & set(range(400, 420))


def test_bands_reject_what_is_unlike_and_too_plain(spark):
    plain = ["the quick brown fox jumps over the lazy dog and then it sleeps near the river bank for a while number %d because the day was long" % i for i in range(60)]
    odd = ["zx qj kk vv xw zzq jq " * 40, "the " * 5 + " ".join("qzxj" + chr(97 + i % 26) * (i % 9) for i in range(200))]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(plain + odd)], "doc_id long, text string, lang string")
    rows = {r.doc_id: r for r in quality.judge(df).collect()}
    assert all(rows[i].kept for i in range(60))
    assert not rows[61].kept and not rows[61].base_failed


def test_odd_rows(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, " \n\t\n", None), (4, "a b c\na b c\n\na b c\r\n", None), (None, "x " * 25, "en"), (5, "é 中文 # |", "de"), (5, "é 中文 # |", "de"), (6, "one two three four five six seven eight nine " * 30000, "en"), (7, "a\n\nb\n", "\x00")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, KEPT int").coalesce(1)
    got = quality.judge(df).collect()
    assert len(got) == len(rows)
    for r in got:
        text = next(t for d, t, _ in rows if d == r.doc_id)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(text)
        assert r.kept is not None and r.base_failed is not None
    assert quality.judge(df.limit(0)).count() == 0
