import hashlib
import re

import pytest

from sieveworks.llm import pii
from sieveworks.llm.queries import op8_weak_supervision_pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, hit):
    digits = re.sub(r"[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind != "phone" or 10 <= len(digits) <= 15


def brute(text):
    found = [(m.start(), i, m.end(), k) for i, (k, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text or "") if valid(k, m[0])]
    return [(k, s, e) for s, _, e, k in sorted(found)]


def listed(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    secrets = planted = 0
    for r in op8_weak_supervision_pii(spark, sf).collect():
        text = texts[r.doc_id]
        base = brute(text)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in base) for x in PLAIN]
        assert r.base_sha256 == hashlib.sha256(listed(base).encode()).hexdigest()
        got = [x.split(":") for x in r.spans.split(",") if x]
        assert listed([x for x in got if x[0] != "secret"]) == listed(base)
        for _, s, e in [x for x in got if x[0] == "secret"]:
            secrets += bool(re.search(r'token = "$', text[: int(s)]) and re.fullmatch("[0-9a-f]+", text[int(s) : int(e)]))
            assert re.search("[0-9]", text[int(s) : int(e)])
        planted += len(re.findall(r'token = "[0-9a-f]{20,}"', text))
    assert planted and secrets == planted


ODD = [
    None, "", "a@b.c_x@y.zz", "a@b.c.d@e.f", "@a.b a@b a@b. é😀 x@y.z", "1.2.3.4.5.6.7.8 256.1.1.1 0001.0255.3.4 1.2.3", "999.1.2.3.4",
    "4111 1111 1111 1111 4111-1111-1111-1112 0 0", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0 1 2", "+1 (555) 123-4567 +44 20 7946 0958. +1 2 +1234567890123456", "++12-3456789012",
    "a" * 30000 + "@", "1" * 30000, "1 " * 20000, "a@" * 5000 + "b.c", "+1" * 5000, "1.2.3." * 3000, "x@y.z " * 600, "😀" * 50 + "4111111111111111",
]


def test_odd_texts(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)] + [(None, "a@b.cc", "x"), (0, None, "y")], "doc_id long, text string, SPANS string")
    rows = pii.find(df, []).collect()
    assert len(rows) == len(ODD) + 2
    for r in rows:
        if r.doc_id is not None:
            assert [(s.kind, s.start, s.end) for s in r.spans] == brute(ODD[r.doc_id]), r.doc_id
    assert pii.find(df.limit(0), []).count() == 0
    assert pii.train(df.limit(0)) == []


def test_expectation_maximisation_recovers_rates():
    counts, prior, rates = {}, 0.3, [(0.9, 0.05), (0.8, 0.1), (0.7, 0.02)]
    for v in [(a, b, c) for a in (False, True) for b in (False, True) for c in (False, True)]:
        yes, no = prior, 1 - prior
        for x, (t, f) in zip(v, rates):
            yes, no = yes * (t if x else 1 - t), no * (f if x else 1 - f)
        counts[v] = round(1_000_000 * (yes + no))
    found, got, posterior = pii.expectation_maximisation(counts, 500)
    assert found == pytest.approx(prior, abs=0.02)
    for a, b in zip(got, rates):
        assert a == pytest.approx(b, abs=0.02)
    assert posterior[True, True, True] > 0.99 > 0.01 > posterior[False, False, False]
    assert pii.expectation_maximisation({})[2] == {}


def test_redact(spark):
    df = spark.createDataFrame([(1, "mail a@b.cc now 10.0.0.1!", 5), (2, None, 5), (3, "clean", 5)], "doc_id long, text string, n int")
    got = {r.doc_id: (r.text, r.n) for r in pii.redact(df, []).collect()}
    assert got == {1: ("mail [EMAIL] now [IP]!", 5), 2: (None, 5), 3: ("clean", 5)}


def test_no_python_in_the_plan(spark, sf):
    plan = op8_weak_supervision_pii(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_long_texts_of_many_spans(spark):
    """A megabyte of two-digit numbers, emails or credentials takes seconds, and its spans are those of the plain patterns."""
    import time

    emails, numbers = " ".join(f"u{i}@h{i % 7}.org" for i in range(75_000)), ", ".join(str(10 + i % 90) for i in range(260_000))
    cards, mixed = "; ".join(["4111 1111 1111 1111"] * 50_000), " ".join(f"a{i}@b.cc key='AKIA{i:016d}'" for i in range(25_000))
    df = spark.createDataFrame([(1, emails), (2, numbers), (3, cards), (4, mixed)], "doc_id long, text string").repartition(4)
    weights = pii.train(spark.createDataFrame([(f"token = \"{i:040x}\" and some ordinary-looking words",) for i in range(50)], "text string"))
    pii.find(df.limit(0), weights).collect()
    start = time.time()
    got = {r.doc_id: r for r in pii.find(df, weights).collect()}
    clean = {r.doc_id: r.text for r in pii.redact(df, weights).collect()}
    assert time.time() - start < 60
    for i, text in enumerate((emails, numbers, cards, mixed), 1):
        assert [(s.kind, s.start, s.end) for s in got[i].spans if s.kind != "secret"] == brute(text)
    assert len(got[1].spans) == 75_000 and len(got[3].spans) == 50_000 and not got[2].spans
    assert clean[1] == " ".join(["[EMAIL]"] * 75_000) and clean[2] == numbers and clean[3] == "; ".join(["[CARD]"] * 50_000)


def test_overlaps_and_redaction_against_brute_force(spark):
    """Secrets that overlap a base span go; marks stand where spans that begin inside another don't; every place is in code points."""
    import random

    rng, parts = random.Random(3), ["a@b.cc", "4111111111111111", "x" * 20 + "1", "é😀", " ", "\n", ".", "+1 555 123 4567", "10.0.0.1", "token='", "'"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 400))) for _ in range(60)]
    weights = [0.0] * len(pii.FEATURES) + [1.0]  # every candidate is a secret
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.find(df, weights).collect()}
    clean = {r.doc_id: r.text for r in pii.redact(df, weights).collect()}
    for i, text in enumerate(texts):
        base = brute(text)
        secrets = [("secret", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9_/+=-]{16,}", text)]
        free = [s for s in secrets if not any(b[1] < s[2] and s[1] < b[2] for b in base)]
        assert got[i] == sorted(base + free, key=lambda s: (s[1], pii.KINDS.index(s[0]), s[2]))
        out, at = "", 0
        for kind, start, end in got[i]:
            if start >= at:
                out += text[at:start] + f"[{kind.upper()}]"
            at = max(at, end)
        assert clean[i] == out + text[at:]
