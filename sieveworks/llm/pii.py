"""Personal data: base patterns, and credentials found by weak supervision.

Emails, IP addresses, card and phone numbers are matched by fixed patterns.
Credentials have no fixed shape: three labelers (a pattern for the value, a
gazetteer of issuer prefixes and credential names, the context before it) vote
on every candidate; expectation-maximisation estimates from the counts of vote
patterns how reliable each labeler is, and a logistic classifier of the
candidates' features, trained on the posteriors, has the last word.

All that touches texts is a DataFrame expression.  What comes to the driver are
counts of feature patterns, at most 2**14 rows however large the corpus, and of
vote patterns, at most 2**3.  The labelers share nothing: one looks at the value's
shape, one at lists of names, one at the punctuation before it.

Places and overlaps are running sums, maxima and minima of arrays, by doubling:
n spans of a text cost about n * log(n), and a text is cut by blocks of it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveworks.llm.common import pick

# Patterns that match what the plain forms in the comments match, but without
# backtracking into runs (possessive) and without starts inside a run that has
# already failed (\G is the end of the last match), so long runs cost linear time.
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+, of these only the whole matches of 14 to 19 digits
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){13,18}+(?![\x20-]?[0-9])",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
KINDS = ("email", "ip", "card", "phone", "secret")
CANDIDATE = r"(?:\G|(?<![A-Za-z0-9_/+=-]))[A-Za-z0-9_/+=-]{16,}+"
BLOCK = 1024  # characters that a text is cut from at once
BEFORE = 32  # characters before a candidate that the labelers look at
# How values of known issuers begin, and what credentials are called.
PREFIXES = r"^(AKIA|ASIA|ghp_|gho_|github_pat_|glpat-|sk-|pk_live_|sk_live_|xox[abprs]-|AIza|eyJ)"
NAMES = r"(?i)(token|secret|passw(or)?d|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth|bearer|credential)[\"']?\s*[:=]?\s*[\"']?$"
VOTERS = ("by_pattern", "by_gazetteer", "by_context")
FEATURES = ("hex", "long", "mixed", "letters_only", "digits_only", "known_prefix", "assigned", "quoted", "named", "both_cases", "wordlike", "very_long", "separated", "padded")
ROUNDS = 50
END = (1 << 31) - 1  # beyond any place


def bound(value: Column, use) -> Column:
    """use(value), with value computed once however often use names it, also inside its lambdas."""
    return F.get(F.transform(F.array(value), use), 0)


def running(values: Column, joined, zero: int) -> Column:
    """What joined makes of all values up to each place (sums, maxima, minima), in log(n) passes over the array.

    After the pass of step s each place has what 2**(s+1) values make up."""

    def of(v: Column) -> Column:
        passes = F.when(F.size(v) > 1, F.sequence(F.lit(0), F.ceil(F.log2(F.size(v))).cast("int"))).otherwise(F.from_json(F.lit("[]"), "array<int>"))
        shifted = lambda acc, s: F.slice(F.concat(F.array_repeat(F.lit(zero), F.least(F.pow(F.lit(2), s).cast("int"), F.size(acc))), acc), 1, F.size(acc))
        return F.reduce(passes, v, lambda acc, s: F.zip_with(acc, shifted(acc, s), joined))

    return bound(values, of)


def blocks_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % BLOCK), F.lit(0))


def cut(blocks: Column, start: Column, n: Column) -> Column:
    """n characters from `start` on, from the blocks of a text: the cost is that of the blocks they lie in."""
    first, last = (F.floor(x / BLOCK).cast("int") for x in (start, start + F.greatest(n, F.lit(1)) - 1))
    return F.substring(F.array_join(F.slice(blocks, first + 1, last - first + 1), ""), start - first * BLOCK + 1, n)


def hits(text: Column, pattern: str, needs: str | None = None) -> Column:
    """Leftmost non-overlapping matches as an array of structs (start, end, hit), in code points.

    Places are the running lengths of what stands between matches and of the matches.
    needs: a string that every match has.  Null: none.
    """

    def of(v: Column) -> Column:
        lengths = F.zip_with(v["found"], F.slice(v["between"], 1, F.size(v["found"])), lambda h, b: F.length(b) + F.length(h))
        return F.zip_with(running(lengths, lambda a, b: a + b, 0), v["found"], lambda end, h: F.struct((end - F.length(h)).alias("start"), end.alias("end"), h.alias("hit")))

    out = bound(F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("between")), of)
    empty = F.from_json(F.lit("[]"), "array<struct<start:int,end:int,hit:string>>")
    return F.when(text.contains(needs) if needs else text.isNotNull(), out).otherwise(empty)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    marks = F.split(F.reverse(digits), "")
    total = F.aggregate(
        F.transform(marks, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2))),
        F.lit(0),
        lambda a, d: a + d,
    )
    return total % 10 == 0


def _valid(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(hit, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.lpad(F.ltrim(p, F.lit("0")), 3, "0") <= "255"))
    if kind == "card":
        digits = _digits(hit)
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(hit)).between(10, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    found = hits(text, PATTERNS[kind], NEEDS.get(kind))
    if kind == "card":  # the pattern needs digits, most texts have none
        found = F.when(text.rlike("[0-9]"), found).otherwise(F.from_json(F.lit("[]"), "array<struct<start:int,end:int,hit:string>>"))
    return F.filter(found, lambda x: _valid(kind, x["hit"]))


def candidates(text: Column) -> Column:
    """Credential candidates as structs (start, end, hit, before); the labelers and features need nothing else."""
    empty = F.from_json(F.lit("[]"), "array<struct<start:int,end:int,hit:string,before:string>>")

    def of(found: Column) -> Column:
        before = lambda blocks, x: cut(blocks, F.greatest(x["start"] - BEFORE, F.lit(0)), F.least(x["start"], F.lit(BEFORE)))
        out = bound(blocks_of(text), lambda blocks: F.transform(found, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["hit"].alias("hit"), before(blocks, x).alias("before"))))
        return F.when(F.size(found) > 0, out).otherwise(empty)

    return bound(hits(text, CANDIDATE), of)


def features(x: Column) -> dict[str, Column]:
    hit, before = x["hit"], x["before"]
    return {
        "hex": hit.rlike("^([0-9a-f]+|[0-9A-F]+)$") & hit.rlike("[0-9]") & hit.rlike("[A-Fa-f]"),
        "long": F.length(hit) >= 32,
        "mixed": hit.rlike("[0-9]") & hit.rlike("[A-Za-z]"),
        "letters_only": hit.rlike("^[A-Za-z_-]+$"),
        "digits_only": hit.rlike("^[0-9-]+$"),
        "known_prefix": hit.rlike(PREFIXES),
        "assigned": before.rlike("[:=]\\s*[\"']?$"),
        "quoted": before.rlike("[\"']$"),
        "named": before.rlike(NAMES),
        "both_cases": hit.rlike("[a-z]") & hit.rlike("[A-Z]"),
        "wordlike": hit.rlike("[A-Za-z][a-z]{5}"),
        "very_long": F.length(hit) >= 64,
        "separated": hit.rlike("[_/+-]"),
        "padded": hit.endswith("="),
    }


def votes(f: dict[str, Column]) -> dict[str, Column]:
    return {
        "by_pattern": (f["hex"] | f["mixed"]) & f["long"],
        "by_gazetteer": f["known_prefix"] | f["named"],
        "by_context": f["assigned"] | f["quoted"],
    }


def expectation_maximisation(counts: dict[tuple, int], rounds: int = ROUNDS) -> tuple[float, list[tuple[float, float]], dict[tuple, float]]:
    """Of counts by vote pattern: the share of true candidates, each labeler's (hit rate, false alarm rate), posteriors.

    Starts from the majority; rates are smoothed by one pseudo-count.  Which of
    the two classes is which is told at the end by the sum of the labelers' rates.
    """
    n = len(next(iter(counts), ()))
    posterior = {v: 0.9 if 2 * sum(v) > n else 0.1 if sum(v) else 0.01 for v in counts}
    prior, rates = 0.5, [(0.9, 0.1)] * n
    for _ in range(rounds if counts else 0):
        yes = sum(c * posterior[v] for v, c in counts.items())
        no = sum(c * (1 - posterior[v]) for v, c in counts.items())
        prior = (yes + 1) / (yes + no + 2)
        rates = []
        for i in range(n):
            true = (sum(c * posterior[v] for v, c in counts.items() if v[i]) + 1) / (yes + 2)
            false = (sum(c * (1 - posterior[v]) for v, c in counts.items() if v[i]) + 1) / (no + 2)
            rates.append((true, false))
        for v in counts:
            odds = math.log(prior / (1 - prior))
            for x, (true, false) in zip(v, rates):
                odds += math.log(true / false) if x else math.log((1 - true) / (1 - false))
            posterior[v] = 1 / (1 + math.exp(-max(-60.0, min(60.0, odds))))
    if sum(true - false for true, false in rates) < 0:
        prior, rates, posterior = 1 - prior, [(false, true) for true, false in rates], {v: 1 - p for v, p in posterior.items()}
    return prior, rates, posterior


def logistic(rows: list[tuple[tuple, float, float]], rounds: int = 400, rate: float = 1.0, decay: float = 1e-4) -> list[float]:
    """Weights and bias from (features, weight, soft label) by gradient descent, rows in any order."""
    if not rows:
        return []
    rows = sorted(rows)
    n, total = len(rows[0][0]), sum(w for _, w, _ in rows)
    weights = [0.0] * (n + 1)
    for _ in range(rounds):
        slope = [0.0] * (n + 1)
        for f, w, y in rows:
            z = weights[n] + sum(a for a, b in zip(weights, f) if b)
            error = w * (1 / (1 + math.exp(-max(-60.0, min(60.0, z)))) - y)
            for i, x in enumerate((*f, True)):
                slope[i] += error * x
        weights = [a - rate * (s / total + decay * a) for a, s in zip(weights, slope)]
    return weights


def train(documents: DataFrame) -> list[float]:
    """The span classifier's weights, from counts of vote and feature patterns over all candidates of (text).

    Without a candidate the list is empty and the classifier accepts nothing.
    Feature patterns are weighted by the square root of their counts, so that
    common harmless words don't drown rare credentials.
    """
    rows = pick(documents, text="string").select(F.explode(candidates(F.coalesce("text", F.lit("")))).alias("x"))
    f = features(F.col("x"))
    rows = rows.select(*[c.alias(n) for n, c in f.items()])
    v = votes({n: F.col(n) for n in FEATURES})
    counted = rows.groupBy(*FEATURES).agg(F.count("*").alias("n")).select(*FEATURES, *[c.alias(n) for n, c in v.items()], "n").collect()
    patterns: dict[tuple, int] = {}
    for r in counted:
        key = tuple(r[x] for x in VOTERS)
        patterns[key] = patterns.get(key, 0) + r["n"]
    _, _, posterior = expectation_maximisation(patterns)
    return logistic([(tuple(r[x] for x in FEATURES), math.sqrt(r["n"]), posterior[tuple(r[x] for x in VOTERS)]) for r in counted])


def accepted(x: Column, weights: list[float]) -> Column:
    if not weights:
        return F.lit(False)
    z = F.lit(weights[-1])
    for (_, f), w in zip(features(x).items(), weights):
        z = z + F.when(f, w).otherwise(0.0)
    return z > 0


def spans_of(text: Column, weights: list[float]) -> Column:
    """All spans of a text that isn't null: structs (start, rank, end, kind, hit), sorted; rank is the kind's place in KINDS."""

    def ranked(spans: Column, kind: str) -> Column:
        return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), x["end"].alias("end"), F.lit(kind).alias("kind"), x["hit"].alias("hit")))

    base = F.concat(*[ranked(base_spans(text, kind), kind) for kind in KINDS[:4]])
    secret = ranked(F.filter(candidates(text), lambda x: accepted(x, weights)), "secret")
    return bound(F.struct(F.array_sort(base).alias("base"), secret.alias("secret")), _together)


def _together(v: Column) -> Column:
    """The base spans and those secrets that overlap none of them, sorted."""
    secret = KINDS.index("secret")

    def of(spans: Column) -> Column:
        ends = running(F.transform(spans, lambda x: F.when(x["rank"] == secret, F.lit(0)).otherwise(x["end"])), lambda a, b: F.greatest(a, b), 0)
        starts = F.transform(F.reverse(spans), lambda x: F.when(x["rank"] == secret, F.lit(END)).otherwise(x["start"]))
        around = F.struct(ends.alias("ends"), F.reverse(running(starts, lambda a, b: F.least(a, b), END)).alias("starts"))
        free = lambda a, x, i: (x["rank"] != secret) | ((F.get(a["ends"], i) <= x["start"]) & (F.get(a["starts"], i) >= x["end"]))
        return bound(around, lambda a: F.filter(spans, lambda x, i: free(a, x, i)))

    both = bound(F.array_sort(F.concat(v["base"], v["secret"])), of)
    return F.when(F.size(v["secret"]) == 0, v["base"]).when(F.size(v["base"]) == 0, v["secret"]).otherwise(both)


def find(documents: DataFrame, weights: list[float]) -> DataFrame:
    """doc_id, text and spans of every row of (doc_id, text).

    spans: array of structs (start, rank, end, kind, hit), sorted; places are in
    code points, ends exclusive.  Kinds may overlap.  A secret that overlaps a
    base span is left out.  A null text counts as empty and has none.  Repeated
    rows come back each, null doc_ids stay null, texts are read whole, extra
    columns are ignored.
    """
    rows = pick(documents, doc_id="long", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    return rows.withColumn("spans", spans_of(F.col("text"), weights))


def redact(rows: DataFrame, weights: list[float]) -> DataFrame:
    """All rows and columns, every span of the column text replaced by its kind in brackets; a null text stays null.

    Overlapping spans merge into the first.
    """
    text = F.col("text")

    def marked(v: Column) -> Column:
        def part(x: Column, i: Column) -> Column:
            before = F.when(i > 0, F.get(v["ends"], i - 1)).otherwise(0)  # where what is done already ends
            mark = F.concat(cut(v["blocks"], before, x["start"] - before), F.lit("["), F.upper(x["kind"]), F.lit("]"))
            return F.when(x["start"] >= before, mark).otherwise("")

        end = F.element_at(v["ends"], -1)
        return F.concat(F.array_join(F.transform(v["spans"], part), ""), cut(v["blocks"], end, F.length(text) - end))

    def clean(spans: Column) -> Column:
        ends = running(F.transform(spans, lambda x: x["end"]), lambda a, b: F.greatest(a, b), 0)
        return F.when(F.size(spans) > 0, bound(F.struct(spans.alias("spans"), ends.alias("ends"), blocks_of(text).alias("blocks")), marked)).otherwise(text)

    return rows.withColumn("text", bound(spans_of(text, weights), clean))
