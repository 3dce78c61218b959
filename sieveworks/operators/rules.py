"""Rejection: exclusion rules and lints as columns, the first reason that applies, counts of reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveworks.functions import text

# Tokens that no positive prompt may have, the least number of tokens, and what has to be filled in.
BANNED = ("lowres", "bad anatomy", "bad hands", "text", "error", "worst quality", "low quality", "normal quality", "jpeg artifacts", "signature", "watermark", "username", "blurry", "ugly", "duplicate", "mutation", "deformed", "disfigured")
MIN_TOKENS = 8
NEEDED = ("subject", "eyes", "hair_color", "hair_style", "expression")
FIELDS = ("id", "positive_prompt", "negative_prompt", "shard_id", "seed")
TEXT_FIELDS = FIELDS[:3]
CONTRADICTIONS = (("closed mouth", "laughing"),)


def violations(tests: dict[str, Column]) -> Column:
    """The messages whose test holds, in order."""
    return F.filter(F.array(*[F.when(test, message) for message, test in tests.items()]), lambda m: m.isNotNull()) if tests else F.array().cast("array<string>")


def incompatible(rules: list[dict], columns: list[str]) -> Column:
    """FLT-1: whether any rule's two values stand together; a rule on an unknown or array component never applies."""
    out = F.lit(False)
    for r in rules:
        if r["component_a"] in columns and r["component_b"] in columns:
            out = out | F.coalesce((F.col(r["component_a"]) == r["value_a"]) & (F.col(r["component_b"]) == r["value_b"]), F.lit(False))
    return out


def compatible(rows: DataFrame, rules: DataFrame, components: list[str]) -> DataFrame:
    """FLT-1 for rule tables of any size: rows that no rule (component_a, value_a, component_b, value_b) excludes.

    Only pairs of components that some rule names are looked at (at most the square
    of the number of components); a row's pairs are joined to the rules by all four
    values.
    """
    keys = ["component_a", "value_a", "component_b", "value_b"]
    named = [(r[0], r[1]) for r in rules.select("component_a", "component_b").distinct().collect() if r[0] in components and r[1] in components]
    if not named:
        return rows
    pairs = F.array(*[F.struct(F.lit(a).alias("component_a"), F.col(a).alias("value_a"), F.lit(b).alias("component_b"), F.col(b).alias("value_b")) for a, b in sorted(named)])
    numbered = rows.withColumn("_row", F.struct(*rows.columns))
    hit = numbered.select("_row", F.explode(pairs).alias("p")).select("_row", "p.*").join(rules.select(*keys).distinct(), keys, "left_semi").select("_row").distinct()
    return numbered.join(hit, "_row", "left_anti").drop("_row")


def component_lint() -> Column:
    """FLT-2: missing components; null and empty are missing."""
    return violations({f"missing {n}": F.coalesce(F.col(n), F.lit("")) == "" for n in NEEDED})


def positive_lint(tokens: Column, banned=BANNED, least: int = MIN_TOKENS) -> Column:
    """FLT-3: banned tokens, sorted, and too few tokens (empty ones count)."""
    found = F.array_intersect(F.array(*[F.lit(b) for b in sorted(banned)]), tokens)
    told = F.transform(found, lambda t: F.concat(F.lit("banned token in positive prompt: '"), t, F.lit("'")))
    few = F.when(F.size(tokens) < least, F.array(F.concat(F.lit("too few tokens: "), F.size(tokens).cast("string"), F.lit(f" < {least}"))))
    return F.concat(told, F.coalesce(few, F.array().cast("array<string>")))


def semantic_lint(tokens: Column, contradictions=CONTRADICTIONS) -> Column:
    """FLT-4."""
    return violations({f"contradiction: {a} with {b}": F.array_contains(tokens, a) & F.array_contains(tokens, b) for a, b in contradictions})


def field_lint(fields=FIELDS, texts=TEXT_FIELDS) -> Column:
    """FLT-5: missing (null) and empty (blank) fields."""
    tests: dict[str, Column] = {}
    for f in fields:
        tests[f"missing field: {f}"] = F.col(f).isNull()
        if f in texts:
            tests[f"empty field: {f}"] = text.strip(F.col(f)) == ""
    return violations(tests)


def first_reason(tests: dict[str, Column]) -> Column:
    """The first reason whose test holds, or null: CASE WHEN stops there, as the chain of checks does."""
    out = None
    for reason, test in tests.items():
        out = F.when(test, reason) if out is None else out.when(test, reason)
    return out if out is not None else F.lit(None).cast("string")


def reason_counts(rows: DataFrame, reason: str = "reason") -> DataFrame:
    """AGG-5: (reason, n) of rejected rows, the most frequent first."""
    return rows.where(F.col(reason).isNotNull()).groupBy(reason).agg(F.count("*").alias("n")).orderBy(F.desc("n"), reason)
