import hashlib
import random

import pytest
from pyspark.sql import functions as F

from sieveworks.functions import draws
from sieveworks.operators import dedup, rules

OPTIONS = [("a", 1.0), ("b", 0.5), ("c", 0.0), ("d", 3.5)]


def test_weighted_marginals_and_partition_invariance(spark):
    n = 20_000
    results = []
    for parts in (1, 7, 32):
        df = spark.range(n).repartition(parts).select("id", draws.weighted(F.col("id"), OPTIONS).alias("v"))
        results.append({r.id: r.v for r in df.collect()})
    assert results[0] == results[1] == results[2]
    for v, (mean, deviation) in draws.expected_draws(OPTIONS, n).items():
        assert abs(sum(x == v for x in results[0].values()) - mean) <= 4 * deviation


def test_subset_has_different_sorted_options(spark):
    options = [("a", 1.0), ("b", 0.5), ("d", 3.5), ("e", 0.1), ("f", 1.0), ("g", 1.0)]
    rows = spark.range(4000).select(draws.weighted_subset(F.col("id"), options).alias("s")).collect()
    sizes = [len(r.s) for r in rows]
    assert all(list(r.s) == sorted(set(r.s)) for r in rows) and set(sizes) == {3, 4, 5, 6}
    rng = random.Random(1)

    def loop(n):
        got = set()
        while len(got) < n:
            got.add(rng.choices([v for v, _ in options], [w for _, w in options])[0])
        return got

    want = [loop(3) for _ in range(4000)]
    for v, _ in options:
        mine = [v in r.s for r in rows if len(r.s) == 3]
        assert abs(sum(mine) / len(mine) - sum(v in w for w in want) / 4000) < 0.06
    with pytest.raises(ValueError):
        draws.weighted_subset(F.lit(1), OPTIONS)
    with pytest.raises(ValueError):
        draws.weighted(F.lit(1), [])


def test_shard_seeds_like_python(spark):
    got = [r.s for r in spark.range(50).select(draws.shard_seed(F.lit(42), F.col("id")).alias("s")).collect()]
    assert got == [int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16) for i in range(50)]


def sequential(rows, plan):
    """(cuts, accepted) of a run over shards in order, or None if candidates run out."""
    seen, cuts, out = set(), {}, []
    for shard, wanted in sorted(plan.items()):
        cuts[shard], n = -1, 0
        for attempt, h in sorted((a, h) for s, a, h in rows if s == shard):
            if n == wanted:
                break
            cuts[shard] = attempt
            if h is not None and h not in seen:
                seen.add(h)
                out.append((shard, attempt, h, n))
                n += 1
        if n < wanted:
            return None
    return cuts, sorted(out)


@pytest.mark.parametrize("seed", range(6))
def test_fixpoint_against_a_sequential_run(spark, seed):
    rng = random.Random(seed)
    n_shards = rng.randrange(1, 6)
    rows = [(s, a, rng.choice([None, *"abcdefghijklmnopqrstuvwxyz"[: rng.randrange(8, 26)]])) for s in range(n_shards) for a in range(40)]
    plan = {s: rng.randrange(0, 4) for s in range(n_shards)}
    df = spark.createDataFrame(rows, "shard_id long, attempt long, hash string")
    cuts, accepted = dedup.consumed(df, spark.createDataFrame(list(plan.items()), "shard_id long, wanted long"))
    want = sequential(rows, plan)
    if want is None:
        assert cuts is None
    else:
        assert {r.shard_id: r.cut for r in cuts.collect()} == want[0]
        assert sorted((r.shard_id, r.attempt, r.hash, r.record_idx) for r in accepted.collect()) == want[1]


def test_exhausted_slots(spark):
    """A slot of two attempts: gaps of 0, 1, 2, 5 rejections give up 0, 0, 1, 2 slots."""
    df = spark.createDataFrame([(0, a) for a in (0, 2, 5, 11)], "shard_id long, attempt long")
    assert dedup.exhausted_slots(df, 2).first().exhausted == 3


def test_keep_first_with_null_keys_and_ties(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (0, "b")], "id long, k string")
    assert sorted(r.id for r in dedup.keep_first(df, "k", ["id"]).collect()) == [0, 1, 3]


def test_lints(spark):
    df = spark.createDataFrame([("x", None, "", "s", "e"), ("x", "y", "z", "s", "e")], "subject string, eyes string, hair_color string, hair_style string, expression string")
    assert [list(r.v) for r in df.select(rules.component_lint().alias("v")).collect()] == [["missing eyes", "missing hair_color"], []]
    tokens = F.split(F.lit("blurry|a|text|b"), r"\|")
    got = spark.range(1).select(rules.positive_lint(tokens).alias("v")).first().v
    assert got == ["banned token in positive prompt: 'blurry'", "banned token in positive prompt: 'text'", "too few tokens: 4 < 8"]
    tokens = F.split(F.lit("laughing|closed mouth"), r"\|")
    assert spark.range(1).select(rules.semantic_lint(tokens).alias("v")).first().v == ["contradiction: closed mouth with laughing"]
    df = spark.createDataFrame([(None, " \t", "n", None, 1)], "id string, positive_prompt string, negative_prompt string, shard_id int, seed long")
    assert df.select(rules.field_lint().alias("v")).first().v == ["missing field: id", "empty field: positive_prompt", "missing field: shard_id"]


def test_exclusions_with_unknown_and_null(spark):
    listed = [{"component_a": "a", "value_a": "1", "component_b": "b", "value_b": "2"}, {"component_a": "zz", "value_a": "1", "component_b": "b", "value_b": "9"}]
    df = spark.createDataFrame([("1", "2"), ("1", None), (None, "2"), ("2", "2"), ("1", "9")], "a string, b string")
    want = [("1", None), ("1", "9"), ("2", "2"), (None, "2")]
    key = lambda r: (r[0] or "~", r[1] or "")
    assert sorted(map(tuple, df.where(~rules.incompatible(listed, df.columns)).collect()), key=key) == want
    table = spark.createDataFrame([tuple(r.values()) for r in listed], "component_a string, value_a string, component_b string, value_b string")
    assert sorted(map(tuple, rules.compatible(df, table, ["a", "b"]).collect()), key=key) == want
