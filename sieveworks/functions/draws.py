"""Random draws as functions of a row's key, so that partitioning, retries and order never change them."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

STYLE_SIZES = (3, 6)
SEEDS = (1 << 31) + 1  # seeds run from 0 to 2**31


def hashed(key: Column) -> Column:
    """32 bits of the key's SHA-256 as a long."""
    return F.conv(F.substring(F.sha2(key.cast("string").cast("binary"), 256), 1, 8), 16, 10).cast("long")


def uniform(key: Column) -> Column:
    """A number in (0, 1), never 0, so that it has a logarithm."""
    return (hashed(key) + 0.5) / float(1 << 32)


def shard_seed(base_seed: Column, shard_id: Column) -> Column:
    """GEN-4."""
    return hashed(F.concat_ws(":", base_seed, shard_id))


def sub_seed(base_seed: Column, shard_id: Column, attempt: Column) -> Column:
    """GEN-5: the seed that a candidate is drawn from; the candidate depends on nothing else."""
    return F.pmod(hashed(F.concat_ws(":", base_seed, shard_id, attempt)), F.lit(SEEDS))


def weighted_at(u: Column, options: list[tuple[str, float]]) -> Column:
    """GEN-6: the first option whose cumulative weight exceeds u times the total.

    A chain of comparisons, which compiles; u is best a column of its own, since
    every comparison refers to it.
    """
    if not options or any(w < 0 for _, w in options) or not sum(w for _, w in options) > 0:
        raise ValueError("a weighted draw needs options with a positive total weight")
    total, end, out = sum(w for _, w in options), 0.0, None
    for v, w in options:
        end += w
        test = F.lit(end) > u * F.lit(total)
        out = F.when(test, v) if out is None else out.when(test, v)
    return out.otherwise([v for v, w in options if w > 0][-1])


def weighted(key: Column, options: list[tuple[str, float]]) -> Column:
    return weighted_at(uniform(key), options)


def weighted_subset(key: Column, options: list[tuple[str, float]], sizes: tuple[int, int] = STYLE_SIZES) -> Column:
    """GEN-7: a sorted array of n different options, drawn one after another by weight; n is uniform between the sizes.

    By exponential keys (Efraimidis and Spirakis 2006), which have the same
    distribution as drawing again after repeats.  Raises ValueError if there are
    fewer options with a positive weight than n can be.
    """
    able = [(v, w) for v, w in dict(reversed(options)).items() if w > 0]
    low, high = sizes
    if len(able) < high:
        raise ValueError(f"{high} different options asked of {len(able)}")
    n = F.lit(low) + F.floor(uniform(F.concat_ws(":", key, F.lit("n"))) * (high - low + 1)).cast("int")
    races = F.array(*[F.struct((-F.ln(uniform(F.concat_ws(":", key, F.lit(v)))) / w).alias("t"), F.lit(v).alias("v")) for v, w in sorted(able)])
    return F.array_sort(F.transform(F.slice(F.array_sort(races), F.lit(1), n), lambda r: r["v"]))


def expected_draws(options: list[tuple[str, float]], draws: int) -> dict[str, tuple[float, float]]:
    """Mean and standard deviation of each option's count, for statistical tests."""
    total = sum(w for _, w in options)
    return {v: (draws * w / total, math.sqrt(draws * w / total * (1 - w / total))) for v, w in options}
