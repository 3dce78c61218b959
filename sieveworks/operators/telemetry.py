"""Progress and telemetry of runs: counts that are taken while rows pass, without a job of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def observed(rows: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """SNK-12: rows, and an observation whose get has n and the metrics once an action on them is done."""
    observation = Observation(name)
    return rows.observe(observation, F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in metrics.items()]), observation


def percentage(done: Column, total: Column) -> Column:
    """PRJ-14: done of total in per cent, to one place; 100 where there is nothing to do."""
    return F.when(total > 0, F.round(100.0 * done / total, 1)).otherwise(100.0)


def progress_line(name: str, done: int, total: int) -> str:
    share = 100.0 * done / total if total > 0 else 100.0
    return f"{name}: {done}/{total} ({share:.1f}%)"
