"""What the operators share: column picking, and tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveworks.session import shared_folder as scratch
from sieveworks.session import written as materialize

__all__ = ["materialize", "pick", "scratch"]


def pick(df: DataFrame, **kinds: str) -> DataFrame:
    """The named columns of df, cast to the given types, and nothing else.

    A column is found by its exact name, else by its name without regard to
    case; extra columns, also ones whose names clash, never get in the way.
    Raises ValueError if a column is missing.
    """
    names = df.columns
    folded = [n.lower() for n in names]
    safe = df.toDF(*[f"c{i}" for i in range(len(names))])
    out = []
    for name, kind in kinds.items():
        if name in names:
            at = names.index(name)
        elif name.lower() in folded:
            at = folded.index(name.lower())
        else:
            raise ValueError(f"column {name} is missing; there are {names}")
        out.append(F.col(f"c{at}").cast(kind).alias(name))
    return safe.select(*out)
