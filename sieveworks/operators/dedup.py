"""Near duplicates by canonical hash: keep the first, also where the order of shards and attempts decides."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sieveworks.session import written

MAX_ATTEMPTS = 50  # a slot
MAX_FAILED = 10  # slots a record


def keep_first(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """FLT-6: of rows with an equal key the first in order; a null key is a key.

    min_by over a struct is aggregated before the shuffle, so a frequent key costs
    a row a task; order should be unique.
    """
    names = rows.columns
    first = F.min_by(F.struct(*names), F.struct(*order)).alias("r")
    return rows.groupBy(F.col(key).alias("_key")).agg(first).select("r.*")


def duplicates(rows: DataFrame, key: str) -> DataFrame:
    """(key, n) of keys that more than one row has."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def consumed(candidates: DataFrame, plan: DataFrame) -> tuple[DataFrame | None, DataFrame]:
    """Which candidates a sequential run over shards would consume and accept.

    candidates: shard_id, attempt, hash (null: rejected before).  plan: shard_id,
    wanted.  A candidate is consumed while its shard still wants records, and
    accepted if it is consumed, not rejected, and its hash was not accepted
    before, in order of shard and attempt.

    Returns (cuts, accepted).  cuts: shard_id, cut (the last consumed attempt, -1
    for shards that want nothing), None if the candidates don't suffice.  accepted:
    shard_id, attempt, hash of first occurrences with their place (record_idx).

    A fixpoint: with the cuts of the last round, hashes that an earlier shard has
    up to its cut are duplicates; that gives new cuts, until they stay.  Shard i
    is exact after round i + 1 at the latest.
    """
    first = written(candidates.where("hash IS NOT NULL").groupBy("shard_id", "hash").agg(F.min("attempt").alias("attempt")), "first-of-shard")
    ends = candidates.groupBy("shard_id").agg(F.max("attempt").alias("end"))
    plan = plan.join(ends, "shard_id", "left").select("shard_id", "wanted", F.coalesce("end", F.lit(-1)).cast("long").alias("end"))
    cuts = plan.select("shard_id", F.when(F.col("wanted") > 0, F.col("end")).otherwise(-1).alias("cut"))
    total, different = first.agg(F.count("*"), F.count_distinct("hash")).first()
    by_attempt = Window.partitionBy("shard_id").orderBy("attempt")
    while True:
        if total == different:
            fresh = first
        else:
            live = first.join(cuts, "shard_id").where("attempt <= cut").groupBy("hash").agg(F.min("shard_id").alias("owner"))
            fresh = first.join(live, "hash", "left").where("owner IS NULL OR owner >= shard_id").select("shard_id", "hash", "attempt")
        placed = fresh.withColumn("record_idx", (F.row_number().over(by_attempt) - 1).cast("long"))
        last = placed.join(plan, "shard_id").where("record_idx = wanted - 1").select("shard_id", F.col("attempt").cast("long").alias("cut"))
        short = (F.col("wanted") > 0) & F.col("cut").isNull()  # it may still be filled once earlier shards give hashes back
        cut = F.when(F.col("wanted") > 0, F.coalesce("cut", "end")).otherwise(-1)
        found = written(plan.join(last, "shard_id", "left").select("shard_id", cut.alias("cut"), short.alias("short")), "cuts")
        new = found.select("shard_id", "cut")
        if total == different or not new.exceptAll(cuts).limit(1).count():
            if found.where("short").limit(1).count():
                return None, placed
            accepted = placed.join(plan, "shard_id").where("record_idx < wanted").select("shard_id", "attempt", "hash", "record_idx")
            return new, accepted
        cuts = new


def exhausted_slots(accepted: DataFrame, limit: int = MAX_ATTEMPTS) -> DataFrame:
    """(shard_id, exhausted): slots given up after `limit` rejections, from the gaps between accepted attempts."""
    order = Window.partitionBy("shard_id").orderBy("attempt")
    gap = F.col("attempt") - F.lag("attempt", 1, -1).over(order) - 1
    return accepted.withColumn("gap", gap).groupBy("shard_id").agg(F.sum(F.floor(F.col("gap") / limit)).cast("long").alias("exhausted"))
