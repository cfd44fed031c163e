"""Sharding by balanced label propagation, in DataFrame operations only.

Documents of equal texts are linked. They start in the shard of their id's hash; in each round a group's documents turn
to the shard that holds most of them (ties: by hash), as far as that shard's quota has room. At last all documents, ordered by shard and
group, are cut into shards of equal counts (at most one apart), which splits a group only where a quota demands it.
Null texts have size 1, no links and the checksum of an empty text. Repeated rows are documents of their own; a group
of any size is ranked in salted buckets, so none meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymill.session import settle

ROUNDS = 5
#: Rows that are ranked together, and the number of such buckets aimed at for small tables.
MOST_RANKED, BUCKETS = 50_000, 2048


def _share(*columns: Column | str) -> Column:
    """A number in [0, 1) by hash."""
    return F.pmod(F.xxhash64(*columns), F.lit(1_000_003)) / F.lit(1_000_003.0)


def _round(state: DataFrame, number: int, shards: int, quota: float) -> DataFrame:
    held = settle(state.groupBy("key", "copies", "shard").agg(F.count("*").alias("n")), "held")
    goals = held.where("copies > 1").groupBy("key").agg(F.max(F.struct("n", _share("key", "shard").alias("draw"), "shard")).alias("best"))
    goals = settle(goals.select("key", F.col("best.shard").alias("goal")), "goals")
    moves = held.where("copies > 1").join(goals, "key").where("shard != goal")
    came = moves.groupBy(F.col("goal").alias("shard")).agg(F.sum("n").alias("wanted"))
    left = moves.groupBy("shard").agg(F.sum("n").alias("leaving"))
    load = held.groupBy("shard").agg(F.sum("n").alias("load"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    room = F.greatest(F.lit(0.0), F.lit(quota) - zero("load") + zero("leaving"))
    quotas = came.join(load, "shard", "left").join(left, "shard", "left")
    quotas = settle(quotas.select(F.col("shard").alias("goal"), F.least(F.lit(1.0), room / zero("wanted")).alias("taken")), "quotas")
    # A small group moves as a whole; of one that a quota cannot hold, a share moves.
    small = F.col("copies") * shards <= quota
    draw = F.when(small, _share("key", F.lit(number))).otherwise(_share("doc_id", F.lit(number)))
    plans = settle(goals.join(quotas, "goal"), "plans")
    moved = (F.col("goal") != F.col("shard")) & (draw < F.col("taken"))
    return settle(
        state.join(plans, "key", "left").select(
            "doc_id", "size", "text_crc32", "key", "copies", F.when(moved, F.col("goal")).otherwise(F.col("shard")).alias("shard")
        ),
        "state",
    )


def sharding(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law (`rows`), shard, slot and grown_shard (null under this law)."""
    data = F.col("text").cast("binary")
    rows = settle(
        docs.select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce(data, F.lit(b""))).alias("text_crc32"),
            F.coalesce(F.sha2(data, 256), F.concat(F.lit("null "), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("key"),
            F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("shard"),
        ),
        "rows",
    )
    n = rows.count()
    groups = settle(rows.groupBy("key").agg(F.count("*").alias("copies")).where("copies > 1"), "groups")
    state = rows.join(groups, "key", "left").withColumn("copies", F.coalesce("copies", F.lit(1)))
    state = settle(state, "state")
    for number in range(ROUNDS):
        state = _round(state, number, shards, n / shards)
    ranked = max(256, min(MOST_RANKED, n // BUCKETS))
    buckets = max(1, -(-n // (ranked * shards)))
    salts = F.ceil(F.col("copies") / ranked)
    state = state.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets))).withColumn(
        "salt",
        F.when(salts > 1, F.concat_ws(":", "key", F.pmod(F.xxhash64("doc_id", "text_crc32"), salts).cast("string"))).otherwise(""),
    )
    place = ["shard", "bucket", "salt"]
    # One row per bucket: n / ranked of them, and a few more for large groups.
    sums = state.groupBy(*place).agg(F.count("*").alias("n"))
    before = Window.orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    starts = settle(sums.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"), "starts")
    rank = F.row_number().over(Window.partitionBy(*place).orderBy("key", "doc_id"))
    placed = state.withColumn("rank", rank).join(starts, place).withColumn("at", F.col("start") + F.col("rank") - 1)
    # The first n % shards shards hold one row more.
    small, more = n // shards, n % shards
    edge = more * (small + 1)
    wide = F.floor(F.col("at") / (small + 1))
    narrow = more + F.floor((F.col("at") - edge) / max(1, small))
    shard = F.when(F.col("at") < edge, wide).otherwise(narrow)
    first = F.when(F.col("at") < edge, wide * (small + 1)).otherwise(edge + (narrow - more) * small)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        shard.cast("int").alias("shard"),
        (F.col("at") - first).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
