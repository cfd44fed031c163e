"""Whole-column statistics whose memory stays bounded however large the column is."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymill.session import settle

# Distinct values that one task may sort.
MEDIAN_DISTINCT_LIMIT = 1_000_000
_FAN_OUT = 64
_SKETCH_ACCURACY = 10_000


def exact_median(
    df: DataFrame, column: str, distinct_limit: int = MEDIAN_DISTINCT_LIMIT
) -> float | None:
    """Exact median of a numeric column, nulls and NaNs ignored, middle pair averaged.

    A plain ``median`` holds every distinct value in one task. Here the column is read once, to
    count its distinct values, combined before the shuffle, so a value in a third of all rows
    costs nothing. The counts are written. While the part of them that holds the middle is more
    than one task should sort, quantiles of the distinct values cut it about thirtyfold.
    """
    value = F.col(column).cast("double")
    counts = settle(
        df.select(value.alias("v"))
        .where(F.col("v").isNotNull() & ~F.isnan("v"))
        .groupBy("v")
        .agg(F.count("*").alias("n")),
        f"{column}-counts",
    )
    size = counts.agg(F.sum("n").alias("rows"), F.count("*").alias("distinct")).first()
    if not size["rows"]:
        return None
    ranks = ((size["rows"] - 1) // 2, size["rows"] // 2)
    inside, distinct, below = counts, size["distinct"], 0

    while distinct > distinct_limit:
        shares = [i / _FAN_OUT for i in range(1, _FAN_OUT)]
        cuts = sorted(
            set(inside.agg(F.percentile_approx("v", shares, _SKETCH_ACCURACY)).first()[0])
        )
        upto = inside.agg(*[F.sum(F.when(F.col("v") <= cut, F.col("n"))) for cut in cuts]).first()
        reached = [(cut, below + (rows or 0)) for cut, rows in zip(cuts, upto)]
        before = [(cut, rows) for cut, rows in reached if rows <= ranks[0]]
        after = [cut for cut, rows in reached if rows > ranks[1]]
        if before:
            low, below = before[-1]
            inside = inside.where(F.col("v") > low)
        if after:
            inside = inside.where(F.col("v") <= after[0])
        left = inside.count()
        if left == distinct:
            raise RuntimeError(f"quantiles of {column} did not narrow down its median")
        distinct = left

    # One task sorts what is left, a bounded number of distinct values.
    running = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = inside.withColumn("upto", F.sum("n").over(running))
    middle = upto.agg(
        *[
            F.min(F.when(F.col("upto") > rank - below, F.col("v"))).alias(name)
            for name, rank in zip(("lower", "upper"), ranks)
        ]
    ).first()
    return (middle["lower"] + middle["upper"]) / 2


def modes(df: DataFrame, columns: list[str]) -> dict[str, str | None]:
    """Most frequent non-null value of each column, the smallest one on a tie.

    Every column is counted in one scan and one shuffle of (column, value) counts, which are
    combined before they are sent. Only one row per column comes back.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in columns])
    )
    counts = (
        df.select(pairs.alias("pair"))
        .select("pair.*")
        .where(F.col("value").isNotNull())
        .groupBy("name", "value")
        .count()
    )
    top = counts.groupBy("name").agg(
        F.min_by("value", F.struct(-F.col("count"), F.col("value"))).alias("value")
    )
    found = {row["name"]: row["value"] for row in top.collect()}
    return {c: found.get(c) for c in columns}
