"""Embedding near-dedup by iterative quantisation.

Rotations learned on a bounded sample turn vectors into balanced binary codes. Vectors of each length have rotations and
an index of their own; those of a rare length are turned at random, which keeps the angles' bits as well. Codes are cut into blocks, each a table of
a multi-index; blocks that differ in one bit at most retrieve candidates, and the original vectors decide by cosine in
double precision. Equal vectors form one class first. Null, zero and non-finite vectors link with nothing. Of rows that
share a vec_id the smallest vector counts, and each row is returned.

The driver gets rotations, not vectors. Joins with probes, links or vectors are never broadcast joins: the planner takes an
exploded table to be as large as what it came from (17 times too small for the probes), and a written one as large as its
file, where repeated ids and numbers take little.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.llm.components import components
from tallymill.session import settle

COSINE = 0.9
FIT_VECTORS = 10_000
CODES, BITS, BLOCK = 2, 64, 16
STEPS = 30
#: The most frequent lengths, for which rotations are learned from a sample each.
LEARNED_LENGTHS = 8
#: Differing bits of the first code beyond which a candidate is not compared; 0.9 has 9.2 on average, 2.8 deviation.
MOST_BITS = 21


def learn(sample: np.ndarray, seed: int) -> np.ndarray:
    """Projection to the main axes and the rotation that brings the codes nearest to them (dims by bits)."""
    rng = np.random.default_rng(seed)
    dims = sample.shape[1]
    wide = min(BITS, dims)
    axes = np.linalg.eigh(sample.T @ sample)[1][:, ::-1][:, :wide]
    data = sample @ axes
    turn = np.linalg.qr(rng.normal(size=(wide, wide)))[0]
    for _ in range(STEPS):
        u, _, v = np.linalg.svd(np.sign(data @ turn).T @ data)
        turn = (u @ v).T
    return axes @ turn


def usable(vector) -> bool:
    if vector is None:
        return False
    v = np.asarray(vector, dtype=float)
    return bool(len(v) and np.isfinite(v).all() and np.any(v))


@lru_cache(maxsize=16)
def drawn_turn(dims: int, seed: int) -> np.ndarray:
    """Random directions for vectors of a length without a sample (dims by bits)."""
    return np.random.default_rng([dims, seed]).normal(size=(dims, BITS))


def learned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rotations, by seed, from a sample (hash, embedding) of vectors of one length."""
    rows = [row for batch in batches for row in zip(batch["hash"], batch["embedding"], strict=True)]
    good = [np.asarray(v, dtype=float) for _, v in sorted(rows, key=lambda row: row[0]) if usable(v)]
    if good:
        x = np.array([v / np.linalg.norm(v) for v in good])
        yield pd.DataFrame({"seed": range(CODES), "turn": [learn(x, seed).tobytes() for seed in range(CODES)]})


def learned_turns(classes: DataFrame) -> dict[int, list[np.ndarray]]:
    """Rotations by length, for the most frequent lengths that have as many vectors as numbers in one. Those of the
    FIT_VECTORS smallest hashes are a length's sample, found by their hashes alone; one task learns from it."""
    common = classes.groupBy("dims").count().where("dims > 0 and count >= dims")
    out = {}
    for r in common.orderBy(F.desc("count"), "dims").limit(LEARNED_LENGTHS).collect():
        hashed = classes.where(F.col("dims") == r["dims"]).withColumn("hash", F.xxhash64("vec_id"))
        last = hashed.select("hash").orderBy("hash").limit(FIT_VECTORS).agg(F.max("hash")).first()[0]
        drawn = hashed.where(F.col("hash") <= last).select("hash", "embedding").repartition(1)
        if turns := drawn.mapInPandas(learned, "seed int, turn binary").collect():
            out[r["dims"]] = [np.frombuffer(t["turn"]).reshape(r["dims"], -1) for t in sorted(turns)]
    return out


def coded(vectors: DataFrame, turns: dict[int, list[np.ndarray]]) -> DataFrame:
    """vec_id, length and codes of every usable vector."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[[usable(v) for v in batch["embedding"]]]
            for dims, part in batch.groupby(batch["embedding"].map(len)):
                x = np.array([np.asarray(v, dtype=float) for v in part["embedding"]]).reshape(len(part), -1)
                codes = []
                for turn in turns.get(dims) or [drawn_turn(dims, seed) for seed in range(CODES)]:
                    bits = np.zeros((len(x), BITS), np.uint8)
                    bits[:, : turn.shape[1]] = x @ turn > 0
                    codes.append(np.packbits(bits, axis=1).view(np.int64).reshape(-1))
                yield pd.DataFrame({"vec_id": part["vec_id"], "dims": dims, "codes": list(np.array(codes).T.reshape(-1, CODES))})

    return vectors.mapInPandas(run, "vec_id long, dims int, codes array<long>")


def near_vectors(rows: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept."""
    rows = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    unique = rows.where("vec_id is not null").groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    # Classes of equal vectors; the smallest id stands for each.
    classes = settle(
        unique.where("embedding is not null")
        .groupBy("embedding")
        .agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
        .withColumn("dims", F.size("embedding")),
        "classes",
    )
    codes = settle(coded(classes.select("vec_id", "embedding"), learned_turns(classes)), "codes")
    mask = (1 << BLOCK) - 1
    blocks = [
        F.struct(
            F.lit(c * 4 + k).alias("of"),
            F.shiftrightunsigned(F.col("codes")[c], BLOCK * k).bitwiseAND(F.lit(mask)).alias("value"),
        )
        for c in range(CODES)
        for k in range(BITS // BLOCK)
    ]
    index = codes.select("vec_id", "dims", F.col("codes")[0].alias("code"), F.explode(F.array(*blocks)).alias("block"))
    index = settle(index.select("vec_id", "dims", "code", "block.of", "block.value"), "index")
    flips = F.array(F.lit(0), *(F.lit(1 << k) for k in range(BLOCK)))
    probes = index.withColumn("flip", F.explode(flips)).select(
        F.col("vec_id").alias("a"), "dims", F.col("code").alias("code_a"), "of", F.col("value").bitwiseXOR(F.col("flip")).alias("value")
    )
    pairs = (
        probes.hint("merge")
        .join(index, ["dims", "of", "value"])
        .where((F.col("a") < F.col("vec_id")) & (F.bit_count(F.col("code_a").bitwiseXOR(F.col("code"))) <= MOST_BITS))
        .select("a", F.col("vec_id").alias("b"))
        .distinct()
    )

    @F.pandas_udf("double")
    def cosine(x: pd.Series, y: pd.Series) -> pd.Series:
        def one(p, q):
            p, q = np.asarray(p, dtype=float), np.asarray(q, dtype=float)
            return float(p @ q / (np.sqrt(p @ p) * np.sqrt(q @ q)))

        return pd.Series([one(p, q) for p, q in zip(x, y, strict=True)], dtype=float)

    of = classes.select("vec_id", "embedding").hint("merge")
    both = pairs.join(of.select(F.col("vec_id").alias("b"), F.col("embedding").alias("y")), "b").join(
        of.select(F.col("vec_id").alias("a"), F.col("embedding").alias("x")), "a"
    )
    links = settle(both.where(cosine("x", "y") >= COSINE).select("a", "b"), "links")
    ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    size = classes.select(F.col("vec_id").alias("b"), "copies")
    near = ends.hint("merge").join(size, "b").groupBy(F.col("a").alias("class")).agg(F.sum("copies").alias("near"))
    groups = components(links).withColumnRenamed("node", "class")
    good_class = classes.join(codes.select("vec_id"), "vec_id", "left_semi")
    good_class = good_class.select(F.col("vec_id").alias("class"), "copies", "embedding")
    named = unique.join(good_class.hint("merge"), "embedding", "left")
    named = named.join(near, "class", "left").join(groups, "class", "left")
    out = named.select(
        "vec_id",
        F.coalesce(F.col("copies") - 1 + F.coalesce("near", F.lit(0)), F.lit(0)).alias("n_links"),
        F.coalesce("component", "class", "vec_id").alias("component_id"),
    )
    found = rows.select("vec_id").join(out, "vec_id", "left")
    return found.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept")
    )
