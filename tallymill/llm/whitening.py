"""Whitening of embeddings by weighted multiplicity covariance.

Entries become whole numbers x = floor(1024 c) + 100000. Equal x vectors are one distinct vector with a count, found with
map-side counting, so copies are neither shuffled nor multiplied one by one. Sums are exact decimals. Each task centres its
distinct vectors by the exact mean, scales them by the square roots of their fit weights (counts, or one each) and
multiplies them by themselves; the partial products are added up entry by entry. Unit eigenvectors of the covariance, by
falling eigenvalue, whiten each distinct vector once, and a join by x gives the result back to all rows.

Vectors of each length are a fit list of their own; nothing is gathered but one length's covariance in one task, whose size
is the square of the length and doesn't grow with the table. Vectors that are null, empty, hold a null or non-finite entry,
or one whose x doesn't fit 63 bits, are dropped. Rows that repeat come out as often as they go in, null ids too; other
columns are ignored; an empty table gives none. Directions without spread (one distinct vector; equal entries) have an
eigenvalue of 0 and a null `whitened`, and are left out of `identity_error`; `explained` is null if nothing varies at all.
The largest entry of each eigenvector is positive, so its sign does not depend on the order of additions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.session import settle

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Distinct vectors of a block that is multiplied in one go.
BLOCK = 4_096
#: Eigenvalues under this part of the largest one, times the length, are rounding.
ROUNDING = 1e-15
WIDE = "decimal(38,0)"
#: The largest magnitude of c whose x fits 63 bits with room for the shift.
LARGEST = float(2**52)


def whole_vectors(embeddings: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(key, x, dims) of the rows whose vector is usable."""
    c = F.transform(F.col(vector), lambda v: v.cast("double"))
    usable = F.forall(F.col("c"), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < LARGEST))
    rows = embeddings.select(F.col(key), c.alias("c")).where(F.col("c").isNotNull() & (F.size("c") > 0)).where(usable)
    x = F.transform("c", lambda v: F.floor(v * SCALE) + F.lit(SHIFT).cast("long"))
    return rows.select(key, x.alias("x"), F.size("c").alias("dims"))


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    return vectors.groupBy("dims", "x").agg(F.count("*").alias("count"))


def exact_means(distinct: DataFrame, weight: Column) -> DataFrame:
    """Per length: n, the sum of the weights, and sums, of each entry; exact."""
    entries = distinct.select("dims", weight.cast("long").alias("w"), F.posexplode("x").alias("at", "x"))
    sums = entries.groupBy("dims", "at").agg(
        F.sum(F.col("w").cast("decimal(18,0)") * F.col("x").cast("decimal(19,0)")).cast(WIDE).alias("sum"), F.sum("w").alias("n")
    )
    in_order = F.array_sort(F.collect_list(F.struct("at", "sum")))
    return sums.groupBy("dims").agg(F.max("n").alias("n"), F.transform(in_order, lambda s: s["sum"]).alias("sums"))


def _sum_entries(products: DataFrame) -> DataFrame:
    """The matrices of each length, added up by row."""
    rows = products.select("dims", "at", F.posexplode("row").alias("column", "value"))
    summed = rows.groupBy("dims", "at", "column").agg(F.sum("value").alias("value"))
    in_order = F.array_sort(F.collect_list(F.struct("column", "value")))
    return summed.groupBy("dims", "at").agg(F.transform(in_order, lambda s: s["value"]).alias("row"))


def _products(frame: DataFrame) -> DataFrame:
    """Sums of w v v' over the rows (dims, w, v), v being already centred, as rows of the matrix."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}

        def out() -> pd.DataFrame:
            found = [(d, k, row) for d, m in sums.items() for k, row in enumerate(m)]
            return pd.DataFrame(found, columns=["dims", "at", "row"])

        for batch in batches:
            for dims, group in batch.groupby("dims"):
                for at in range(0, len(group), BLOCK):
                    part = group.iloc[at : at + BLOCK]
                    v = np.stack(part["v"].to_numpy()) * np.sqrt(part["w"].to_numpy(float))[:, None]
                    sums[dims] = sums.get(dims, 0) + v.T @ v
            # Many lengths at once: hand on what there is.
            if sum(m.size for m in sums.values()) > 1 << 24:
                yield out()
                sums = {}
        if sums:
            yield out()

    return _sum_entries(frame.mapInPandas(run, "dims int, at int, row array<double>"))


def _eigen(pdf: pd.DataFrame) -> pd.DataFrame:
    """Unit eigenvectors of one length's covariance, by falling eigenvalue."""
    pdf = pdf.sort_values("at")
    covariance = np.stack(pdf["row"].to_numpy()) / pdf["n"].iloc[0]
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:COMPONENTS]
    trace = float(np.trace(covariance))
    rows = []
    for number, k in enumerate(order, start=1):
        v = vectors[:, k]
        v = v * np.sign(v[np.argmax(np.abs(v))])
        flat = values[k] <= ROUNDING * len(values) * values.max()
        rows.append((pdf["dims"].iloc[0], number, v, 0.0 if flat else float(values[k]), trace))
    return pd.DataFrame(rows, columns=["dims", "component", "vector", "value", "trace"])


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def whiten(embeddings: DataFrame, weights: str = "counts", vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """One row per usable row and component (up to COMPONENTS): key, component, n, deviation (exact decimal, null beyond 38
    digits), whitened, explained, identity_error. `weights`: "counts", or "one" for each distinct vector."""
    vectors = settle(whole_vectors(embeddings, vector, key), "vectors")
    distinct = settle(distinct_vectors(vectors), "distinct")
    weight = {"counts": F.col("count"), "one": F.lit(1).cast("long")}[weights]
    means = settle(exact_means(distinct, weight), "means")
    # n x - S is whole, so the centred entries are off by the rounding of one division only.
    off = F.zip_with("x", "sums", lambda x, s: (F.col("n").cast(WIDE) * x.cast(WIDE) - s).cast(WIDE))
    centred = (
        distinct.join(means, "dims")
        .select("dims", "x", weight.alias("w"), "n", off.alias("off"))
        .withColumn("v", F.transform("off", lambda o: o.cast("double") / F.col("n")))
    )
    squares = F.aggregate(
        "off", F.lit(0).cast(WIDE), lambda s, o: F.try_add(s, F.try_multiply(o, o).cast(WIDE)).cast(WIDE)
    )
    centred = settle(centred.select("dims", "x", "w", "n", "v", squares.alias("deviation")), "centred")
    matrix = _products(centred.select("dims", "w", "v")).join(means.select("dims", "n"), "dims")
    parts = matrix.groupBy("dims").applyInPandas(
        _eigen, "dims int, component int, vector array<double>, value double, trace double"
    )
    axes = settle(
        parts.groupBy("dims").agg(
            F.array_sort(F.collect_list(F.struct("component", "vector", "value", "trace"))).alias("axes")
        ),
        "axes",
    )
    scores = F.transform("axes", lambda a: F.when(a["value"] > 0, _dot(F.col("v"), a["vector"]) / F.sqrt(a["value"])))
    whitened = settle(
        centred.join(axes, "dims").select("dims", "x", "w", "n", "deviation", scores.alias("scores")), "whitened"
    )
    errors = settle(identity_errors(whitened), "errors")
    shares = axes.select(
        "dims",
        F.transform("axes", lambda a: F.when(a["trace"] > 0, a["value"] / a["trace"])).alias("shares"),
    )
    back = (
        vectors.join(whitened.drop("w"), ["dims", "x"])
        .join(errors, "dims", "left")
        .join(shares, "dims")
        .select(key, "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("scores", "shares")).alias("at", "one"))
    )
    return back.select(
        key,
        (F.col("at") + 1).alias("component"),
        "n",
        "deviation",
        F.col("one.scores").alias("whitened"),
        F.col("one.shares").alias("explained"),
        "identity_error",
    )


def identity_errors(whitened: DataFrame) -> DataFrame:
    """Per length: the largest entry by which the whitened vectors' covariance, centred anew, differs from the identity."""
    kept = whitened.select("dims", "w", "n", F.filter("scores", lambda s: s.isNotNull()).alias("v"))
    entries = kept.select("dims", "w", F.posexplode("v").alias("at", "value"))
    sums = entries.groupBy("dims", "at").agg((F.sum(F.col("w") * F.col("value")) / F.sum("w")).alias("mean"))
    in_order = F.array_sort(F.collect_list(F.struct("at", "mean")))
    centres = settle(sums.groupBy("dims").agg(F.transform(in_order, lambda s: s["mean"]).alias("centre")), "centres")
    again = kept.join(centres, "dims").select("dims", "w", F.zip_with("v", "centre", lambda v, c: v - c).alias("v"))
    matrix = _products(again).join(whitened.groupBy("dims").agg(F.max("n").alias("n")), "dims")
    off = matrix.select(
        "dims",
        F.transform("row", lambda value, k: F.abs(value / F.col("n") - F.when(k == F.col("at"), 1.0).otherwise(0.0))).alias("off"),
    )
    return off.groupBy("dims").agg(F.max(F.array_max("off")).alias("identity_error"))
