"""Quality classifier with hierarchical empirical Bayes.

A logistic model of the text's surface gives each document evidence. Means per host and per path are shrunk towards the
level above, the more the fewer documents a site has; how strongly is estimated from the spread between sites. The
path's posterior shifts the document's log odds. Null and empty texts have evidence of their own (no words); a null host
or path is a site like any other. Repeated rows are judged row by row.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.llm.batches import in_small_batches
from tallymill.llm.toxicity import held_out
from tallymill.session import settle

#: Labelled rows of each label that the fit may use.
FIT_ROWS = 1500
KEEP = 0.3
SYMBOL = re.compile(r"[#*$%&|<>]")


def surface(text: str | None) -> list[float]:
    text = text or ""
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n, chars = max(1, len(words)), max(1, len(text))
    data = text.encode("utf-8", "surrogatepass")
    return [
        1.0,
        math.log1p(len(words)),
        len(SYMBOL.findall(text)) / n,
        sum(map(str.isupper, words)) / n,
        text.count("!") / n,
        text.count("|") / n,
        sum(map(str.isdigit, text)) / chars,
        len(set(words)) / n,
        len(set(lines)) / max(1, len(lines)),
        len(data) / max(1, len(zlib.compress(data, 1))),
        sum(map(len, words)) / n / 10,
        text.count(".") / n,
    ]


def fit(rows: list[tuple[list[float], int]]) -> tuple[list[float], list[float], list[float]]:
    """Mean, scale and weights; balanced logistic regression by Newton's method with a small ridge. Without rows of both
    labels the model is neutral: every text is as good as another, and kept."""
    width = len(surface(""))
    x = np.array([features for features, _ in rows]).reshape(-1, width)
    y = np.array([label for _, label in rows], dtype=float)
    if len(set(y.tolist())) < 2:
        return [0.0] * width, [1.0] * width, [3.0] + [0.0] * (width - 1)
    mean, scale = x.mean(0), x.std(0) + 1e-9
    mean[0], scale[0] = 0, 1
    x = np.clip((x - mean) / scale, -6, 6)
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.eye(len(w))
        w += np.linalg.solve(h, x.T @ (y - p) - w)
    return mean.tolist(), scale.tolist(), w.tolist()


def fit_rows(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> list[tuple[list[float], int]]:
    """(surface, label) of at most `rows` labelled documents of each label outside the held-out fold. Texts are measured in
    the tasks; only numbers come to the driver."""
    usable = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(label).alias("y"))
    )
    chosen = [usable.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for y in (0, 1)]

    @F.pandas_udf("array<double>")
    def measured(texts: pd.Series) -> pd.Series:
        return pd.Series([surface(t) for t in texts])

    # At most two times `rows` ids.
    found = docs.select("doc_id", "text").join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")
    numbers = found.select("doc_id", "y", measured("text").alias("x")).orderBy("doc_id", "x")
    return [(r["x"], r["y"]) for r in numbers.collect()]


def evidence(model):
    mean, scale, weights = map(np.array, model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        x = np.array([surface(t) for t in texts]).reshape(len(texts), len(mean))
        z = np.clip((x - mean) / scale, -6, 6) @ weights
        return pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return score


def _level(stats: DataFrame, prior: float) -> float:
    """Strength of the level's prior, in documents: within-site over between-site variance, by moments."""
    row = stats.agg(
        F.sum("n").alias("n"), F.count("*").alias("k"), F.sum("s2").alias("s2"),
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("q"),
        F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - prior, F.lit(2))).alias("b"),
    ).first()
    if not row["n"] or row["n"] <= row["k"]:
        return 10.0
    within = max(1e-6, (row["s2"] - row["q"]) / (row["n"] - row["k"]))
    between = max(1e-6, (row["b"] - row["k"] * within) / row["n"])
    return min(1e4, max(1.0, within / between))


def site_posteriors(scored: DataFrame) -> tuple[DataFrame, float]:
    """(host, path) with both posteriors, and the global mean. scored: host, path, evidence."""
    by_path = settle(
        scored.groupBy("host", "path").agg(
            F.count("*").alias("n"), F.sum("evidence").alias("s"), F.sum(F.col("evidence") * F.col("evidence")).alias("s2")
        ),
        "paths",
    )
    total = by_path.agg(F.sum("s"), F.sum("n")).first()
    prior = total[0] / total[1] if total[1] else 0.5
    hosts = by_path.groupBy("host").agg(*(F.sum(c).alias(c) for c in ("n", "s", "s2")))
    k_host, k_path = _level(hosts, prior), _level(by_path, prior)
    hosts = hosts.select(
        F.col("host").alias("of"), ((F.col("s") + k_host * prior) / (F.col("n") + k_host)).alias("host_posterior")
    )
    out = by_path.join(hosts, F.col("host").eqNullSafe(F.col("of"))).select(
        "host", "path", "host_posterior",
        ((F.col("s") + k_path * F.col("host_posterior")) / (F.col("n") + k_path)).alias("path_posterior"),
    )
    return settle(out, "sites"), prior


def quality(docs: DataFrame, labels: DataFrame, host="source", path="lang") -> DataFrame:
    """All columns of docs, with evidence, both posteriors, score and kept."""
    docs = in_small_batches(docs)
    score = evidence(fit(fit_rows(docs, labels, "quality", FIT_ROWS)))
    scored = docs.select(
        F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]).alias("row"), F.col(host).alias("host"), F.col(path).alias("path"), score("text").alias("evidence")
    )
    sites, prior = site_posteriors(settle(scored.select("host", "path", "evidence"), "evidence"))
    sites = sites.select(F.col("host").alias("h"), F.col("path").alias("p"), "host_posterior", "path_posterior")
    bound = lambda c: F.least(F.greatest(c, F.lit(1e-6)), F.lit(1 - 1e-6))
    odds = lambda c: F.log(bound(c) / (1 - bound(c)))
    z = odds(F.col("evidence")) + odds(F.col("path_posterior")) - odds(F.lit(prior))
    return (
        scored.join(sites, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p")))
        .withColumn("score", 1 / (1 + F.exp(-z)))
        .select("row", "evidence", "host_posterior", "path_posterior", "score", (F.col("score") >= KEEP).alias("kept"))
    )
