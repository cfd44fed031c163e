"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a probability from its words, the document's is their noisy-or, and
the weights are fitted to document labels through it; the sentences that carry the probability are then the offending
ones. Words and their first letters are chosen by counts over all labelled rows of the training fold; only the fit of their
weights uses a sample, weighted back to the true balance and held near what the counts say. Null and empty texts have no sentences: score 0. Repeated rows are scored row by row, ties need no breaking.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.llm.batches import in_small_batches
from tallymill.session import settle

THRESHOLD = 0.7
#: Labelled rows of each label that the fit may use; chosen by the hash of their id.
FIT_ROWS = 1500
#: A mark counts if it is in so many labelled documents; the most telling ones are weighted.
LEAST_DOCS, MOST_WORDS = 5, 4096
#: How often as frequent a mark must be in toxic documents; twice the log-likelihood ratio that chance must be excluded by.
LEAST_RATIO, LEAST_EVIDENCE = 3.0, 20.0
#: Letters of a word's beginnings, which stand for rare words of a common stem.
STEMS = (4, 6)
#: Greatest weight that counts alone give; the weights' pull towards it.
MOST_PRIOR, PULL = 4.0, 0.02
STEPS = 300
SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def sentences(text: str) -> list[str]:
    return [s for s in SENTENCE.findall(text) if WORD.search(s)]


def words(sentence: str) -> set[str]:
    return set(WORD.findall(sentence.lower()))


def marks(sentence: str) -> set[str]:
    """Words and beginnings of longer ones, such as `begi-`."""
    found = words(sentence)
    return found | {w[:n] + "-" for w in found for n in STEMS if len(w) > n}


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float

    def log_clean(self, found: set[str]) -> float:
        """log(1 - p) of a sentence with these marks."""
        z = self.bias + sum(self.weights.get(w, 0.0) for w in sorted(found))
        return -(z + math.log1p(math.exp(-z)) if z > 0 else math.log1p(math.exp(z)))

    def score(self, text: str | None) -> float:
        """Sentences without a weighted mark all have the same share; they count as one, lest long texts grow toxic."""
        found = map(marks, sentences(text or ""))
        parts = [self.log_clean(f & self.weights.keys()) for f in found if not f.isdisjoint(self.weights)]
        return -math.expm1(sum(parts)) if parts else 0.0

    def offending(self, text: str | None, least: float = 0.5) -> list[str]:
        return [s.strip() for s in sentences(text or "") if -math.expm1(self.log_clean(marks(s) & self.weights.keys())) >= least]


    def judged(self, text: str | None, least: float = 0.5) -> tuple[float, list[str]]:
        """score and offending, in one pass over the sentences."""
        parts, found, plain = [], [], -math.expm1(self.log_clean(set())) >= least
        for s in sentences(text or ""):
            own = marks(s)
            if own.isdisjoint(self.weights):
                offends = plain
            else:
                parts.append(self.log_clean(own & self.weights.keys()))
                offends = -math.expm1(parts[-1]) >= least
            if offends:
                found.append(s.strip())
        return -math.expm1(sum(parts)) if parts else 0.0, found


def training(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id and y of all labelled documents outside the held-out fold."""
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return usable.groupBy("doc_id").agg(F.max("toxic").alias("y"))


def mark_counts(rows: DataFrame) -> DataFrame:
    """mark, and the clean and toxic documents that hold it; the empty mark stands for all documents."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for text, y in zip(batch["text"], batch["y"], strict=True):
                for w in {""}.union(*map(marks, sentences(text or ""))):
                    counts.setdefault(w, [0, 0])[int(y)] += 1
            yield pd.DataFrame([(w, *n) for w, n in counts.items()], columns=["mark", "clean", "toxic"])

    found = rows.select("text", "y").mapInPandas(run, "mark string, clean long, toxic long")
    return found.groupBy("mark").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def telling(counts: DataFrame, clean: int, toxic: int) -> dict[str, float]:
    """The marks to weight with the weight that their counts alone give."""
    a, b = F.col("clean"), F.col("toxic")
    share = toxic / (clean + toxic)

    def part(n, of: float):
        return F.when(n > 0, n * F.log(n / ((a + b) * of))).otherwise(0.0)

    chosen = counts.where((F.col("mark") != "") & (a + b >= LEAST_DOCS) & (b * clean >= LEAST_RATIO * toxic * a))
    chosen = chosen.withColumn("evidence", 2 * (part(a, 1 - share) + part(b, share))).where(F.col("evidence") >= LEAST_EVIDENCE)
    rows = chosen.orderBy(F.desc("evidence"), "mark").limit(MOST_WORDS).collect()
    return {
        r["mark"]: min(MOST_PRIOR, math.log((r["toxic"] + 0.5) / (toxic + 1)) - math.log((r["clean"] + 0.5) / (clean + 1)))
        for r in rows
    }


def marked(rows: DataFrame, number: dict[str, int]) -> list[tuple[int, list[list[int]]]]:
    """y and, of each sentence with weighted marks, their numbers; texts stay where they are."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bags = [
                [hit for s in sentences(t or "") if (hit := sorted(number[w] for w in marks(s) & number.keys()))] for t in batch["text"]
            ]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "y": batch["y"].astype("int64"), "bag": bags})

    found = rows.select("doc_id", "text", "y").mapInPandas(run, "doc_id long, y long, bag array<array<int>>")
    return [(r["y"], r["bag"]) for r in found.orderBy("doc_id", "bag").select("y", "bag").collect()]


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    docs = in_small_batches(docs).select("doc_id", "text")
    usable = settle(training(docs, labels), "training")
    # The same plan at every size: a labelled text is shuffled once, whether or not the labels are few.
    counts = settle(mark_counts(docs.join(usable.hint("merge"), "doc_id")), "marks")
    total = counts.where("mark = ''").first()
    if total is None or not total["toxic"] or not total["clean"]:
        return Model({}, -5.0)
    priors = telling(counts, total["clean"], total["toxic"])
    if not priors:
        return Model({}, -5.0)
    chosen = [usable.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS) for y in (0, 1)]
    sample = docs.join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")
    rows = marked(sample, {w: k for k, w in enumerate(priors)})
    return fit(rows, priors, (total["clean"], total["toxic"]))


def fit(rows: list[tuple[int, list[list[int]]]], priors: dict[str, float], totals: tuple[int, int]) -> Model:
    """Weights of the marks from a sample; each label's rows count as all of that label."""
    y = np.array([label for label, _ in rows], dtype=int)
    n = len(rows)
    # One row per weighted mark of a sentence; sentences without one cannot differ and are left out.
    sentence, word, owner = [], [], []
    for d, (_, bag) in enumerate(rows):
        for hit in bag:
            sentence += [len(owner)] * len(hit)
            word += hit
            owner.append(d)
    prior = np.array(list(priors.values()))
    weight, bias = prior.copy(), -2.0
    if not owner:
        return Model(priors, bias)
    sentence, word, owner = np.array(sentence), np.array(word), np.array(owner)
    stands = np.array(totals) / np.maximum(1, np.bincount(y, minlength=2))
    stands = stands[y] * n / stands[y].sum()
    grown, grown_bias = np.full(len(prior), 1e-6), 1e-6
    for _ in range(STEPS):
        z = bias + np.bincount(sentence, weight[word], len(owner))
        p = 1 / (1 + np.exp(-z))
        clean = np.exp(-np.bincount(owner, np.logaddexp(0, z), n))
        pull = stands * np.where(y == 1, clean / np.maximum(1 - clean, 1e-9), -1.0)
        g = pull[owner] * p
        slope = np.bincount(word, g[sentence], len(prior)) - PULL * (weight - prior)
        grown += slope**2
        grown_bias += (step := g.sum()) ** 2
        weight += 0.5 * slope / np.sqrt(grown)
        bias += 0.1 * step / math.sqrt(grown_bias)
    return Model({w: float(x) for w, x in zip(priors, weight, strict=True)}, float(bias))


def scorer(model: Model):
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype=float)

    return score


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out (null for a null id), score, predicted, and the offending sentences."""
    model = learn(docs, labels)

    @F.pandas_udf("score double, offending array<string>")
    def judged(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.judged(t) for t in texts], columns=["score", "offending"])

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), judged("text").alias("judged"))
    return rows.select("doc_id", "held_out", "judged.*").select(
        "doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "offending"
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = learn(docs, labels)
    return docs.where(scorer(model)("text") < THRESHOLD)
