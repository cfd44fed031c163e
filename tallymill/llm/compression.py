"""Quality rules by compression bands.

Whole documents and fixed chunks are compressed with zstandard. Text that compresses better than the limit of its length
class is repetitive, text that compresses worse is noise. Limits depend on length: short texts hardly compress. They are
fences around the quartiles of the table's own texts, equal ones counted once, separately for whole texts and chunks;
BANDS are outer limits, and the only ones of a length class with few texts.
Null and empty texts fail the base rules (no words). Repeated rows are judged row by row, further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.llm.batches import in_small_batches
from tallymill.session import settle

#: Least length in bytes, least and greatest ratio of plain to compressed size.
BANDS = ((0, 0.0, 30.0), (200, 1.05, 8.0), (1000, 1.2, 8.0), (5000, 1.4, 9.0), (20000, 1.5, 12.0))
CHUNK = 4096
#: Greatest share of chunks that may lie outside their band.
CHUNK_SHARE = 0.25
#: Length classes from one power of two to the next; distinct texts that a class needs for limits of its own.
CLASSES_A_DOUBLING, LEAST_TEXTS = 2, 50
#: Distance of the limits from the quartiles, in quartile distances, for texts and for chunks.
FENCE, CHUNK_FENCE = 1.5, 3.0
#: A quartile distance counts as this share of the upper quartile at least, lest many near copies close a class.
LEAST_SPREAD = 0.04
#: Ratios are counted in hundredths up to this one.
MOST_RATIO = 40
WINDOW = 8
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, ratio double, bad_chunks long, n_chunks long"
)
MEASURES = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, ratio double, n_bytes long, chunks array<struct<n_bytes:long,ratio:double>>, hash long"
)
SPACE = str.maketrans("", "", " \t\n\x0b\x0c\r")


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of WINDOW words that occur at least twice."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    # Ranks of pairs, then of fours, then of eights: equal ranks mean equal windows.
    step = 1
    while step < WINDOW:
        ids = np.unique(ids[:-step] * (len(words) + 1) + ids[step:], return_inverse=True)[1]
        step *= 2
    starts = np.flatnonzero(np.bincount(ids)[ids] > 1)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(edge)))


def band(n: int) -> tuple[float, float]:
    return next((low, high) for least, low, high in reversed(BANDS) if n >= least)


def outside(data: bytes, compressor: zstandard.ZstdCompressor) -> tuple[bool, float]:
    if not data:
        return False, 0.0
    ratio = len(data) / len(compressor.compress(data))
    low, high = band(len(data))
    return not low <= ratio <= high, ratio


def measured(text: str | None, compressor: zstandard.ZstdCompressor) -> tuple:
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    seen: set[str] = set()
    repeats = 0
    for line in text.split("\n"):
        if line.translate(SPACE):
            repeats += line in seen
            seen.add(line)
    n_repeat = repeated_words(words)
    failed = len(words) < 20 or 100 * n_repeat > 30 * len(words)
    chunks = [data[k : k + CHUNK] for k in range(0, len(data), CHUNK)]
    return (
        len(words),
        len(text.translate(SPACE)),
        sum(map(text.count, "#*$%&|<>")),
        repeats,
        n_repeat,
        failed,
        outside(data, compressor)[1],
        len(data),
        [{"n_bytes": len(c), "ratio": outside(c, compressor)[1]} for c in chunks],
        xxhash.xxh3_64_intdigest(data) - 2**63,
    )


def length_class(n: Column) -> Column:
    """Of a length in bytes; whole powers of two begin a class."""
    return F.floor(F.log2(n.cast("double")) * CLASSES_A_DOUBLING + 1e-9).cast("int")


def learned_limits(measures: DataFrame) -> dict[tuple[str, int], tuple[float, float]]:
    """(least, greatest) ratio by kind and length class; few rows: one per class."""
    once = measures.where("n_bytes > 0").groupBy("hash", "n_bytes").agg(F.first("ratio").alias("ratio"), F.first("chunks").alias("chunks"))
    part = F.struct(F.lit("text").alias("kind"), F.col("n_bytes").alias("n"), "ratio")
    parts = F.transform("chunks", lambda c: F.struct(F.lit("chunk").alias("kind"), c["n_bytes"].alias("n"), c["ratio"].alias("ratio")))
    rows = once.select(F.explode(F.concat(F.array(part), parts)).alias("part")).select(
        "part.kind",
        length_class(F.col("part.n")).alias("class"),
        F.round(F.least("part.ratio", F.lit(float(MOST_RATIO))) * 100).cast("int").alias("ratio"),
    )
    counts = rows.groupBy("kind", "class", "ratio").agg(F.count("*").alias("n"))
    quartiles = counts.groupBy("kind", "class").agg(
        F.sum("n").alias("n"), F.percentile("ratio", F.array(F.lit(0.25), F.lit(0.75)), F.col("n")).alias("q")
    )
    out = {}
    for r in quartiles.where(F.col("n") >= LEAST_TEXTS).collect():
        low, high = (q / 100 for q in r["q"])
        room = (FENCE if r["kind"] == "text" else CHUNK_FENCE) * max(high - low, LEAST_SPREAD * high)
        out[r["kind"], r["class"]] = low - room, high + room
    return out


def outside_limits(kind: str, n: Column, ratio: Column, limits: dict[tuple[str, int], tuple[float, float]]) -> Column:
    least, greatest = F.lit(BANDS[0][1]), F.lit(BANDS[0][2])
    for length, low, high in BANDS[1:]:
        least, greatest = F.when(n >= length, low).otherwise(least), F.when(n >= length, high).otherwise(greatest)
    own = {k: v for (of, k), v in limits.items() if of == kind}
    if own:
        table = F.create_map(*(x for k, (low, high) in sorted(own.items()) for x in (F.lit(k), F.array(F.lit(low), F.lit(high)))))
        found = F.try_element_at(table, length_class(n))
        least, greatest = F.greatest(least, found[0]), F.least(greatest, found[1])
    return (n > 0) & ~ratio.between(least, greatest)


def compression_rules(docs: DataFrame) -> DataFrame:
    """One row per document with its counts, its ratios and the verdict."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compressor = zstandard.ZstdCompressor(level=3)
        names = [c.split()[0] for c in MEASURES.split(", ")]
        for batch in batches:
            rows = [(i, *measured(t, compressor)) for i, t in zip(batch["doc_id"].astype("Int64"), batch["text"], strict=True)]
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    measures = settle(in_small_batches(docs).select("doc_id", "text").mapInPandas(run, MEASURES), "measures")
    limits = learned_limits(measures)
    bad = outside_limits("text", F.col("n_bytes"), F.col("ratio"), limits)
    bad_chunks = F.size(F.filter("chunks", lambda c: outside_limits("chunk", c["n_bytes"], c["ratio"], limits))).cast("long")
    judged = measures.withColumn("bad_chunks", bad_chunks).withColumn("n_chunks", F.size("chunks").cast("long"))
    kept = ~F.col("base_failed") & ~bad & (F.col("bad_chunks") <= CHUNK_SHARE * F.col("n_chunks"))
    return judged.withColumn("kept", kept).select(*(c.split()[0] for c in SCHEMA.split(", ")))
