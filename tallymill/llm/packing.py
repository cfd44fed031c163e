"""Best-fit packing with certified repacking.

Documents become token ids plus an end mark; longer ones than a sequence are cut, the first piece being the shorter one.
Pieces are dealt to partitions of bounded size, and each packs its own by best-fit decreasing. A dual-feasible-function
bound certifies a partition whose number of bins it reaches. Partitions with a gap, and all bins with room, hand their
pieces to a smaller set of partitions, which pack again, while that needs fewer bins.
Null text is empty text: one piece, the end mark. Repeated rows are packed one by one; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.llm.batches import in_small_batches
from tallymill.llm.word_ids import BYTE_LETTERS, MARKS, plain_letters
from tallymill.session import new_work_path

CAPACITY = 1024
END = 2
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES_A_PARTITION = 50_000
ROUNDS = 4
#: Words of a generation that a worker keeps; the one before is kept beside it, so words in use outlive the change.
WORDS_KEPT = 300_000
#: Words of common letters with a mark, white space or nothing after them, runs of marks that end before letters, digits or
#: white space, and what else lies between white space. No token crosses from one to the next, and marks are met in few runs.
MARK, LETTER = re.escape(MARKS), "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f"
CHUNKS = re.compile(
    rf" ?[{LETTER}]++(?![^\s{MARK}])| ?[{MARK}][{MARK}']*+(?![^\s{LETTER}0-9])| ?\S+|\s+(?!\S)|\s+"
)
#: Texts with these go to the tokenizer whole: white space differs there, or a special token may be meant.
ODD = ("\x1c", "\x1d", "\x1e", "\x1f", "<|")
#: The byte letters of all bytes in UTF-32, and the one that ends a line.
LETTERS = np.array([BYTE_LETTERS[b] for b in range(256)], "<u4")
LINE_END = chr(BYTE_LETTERS[10])
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, nonce long"


class Ids:
    """Token ids of texts as little-endian bytes. No token crosses a chunk, so each new chunk is encoded once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # The same merges without the search for words: it takes words in byte letters, a line end between them.
        self.merges = Tokenizer.from_file(path)
        self.merges.pre_tokenizer = pre_tokenizers.Split(LINE_END, "removed")
        self.sizes = np.zeros(self.merges.get_vocab_size(), np.int64)
        for token, number in self.merges.get_vocab().items():
            self.sizes[number] = len(token)
        self.end = self.whole("\n")
        trial = [" Ab", "C", " \u00c9t\u00e9s", "abcdefgh"]
        self.by_letters = self.merged(trial) == [self.whole(t) for t in trial]
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def merged(self, words: list[str]) -> list[bytes]:
        """Ids of words that are one run of letters each, maybe after a space; their bytes tell where each word's end."""
        raw = np.frombuffer("\n".join(words).encode(), np.uint8)
        ids = self.merges.encode_batch_fast([LETTERS[raw].tobytes().decode("utf-32-le")], add_special_tokens=False)[0].ids
        ids = np.array(ids, "<u4")
        breaks = np.append(np.flatnonzero(raw == 10), len(raw))
        bytes_upto = breaks - np.arange(len(breaks))
        ends = np.searchsorted(np.cumsum(self.sizes[ids]), bytes_upto) + 1
        return self._cut(ids, ends, ends)

    def _cut(self, ids: np.ndarray, ends: np.ndarray, nexts: np.ndarray) -> list[bytes]:
        """The ids of each word, which end and go on at these places."""
        data = ids.tobytes()
        return [data[a:b] for a, b in zip([0, *(4 * nexts).tolist()], (4 * ends).tolist(), strict=False)]

    def learn(self, new: list[str]) -> None:
        """Plain words go straight to the merges, others to the tokenizer."""
        known, plain, others = self.known, [], []
        for word in new:
            if word.isspace():
                known[word] = self.whole(word)
            elif plain_letters(word[1:] if word[0] == " " else word):
                plain.append(word)
            else:
                others.append(word)
        if not self.by_letters:
            plain, others = [], others + plain
        if plain:
            known.update(zip(plain, self.merged(plain), strict=True))
        if others:
            lines = "\n".join(others) + "\n"
            ids = np.array(self.tokenizer.encode_batch_fast([lines], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(ids == np.frombuffer(self.end, "<u4")[0])
            known.update(zip(others, self._cut(ids, ends, ends + 1), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > WORDS_KEPT:
            self.before, self.known = self.known, {}
        split = [None if any(odd in t for odd in ODD) else CHUNKS.findall(t) for t in texts]
        known, new = self.known, []
        for chunk in set(chain.from_iterable(s for s in split if s)).difference(known):
            if (ids := self.before.get(chunk)) is None:
                new.append(chunk)
            else:
                known[chunk] = ids
        self.learn(new)
        return [
            self.whole(t) if chunks is None else b"".join(map(known.__getitem__, chunks))
            for t, chunks in zip(texts, split, strict=True)
        ]


@cache
def encoder(path: str) -> Ids:
    return Ids(path)


def pieces(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """The pieces of all documents; nonce spreads them evenly and the same way after a retry."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in PIECES.split(", ")]
        ids, end = encoder(path), np.array([END], "<u4").tobytes()
        for batch in batches:
            rows = []
            texts = [t or "" for t in batch["text"]]
            for at in range(0, len(texts), 500):
                part = zip(batch["doc_id"].astype("Int64")[at : at + 500], ids.encode(texts[at : at + 500]), strict=True)
                for doc_id, data in part:
                    data += end
                    n = len(data) // 4
                    cuts = [0, *range((n - 1) % CAPACITY + 1, n + 1, CAPACITY)]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        crc = zlib.crc32(data[4 * a : 4 * b])
                        rows.append((doc_id, k, a, b - a, crc, crc * 31 + (0 if doc_id is pd.NA else int(doc_id)) * 7 + k))
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    return in_small_batches(docs).select("doc_id", "text").mapInPandas(run, PIECES)


def best_fit(lengths: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Bin of each piece by best-fit decreasing, and each bin's fill. A bit mask tells which rooms are on offer."""
    bins = np.empty(len(lengths), dtype=np.int64)
    room: list[list[int]] = [[] for _ in range(CAPACITY + 1)]
    fill: list[int] = []
    offered = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = offered >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                offered &= ~(1 << r)
        else:
            b, r = len(fill), CAPACITY
            fill.append(0)
        bins[i] = b
        fill[b] += size
        if r > size:
            room[r - size].append(b)
            offered |= 1 << (r - size)
    return bins, fill


def least_bins(lengths: np.ndarray) -> int:
    """The best of the dual-feasible functions f_k: over capacity - k counts whole, under k nothing, others their length."""
    count = np.bincount(lengths, minlength=CAPACITY + 1)
    sums = np.cumsum(count * np.arange(CAPACITY + 1))
    best = -(-int(sums[-1]) // CAPACITY)
    for k in range(1, CAPACITY // 2 + 1):
        large = int(count[CAPACITY - k + 1 :].sum())
        middle = int(sums[CAPACITY - k] - sums[k - 1])
        best = max(best, large + -(-middle // CAPACITY))
    return best


def _packed(spark: SparkSession, frame: DataFrame, number: int, folder: str) -> DataFrame:
    """Packs a round's pieces, writes them, and reads them again with the bins' fill and the partition's gap."""
    parts = max(1, -(-frame.count() // PIECES_A_PARTITION))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=False, kind="stable")
        lengths = pdf["length"].to_numpy()
        bins, fill = best_fit(lengths)
        order = np.argsort(bins, kind="stable")
        sorted_lengths, sorted_bins = lengths[order], bins[order]
        before = np.cumsum(sorted_lengths) - sorted_lengths
        first = np.searchsorted(sorted_bins, sorted_bins)
        offset = np.empty(len(pdf), dtype=np.int64)
        offset[order] = before - before[first]
        base = (number << 56) | (int(pdf["part"].iloc[0]) << 24)
        return pdf.assign(
            sequence_id=bins + base,
            offset=offset,
            fill=np.array(fill)[bins],
            gap=len(fill) - least_bins(lengths),
        )

    out = f"{folder}/round={number}"
    (
        frame.withColumn("part", F.pmod(F.xxhash64("nonce", F.lit(number)), F.lit(parts)))
        .groupBy("part")
        .applyInPandas(run, f"{PIECES}, part long, sequence_id long, offset long, fill long, gap long")
        .write.parquet(out)
    )
    return spark.read.parquet(out)


def best_fit_packing(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """One row per piece with its sequence and its place there."""
    spark = docs.sparkSession
    folder = new_work_path(spark, "packing")
    pieces(docs, path).write.parquet(f"{folder}/pieces")
    columns = [c.split()[0] for c in PIECES.split(", ")]
    packed = _packed(spark, spark.read.parquet(f"{folder}/pieces"), 0, folder)
    done: list[DataFrame] = []
    for number in range(1, ROUNDS):
        # Bins with room are exchanged; so are all of a partition whose count is not certified.
        loose = (F.col("fill") < CAPACITY) | ((F.col("gap") > 0) & (F.col("length") < CAPACITY))
        totals = packed.where(loose).agg(F.count_distinct("sequence_id"), F.sum("length"), F.count_distinct("part")).first()
        if not totals[0] or totals[0] <= -(-totals[1] // CAPACITY) or totals[2] < 2:
            break
        again = _packed(spark, packed.where(loose).select(*columns), number, folder)
        if again.agg(F.count_distinct("sequence_id")).first()[0] >= totals[0]:
            break
        done.append(packed.where(~loose))
        packed = again
    for frame in done:
        packed = packed.unionByName(frame)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
