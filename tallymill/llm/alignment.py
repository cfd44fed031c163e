"""Alignment of two tokenizers over the same bytes, by products of sparse incidence matrices.

A encodes a space and the text, B the text, to which it adds the space itself. Row i of a token-byte matrix marks the bytes
of token i; Gustavson's row products of A and B transposed give the overlap links, with the bytes they share. Offsets where
tokens of both end cut the tokens into groups; products of the token-group matrices give the shared-group links. The
matrices are built by hand in compressed sparse rows.

No token of either crosses a single space between other characters, so a text is taken apart there and each new word is
aligned once per worker. A block of documents is a matrix too: documents by words, times words by linked id pairs, gives how
often each document links each pair. Blocks send every pair once, with the number of their documents that hold it; summed
over the corpus that is the pair's count, which comes back to the blocks by a join and is multiplied by their matrices.
A block is bounded in documents and in characters (but for one text longer than that), so no pair, word or text, however
frequent, makes a task heavier than others. A worker's memory is bounded too: by the words kept between blocks (as columns,
not as objects), those learned at once, and the products summed at once (but for one document's). Matrices travel as bytes
of the smallest type that holds them.

Null and empty texts have no tokens; neither has a text whose joined token bytes in A or B are not the space and the text.
Repeated rows count as documents of their own, null ids stay null, other columns are ignored, an empty table gives none.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from hashlib import sha256
from itertools import accumulate, chain

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.llm.batches import few_rows_a_batch
from tallymill.llm.word_ids import BYTE_LETTERS, MARKS, byte_letters, plain_letters
from tallymill.session import settle

BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
#: Words of a generation that a worker keeps, up to this length; the one before is kept beside it.
WORDS_KEPT, LONGEST_KEPT = 200_000, 64
#: New words aligned at once, and products of two matrices summed at once.
WORDS_LEARNED, PRODUCTS = 5_000, 200_000
#: Documents and characters of a block, and documents whose groups are put together at once.
BLOCK_DOCS, BLOCK_CHARS, DIGESTED = 1_000, 4_000_000, 50
#: Of a word or a document: tokens of A and of B, and groups; of a document links too.
COUNTS = ("n_a", "n_b", "n_groups")
PER_DOCUMENT = (*COUNTS, "n_links")
#: A space beside white space, or at an end; such texts are taken apart more slowly.
WHITE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\pZ]"
BESIDE_WHITE = rf"(?:^|{WHITE}) | (?:{WHITE}|$)"
APART = re.compile(r"(?<=\S)(?= \S)")


def joined(cuts: np.ndarray, texts: pa.Array) -> pa.Array:
    """The texts between each two cuts, put together."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), texts), pa.scalar("", texts.type))


@dataclass
class Csr:
    """A sparse matrix: the columns and values of row i are those from indptr[i] to indptr[i + 1]."""

    indptr: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @staticmethod
    def of_ranges(begins: np.ndarray, ends: np.ndarray, width: int) -> Csr:
        """Row i holds ones from begins[i] up to ends[i]."""
        many = ends - begins
        indptr = np.concatenate([[0], np.cumsum(many)])
        columns = np.arange(indptr[-1]) + np.repeat(begins - indptr[:-1], many)
        return Csr(indptr, columns, np.ones(len(columns), np.int64), width)

    @staticmethod
    def of_entries(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, height: int, width: int) -> Csr:
        """Entries of the same place are added up; each row's columns ascend."""
        key = rows.astype(np.int64) * width + columns
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        sums = np.add.reduceat(values[order], first) if len(first) else values[:0]
        rows, columns = np.divmod(key[first], width) if width else (key[:0], key[:0])
        indptr = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=height))])
        return Csr(indptr, columns, sums, width)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))

    def transposed(self) -> Csr:
        order = np.argsort(self.columns, kind="stable")
        indptr = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Csr(indptr, self.rows()[order], self.values[order], len(self.indptr) - 1)

    def slice(self, begin: int, end: int) -> Csr:
        at = slice(self.indptr[begin], self.indptr[end])
        return Csr(self.indptr[begin : end + 1] - self.indptr[begin], self.columns[at], self.values[at], self.width)

    def times(self, other: Csr) -> Csr:
        """Gustavson: row i is the sum of the other's rows k, weighted by the values at (i, k). As many rows at a time as make
        PRODUCTS of them, or one of more."""
        products = np.concatenate([[0], np.cumsum(np.diff(other.indptr)[self.columns])])[self.indptr]
        parts, at, height = [], 0, len(self.indptr) - 1
        while at < height or not parts:
            end = min(height, max(at + 1, int(np.searchsorted(products, products[at] + PRODUCTS, "right")) - 1))
            parts.append(self.slice(at, end)._times(other))
            at = end
        counts = np.concatenate([[0], *(np.diff(p.indptr) for p in parts)])
        columns, values = (np.concatenate(x) for x in zip(*((p.columns, p.values) for p in parts), strict=True))
        return Csr(np.cumsum(counts), columns, values, other.width)

    def _times(self, other: Csr) -> Csr:
        begins, many = other.indptr[self.columns], np.diff(other.indptr)[self.columns]
        ends = np.cumsum(many)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - (ends - many), many)
        values = np.repeat(self.values, many) * other.values[at]
        return Csr.of_entries(np.repeat(self.rows(), many), other.columns[at], values, len(self.indptr) - 1, other.width)

    def dot(self, vector: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(self.values * vector[self.columns])])
        return sums[self.indptr[1:]] - sums[self.indptr[:-1]]


def overlap_links(a_ends: np.ndarray, b_ends: np.ndarray) -> Csr:
    """Tokens of A by tokens of B: the number of bytes that both cover. Ends are offsets in the same bytes."""
    width = int(a_ends[-1]) if len(a_ends) else 0
    a, b = (Csr.of_ranges(np.concatenate([[0], e[:-1]])[: len(e)], e, width) for e in (a_ends, b_ends))
    return a.times(b.transposed())


def group_numbers(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The group of each token of A and of B, and how many groups there are."""
    shared = np.intersect1d(a_ends, b_ends)
    return np.searchsorted(shared, a_ends), np.searchsorted(shared, b_ends), len(shared)


def group_links(a_group: np.ndarray, b_group: np.ndarray, groups: int) -> Csr:
    """Tokens of A by tokens of B: one where they share a group."""
    a, b = (Csr.of_ranges(g, g + 1, groups) for g in (a_group, b_group))
    return a.times(b.transposed())


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = {chr(c): b for b, c in BYTE_LETTERS.items()}
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.a_bytes[i] = bytes([letters[c] for c in entry]) if all(c in letters for c in entry) else entry.encode()
        b_pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(b_pieces)
        ]
        self.a_sizes, self.b_sizes = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        # No piece goes on behind a space mark that follows another character, so words can be taken one by one.
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in b_pieces)
        #: Ids of both as text, with what follows them: the next id of the group, the other side, the next group.
        both = [*range(len(self.a_bytes)), *range(len(self.b_bytes))]
        self.shown = pa.array([f"{i}{mark}" for mark in (",", "|", ";") for i in both], pa.large_string())
        #: A space and a word, aligned: its groups as text (each with `;` behind it), linked id pairs, and counts.
        pair = pa.uint32() if len(self.a_bytes) * len(self.b_bytes) <= 1 << 32 else pa.int64()
        self.aligned = pa.schema(
            [("word", pa.string()), ("groups", pa.large_string()), ("pairs", pa.list_(pair)), *((n, pa.int32()) for n in COUNTS)]
            + [("fits", pa.bool_())]
        )
        self.known = self.before = self._none()

    def _none(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([], self.aligned)

    def a_ids(self, words: list[str]) -> list[list[int]]:
        """A's ids of a space and each word. Plain words go straight to the vocabulary's merges, then the marks after them."""
        space, model, out, others, marks_ids = chr(BYTE_LETTERS[32]), self.a.model, [None] * len(words), [], {}
        for k, word in enumerate(words):
            stem = word.rstrip(MARKS)
            if stem and plain_letters(stem):
                ids = [t.id for t in model.tokenize(space + byte_letters(stem))]
                if marks := word[len(stem) :]:
                    if marks not in marks_ids:
                        marks_ids[marks] = [t.id for t in model.tokenize(marks)]
                    ids = ids + marks_ids[marks]
                out[k] = ids
            else:
                others.append(k)
        for k, found in zip(others, self.a.encode_batch_fast([" " + words[k] for k in others], add_special_tokens=False), strict=True):
            out[k] = found.ids
        return out

    def tokens(self, words: list[str]) -> tuple[list[list[int]], list[list[int]], list[bool]]:
        """Ids of a space and each word in A and in B, and whether both spell it."""
        a, b = self.a_ids(words), self.b.encode(words, num_threads=1)
        fits = []
        for word, x, y in zip(words, a, b, strict=True):
            data = b" " + word.encode()
            fits.append(
                b"".join([self.a_bytes[i] for i in x]) == data and b"".join([self.b_bytes[i] for i in y]) == data
            )
        return a, b, fits

    def _learn(self, words: list[str]) -> pa.RecordBatch:
        a, b, fits = self.tokens(words)
        a, b = ([x if fit else [] for x, fit in zip(side, fits, strict=True)] for side in (a, b))
        a_flat, b_flat = (np.array(list(chain.from_iterable(side)), np.int64) for side in (a, b))
        a_cuts, b_cuts = (np.array(list(accumulate(map(len, x), initial=0))) for x in (a, b))
        # All words' bytes one after the other: every word's end is the end of a token of both, so no group crosses it.
        a_group, b_group, groups = group_numbers(np.cumsum(self.a_sizes[a_flat]), np.cumsum(self.b_sizes[b_flat]))
        links = group_links(a_group, b_group, groups)
        pairs = np.repeat(a_flat, np.diff(links.indptr)) * len(self.b_bytes) + b_flat[links.columns]
        # Both sides' ids in the order of their groups, A before B; a mark by what comes next.
        side = np.repeat([0, 1], [len(a_flat), len(b_flat)])
        group = np.concatenate([a_group, b_group])
        order = np.argsort(group * 2 + side, kind="stable")
        side, group = side[order], group[order]
        ids = np.concatenate([a_flat, b_flat + len(self.a_bytes)])[order]
        last = np.append(group[1:] != group[:-1], True) if len(group) else np.empty(0, bool)
        turn = np.append(side[1:] != side[:-1], True) if len(side) else last
        mark = np.where(last, 2, np.where(turn, 1, 0))
        shown = self.shown.take(pa.array(mark * (len(self.a_bytes) + len(self.b_bytes)) + ids))
        group_cuts = np.concatenate([[0], np.cumsum(np.bincount(a_group, minlength=groups) > 0)])
        ends = np.concatenate([[0], a_group + 1])[a_cuts]
        kinds = self.aligned
        return pa.RecordBatch.from_arrays(
            [
                pa.array(words, pa.string()),
                joined(a_cuts + b_cuts, shown),
                pa.ListArray.from_arrays(pa.array(links.indptr[a_cuts], pa.int32()), pa.array(pairs).cast(kinds.field("pairs").type.value_type)),
                *(pa.array(np.diff(x), pa.int32()) for x in (a_cuts, b_cuts, group_cuts[ends])),
                pa.array(fits, pa.bool_()),
            ],
            schema=kinds,
        )

    def _keep(self, aligned: pa.RecordBatch) -> None:
        while len(aligned):
            if len(self.known) >= WORDS_KEPT:
                self.before, self.known = self.known, self._none()
            some = aligned.slice(0, WORDS_KEPT - len(self.known))
            self.known = pa.concat_batches([self.known, some])
            aligned = aligned.slice(len(some))

    def words(self, words: pa.Array | list[str]) -> pa.RecordBatch:
        """Distinct words, aligned."""
        words = words.cast(pa.string()) if isinstance(words, pa.Array) else pa.array(words, pa.string())
        rest, parts, places = np.arange(len(words)), [], []
        for kept in (self.known, self.before):
            at = pc.fill_null(pc.index_in(words.take(pa.array(rest)), value_set=kept.column("word")), -1).to_numpy()
            parts.append(kept.take(pa.array(at[at >= 0])))
            places.append(rest[at >= 0])
            rest = rest[at < 0]
        self._keep(parts[1])
        for at in range(0, len(rest), WORDS_LEARNED):
            some = rest[at : at + WORDS_LEARNED]
            parts.append(self._learn(words.take(pa.array(some)).to_pylist()))
            places.append(some)
            self._keep(parts[-1].filter(pc.less_equal(pc.utf8_length(parts[-1].column("word")), LONGEST_KEPT)))
        found = pa.concat_batches(parts)
        parts.clear()
        return found.take(pa.array(np.argsort(np.concatenate(places))))

    def split(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The texts' distinct words, the place of each word there, and how many words each text has."""
        texts = pc.fill_null(texts, "")
        lists = pc.split_pattern(texts, " ")
        slow = pc.match_substring_regex(texts, BESIDE_WHITE) if self.by_word else pa.array([True] * len(texts))
        # An empty text would be one empty word.
        slow = pc.or_(slow, pc.equal(pc.binary_length(texts), 0)).to_numpy(zero_copy_only=False)
        if slow.any():
            apart = APART.split if self.by_word else lambda text: [text]
            own = {k: [p[1:] for p in apart(" " + t)] if (t := texts[k].as_py()) else [] for k in np.flatnonzero(slow).tolist()}
            fast = pc.filter(lists, pa.array(~slow))
            counts = np.zeros(len(texts), np.int64)
            counts[~slow] = pc.list_value_length(fast).to_numpy()
            counts[list(own)] = [len(w) for w in own.values()]
            flat = pa.concat_arrays([fast.flatten(), pa.array(list(chain.from_iterable(own.values())), texts.type)])
            owner = np.concatenate([np.repeat(np.flatnonzero(~slow), counts[~slow]), np.repeat(list(own), counts[list(own)])])
            order = np.argsort(owner.astype(np.int64), kind="stable")
        else:
            counts, flat, order = pc.list_value_length(lists).to_numpy().astype(np.int64), lists.flatten(), slice(None)
        coded = flat.dictionary_encode()
        return coded.dictionary, coded.indices.to_numpy()[order], counts


@cache
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def lean() -> None:
    """For a worker that shares its memory: tokenizers start no threads beside a task's, and what Arrow frees others may take."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    pa.set_memory_pool(pa.system_memory_pool())


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (doc_id, text) put together and cut into blocks."""
    held, docs, chars = [], 0, 0
    for batch in batches:
        sizes = pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_numpy()
        at = 0
        while at < len(batch):
            part = chars + np.cumsum(sizes[at : at + BLOCK_DOCS - docs], dtype=np.int64)
            many = int(np.searchsorted(part, BLOCK_CHARS, "right")) or int(not held)
            if many:
                held.append(batch.slice(at, many))
                at, docs, chars = at + many, docs + many, int(part[many - 1])
            if at < len(batch) or docs == BLOCK_DOCS:
                yield pa.concat_batches(held)
                held, docs, chars = [], 0, 0
    if held:
        yield pa.concat_batches(held)


def _one(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def small(values: np.ndarray) -> bytes:
    """Numbers from 0 as bytes of the smallest type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0)))).tobytes()


def wide(data: bytes, many: int) -> np.ndarray:
    """What `small` made of so many numbers."""
    return np.frombuffer(data, f"u{len(data) // many}" if many else "u1").astype(np.int64)


def digests(groups: pa.Array, which: np.ndarray, cuts: np.ndarray) -> Iterator[str]:
    """Of each document, whose words are those from one cut to the next; empty for one without words. A few documents at a
    time, so that their groups are never together."""
    for at in range(0, len(cuts) - 1, DIGESTED):
        ends = cuts[at : at + DIGESTED + 1]
        shown = groups.take(pa.array(which[ends[0] : ends[-1]]))
        for text in joined(ends - ends[0], shown):
            data = memoryview(text.as_buffer())[:-1]
            yield sha256(data).hexdigest() if len(data) else ""


def _block(own: Aligner, part: pa.RecordBatch, number: int) -> pa.RecordBatch:
    words, which, counts = own.split(part.column(1))
    aligned = own.words(words)
    owner = np.repeat(np.arange(len(part)), counts)
    misfit = ~aligned.column("fits").to_numpy(zero_copy_only=False)[which]
    fits = np.bincount(owner[misfit], minlength=len(part)) == 0
    owner, which = owner[fits[owner]], which[fits[owner]]
    occurs = Csr.of_entries(owner, which, np.ones(len(owner), np.int64), len(part), len(words))
    lists = aligned.column("pairs")
    pairs, places = np.unique(lists.flatten().to_numpy(), return_inverse=True)
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(), dtype=np.int64)
    linked = occurs.times(Csr(np.concatenate([[0], ends]), places, np.ones(len(places), np.int64), len(pairs)))
    # Pairs that only texts without tokens have fall away.
    held = np.bincount(linked.columns, minlength=len(pairs))
    new_place = np.cumsum(held > 0) - 1
    sums = [occurs.dot(aligned.column(n).to_numpy().astype(np.int64)) for n in COUNTS]
    sums.append(linked.dot(np.ones(len(pairs), np.int64)))
    cuts = np.concatenate([[0], np.cumsum(np.where(fits, counts, 0))])
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number], pa.int64()),
            pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part.column(0)),
            *(_one(s, pa.int64()) for s in sums),
            pa.array([list(digests(aligned.column("groups"), which, cuts))], pa.list_(pa.string())),
            _one(pairs[held > 0].astype(np.int64), pa.int64()),
            _one(held[held > 0], pa.int32()),
            _one(linked.indptr, pa.int32()),
            pa.array([small(new_place[linked.columns])], pa.binary()),
            pa.array([small(linked.values)], pa.binary()),
        ],
        names=["block", "doc_id", *PER_DOCUMENT, "digest", "pairs", "documents", "starts", "columns", "occurs"],
    )


def block_rows(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """A row per block: its documents' ids, counts and digests, its id pairs, how many documents hold each, and the matrix of
    documents by pairs (row starts, columns, occurrences)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        own, task = aligner(a_path, b_path), TaskContext.get().partitionId()
        for number, part in enumerate(blocks(batches)):
            yield _block(own, part, (task << 32) + number)

    schema = (
        "block long, doc_id array<long>, "
        + ", ".join(f"{n} array<long>" for n in PER_DOCUMENT)
        + ", digest array<string>, pairs array<long>, documents array<int>, starts array<int>, columns binary, occurs binary"
    )
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def pair_counts(in_blocks: DataFrame, size_b: int) -> DataFrame:
    """(pair, n, best): the documents that hold an id pair, and whether its A id has no pair of more."""
    counts = settle(in_blocks.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    named = counts.withColumn("a", F.expr(f"pair div {size_b}"))
    most = named.groupBy("a").agg(F.max("n").alias("most"))
    return settle(named.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-counts")


def _scored(block: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
    """A block's documents, with their matrix times the counts, and times the best pairs."""
    row, pairs = block.iloc[0], pairs.sort_values("pair")
    starts = row["starts"].astype(np.int64)
    matrix = Csr(starts, wide(row["columns"], starts[-1]), wide(row["occurs"], starts[-1]), len(pairs))
    return pd.DataFrame(
        {
            "doc_id": pd.array(row["doc_id"], "Float64" if row["doc_id"].dtype == float else None).astype("Int64"),
            **{name: row[name] for name in PER_DOCUMENT},
            "n_best": matrix.dot(pairs["best"].to_numpy(np.int64)),
            "count_sum": matrix.dot(pairs["n"].to_numpy(np.int64)),
            "groups_sha256": row["digest"],
        }
    )


def alignment(docs: DataFrame, a_path: str = BYTE_LEVEL, b_path: str = PIECES) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    with few_rows_a_batch(docs):
        rows = settle(block_rows(docs, a_path, b_path), "blocks")
    in_blocks = rows.select("block", F.explode(F.arrays_zip("pairs", "documents")).alias("one")).select(
        F.col("block").alias("of_block"), F.col("one.pairs").alias("pair"), F.col("one.documents").cast("long").alias("n")
    )
    counts = pair_counts(in_blocks, len(aligner(a_path, b_path).b_bytes))
    looked_up = in_blocks.drop("n").join(counts, "pair")
    schema = "doc_id long, " + ", ".join(f"{n} long" for n in PER_DOCUMENT) + ", n_best long, count_sum long, groups_sha256 string"
    kept = rows.drop("pairs", "documents")
    return kept.groupBy("block").cogroup(looked_up.groupBy("of_block")).applyInPandas(_scored, schema)


def aligned_tokens(docs: DataFrame, a_path: str = BYTE_LEVEL, b_path: str = PIECES) -> DataFrame:
    """Per document the ids of A and B, the group of each token, and the overlap links (token of A, token of B, bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        own = aligner(a_path, b_path)
        for part in blocks(batches):
            words, which, counts = own.split(part.column(1))
            tokens = own.tokens(words.to_pylist())
            cuts = np.concatenate([[0], np.cumsum(counts)]).tolist()
            rows = []
            for k, doc_id in enumerate(part.column(0).to_pylist()):
                mine = which[cuts[k] : cuts[k + 1]].tolist()
                if not all(tokens[2][w] for w in mine):
                    mine = []
                a, b = (np.array(list(chain.from_iterable(side[w] for w in mine)), np.int64) for side in tokens[:2])
                a_ends, b_ends = np.cumsum(own.a_sizes[a]), np.cumsum(own.b_sizes[b])
                a_group, b_group, _ = group_numbers(a_ends, b_ends)
                links = overlap_links(a_ends, b_ends)
                overlaps = [
                    {"a": x, "b": y, "bytes": n}
                    for x, y, n in zip(links.rows().tolist(), links.columns.tolist(), links.values.tolist(), strict=True)
                ]
                rows.append((doc_id, a.tolist(), b.tolist(), a_group.tolist(), b_group.tolist(), overlaps))
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["doc_id", "a_ids", "b_ids", "a_groups", "b_groups", "overlaps"],
            )

    ints = pa.list_(pa.int32())
    link = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("bytes", pa.int32())])
    kinds = [pa.int64(), ints, ints, ints, ints, pa.list_(link)]
    schema = (
        "doc_id long, a_ids array<int>, b_ids array<int>, a_groups array<int>, b_groups array<int>, "
        "overlaps array<struct<a: int, b: int, bytes: int>>"
    )
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
