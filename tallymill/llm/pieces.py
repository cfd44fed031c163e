"""SentencePiece encoding and decoding by suffix-array matching.

The new words of a batch are concatenated and indexed by a suffix array; a binary search gives every piece's range of
occurrences. Occurrences are edges, sorted by position and relaxed from the left. The model merges pairs by score, and its
encoding is the one path whose pieces each encode to themselves and whose neighbours each stay apart when encoded as a
pair, so an edge relaxes its end if it is compatible with the piece that ends at its start. No piece of the model crosses
into the next word. Characters without a piece become bytes. Null and empty texts have no ids. Repeated rows are encoded
one by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame

from tallymill.llm.batches import in_small_batches

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
#: Numbers that regular expressions count as letters.
NUMERALS = "²³¹¼½¾"
#: Words of a generation that a worker keeps; the one before is kept beside it, so words in use outlive the change.
WORDS_KEPT = 300_000
#: Pairs of neighbours whose answers a worker keeps, and characters up to which words are relaxed side by side.
PAIRS_KEPT, SHORT = 500_000, 64


def suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes, sorted by their first `depth` characters (a power of two)."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64) + 1
    step = 1
    while step < depth:
        after = np.zeros_like(rank)
        after[:-step] = rank[step:]
        rank = np.unique(rank * (len(text) + 2) + after, return_inverse=True)[1].astype(np.int64) + 1
        step *= 2
    return np.argsort(rank, kind="stable")


class Model:
    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        plain = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.ids = {sp.id_to_piece(i): i for i in plain}
        self.scores = {p: sp.get_score(i) for p, i in self.ids.items()}
        self.text = {i: p for p, i in self.ids.items()}
        self.bytes = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(size) if sp.is_byte(i)}
        self.raw = [b""] * size
        for p, i in self.ids.items():
            self.raw[i] = p.encode()
        for b, i in self.bytes.items():
            self.raw[i] = bytes([b])
        self.depth = 1 << (max(map(len, self.ids)) - 1).bit_length()
        # Words can be taken apart where no piece goes on: before a space mark, and around line ends.
        apart = not any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.ids)
        letter, other = rf"[^\W\d_{NUMERALS}{SPACE}]", rf"[\W\d_{NUMERALS}]"
        # Nor does one here go on from a letter to another character or back, so marks are words of their own.
        crossing = re.compile(rf"{letter}(?!{SPACE}){other}|(?!{SPACE}){other}{letter}")
        if not apart:
            words = r"(?s).+"
        elif any(map(crossing.search, self.ids)):
            words = rf"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n"
        else:
            marks = rf"(?:[^\w{SPACE}\n]+|[\d_{NUMERALS}]+)"
            words = rf"{SPACE}*{letter}+|{SPACE}+{marks}*|{marks}+|\n"
        self.words = re.compile(words)
        self.order = sorted(self.ids)
        self.lengths = np.array([len(p) for p in self.order])
        self.chars = np.zeros((len(self.order), self.depth), np.int64)
        for k, p in enumerate(self.order):
            self.chars[k, : len(p)] = [ord(c) for c in p]
        self.numbers = np.array([self.ids[p] for p in self.order])
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.size = size
        self.pairs, self.answers = np.empty(0, np.int64), np.empty(0, bool)

    def merged(self, text: str) -> list[str]:
        """A short text's pieces, by merging the best pair again and again."""
        parts = list(text)
        while True:
            pairs = [(-self.scores[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.scores]
            if not pairs:
                return parts
            k = min(pairs)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    def fits(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether the pieces can follow; before is -1 at a word's start and after a character without a piece."""
        pairs, which = np.unique((before + 1) * self.size + piece, return_inverse=True)
        at = np.searchsorted(self.pairs, pairs)
        there = at < len(self.pairs)
        there[there] = self.pairs[at[there]] == pairs[there]
        if not there.all():
            if len(self.pairs) > PAIRS_KEPT:
                self.pairs, self.answers, at = self.pairs[:0], self.answers[:0], np.zeros_like(at)
                there[:] = False
            new = [self.stay(a - 1, b) for a, b in zip(*(x.tolist() for x in np.divmod(pairs[~there], self.size)), strict=True)]
            self.answers = np.insert(self.answers, at[~there], new)
            self.pairs = np.insert(self.pairs, at[~there], pairs[~there])
            at = np.searchsorted(self.pairs, pairs)
        return self.answers[at[which]]

    def stay(self, before: int, piece: int) -> bool:
        parts = [self.text[i] for i in (before, piece) if i >= 0]
        return self.merged("".join(parts)) == parts

    def edges(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ids of all pieces' occurrences, sorted by start."""
        order = suffixes(text, self.depth)
        padded = np.concatenate([text, np.zeros(self.depth, np.int64)])
        low, high = np.zeros(len(self.order), np.int64), np.full(len(self.order), len(order), np.int64)
        for d in range(self.depth):
            on = np.flatnonzero((self.lengths > d) & (low < high))
            for upper in (False, True):
                a, b = low[on].copy(), high[on].copy()
                if upper:
                    b = ends
                want = self.chars[on, d] + upper
                while (open_ := a < b).any():
                    mid = (a + b) >> 1
                    less = padded[order[np.minimum(mid, len(order) - 1)] + d] < want
                    a = np.where(open_ & less, mid + 1, a)
                    b = np.where(open_ & ~less, mid, b)
                if upper:
                    high[on] = a
                else:
                    first, ends = a, high[on].copy()
            low[on] = first
        counts = np.maximum(0, high - low)
        which = np.repeat(np.arange(len(counts)), counts)
        at = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts) + low[which]
        starts = order[at]
        by = np.argsort(starts, kind="stable")
        return starts[by], which[by]

    def learn(self, words: list[str]) -> None:
        """Encodes words together: the edges of all words that start at the same place of theirs are relaxed in one go."""
        if not words:
            return
        joined = "\0".join(words) + "\0"
        text = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        starts, which = self.edges(text)
        ids, ends = self.numbers[which], starts + self.lengths[which]
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        begins = np.cumsum(sizes + 1) - sizes - 1
        owner = np.repeat(np.arange(len(words)), sizes + 1)
        place = np.arange(len(text)) - begins[owner]
        inside = ends <= (begins + sizes)[owner[starts]]
        starts, ids, ends = starts[inside], ids[inside], ends[inside]
        single = np.zeros(len(text), bool)
        single[starts[ends == starts + 1]] = True
        skips = np.flatnonzero(~single & (place < sizes[owner]))
        # The piece that ends at a position, and where it starts; -1: none, -2: not reached.
        last, back = np.full(len(text) + 1, -2, np.int64), np.zeros(len(text) + 1, np.int64)
        last[begins] = -1
        by, skip_by = np.argsort(place[starts], kind="stable"), np.argsort(place[skips], kind="stable")
        steps = np.arange(int(sizes.max()) + 1)
        cuts = np.searchsorted(place[starts[by]], steps).tolist()
        skip_cuts = np.searchsorted(place[skips[skip_by]], steps).tolist()
        for a, b, c, d in zip(cuts, cuts[1:], skip_cuts, skip_cuts[1:], strict=False):
            e = by[a:b]
            e = e[last[starts[e]] > -2]
            e = e[self.fits(last[starts[e]], ids[e])]
            last[ends[e]], back[ends[e]] = ids[e], starts[e]
            p = skips[skip_by[c:d]]
            p = p[last[p] > -2]
            last[p + 1], back[p + 1] = -1, p
        # The paths, from the ends back, again side by side.
        at, word, found = begins + sizes, np.arange(len(words)), []
        while len(at := at[on := at > begins[word]]):
            word = word[on]
            found.append((word, back[at], last[at]))
            at = back[at]
        word, start, piece = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(start, kind="stable")
        word, start, piece = word[order], start[order], piece[order]
        spelled = [[self.bytes[x] for x in joined[p].encode("utf-8", "replace")] for p in start[piece < 0].tolist()]
        counts = np.ones(len(piece), np.int64)
        counts[piece < 0] = [len(own) for own in spelled]
        flat = np.repeat(piece, counts)
        flat[flat < 0] = list(chain.from_iterable(spelled))
        edges = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(word, np.arange(len(words) + 1))].tolist()
        data = flat.astype(np.int32).tobytes()
        for w, a, b in zip(words, edges, edges[1:], strict=False):
            self.known[w] = data[4 * a : 4 * b]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.known) > WORDS_KEPT:
            self.before, self.known = self.known, {}
        split = [self.words.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        known, new = self.known, []
        for word in set(chain.from_iterable(split)).difference(known):
            if (ids := self.before.get(word)) is None:
                new.append(word)
            else:
                known[word] = ids
        # Few words are long; they would multiply the steps of all others.
        self.learn([w for w in new if len(w) <= SHORT])
        self.learn([w for w in new if len(w) > SHORT])
        return [np.frombuffer(b"".join(map(known.__getitem__, s)), np.int32) for s in split]

    def decode(self, ids) -> str:
        text = b"".join([self.raw[i] for i in ids]).decode("utf-8", "replace").replace(SPACE, " ")
        return text.removeprefix(" ")


@cache
def model(path: str) -> Model:
    return Model(path)


def encode(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, ids, and the text that they decode to."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = model(path)
        for batch in batches:
            ids = own.encode([t or "" for t in batch["text"]])
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "ids": ids, "decoded": [own.decode(i.tolist()) for i in ids]})

    return in_small_batches(docs).select("doc_id", "text").mapInPandas(run, "doc_id long, ids array<int>, decoded string")
