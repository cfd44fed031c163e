"""Token ids of whole texts by the tokenizers library, with the ids of known words kept."""

from __future__ import annotations

import string
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words of a generation that a worker keeps; the one before is kept beside it, so words in use outlive the change.
WORDS_KEPT = 200_000
#: Longer words are encoded each time, so that what is kept is bounded in bytes too.
LONGEST_KEPT = 64
#: Marks that a letter before them never joins; the apostrophe may.
MARKS = string.punctuation.replace("'", "")
#: Of letters before this one, every version of Unicode says the same; one of them becomes two characters in lower case.
FIRST_OTHER, DOTTED = "\u0180", "\u0130"
#: The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, others from 256 on.
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = {b: b for b in SHOWN} | {b: 256 + k for k, b in enumerate(sorted(set(range(256)).difference(SHOWN)))}


def plain_letters(word: str) -> bool:
    """Whether a word is one run of common Latin letters to any tokenizer, which normal forms leave as they are."""
    return word.isalpha() and (word.isascii() or (max(word) < FIRST_OTHER and DOTTED not in word))


def byte_letters(text: str) -> str:
    """A text's UTF-8 bytes in the letters of byte-level vocabularies."""
    return text if text.isascii() and text.isalpha() else text.encode().decode("latin-1").translate(BYTE_LETTERS)


class WordIds:
    """Ids as bytes of the smallest unsigned type that holds the vocabulary.

    Where the tokenizer drops white space (seen by a trial), no token crosses it, so each new word is encoded once; other
    tokenizers get whole texts. Special tokens written out in a text become their ids, as the library does by default.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        added = self.tokenizer.get_added_tokens_decoder()
        largest = max([self.tokenizer.get_vocab_size() - 1, *added])
        self.dtype = np.dtype("<u2" if largest < 1 << 16 else "<u4")
        self.code = self.dtype.char
        self.known: dict[str, bytes] = {}
        trial = ["Ab", "C9", "\u00c9t\u00e9s,", "don't", "abcdefgh"]
        single = b"".join(self.whole(trial))
        self.by_word = self.whole([" Ab\n\tC9\xa0\u00c9t\u00e9s, \rdon't abcdefgh\x0b"])[0] == single
        self.by_word &= not any(t.single_word or t.lstrip or t.rstrip or any(map(str.isspace, t.content)) for t in added.values())
        if self.by_word:
            self._learn(trial)
            self.by_word = b"".join(map(self.known.__getitem__, trial)) == single
        self.before: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(f.ids, self.dtype).tobytes() for f in found]

    def _learn(self, words: list[str]) -> None:
        """Plain words go straight to the vocabulary's merges, without the marks after them; others to the tokenizer."""
        others, code, model, known = [], self.code, self.tokenizer.model, self.known
        for word in words:
            stem = word.rstrip(MARKS)
            if stem and plain_letters(stem):
                ids = known.get(stem)
                if ids is None:
                    ids = array(code, [t.id for t in model.tokenize(byte_letters(stem.lower()))]).tobytes()
                    known[stem] = ids
                if marks := word[len(stem) :]:
                    if marks not in known:
                        known[marks] = self.whole([marks])[0]
                    known[word] = ids + known[marks]
            else:
                others.append(word)
        known.update(zip(others, self.whole(others), strict=True))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids one after the other, and where each text's begin and the last one's end."""
        texts = pc.fill_null(texts, "")
        if not self.by_word:
            found = self.whole(texts.to_pylist())
            sizes = np.array([len(f) for f in found], dtype=np.int64) // self.dtype.itemsize
            return np.frombuffer(b"".join(found), self.dtype), np.concatenate([[0], np.cumsum(sizes)])
        split = pc.ascii_split_whitespace(texts)
        flat = split.flatten().dictionary_encode()
        words, which = flat.dictionary.to_pylist(), flat.indices.to_numpy()
        ids = self._ids(words)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
        pool = np.frombuffer(b"".join(ids), self.dtype)
        many = sizes[which]
        ends = np.cumsum(many)
        begins = np.cumsum(sizes) - sizes
        at = np.repeat(begins[which] - (ends - many), many)
        at += np.arange(len(at))
        counts = pc.list_value_length(split).to_numpy()
        return pool[at], np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]

    def _ids(self, words: list[str]) -> list[bytes]:
        if len(self.known) > WORDS_KEPT:
            self.before, self.known = self.known, {}
        known = self.known
        ids = list(map(known.get, words))
        missing = [k for k, i in enumerate(ids) if i is None]
        new = []
        for k in missing:
            if (kept := self.before.get(words[k])) is None:
                new.append(words[k])
            else:
                known[words[k]] = kept
        self._learn(new)
        for k in missing:
            ids[k] = known[words[k]]
        for word in new:
            if len(word) > LONGEST_KEPT:
                del known[word]
        return ids


@cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)
