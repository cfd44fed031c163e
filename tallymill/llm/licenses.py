"""License scans by MinHash over overlapping text windows.

Texts and templates are sets of five-word shingles (lower case, words of letters and digits); a template of fewer words is
one shingle of all its words, and texts have shingles of that length for it. Windows of eight shingles,
four apart, have one minimum for each of 64 hashes, and each minimum is a band: a window that shares a tenth of its union
with a template's window collides with probability 0.998. Collisions are verified by the exact share of the template's
shingles in the whole text. Null, empty and shorter texts hold no license. Repeated rows are scanned row by row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame

from tallymill.llm.batches import in_small_batches
from tallymill.llm.minhash import MIX, mixed

SHINGLE, WINDOW, STEP, HASHES, CONTAINMENT = 5, 8, 4, 64, 0.8
#: Texts whose windows are hashed in one go.
TEXTS_TOGETHER = 64
WORD = re.compile(r"[^\W_]+")
#: The notices themselves.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "All-Rights-Reserved": "All rights reserved.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction"
    ),
    "BSD-text": "Redistribution and use in source and binary forms, with or without modification, are permitted",
}


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def shingles(texts: list[list[str]], wide: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of all texts one after the other, and where each text's begin (one entry more than texts)."""
    number = {w: xxhash.xxh3_64_intdigest(w) for w in set().union(*texts)}
    hashes = np.array([number[w] for split in texts for w in split] + [0] * (wide - 1), dtype=np.uint64)
    out = np.zeros(len(hashes) - wide + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(wide):
            out = mixed(out * MIX[1] + hashes[k : k + len(out)])
    lengths = np.array([len(split) for split in texts], dtype=np.int64)
    counts = np.maximum(0, lengths - wide + 1)
    # The last words of a text begin no shingle.
    place = np.arange(len(out)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return out[place < np.repeat(counts, lengths)], np.concatenate([[0], np.cumsum(counts)])


def windows(counts: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and first shingle (from the text's) of every window; a text's last window reaches its end."""
    many = np.where(counts > 0, np.maximum(1, -(-(counts - WINDOW + step) // step)), 0)
    text = np.repeat(np.arange(len(counts)), many)
    return text, step * (np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many))


def minima(found: np.ndarray, edges: np.ndarray, step: int) -> tuple[np.ndarray, Iterator[np.ndarray]]:
    """The text of each window, and for each hash the windows' minima. Room after each text keeps windows inside it."""
    counts = np.diff(edges)
    text, first = windows(counts, step)
    own = np.repeat(np.arange(len(counts)), counts)
    padded = np.zeros(len(found) + WINDOW * len(counts), np.uint64)
    blank = np.ones(len(padded), bool)
    at = np.arange(len(found)) + WINDOW * own
    padded[at], blank[at] = found, False
    blank = np.flatnonzero(blank)
    starts = edges[text] + WINDOW * text + first

    def rows() -> Iterator[np.ndarray]:
        for k in range(HASHES):
            h = mixed(padded ^ np.uint64(k * 0x9E3779B97F4A7C15 % 2**64))
            h[blank] = np.uint64(2**64 - 1)
            width = 1
            while width < WINDOW:
                np.minimum(h[:-width], h[width:], out=h[:-width])
                width *= 2
            yield h[starts]

    return text, rows()


class Index:
    """Templates of one shingle length."""

    def __init__(self, templates: dict[str, str], wide: int):
        self.names, self.wide = sorted(templates), wide
        self.sets, tables = [], [[] for _ in range(HASHES)]
        for n, name in enumerate(self.names):
            split = words(templates[name])
            self.sets.append(self.own(split))
            for k, low in enumerate(minima(*shingles([split], wide), 1)[1]):
                tables[k] += [(int(v), n) for v in low]
        self.tables = [(np.array([v for v, _ in sorted(set(t))], np.uint64), [n for _, n in sorted(set(t))]) for t in tables]

    def own(self, split: list[str]) -> set[tuple[str, ...]]:
        return {tuple(split[k : k + self.wide]) for k in range(len(split) - self.wide + 1)}

    def candidates(self, texts: list[list[str]]) -> list[set[int]]:
        """For each text the templates that share a band with one of its windows."""
        out: list[set[int]] = [set() for _ in texts]
        text, rows = minima(*shingles(texts, self.wide), STEP)
        for (values, names), low in zip(self.tables, rows, strict=True):
            left, right = np.searchsorted(values, low, "left"), np.searchsorted(values, low, "right")
            hit = np.flatnonzero(right > left)
            for t, a, b in set(zip(text[hit].tolist(), left[hit].tolist(), right[hit].tolist(), strict=True)):
                out[t].update(names[a:b])
        return out

    def matches(self, texts: list[list[str]]) -> list[list[str]]:
        return [self.verified(split, chosen) for split, chosen in zip(texts, self.candidates(texts), strict=True)]

    def verified(self, split: list[str], chosen: set[int]) -> list[str]:
        if not chosen:
            return []
        own = self.own(split)
        return [self.names[n] for n in sorted(chosen) if len(own & self.sets[n]) >= CONTAINMENT * len(self.sets[n])]


def indexes(templates: dict[str, str]) -> list[Index]:
    by: dict[int, dict[str, str]] = {}
    for name, text in templates.items():
        if not (n := len(words(text))):
            raise ValueError(f"{name} has no words")
        by.setdefault(min(SHINGLE, n), {})[name] = text
    return [Index(part, wide) for wide, part in sorted(by.items())]


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id and the names of the licenses it holds, sorted."""
    chosen = templates or TEMPLATES

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        every = indexes(chosen)
        for batch in batches:
            found = []
            for at in range(0, len(batch), TEXTS_TOGETHER):
                texts = [words(t or "") for t in batch["text"].iloc[at : at + TEXTS_TOGETHER]]
                found += [sorted(sum(of, [])) for of in zip(*(index.matches(texts) for index in every), strict=True)]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "licenses": found})

    return in_small_batches(docs).select("doc_id", "text").mapInPandas(run, "doc_id long, licenses array<string>")
