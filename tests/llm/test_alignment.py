"""Alignment against the tokenizers and plain loops over bytes; matrices against dense ones."""

from __future__ import annotations

import os
import subprocess
import sys
import tracemalloc
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest

from tallymill.llm import alignment

ODD = [
    "Hello,world's  don't! É. ß? x́, é.", None, "a<|endoftext|>b <s> c</s><0x0A>", "\x1ca b\x1c",
    "1,234.5 don't... 日本語。 ", "a​b ﻿c", "", ",", "ﬁ½²ⅷ, İI. ǅ.", "a b", " lead  trail ",
    "x" * 200 + "***.", "a\n\nb \n c\t d", " ", "  ", "▁x y", "\0a \0", "\n", "a  b", "ends ",
    "wörd étés, fin. <|endoftext|>", "the same word, the same word", "the same word, the same word", "long text of words " * 400,
]
#: The document that holds U+2581, which B cannot tell from a space.
SPOILT = ODD.index("▁x y")


def plain(text):
    """Ids of both, and groups as (A's tokens, B's tokens) by their places, with the tokens' byte ends."""
    import sentencepiece
    from tokenizers import Tokenizer

    own = alignment.aligner(alignment.BYTE_LEVEL, alignment.PIECES)
    tokenizer = Tokenizer.from_file(alignment.BYTE_LEVEL)
    tokenizer.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=alignment.PIECES)
    if not text:
        return [], [], [], [], []
    a, b = tokenizer.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
    data = (" " + text).encode()
    if b"".join(own.a_bytes[i] for i in a) != data or b"".join(own.b_bytes[i] for i in b) != data:
        return [], [], [], [], []
    a_ends, b_ends = (np.cumsum(sizes[ids]).tolist() for sizes, ids in ((own.a_sizes, a), (own.b_sizes, b)))
    groups, begin = [], 0
    for end in sorted(set(a_ends) & set(b_ends)):
        groups.append([[k for k, e in enumerate(ends) if begin < e <= end] for ends in (a_ends, b_ends)])
        begin = end
    return a, b, groups, a_ends, b_ends


def brute_force(texts):
    """The query's rows, by loops over all texts."""
    found, held, links = [], Counter(), []
    for text in texts:
        a, b, groups, _, _ = plain(text)
        links.append(Counter((a[x], b[y]) for xs, ys in groups for x in xs for y in ys))
        held.update(links[-1].keys())
        shown = ";".join(",".join(str(a[x]) for x in xs) + "|" + ",".join(str(b[y]) for y in ys) for xs, ys in groups)
        digest = sha256(shown.encode()).hexdigest() if groups else ""
        found.append([len(a), len(b), len(groups), sum(links[-1].values()), digest])
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    for row, own in zip(found, links, strict=True):
        best = sum(n for p, n in own.items() if held[p] == most[p[0]])
        row[4:4] = [best, sum(n * held[p] for p, n in own.items())]
    return found


def test_products_equal_dense_ones():
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 3, (7, 9)) * (rng.random((7, 9)) < 0.4), rng.integers(0, 3, (9, 5)) * (rng.random((9, 5)) < 0.4)

    def sparse(m):
        rows, columns = np.nonzero(m)
        return alignment.Csr.of_entries(rows, columns, m[rows, columns], *m.shape)

    def dense(m):
        out = np.zeros((len(m.indptr) - 1, m.width), np.int64)
        np.add.at(out, (m.rows(), m.columns), m.values)
        return out

    assert (dense(sparse(x).times(sparse(y))) == x @ y).all()
    assert (dense(sparse(x).transposed()) == x.T).all()
    assert (sparse(x).dot(np.arange(9)) == x @ np.arange(9)).all()
    nothing = sparse(np.zeros((3, 4), int))
    assert (dense(nothing.times(sparse(np.zeros((4, 2), int)))) == 0).all()


def test_products_take_memory_by_the_result(monkeypatch):
    rng = np.random.default_rng(4)
    # 200 documents of 1,000 words of 20 pairs each make 4 million products, but 200 by 50 sums.
    x, y = (alignment.Csr.of_ranges(np.zeros(n, int), np.full(n, w), w) for n, w in ((200, 1_000), (1_000, 20)))
    x.values, y.columns, y.width = rng.integers(1, 5, 200_000), rng.integers(0, 50, 20_000), 50
    tracemalloc.start()
    found = x.times(y)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 60e6
    monkeypatch.setattr(alignment, "PRODUCTS", 1 << 40)
    whole = x.times(y)
    for name in ("indptr", "columns", "values"):
        assert (getattr(found, name) == getattr(whole, name)).all()
    # Fewer than a row makes, and rows without any.
    monkeypatch.setattr(alignment, "PRODUCTS", 3)
    bare = alignment.Csr(np.array([0, 0, 2, 2, 3, 3]), np.array([0, 1, 2]), np.array([1, 2, 3]), 1_000)
    few = bare.times(y)
    assert few.indptr[[1, 3, 5]].tolist() == [0, few.indptr[2], len(few.columns)]
    assert few.values.sum() == 20 * (1 + 2 + 3)


def test_a_worker_keeps_few_words(monkeypatch):
    monkeypatch.setattr(alignment, "WORDS_KEPT", 50)
    monkeypatch.setattr(alignment, "WORDS_LEARNED", 7)
    own = alignment.Aligner(alignment.BYTE_LEVEL, alignment.PIECES)
    words = [f"word{k}" for k in range(300)]
    first = own.words(words)
    assert len(own.known) <= 50 and len(own.before) <= 50
    assert first == own.words(words) == own._learn(words)
    assert len(own.known) <= 50 and len(own.before) <= 50


def test_blocks_do_not_depend_on_batches(monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_DOCS", 5)
    monkeypatch.setattr(alignment, "BLOCK_CHARS", 20)
    texts = ["x" * n for n in (3, 0, 30, 4, 4, 4, 4, 4, 1, 1, 1, 1, 1, 1, 19, 2, 20, 21)]
    rows = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    want = [b.column(0).to_pylist() for b in alignment.blocks(iter([rows]))]
    assert want == [[0, 1], [2], [3, 4, 5, 6, 7], [8, 9, 10, 11, 12], [13, 14], [15], [16], [17]]
    for size in (1, 2, 7):
        parts = [rows.slice(at, size) for at in range(0, len(rows), size)]
        assert [b.column(0).to_pylist() for b in alignment.blocks(iter([rows.slice(0, 0), *parts]))] == want


def test_links_of_one_text():
    text = "wörd unbelievably, 日本語 étés."
    a, b, groups, a_ends, b_ends = plain(text)
    a_ends, b_ends = np.array(a_ends), np.array(b_ends)
    overlaps = alignment.overlap_links(a_ends, b_ends)
    found = set(zip(overlaps.rows().tolist(), overlaps.columns.tolist(), overlaps.values.tolist(), strict=True))
    spans = [list(zip([0, *e[:-1]], e, strict=True)) for e in (a_ends.tolist(), b_ends.tolist())]
    want = {(x, y, min(p[1], q[1]) - max(p[0], q[0])) for x, p in enumerate(spans[0]) for y, q in enumerate(spans[1])}
    assert found == {w for w in want if w[2] > 0}
    shared = alignment.group_links(*alignment.group_numbers(a_ends, b_ends))
    links = set(zip(shared.rows().tolist(), shared.columns.tolist(), strict=True))
    assert links == {(x, y) for xs, ys in groups for x in xs for y in ys}
    assert {(x, y) for x, y, _ in found} <= links


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, 0, "clash") for k, t in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, block int, n_a string")


def test_query_equals_brute_force(docs):
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rows = {r["doc_id"]: [r[n] for n in names] for r in alignment.alignment(docs.repartition(3)).collect()}
    want = brute_force(ODD)
    assert len(rows) == len(ODD)
    assert [rows[k] for k in range(len(ODD))] == want
    for k in (SPOILT, ODD.index(None), ODD.index("")):
        assert rows[k] == [0] * 6 + [""]


def test_repeated_and_null_ids_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_DOCS", 3)
    texts = ["one two", "one two", None, "three", "one two", "one three", "two"]
    rows = [(5, t) for t in texts[:3]] + [(None, t) for t in texts[3:]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = sorted(tuple(r) for r in alignment.alignment(docs).collect() if r["doc_id"] is not None)
    want = sorted((5, *w) for w in brute_force(texts)[:3])
    assert found == want
    assert alignment.alignment(docs).where("doc_id is null").count() == 4
    assert alignment.alignment(docs.where("false")).count() == 0
    assert alignment.alignment(docs.where("text is null")).collect()[0]["groups_sha256"] == ""


def test_tokens_of_documents(docs):
    for row in alignment.aligned_tokens(docs.where("length(text) < 500 or text is null")).collect():
        a, b, groups, a_ends, b_ends = plain(ODD[row["doc_id"]])
        assert row["a_ids"] == a and row["b_ids"] == b
        assert [[k for k, g in enumerate(row["a_groups"]) if g == n] for n in range(len(groups))] == [g[0] for g in groups]
        assert sum(o["bytes"] for o in row["overlaps"]) == (a_ends[-1] if a else 0)


GROWTH = """
import random, sys
from tallymill.llm import alignment

def held():
    return next(int(line.split()[1]) for line in open("/proc/self/status") if line.startswith("RssAnon")) / 1024

own, draw = alignment.Aligner(alignment.BYTE_LEVEL, alignment.PIECES), random.Random(3)
if hasattr(alignment, "lean"):
    alignment.lean()
own.words(["warm", "up"])
before = held()
for _ in range(95):
    own.words(["".join(draw.choices("aeioustrn", k=9)) + str(draw.random())[2:6] for _ in range(4_000)])
print(len(own.known) + len(own.before), held() - before)
"""


def test_kept_words_take_little_memory():
    env = {**os.environ, "TOKENIZERS_PARALLELISM": "false", "PYTHONPATH": os.pathsep.join(p for p in sys.path if p)}
    said = subprocess.run([sys.executable, "-c", GROWTH], env=env, capture_output=True, text=True, check=True, timeout=300)
    words, grown = said.stdout.split()
    assert int(words) > 300_000
    assert float(grown) < 120


def test_small_numbers_come_back_from_bytes():
    for most, size in ((0, 1), (255, 1), (256, 2), (65_536, 4)):
        numbers = np.array([0, most, 1])
        data = alignment.small(numbers)
        assert len(data) == 3 * size
        assert alignment.wide(data, 3).tolist() == numbers.tolist()
    assert len(alignment.wide(alignment.small(np.empty(0, np.int64)), 0)) == 0
