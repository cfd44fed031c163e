"""Token files against the tokenizer itself, on odd texts, repeated and null ids, and several shards."""

from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallymill.llm import token_files
from tallymill.llm.word_ids import word_ids

ODD = [
    "Hello,world's  don't! É. ß? x́, é.",
    None,
    "a<|endoftext|>b <|STARTOFTEXT|> c<|endoftext|>",
    "\x1ca b\x1c",
    "1,234.5 don't... 日本語。 wörd*** étés,",
    "a​b ﻿c d",
    "",
    ",",
    "ﬁ½²ⅷ, İI. ǅ.",
    " lead  trail ",
    "x" * 200 + "***.",
    "a\n\nb\tc\r\n",
    "word " * 3000,
]


def plain_ids(text: str | None) -> list[int]:
    tokenizer = Tokenizer.from_file(token_files.VOCABULARY)
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, token_files.END]


def test_words_equal_whole_texts():
    own = word_ids(token_files.VOCABULARY)
    assert own.by_word
    for _ in range(2):
        ids, edges = own.encode(pa.array(["skipped", *ODD]).slice(1))
        for k, text in enumerate(ODD):
            assert [*ids[edges[k] : edges[k + 1]].tolist(), token_files.END] == plain_ids(text)


def test_tokenizer_that_keeps_white_space_gets_whole_texts():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    own, plain = word_ids(path), Tokenizer.from_file(path)
    assert not own.by_word
    ids, edges = own.encode(pa.array(ODD))
    for k, text in enumerate(ODD):
        assert ids[edges[k] : edges[k + 1]].tolist() == plain.encode(text or "", add_special_tokens=False).ids


@pytest.fixture
def docs(spark):
    rows = [(k - 3, t, k) for k, t in enumerate(ODD)] + [(5, "copy", 0)] * 40 + [(None, "no id", 1), (None, None, 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(3)


def test_round_trip(spark, docs, folder):
    token_files.write_token_files(docs, f"{folder}/tokens")
    rows = sorted(token_files.read_token_files(spark, f"{folder}/tokens").collect(), key=lambda r: r["start"])
    at, ids_before = 0, []
    for row in rows:
        assert row["start"] == at and row["n_tokens"] == len(row["ids"]) // 2
        at += row["n_tokens"]
        ids_before.append(row["doc_id"])
    assert ids_before == sorted(ids_before, key=lambda i: (i is not None, i))
    found = sorted((str(r["doc_id"]), np.frombuffer(r["ids"], "<u2").tolist()) for r in rows)
    assert found == sorted((str(r["doc_id"]), plain_ids(r["text"])) for r in docs.collect())


def test_shards_follow_each_other(spark, docs, folder):
    """Several shards, a hot id among them; a file of an attempt that was not committed is not read."""
    copies = docs.withColumn("id", F.explode(F.sequence(F.lit(0), F.lit(29))))
    many = copies.select((F.col("doc_id") + F.col("id") * 100).alias("doc_id"), "text")
    with_hot = many.unionByName(spark.range(2000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("hot copy").alias("text")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_files.write_token_files(with_hot, f"{folder}/tokens")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    with open(f"{folder}/tokens/stray.ids", "wb") as stray:
        stray.write(b"\1\0")
    shards = json.load(open(f"{folder}/tokens/manifest.json"))["shards"]
    assert len(shards) >= 3 and [s["base"] for s in shards] == np.cumsum([0, *(s["tokens"] for s in shards)])[:-1].tolist()
    # The hot id holds most of the rows and lies in several shards.
    assert max(s["documents"] for s in shards) < 2000
    flat = np.concatenate([np.fromfile(f"{folder}/tokens/{s['name']}.ids", "<u2") for s in shards])
    rows = token_files.read_token_files(spark, f"{folder}/tokens").collect()
    assert len(rows) == with_hot.count() and sum(r["n_tokens"] for r in rows) == len(flat)
    for r in rows:
        assert flat[r["start"] : r["start"] + r["n_tokens"]].tobytes() == bytes(r["ids"])


def test_checksums_and_empty_table(docs):
    out = token_files.token_output(docs.select("doc_id", "text"))
    found = sorted(tuple(r) for r in out.where("doc_id is not null and doc_id <> 5").select("doc_id", "n_tokens", "ids_crc32").collect())
    want = []
    for k, text in enumerate(ODD):
        if k - 3 != 5:
            ids = np.array(plain_ids(text), "<u4")
            want.append((k - 3, len(ids), zlib.crc32(ids.tobytes())))
    assert found == sorted(want)
    assert token_files.token_output(docs.where("false")).count() == 0
