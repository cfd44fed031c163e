"""Token ids in flat binary files, as a data source: ``format("token_files")``.

A folder holds a manifest and, per shard, three flat little-endian files: ``.ids`` (16-bit unsigned integers if the vocabulary
allows it, else 32-bit ones), ``.offsets`` (64-bit: where each document's ids begin in the shard, and the end) and ``.docs``
(64-bit document ids). Shards follow each other in ascending doc_id order; each one's base, the number of ids before it, is
the prefix sum of the sizes that the writing tasks report, so a document's place in the whole is base plus offset.

Rows are dealt by ranges of (doc_id, hash of the text, row), so no id, however frequent, makes one task. Each task sorts its
range, encodes it batch by batch and writes its shard. The manifest comes last and names the shards of the attempts that
were committed, so what lost or repeated tasks leave behind is never read. Readers map the files into memory where the
folder is mounted, and read ranges of them elsewhere.

Null texts are empty texts: the end id alone. Null ids come first; ties between rows of one id go by their text's hash.
Repeated rows are written as often as they occur. Other columns are ignored. No documents make a manifest without shards.
A text's ids are held by one task at once, as its text is.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from tallymill.llm.word_ids import word_ids
from tallymill.session import new_work_path

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END = 2
#: Documents encoded in one go, and ids handed to Spark in one batch.
DOCS_AT_ONCE, IDS_AT_ONCE = 1_000, 2_000_000
MANIFEST = "manifest.json"
READ = "doc_id long, start long, n_tokens long, ids binary"


@dataclass(frozen=True)
class Shard(WriterCommitMessage):
    """One task's files. Of its documents, the first `null_ids` have no id; `base` ids come before it."""

    number: int
    name: str
    documents: int
    tokens: int
    null_ids: int
    base: int = 0


def _place(folder: str) -> tuple[pa.fs.FileSystem, str]:
    system, path = pa.fs.FileSystem.from_uri(folder)
    return system, path.rstrip("/")


class Writer(DataSourceArrowWriter):
    def __init__(self, folder: str, dtype: str):
        self.folder, self.dtype = folder, dtype

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Shard:
        """One shard of (doc_id, ids) rows in their order, under a name of this attempt's own."""
        number = TaskContext.get().partitionId()
        name, width = f"{number:08d}-{uuid.uuid4().hex}", np.dtype(self.dtype).itemsize
        documents = tokens = null_ids = 0
        files = None
        for batch in iterator:
            if not len(batch):
                continue
            if files is None:
                system, folder = _place(self.folder)
                system.create_dir(folder, recursive=True)
                files = {kind: system.open_output_stream(f"{folder}/{name}.{kind}") for kind in ("ids", "offsets", "docs")}
                files["offsets"].write(np.zeros(1, "<i8"))
            doc_id, ids = batch.column(0), batch.column(1)
            ends = np.cumsum(pa.compute.binary_length(ids).to_numpy(), dtype="<i8") // width
            files["offsets"].write(ends + tokens)
            files["docs"].write(pa.compute.fill_null(doc_id, 0).to_numpy().astype("<i8"))
            begin, end = np.frombuffer(ids.buffers()[1], np.int32)[[ids.offset, ids.offset + len(ids)]].tolist()
            files["ids"].write(ids.buffers()[2][begin:end])
            documents, tokens, null_ids = documents + len(batch), tokens + int(ends[-1]), null_ids + doc_id.null_count
        for file in (files or {}).values():
            file.close()
        return Shard(number, name, documents, tokens, null_ids)

    def commit(self, messages: list[Shard | None]) -> None:
        shards = sorted((m for m in messages if m is not None and m.documents), key=lambda m: m.number)
        bases = np.cumsum([0, *(s.tokens for s in shards)]).tolist()
        placed = [asdict(s) | {"base": base} for s, base in zip(shards, bases, strict=False)]
        system, folder = _place(self.folder)
        system.create_dir(folder, recursive=True)
        with system.open_output_stream(f"{folder}/{MANIFEST}") as out:
            out.write(json.dumps({"dtype": self.dtype, "shards": placed}).encode())

    def abort(self, messages: list[Shard | None]) -> None:
        """Without a manifest nothing of it is read."""


@dataclass
class Part(InputPartition):
    shard: Shard


class Reader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder
        system, path = _place(folder)
        with system.open_input_stream(f"{path}/{MANIFEST}") as file:
            manifest = json.loads(file.read())
        self.dtype, self.shards = manifest["dtype"], [Shard(**s) for s in manifest["shards"]]

    def partitions(self) -> list[Part]:
        # Spark makes a partition of its own where there is none.
        return [Part(s) for s in self.shards] or [Part(Shard(0, "", 0, 0, 0))]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        shard, width = partition.shard, np.dtype(self.dtype).itemsize
        if not shard.documents:
            return
        system, folder = _place(self.folder)

        def mapped(kind: str, dtype: str):
            path = f"{folder}/{shard.name}.{kind}"
            if isinstance(system, pa.fs.LocalFileSystem):
                whole = np.memmap(path, dtype, "r")
                return lambda a, b: whole[a:b]
            file, size = system.open_input_file(path), np.dtype(dtype).itemsize
            return lambda a, b: np.frombuffer(file.read_at((b - a) * size, a * size), dtype)

        ids, offsets, docs = mapped("ids", self.dtype), mapped("offsets", "<i8"), mapped("docs", "<i8")
        at = 0
        while at < shard.documents:
            many = min(DOCS_AT_ONCE, shard.documents - at)
            begins = np.asarray(offsets(at, at + many + 1))
            # As many documents as hold IDS_AT_ONCE ids, and one at least.
            many = max(1, min(many, int(np.searchsorted(begins, begins[0] + IDS_AT_ONCE))))
            begins = begins[: many + 1]
            numbers, data = np.asarray(docs(at, at + many)), ids(int(begins[0]), int(begins[-1]))
            cuts = pa.py_buffer(((begins - begins[0]) * width).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(numbers, mask=np.arange(at, at + many) < shard.null_ids),
                    pa.array(begins[:-1] + shard.base),
                    pa.array(np.diff(begins)),
                    pa.Array.from_buffers(pa.binary(), many, [None, cuts, pa.py_buffer(np.ascontiguousarray(data))]),
                ],
                names=["doc_id", "start", "n_tokens", "ids"],
            )
            at += many


class TokenFiles(DataSource):
    """Options: path; when writing (doc_id long, ids binary), also dtype of the ids, <u2 or <u4."""

    @classmethod
    def name(cls) -> str:
        return "token_files"

    def schema(self) -> str:
        return READ

    def reader(self, schema) -> Reader:
        return Reader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options["path"], self.options.get("dtype", "<u2"))


def encoded(docs: DataFrame, path: str = VOCABULARY, end: int = END) -> DataFrame:
    """(doc_id, ids) of every row, the ids as little-endian bytes with the end id last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = word_ids(path)
        last = np.array([end], own.dtype)
        for batch in batches:
            for at in range(0, len(batch), DOCS_AT_ONCE):
                part = batch.slice(at, DOCS_AT_ONCE)
                ids, edges = own.encode(part.column(1))
                # The end id goes behind each document's last one.
                flat = np.insert(ids, edges[1:], last[0])
                cuts = (edges + np.arange(len(edges))) * own.dtype.itemsize
                data = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(flat)])
                yield pa.RecordBatch.from_arrays([part.column(0), data], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids binary")


def write_token_files(docs: DataFrame, folder: str, path: str = VOCABULARY, end: int = END) -> None:
    """Encodes the documents and writes them to a new folder in ascending doc_id order."""
    spark = docs.sparkSession
    spark.dataSource.register(TokenFiles)
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"))
    ordered = keyed.repartitionByRange("doc_id", "tie", "row").sortWithinPartitions("doc_id", "tie", "row")
    dtype = word_ids(path).dtype.str
    encoded(ordered, path, end).write.format("token_files").option("dtype", dtype).mode("append").save(folder)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids (bytes of the files' type) of every document."""
    spark.dataSource.register(TokenFiles)
    return spark.read.format("token_files").load(folder)


def wide_ids(ids, dtype: str):
    """The ids column as little-endian unsigned 32-bit integers."""

    @F.pandas_udf("binary")
    def widened(column):
        return column.map(lambda data: np.frombuffer(data, dtype).astype("<u4").tobytes())

    return ids if np.dtype(dtype).itemsize == 4 else widened(ids)


def token_output(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (over 32-bit ids) of every document, read back from files written for this."""
    spark = docs.sparkSession
    folder = new_work_path(spark, "token-files")
    write_token_files(docs, folder, path)
    back = read_token_files(spark, folder)
    return back.select("doc_id", "start", "n_tokens", F.crc32(wide_ids(F.col("ids"), word_ids(path).dtype.str)).alias("ids_crc32"))
