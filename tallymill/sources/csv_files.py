"""Delivered CSV files and exported rejects.

Everything is read as text first: a null token or a bad number in one row must not fail its
file, and the token list is longer than a CSV reader's single ``nullValue``.
"""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallymill.schemas import FEEDS

# ---- fixed values ----
# Text that stands for "no value" in a delivered file.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# File-name word -> staging table, first match wins.
FEED_WORDS = [
    ("customer", "customers_stage"),
    ("transaction", "sales_transactions_stage"),
    ("product", "products_stage"),
]
# ---- end of fixed values ----

MALFORMED = "_malformed"
CSV_OPTIONS = {
    "header": "true",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": MALFORMED,
    # The schema is made from the file's own header.
    "enforceSchema": "true",
    # Blanks are data here; cleaning decides about them later.
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "escape": '"',
}
CSV_WRITE_OPTIONS = {
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "escape": '"',
}


def staging_table_of(file_name: Column) -> Column:
    """Staging table for a file name, null for an unknown file."""
    lowered = F.lower(file_name)
    table = F.lit(None).cast("string")
    for word, name in reversed(FEED_WORDS):
        table = F.when(lowered.contains(word), name).otherwise(table)
    return table


def feed_glob(table: str) -> str:
    """Case-tolerant file pattern of a feed; ``staging_table_of`` settles names with two words."""
    word = next(word for word, name in FEED_WORDS if name == table)
    return "*" + "".join(f"[{c.lower()}{c.upper()}]" for c in word) + "*.csv"


def raw_schema(table: str) -> StructType:
    """All feed columns as text, plus the whole line of a row with too many or too few fields."""
    names = [*FEEDS[table].fieldNames(), MALFORMED]
    return StructType([StructField(name, StringType(), True) for name in names])


def null_tokens_to_null(text: Column) -> Column:
    return F.when(~text.isin(NULL_TOKENS), text)


def type_feed(raw: DataFrame, table: str) -> DataFrame:
    """Feed columns in their types, plus ``corrupt_text``: the row, where it does not fit."""
    misfit = F.col(MALFORMED).isNotNull()
    typed = {}
    for field in FEEDS[table].fields:
        text = null_tokens_to_null(F.col(field.name))
        if isinstance(field.dataType, StringType):
            typed[field.name] = text
        elif field.dataType.typeName() == "long":
            # Ids of a column with gaps are often delivered as 12.0; 12.5 is no id.
            number = F.trim(text).try_cast("double")
            whole = F.when(number == F.floor(number), F.trim(text).try_cast("decimal(38,6)"))
            typed[field.name] = whole.try_cast("long")
            misfit = misfit | (text.isNotNull() & typed[field.name].isNull())
        else:
            typed[field.name] = F.trim(text).try_cast(field.dataType)
            misfit = misfit | (text.isNotNull() & typed[field.name].isNull())
    line = F.concat_ws(",", *[F.coalesce(f, F.lit("")) for f in FEEDS[table].fieldNames()])
    return raw.withColumn(
        "corrupt_text", F.when(misfit, F.coalesce(F.col(MALFORMED), line))
    ).withColumns(typed).drop(MALFORMED)


# A header longer than this is no header.
LONGEST_HEADER = 1 << 16


@dataclass(frozen=True)
class DeliveredFile:
    """A file with its header's columns, or with the reason why it cannot be staged."""

    path: str
    columns: tuple[str, ...] = ()
    trouble: str | None = None
    detail: str | None = None

    @property
    def name(self) -> str:
        return self.path.rsplit("/", 1)[-1]


def own_file_name() -> Column:
    """The name of the file a row comes from; the metadata has it percent-encoded."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def literal(path: str) -> str:
    """A path whose pattern characters stand for themselves."""
    return re.sub(r"([\\\[\]{}*?,])", r"\\\1", path)


def _first_lines(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """First line by file name; an empty file has none. Reads all files to their ends."""
    lines = spark.read.text([literal(p) for p in paths]).select(
        own_file_name().alias("name"),
        F.col("_metadata.file_block_start").alias("begins"),
        F.substring("value", 1, LONGEST_HEADER).alias("value"),
        F.monotonically_increasing_id().alias("at"),
    )
    # Rows of a split come in the file's order; only the split at 0 has the first one.
    first = F.min_by("value", F.when(F.col("begins") == 0, F.col("at")))
    found = lines.groupBy("name").agg(first.alias("line")).where(F.col("line").isNotNull())
    return {row["name"]: row["line"] for row in found.collect()}


def _readable_lines(spark: SparkSession, paths: list[str]) -> tuple[dict[str, str], dict[str, str]]:
    """First lines, and the errors of files that cannot be read to their ends, by name.

    Files that fail are found by halving the list: one bad file of n costs about 2 log n jobs.
    """
    try:
        return _first_lines(spark, paths), {}
    except Exception as error:
        if len(paths) == 1:
            return {}, {paths[0].rsplit("/", 1)[-1]: str(error).strip().splitlines()[0][:500]}
    lines: dict[str, str] = {}
    errors: dict[str, str] = {}
    for half in (paths[: len(paths) // 2], paths[len(paths) // 2 :]):
        some, bad = _readable_lines(spark, half)
        lines |= some
        errors |= bad
    return lines, errors


def inspect_files(spark: SparkSession, paths: list[str], table: str) -> list[DeliveredFile]:
    """Each file's columns by its own header, or why it is set aside: it cannot be read, its first
    line is empty, a column is named twice, or a column is none of the feed's. Columns may come in
    any order, and may be missing. (Spark lists no files of zero bytes; they stay where they are.) The paths are those of one micro-batch, a bounded number.

    If no file of several can be read, the store is at fault, and the error is raised.
    """
    lines, errors = _readable_lines(spark, paths)
    if len(errors) == len(paths) > 1:
        raise OSError(f"none of {len(paths)} files can be read: {next(iter(errors.values()))}")
    known = set(FEEDS[table].fieldNames())

    def inspected(path: str) -> DeliveredFile:
        name = path.rsplit("/", 1)[-1]
        if name in errors:
            return DeliveredFile(path, trouble="UNREADABLE", detail=errors[name])
        if not lines.get(name, "").strip():
            return DeliveredFile(path, trouble="EMPTY")
        columns = tuple(next(csv.reader([lines[name].removeprefix("\ufeff").replace("\0", "")])))
        if len(set(columns)) < len(columns):
            return DeliveredFile(path, trouble="REPEATED_COLUMN", detail=",".join(columns))
        if unknown := [c for c in columns if c not in known]:
            return DeliveredFile(path, trouble="UNKNOWN_COLUMN", detail=",".join(unknown)[:500])
        return DeliveredFile(path, columns)

    return [inspected(path) for path in paths]


def read_with_header(
    spark: SparkSession, paths: list[str], columns: tuple[str, ...], table: str
) -> DataFrame:
    """Files that share a header, typed by column name; what the header lacks is null."""
    delivered = StructType([StructField(c, StringType(), True) for c in (*columns, MALFORMED)])
    raw = spark.read.options(**CSV_OPTIONS).schema(delivered).csv([literal(p) for p in paths])
    by_name = [
        F.col(f"`{c}`") if c in columns else F.lit(None).cast("string").alias(c)
        for c in FEEDS[table].fieldNames()
    ]
    return type_feed(raw.select(*by_name, MALFORMED, own_file_name().alias("source_file")), table)


def read_feed_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One delivered file, typed, misfit rows marked in ``corrupt_text``.

    Columns go by the file's own header: their order is free, a missing one is null.
    """
    header = spark.read.options(header="true", escape='"').csv(path).columns
    return read_with_header(spark, [path], tuple(header), table).drop("source_file")


def read_rejected_csv(spark: SparkSession, pattern: str, schema: StructType) -> DataFrame:
    """All reject exports matching a glob, as one frame."""
    return spark.read.options(header="true", escape='"').schema(schema).csv(pattern)


def unknown_files(spark: SparkSession, folder: str) -> DataFrame:
    """CSV files whose name says nothing about their feed. Reads names, not contents."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .option("ignoreMissingFiles", "true")  # staged files may be moved away meanwhile
        .load(folder)
        .select(F.element_at(F.split("path", "/"), -1).alias("file_name"))
        .where(staging_table_of(F.col("file_name")).isNull())
    )
