"""How many texts a Python worker holds at once."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

#: Texts may be long; a batch of Spark's usual 10,000 would not fit beside a small executor's heap.
TEXTS_A_BATCH = 256
SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_small_batches(docs: DataFrame) -> DataFrame:
    """The same frame; what is planned from now on hands Python TEXTS_A_BATCH rows at a time."""
    docs.sparkSession.conf.set(SETTING, str(TEXTS_A_BATCH))
    return docs


@contextmanager
def few_rows_a_batch(docs: DataFrame) -> Iterator[None]:
    """The same for what runs inside; groups planned behind it go to Python in batches as before."""
    before = docs.sparkSession.conf.get(SETTING)
    in_small_batches(docs)
    try:
        yield
    finally:
        docs.sparkSession.conf.set(SETTING, before)
