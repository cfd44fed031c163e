from __future__ import annotations

import tempfile

import pytest

from tallymill.session import build_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tallymill-tests",
        master="local[8]",
        shuffle_partitions=4,
        extra={
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def frame(spark):
    def make(schema: str, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make


def values(df, *columns):
    """Rows as sorted tuples."""
    rows = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))
