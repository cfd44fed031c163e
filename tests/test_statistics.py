import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallymill.operators.statistics import exact_median, modes

SCHEMA = "x double"


def median_of(frame, numbers, **options):
    return exact_median(frame(SCHEMA, *[(n,) for n in numbers]), "x", **options)


@pytest.mark.parametrize(
    "numbers", [[3.0], [1.0, 2.0], [-5.0, 0.0, 7.0], [1.0, None, math.nan, 4.0], [2.0] * 9 + [1.0]]
)
def test_median(frame, numbers):
    known = [n for n in numbers if n is not None]
    assert median_of(frame, numbers) == np.nanmedian(known)


def test_median_of_nothing(frame):
    assert median_of(frame, []) is None
    assert median_of(frame, [None, math.nan]) is None


@pytest.mark.parametrize("size", [1001, 5000])
def test_narrowing_gives_the_same(spark, size):
    """A limit of ten distinct values per task forces several narrowing passes."""
    rng = np.random.default_rng(size)
    numbers = np.concatenate([rng.lognormal(3, 2, size).round(3), [42.0] * (size // 3)])
    df = spark.createDataFrame([(float(n),) for n in numbers], SCHEMA)
    assert exact_median(df, "x", distinct_limit=10) == np.median(numbers)


def test_narrowing_large(spark):
    from pyspark.sql import functions as F

    numbers = spark.range(200_000).select(((F.col("id") * 7919) % 200_003).cast("double").alias("x"))
    expected = np.median([(i * 7919) % 200_003 for i in range(200_000)])
    assert exact_median(numbers, "x", distinct_limit=1000) == expected


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=60))
def test_median_property(frame, numbers):
    assert median_of(frame, numbers, distinct_limit=5) == pytest.approx(np.median(numbers), abs=0)


def test_modes(frame):
    df = frame(
        "a string, b string, c string",
        ("x", "q", None), ("y", "p", None), ("y", "q", None), ("x", "p", None), (None, "r", None),
    )
    assert modes(df, ["a", "b", "c"]) == {"a": "x", "b": "p", "c": None}
