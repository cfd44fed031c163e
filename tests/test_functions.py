from datetime import date

import pytest
from pyspark.sql import functions as F

from tallymill.functions.dates import date_key, day_format, looks_like_iso_date, parse_day, weekday_name
from tallymill.functions.numbers import money, nan_to_null, round_cents
from tallymill.functions.text import STOP_NAMES, blank_to_null, is_valid_product_name, strip
from tests.conftest import values


def one(frame, kind, expression, *inputs):
    df = frame(f"i int, x {kind}", *enumerate(inputs))
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_strip_takes_unicode_blanks(frame):
    got = one(frame, "string", strip, "  a b ", " x ", "\x1cy\x1f", "", None, "z\n")
    assert got == ["a b", "x", "y", "", None, "z"]


def test_blank_to_null(frame):
    got = one(frame, "string", blank_to_null, "", "   ", "\t\n", "　", "\x1d", " a ", None)
    assert got == [None, None, None, None, None, " a ", None]


@pytest.mark.parametrize("name", STOP_NAMES)
def test_stop_names_are_invalid(frame, name):
    assert one(frame, "string", is_valid_product_name, f" {name.title()} ") == [False]


def test_product_names(frame):
    names = ["Building", " Up ", "abc", "abcd", "12345", "Ⅳ½³²", "一二三四", "12a45", "", None, "Oils"]
    got = one(frame, "string", is_valid_product_name, *names)
    assert got == [True, False, False, True, False, False, False, True, False, False, True]
    # the rule for bare numbers is Python's
    assert all(n.isnumeric() for n in ("12345", "Ⅳ½³²", "一二三四"))


def test_rounding_is_half_even_on_the_scaled_double(frame):
    inputs = [1.005, 2.675, 1.015, 0.125, -0.125, 919.34]
    assert one(frame, "double", round_cents, *inputs) == [1.0, 2.68, 1.01, 0.12, -0.12, 919.34]


def test_round_matches_numpy(frame):
    import numpy as np

    inputs = [float(x) for x in np.random.default_rng(7).uniform(-1000, 1000, 500).round(3)]
    assert one(frame, "double", round_cents, *inputs) == [float(np.round(x, 2)) for x in inputs]


def test_nan_to_null_and_money(frame):
    assert one(frame, "double", nan_to_null, float("nan"), 1.0, None) == [None, 1.0, None]
    assert [str(v) for v in one(frame, "double", money, 1.5, 229.835)] == ["1.50", "229.84"]


def test_parse_day_is_strict_and_lenient(frame):
    texts = ["2023-02-28", "2023-02-31", "2023-99-99", "2023", "2023-1-5", "2023-01-5T",
             " 2023-01-05", "invalid_date", "", None, "2024-02-29", "2023-02-29"]
    got = one(frame, "string", parse_day, *texts)
    assert got == [date(2023, 2, 28), *[None] * 9, date(2024, 2, 29), None]


def test_parse_day_takes_times_and_compact_days(frame):
    texts = ["2023-02-28 23:59:59", "2023-02-28T00:00", "2023-02-28 10:00:00.123456", "20230228",
             "2023-02-28 24:30:00", "2023-02-28 junk", "2023-02-28 ", "20230231", "202302", "02/03/2023"]
    day = date(2023, 2, 28)
    assert one(frame, "string", parse_day, *texts) == [day] * 4 + [None] * 6
    assert one(frame, "string", day_format, *texts) == ["timed"] * 3 + ["compact"] + [None] * 6


def test_slashed_days_are_read_in_the_order_asked_for(frame):
    texts = ["02/03/2023", "13/03/2023", "2023-03-02", "1/3/2023", None]

    def by(*formats):
        return one(frame, "string", lambda t: parse_day(t, formats), *texts)

    assert by("day_first") == [date(2023, 3, 2), date(2023, 3, 13), None, None, None]
    assert by("month_first") == [date(2023, 2, 3), None, None, None, None]
    assert by("day", "month_first", "day_first")[:3] == [date(2023, 2, 3), date(2023, 3, 13), date(2023, 3, 2)]


def test_date_shape_is_looser_than_parsing(frame):
    texts = ["2023-02-31", "2023-13-01", "2023-02-32", "2023-2-3"]
    assert one(frame, "string", looks_like_iso_date, *texts) == [True, False, False, False]


def test_date_parts(frame):
    df = frame("d date", (date(2024, 6, 1),))
    assert values(df.select(date_key(F.col("d")), weekday_name(F.col("d")))) == [
        (20240601, "Saturday")
    ]
