"""Date expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values ----
DATE_PATTERN = r"\A\d{4}-\d{2}-\d{2}\z"
TIMED_PATTERN = r"\A\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}([.]\d{1,6})?)?\z"
COMPACT_PATTERN = r"\A\d{8}\z"
SLASHED_PATTERN = r"\A\d{2}/\d{2}/\d{4}\z"
ISO_DATE_PATTERN = r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$"
WEEKEND_DAYS = ["Saturday", "Sunday"]
# ---- end of fixed values ----


def _from_parts(year: int, month: int, day: int) -> Callable[[Column], Column]:
    """Reads a date whose year, month and day begin at these characters, counted from 1."""
    return lambda text: F.concat_ws(
        "-", text.substr(year, 4), text.substr(month, 2), text.substr(day, 2)
    ).try_cast("date")


#: Pattern and reader of each format, by name.
FORMATS: dict[str, tuple[str, Callable[[Column], Column]]] = {
    "day": (DATE_PATTERN, lambda text: text.try_cast("date")),
    "timed": (TIMED_PATTERN, lambda text: text.try_cast("timestamp_ntz").cast("date")),
    "compact": (COMPACT_PATTERN, _from_parts(1, 5, 7)),
    "day_first": (SLASHED_PATTERN, _from_parts(7, 4, 1)),
    "month_first": (SLASHED_PATTERN, _from_parts(7, 1, 4)),
}
#: What no other format could mean. Slashed dates are read only where a caller says which part comes first.
PLAIN_FORMATS = ("day", "timed", "compact")


def _readings(text: Column, formats: Sequence[str]) -> list[Column]:
    return [F.when(text.rlike(FORMATS[f][0]), FORMATS[f][1](text)) for f in formats]


def parse_day(text: Column, formats: Sequence[str] = PLAIN_FORMATS) -> Column:
    """Date of ``text`` by the first format that gives a real day, else null.

    Pattern plus cast takes half the time of ``try_to_date``, which raises and catches an
    exception for each bad date. The cast alone would take ``2023`` or ``2023-1-5T``, and any
    text after a day. A time must be a real one, and is dropped.
    """
    return F.coalesce(*_readings(text, formats))


def day_format(text: Column, formats: Sequence[str] = PLAIN_FORMATS) -> Column:
    """Name of the format that ``parse_day`` reads ``text`` by, null where there is none."""
    readings = zip(formats, _readings(text, formats), strict=True)
    return F.coalesce(*[F.when(reading.isNotNull(), name) for name, reading in readings])


def date_key(day: Column) -> Column:
    """The ``yyyymmdd`` integer of a date."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def weekday_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def looks_like_iso_date(text: Column) -> Column:
    """Shape only: 2023-02-31 passes here and fails ``parse_day``."""
    return text.rlike(ISO_DATE_PATTERN)


def utc_today() -> Column:
    return F.to_date(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()))
