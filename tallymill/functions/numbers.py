"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymill.schemas import MONEY


def round_cents(amount: Column) -> Column:
    """Two decimals, halves to even on the scaled double; ``round`` and ``bround`` differ."""
    return F.rint(amount * F.lit(100.0)) / F.lit(100.0)


def money(amount: Column) -> Column:
    """Exact type for sums: adding doubles gives another result in another task order."""
    return amount.cast(MONEY)


def zero_if_null(amount: Column) -> Column:
    return F.coalesce(amount, F.lit(0).cast(MONEY))


def nan_to_null(number: Column) -> Column:
    """Spark orders NaN above every number, so a NaN would pass ``> 0`` tests."""
    return F.when(~F.isnan(number), number)
