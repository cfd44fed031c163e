"""Text expressions with Unicode-aware blanks."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: equal results depend on these ----
# Product names that are really stop words.
STOP_NAMES = [
    "the", "and", "or", "but", "if", "then",
    "push", "since", "try", "stay", "door",
    "fear", "oil", "half", "fire", "hard",
    "every", "money", "edge", "fund", "light",
]
MIN_NAME_LENGTH = 4
# ---- end of fixed values ----

# Java's Unicode \s leaves out the four separator controls that text readers also call blank.
_BLANK = r"[\s\x1c-\x1f]"
_ALL_BLANK = rf"(?U)\A{_BLANK}*\z"
_OUTER_BLANK = rf"(?U)\A{_BLANK}+|{_BLANK}+\z"


def strip(text: Column) -> Column:
    """Drop leading and trailing blanks of any kind (``trim`` drops spaces only)."""
    return F.regexp_replace(text, _OUTER_BLANK, "")


def blank_to_null(text: Column) -> Column:
    # Most texts begin with a printable ASCII character, which comparing bytes tells faster than the pattern.
    return F.when(((text >= "!") & (text < "\x7f")) | ~text.rlike(_ALL_BLANK), text)


@lru_cache(maxsize=1)
def _numeric_pattern() -> str:
    """Number characters, plus the ideographs that stand for numbers (letters to ``\\p{N}``)."""
    ideographs = "".join(
        ch
        for ch in map(chr, range(sys.maxunicode + 1))
        if ch.isnumeric() and not unicodedata.category(ch).startswith("N")
    )
    return rf"\A[\p{{N}}{ideographs}]+\z"


def is_valid_product_name(name: Column) -> Column:
    """Long enough, not a stop word, not a bare number; a missing name is invalid."""
    clean = F.lower(strip(name))
    valid = (
        (F.length(clean) >= MIN_NAME_LENGTH)
        & ~clean.isin(STOP_NAMES)
        & ~clean.rlike(_numeric_pattern())
    )
    return F.coalesce(valid, F.lit(False))
