"""Null-aware predicates and safe parsers.

ANSI mode is on in Spark 4, so a plain ``cast`` raises on bad text; every
parse that must turn bad input into null uses a ``try_`` form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# strict day-month-year with a month abbreviation; 1 or 2 day digits
STRICT_DATE_FORMAT = "d-MMM-yyyy"

# formats tried in order by the free-format parser
FREE_DATE_FORMATS = (
    "d-MMM-yyyy",
    "yyyy-MM-dd",
    "yyyy-MM-dd HH:mm:ss",
    "MM/dd/yyyy",
    "d MMMM yyyy",
    "MMMM d, yyyy",
    "d MMM yyyy",
    "MMM d, yyyy",
    "yyyy/MM/dd",
)

# a number as a pandas/duckdb numeric parse accepts it; guards try_cast
NUMERIC_TEXT = "^\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*$"


def not_equal_keep_null(c: Column, sentinel: str) -> Column:
    """``c != sentinel`` where null counts as different (pandas, N1)."""
    return ~c.eqNullSafe(F.lit(sentinel))


def parse_date_strict(c: Column, fmt: str = STRICT_DATE_FORMAT) -> Column:
    """Date from text in one format; null when it does not parse (H4)."""
    return F.to_date(F.try_to_timestamp(c, F.lit(fmt)))


def parse_date_free(c: Column, formats: Sequence[str] = FREE_DATE_FORMATS) -> Column:
    """First format in the list that parses wins; null when none does (H5)."""
    return F.coalesce(*[F.to_date(F.try_to_timestamp(c, F.lit(f))) for f in formats])


def weekday_name(d: Column) -> Column:
    """Full English weekday name: ``Monday`` (H6)."""
    return F.date_format(d, "EEEE")


def parse_number(c: Column) -> Column:
    """Text to double, bad text to null; ``1d`` stays null."""
    return F.when(c.rlike(NUMERIC_TEXT), F.trim(c).try_cast("double"))


def parse_decimal(c: Column, precision: int = 18, scale: int = 2) -> Column:
    """Text to exact decimal, bad text to null."""
    return F.when(c.cast("string").rlike(NUMERIC_TEXT),
                  F.trim(c.cast("string")).try_cast(f"decimal({precision},{scale})"))
