"""Column expressions for text.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
The regular expressions are written so that Java (Spark) and RE2 read them
the same way: explicit classes instead of ``\\s`` / ``\\d`` / ``\\w``, which are
ASCII-only in Java and RE2 but Unicode in Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the 32 ASCII punctuation marks, as three ranges plus one
PUNCTUATION_CLASS = "[!-/:-@\\[-`{-~]"
PUNCTUATION = "".join(map(chr, [*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]))

# fixed values: the characters Python's str.split() treats as whitespace
WHITESPACE_RUN = (
    "[\\t\\n\\x{0B}\\f\\r\\x{1C}-\\x{20}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+"
)
WHITESPACE = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))

# Unicode decimal digits, as Python's re ``\d``
DIGIT = "\\p{Nd}"


def punctuation_to_space(c: Column) -> Column:
    """Each ASCII punctuation mark becomes one space."""
    return F.regexp_replace(c, PUNCTUATION_CLASS, " ")


def _blanks_at(c: Column, breaks: str) -> Column:
    return F.translate(c, breaks, " " * len(breaks))


def _split_at(c: Column, breaks: str) -> Column:
    """Split at any of some characters: mapped to blanks first, as a split at one
    character needs no regular expression."""
    return F.array_remove(F.split(_blanks_at(c, breaks), " ", -1), "")


def split_whitespace(c: Column) -> Column:
    """Whitespace split with Python ``str.split()`` semantics.

    Leading/trailing whitespace and empty input give no empty tokens.
    """
    return _split_at(c, WHITESPACE)


def remove_digits(c: Column) -> Column:
    """Drop every Unicode decimal digit."""
    return F.regexp_replace(c, DIGIT, "")


def normalize_name(c: Column) -> Column:
    """``lower().strip()`` of a product or command name."""
    return F.lower(F.regexp_replace(c, "^" + WHITESPACE_RUN + "|" + WHITESPACE_RUN + "$", ""))


def pre_tokens(text: Column) -> Column:
    """Lower-case, punctuation to spaces, whitespace split: the tokens the
    lemmatizer sees (first half of J1). A null text has no tokens."""
    return F.coalesce(_split_at(F.lower(text), WHITESPACE + PUNCTUATION), F.array().cast("array<string>"))


def spaced_tokens(text: Column) -> Column:
    """The tokens of ``pre_tokens`` as one text with one or more blanks between them."""
    return F.coalesce(_blanks_at(F.lower(text), WHITESPACE + PUNCTUATION), F.lit(""))


def left_pad(c: Column, width: int) -> Column:
    """``f'{x:<width}'``: pads on the right, never truncates."""
    return F.format_string(f"%-{width}s", c)
