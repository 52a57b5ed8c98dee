"""Array-of-number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine_similarity(a: Column, b: Column) -> Column:
    """Cosine similarity; a zero vector gives 0, so distance 1."""
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))


def cosine_distance(a: Column, b: Column) -> Column:
    """``1 - cosine_similarity``."""
    return F.lit(1.0) - cosine_similarity(a, b)


def round_array(a: Column, places: int) -> Column:
    """Round each element; ``+ 0.0`` turns ``-0.0`` into ``0.0``."""
    return F.transform(a, lambda x: F.round(x, places) + F.lit(0.0))


def zeros(dim: Column | int) -> Column:
    return F.array_repeat(F.lit(0.0), dim if isinstance(dim, Column) else F.lit(dim))
