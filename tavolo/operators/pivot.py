"""Conditional-aggregate pivots and left star assembly.

A pivot is generated as ``sum(CASE WHEN cond THEN v ELSE 0 END)`` per output
column, all inside one hash aggregate: one pass, map-side partial
aggregation, no null for absent combinations (N15).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_when(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` as bigint."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def sum_when(cond: Column, value: Column) -> Column:
    """``SUM(CASE WHEN cond THEN value ELSE 0 END)``: a null value with a true
    condition is skipped by SUM, as in SQL (B9, N18)."""
    return F.sum(F.when(cond, value).otherwise(F.lit(0)))


def conditional_aggregates(conditions: Mapping[str, Column], value: Column | None = None,
                           kind: str = "count") -> list[Column]:
    """One aggregate per named condition; ``kind`` is ``count`` or ``sum``."""
    if kind == "count":
        return [count_when(c).alias(n) for n, c in conditions.items()]
    return [sum_when(c, value).alias(n) for n, c in conditions.items()]


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``IFNULL(c, 0)`` on the named columns only, types kept."""
    fills = {c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in columns}
    return df.withColumns(fills)


def left_star(spine: DataFrame, key: str, parts: Sequence[DataFrame]) -> DataFrame:
    """Left-join each one-row-per-key part onto the spine (C4).

    Every part is an aggregate on ``key``, so it is already hash-partitioned on
    it; the spine is exchanged once and each join is co-partitioned.
    """
    out = spine
    for p in parts:
        out = out.join(p, key, "left")
    return out


def assert_unique(df: DataFrame, key: str, what: str) -> None:
    """Fail when a lookup table repeats a key (a repeat would fan out joins)."""
    dup = df.groupBy(key).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"{what}: key {key} is not unique (e.g. {dup[0][key]!r})")
