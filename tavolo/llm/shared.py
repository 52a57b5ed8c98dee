"""Helpers that several corpus operators use."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tavolo.session import ensure_checkpoint_dir

#: Word separators: space, tab, line feed, vertical tab, form feed, carriage return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage with a table that every executor sees, so a lost executor
    costs a reread and later jobs do not repeat the work.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop input columns whose names an operator's own output uses (any case)."""
    taken = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def word_count(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def text_fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the document id written as text, modulo ``modulus``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def hash_sample(df: DataFrame, key: Column, rows: int, n: int) -> DataFrame:
    """``rows`` rows of ``df`` (or all, if fewer), those with the smallest hashes of ``key``; ``df`` has ``n`` rows.

    Rows far from the smallest hashes are filtered out where they are read, so
    the sort sees about 1.5 times ``rows`` at any size of ``df``.
    """
    order = F.xxhash64(F.lit("fit"), key)
    share = 1.5 * rows / max(n, 1)
    if share < 1:
        df = df.where(F.shiftrightunsigned(order, 11) < int(share * (1 << 53)))
    return df.orderBy(order, key).limit(rows)
