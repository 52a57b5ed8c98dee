"""Join helpers: a size-checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# a lookup side up to this many rows is broadcast; above it, AQE picks the plan
DEFAULT_BROADCAST_ROWS = 2_000_000


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only when it has at most ``max_rows`` rows.

    The check is one count over the lookup table (never the fact table). Above
    the bound the join is left to Catalyst/AQE, which shuffles both sides or
    switches to a broadcast at run time when the side turns out small.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
