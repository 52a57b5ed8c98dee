"""K-means whose result depends on the rows alone.

Coordinates become integers on a grid of 1 / ``GRID``, and all that follows is
integer arithmetic: squared distances, sums (as decimals) and rounded-down means.
So neither the partitions nor the order of rows nor the number of tasks changes a
run, and SQL can repeat it.

The starting centres are fixed: of the ``SAMPLE`` rows with the smallest md5 of
their id, the first, then again and again the one farthest from those chosen.
The centres for k are the first k of them, so all k of an elbow curve share one
list, and all run together: every step is one narrow pass over the points, from
which each task sends the sums and counts of its clusters once. Steps end when
no centre moves. A cluster without points keeps its centre; equally near centres
go to the lower number.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavolo.session import ensure_checkpoint_dir

#: Steps of the grid in one unit.
GRID = 1_000_000
#: Rows that the starting centres are chosen from.
SAMPLE = 100
#: Bits of a coordinate up to which squared distances stay within 64 bits.
PLAIN_BITS = 28

Centres = dict[int, list[tuple[int, ...]]]


def on_grid(df: DataFrame, cols: Sequence[str], id_col: str) -> DataFrame:
    """(id, x): the columns as an array of integers; written once, as every step reads it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.select(F.col(id_col).alias("id"), F.array(*[F.round(F.col(c) * GRID).cast("long") for c in cols]).alias("x")).checkpoint(eager=True)


def starting_centres(points: DataFrame, k: int, sample: int = SAMPLE) -> list[tuple[int, ...]]:
    """Up to ``k`` different rows, in the order of choice."""
    rows = [tuple(r["x"]) for r in points.orderBy(F.md5(F.col("id").cast("string")), "id", "x").limit(sample).collect()]
    chosen: list[tuple[int, ...]] = rows[:1]
    while rows and len(chosen) < k:
        far = [min(sum((a - b) ** 2 for a, b in zip(x, c)) for c in chosen) for x in rows]
        best = max(far)
        if best == 0:
            break
        chosen.append(rows[far.index(best)])
    return chosen


def _points(column: pa.Array, width: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return x if np.abs(x).max(initial=0) < 1 << PLAIN_BITS else x.astype(object)


def _nearest(x: np.ndarray, centres: list[tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each point and the squared distance, centre by centre."""
    best, at = None, np.zeros(len(x), np.int64)
    for j, c in enumerate(centres):
        d = ((x - np.array(c, dtype=x.dtype)) ** 2).sum(1)
        if best is None:
            best = d
        else:
            nearer = (d < best).astype(bool)
            best, at = np.where(nearer, d, best), np.where(nearer, j, at)
    return at, best


def _totals(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres: Centres = sent.value
        total: dict[tuple[int, int], list] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _points(batch.column("x"), len(next(iter(centres.values()))[0]))
            for k, cs in centres.items():
                at, d = _nearest(x, cs)
                for j in np.unique(at).tolist():
                    mine = at == j
                    t = total.setdefault((k, j), [0, 0, [0] * x.shape[1]])
                    t[0] += int(mine.sum())
                    t[1] += sum(d[mine].tolist())
                    t[2] = [a + int(b) for a, b in zip(t[2], x[mine].astype(object).sum(0))]
        rows = [(k, j, n, str(d), [str(v) for v in s]) for (k, j), (n, d, s) in total.items()]
        columns = list(zip(*rows)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.string())))],
                                         names=["k", "j", "n", "d", "sums"])

    return run


def _step(points: DataFrame, centres: Centres) -> list:
    """(k, j, n, d, sums) of each cluster with points."""
    width = len(next(iter(centres.values()))[0])
    sent = points.sparkSession.sparkContext.broadcast(centres)
    exact = lambda c: F.sum(c.cast("decimal(38,0)"))
    return (points.select("x").mapInArrow(_totals(sent), "k int, j int, n long, d string, sums array<string>").groupBy("k", "j")
            .agg(F.sum("n").alias("n"), exact(F.col("d")).alias("d"), F.array(*[exact(F.get("sums", F.lit(i))) for i in range(width)]).alias("sums")).collect())


def kmeans(points: DataFrame, ks: Sequence[int], max_iter: int = 1000, sample: int = SAMPLE) -> tuple[Centres, dict[int, int]]:
    """Centres of each k, and their sums of squared distances (in squared grid steps); ``points`` as from ``on_grid``."""
    start = starting_centres(points, max(ks), sample)
    if not start:
        return {}, {}
    centres: Centres = {k: start[:k] for k in ks}
    moving, sse = dict(centres), {}
    for _ in range(max_iter + 1):
        rows = _step(points, moving)
        for k in list(moving):
            own = {r["j"]: r for r in rows if r["k"] == k}
            sse[k] = sum(int(r["d"]) for r in own.values())
            new = [tuple(int(s) // own[j]["n"] for s in own[j]["sums"]) if j in own else c for j, c in enumerate(moving[k])]
            centres[k] = moving[k]
            if new == moving[k]:
                del moving[k]
            else:
                moving[k] = new
        if not moving:
            break
    return centres, sse


def assign(points: DataFrame, centres: list[tuple[int, ...]], name: str = "Cluster") -> DataFrame:
    """``points`` plus the number of the nearest centre."""
    kind = points.schema["id"].dataType.simpleString()
    sent = points.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at, _ = _nearest(_points(batch.column("x"), len(sent.value[0])), sent.value)
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("x"), pa.array(at, pa.int32())], names=["id", "x", name])

    return points.select("id", "x").mapInArrow(run, f"id {kind}, x array<long>, {name} int")
