"""Vector code compression: product quantisation with Orchard's search.

A vector's components become integers (``floor(SCALE * x)``) and the vector is
cut into ``PARTS`` equal consecutive parts. Each part position has a codebook
of up to ``ENTRIES`` entries, which starts as that part of the vectors with the
smallest ids. A round assigns every part to its nearest entry and moves each
entry to the componentwise floor of its parts' mean; the last assignment is the
code. All arithmetic is on integers.

The nearest entry is found by Orchard's search. Every entry has the list of the
other entries by distance from it. A search holds a current entry, walks its
list, marks what it measured, jumps to the list of an entry that is nearer (or
as near, with a lower index), and stops at the first entry farther from the
current one than twice the current distance: by the triangle inequality that
one and all after it are farther than the current one. Distances are squared,
so the bound is four times. The searches of a record batch go on together, one
step each at a time.

A round is one narrow pass over the vectors. Every task sends the sums and
counts of its entries once, whatever its rows; Spark adds them up, and only the
codebooks (``PARTS * ENTRIES`` entries) and these totals ever reach the driver.

Defined results: vectors null, empty, holding null or non-finite components, or
of another length than most are dropped (a double beyond the range of floats counts
as infinite); of a length that the parts do not
divide, the last components take no part, and vectors shorter than ``PARTS``
give an empty result. Rows with equal ids all stay; equal ids and equal vectors
seed one entry a row; null ids come last. With fewer rows than entries the
codebook is smaller. Distances to equally near entries go to the lower index.
Components too large for 64-bit distances are computed in unbounded integers;
an error beyond a long is null, as is a label's sum. An empty table gives an empty result. Other
input columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tavolo.llm.shared import table, written

#: Parts of a vector, entries of a part's codebook, rounds of moving the entries.
PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: A component x becomes floor(SCALE * x).
SCALE = 1024
#: Bits of a component up to which squared distances of a part stay within 64 bits.
PLAIN_BITS = 26
#: Components from here on lie outside the range of floats and count as infinite, in arrays of doubles too.
FLOAT_RANGE = 2.0 ** 128
#: Totals travel in two numbers, the lower one of so many bits.
LOW_BITS = 60
#: Vectors searched together.
TOGETHER = 2048


def usable(v: Column) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < FLOAT_RANGE))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & fine, F.lit(False))


def whole_vectors(rows: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """(id, label, v): usable vectors of the most frequent length (the shorter of equally frequent ones)."""
    named = rows.select(F.col(f"`{vec_id}`").alias("id"), F.col(f"`{label}`").alias("label"), F.col(f"`{embedding}`").cast("array<double>").alias("v"))
    kept = named.where(usable(F.col("v")))
    usual = kept.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    return kept.where(F.size("v") == (usual["d"] if usual else 0))


def _integers(column: pa.Array, parts: int) -> np.ndarray:
    """Rows x parts x components; 64-bit integers, or unbounded ones where a distance needs them."""
    if not len(column):
        return np.zeros((0, parts, 0), np.int64)
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    width = x.shape[1] // parts
    scaled = np.floor(x[:, :width * parts] * SCALE).reshape(len(x), parts, width)
    if np.abs(scaled).max(initial=0) < 2.0 ** PLAIN_BITS and width < 1 << 9:
        return scaled.astype(np.int64)
    return np.frompyfunc(int, 1, 1)(scaled)


class Codebook:
    """Entries of one part position, their neighbour lists and the distances along them."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        apart = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(2)
        # An entry itself comes first; equally far entries by index.
        np.fill_diagonal(apart, -1)
        self.lists = np.argsort(apart, axis=1, kind="stable")
        self.along = np.take_along_axis(apart, self.lists, 1)
        self.by_sum = np.argsort(entries.sum(1), kind="stable")
        self.sums = entries.sum(1)[self.by_sum]


def orchard(x: np.ndarray, book: Codebook) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each row of ``x`` and the squared distance to it."""
    n, k = len(x), len(book.entries)
    # Any first entry will do; one with a near component sum is seldom far off.
    current = book.by_sum[np.minimum(np.searchsorted(book.sums, x.sum(1)), k - 1)]
    nearest = ((x - book.entries[current]) ** 2).sum(1)
    marked = np.zeros((n, k), bool)
    marked[np.arange(n), current] = True
    place = np.ones(n, np.int64)
    going = np.arange(n) if k > 1 else np.zeros(0, np.int64)
    while len(going):
        at, here = place[going], current[going]
        near = (book.along[here, at] <= 4 * nearest[going]).astype(bool)
        going, at, here = going[near], at[near], here[near]
        entry = book.lists[here, at]
        fresh = ~marked[going, entry]
        place[going] += 1
        rows, tried = going[fresh], entry[fresh]
        marked[rows, tried] = True
        distance = ((x[rows] - book.entries[tried]) ** 2).sum(1)
        better = ((distance < nearest[rows]) | ((distance == nearest[rows]) & (tried < current[rows]))).astype(bool)
        moved = rows[better]
        current[moved], nearest[moved], place[moved] = tried[better], distance[better], 1
        going = going[place[going] < k]
    return current, nearest


def _assigned(batch: pa.RecordBatch, books: list[Codebook]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(integer vectors, codes, squared distances), by slices of a batch."""
    for start in range(0, batch.num_rows, TOGETHER):
        x = _integers(batch.column("v").slice(start, TOGETHER), len(books))
        found = [orchard(x[:, p], book) for p, book in enumerate(books)]
        yield x, np.stack([c for c, _ in found], 1), np.stack([d for _, d in found], 1)


def _sums_of_entries(books):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = books.value
        width = used[0].entries.shape[1]
        count = [np.zeros(len(b.entries), np.int64) for b in used]
        total = [np.zeros((len(b.entries), width), object) for b in used]
        for batch in batches:
            for x, codes, _ in _assigned(batch, used):
                for p, book in enumerate(used):
                    k = len(book.entries)
                    count[p] += np.bincount(codes[:, p], minlength=k)
                    # A slice's sums stay within 64 bits where its components are plain.
                    some = np.zeros((k, width), x.dtype)
                    np.add.at(some, codes[:, p], x[:, p])
                    total[p] += some
        rows = [(p, e, j, int(total[p][e, j]), int(count[p][e])) for p in range(len(used))
                for e in np.flatnonzero(count[p]).tolist() for j in range(width)]
        columns = list(zip(*rows)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32()),
                                          pa.array([str(t >> LOW_BITS) for t in columns[3]], pa.string()),
                                          pa.array([t & ((1 << LOW_BITS) - 1) for t in columns[3]], pa.int64()), pa.array(columns[4], pa.int64())],
                                         names=["part", "entry", "place", "high", "low", "n"])

    return run


def _codes_of(books):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = books.value
        for batch in batches:
            code, error = [], []
            for _, codes, distances in _assigned(batch, used):
                code += ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
                error += [e if e < 1 << 63 else None for e in map(int, distances.astype(object).sum(1))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(code, pa.string()), pa.array(error, pa.int64())],
                                             names=["id", "label", "code", "error"])

    return run


def fit_codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """One array of entries for each part position; ``vectors`` as from ``whole_vectors``."""
    spark = vectors.sparkSession
    first = vectors.select("id", "v").orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    if not first or len(first[0]["v"]) < parts:
        return []
    seeds = _integers(pa.array([r["v"] for r in first], pa.list_(pa.float64())), parts)
    books = [seeds[:, p].copy() for p in range(parts)]
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast([Codebook(b) for b in books])
        sums = (vectors.select("v").mapInArrow(_sums_of_entries(sent), "part int, entry int, place int, high string, low long, n long")
                .groupBy("part", "entry", "place")
                .agg(F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low"), F.sum("n").alias("n")))
        moved = [b.astype(object) for b in books]
        for r in sums.collect():  # parts x entries x components at most
            moved[r["part"]][r["entry"], r["place"]] = ((int(r["high"]) << LOW_BITS) + int(r["low"])) // r["n"]
        plain = all(abs(int(v)) < 1 << PLAIN_BITS for b in moved for v in b.flat) and books[0].dtype != object
        books = [b.astype(np.int64) if plain else b for b in moved]
        sent.unpersist()
    return books


def compress(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error) of every kept vector, and the codebooks."""
    if entries > 256:
        raise ValueError("a code has two hex digits a part: 256 entries at most")
    spark = rows.sparkSession
    vectors = whole_vectors(rows, vec_id, embedding, label)
    books = fit_codebooks(vectors, parts, entries, rounds)
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}
    schema = f"id {kinds['id']}, label {kinds['label']}, code string, error long"
    if not books:
        coded = spark.createDataFrame([], schema)
    else:
        sent = spark.sparkContext.broadcast([Codebook(b) for b in books])
        coded = vectors.mapInArrow(_codes_of(sent), schema)
    return coded.withColumnRenamed("id", "vec_id"), books


def codebook_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(v)) for b in books for entry in b for v in entry).encode()).hexdigest()


def op11_orchard_codes(spark, sf_dir):
    coded, books = compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    coded = written(coded, "codes")
    # Equal labels are added up before they meet, so a hot label is one row a task.
    per_label = coded.groupBy("label").agg(F.try_sum("error").alias("label_error")).withColumnRenamed("label", "__label")
    return (coded.join(per_label, F.col("label").eqNullSafe(F.col("__label")))
            .select("vec_id", "code", "error", "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256")))
