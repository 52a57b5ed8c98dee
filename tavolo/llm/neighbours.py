"""Approximate nearest neighbours by an adaptive dimension scan.

Vectors are rotated by a random orthogonal matrix and filed under the nearest
of the k-means centroids (fitted on a bounded sample). A query probes the lists
with the nearest centroids. Within a list, rotated vectors lie in blocks of
columns. After each block of dimensions a hypothesis test compares a
candidate's partial distance, scaled up to all dimensions, with the query's
current bound: after a random rotation d of D dimensions estimate the whole
distance, with an error that shrinks as 1 / sqrt(d). Candidates whose estimate
exceeds the bound by more than that are abandoned; only the others go on to the
next block. What survives all blocks is measured on the original vectors in
double precision.

How many lists to probe is measured, not guessed: a bounded sample of queries
is searched exactly over all vectors, and the number of probes is the one that
would have reached ``coverage`` of their true neighbours.

Equal vectors are one entry with their ``k + 1`` smallest ids (no other id can
be an answer, as ties go to smaller ids), so groups of copies cost one
comparison. A list is cut into blocks of about ``block_rows`` vectors and its
queries into chunks of about ``chunk_queries``; every (list, block, chunk) is a
task's unit of bounded size, however crowded the list. On the driver there are
only the fitting sample, the centroids and counts by list.

Defined results: vectors null, zero, holding null or non-finite components, or
of another length than most take no part, as query or as candidate, nor do rows
without an id; repeated rows count once; a query's own id is never its answer.
A query that the probed lists give fewer than ``k`` candidates probes further
lists. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tavolo.llm.shared import hash_sample, table, written

K, QUERY_STEP = 10, 100
FIT_ROWS, MOST_LISTS, FIT_STEPS = 20_000, 4096, 10
TRIAL_QUERIES, COVERAGE = 100, 0.98
BLOCK_ROWS, CHUNK_QUERIES, COLUMNS = 2048, 2048, 16
#: Width of the test: an estimate may exceed the bound by this / sqrt(d).
WIDTH = 2.1
#: Parts of a group of equal vectors, before its smallest ids are known.
SALTS = 16


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _rows(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    rows = (vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v"))
            .where(F.col("id").isNotNull() & usable(F.col("v"))))
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1)
    usual = lengths.first()
    return rows.where(F.size("v") == (usual["d"] if usual else 0)).distinct()


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(v, ids): each different vector with its k + 1 smallest ids."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    least = (salted.withColumn("n", F.row_number().over(Window.partitionBy("v", "salt").orderBy("id")))
             .where(F.col("n") <= k + 1))
    return least.groupBy("v").agg(F.slice(F.array_sort(F.collect_list("id")), 1, k + 1).alias("ids"))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.float64).reshape(len(column), -1)


def fit_centroids(sample: np.ndarray, n: int) -> np.ndarray:
    """k-means on the sample; about sqrt(n) lists."""
    lists = max(1, min(MOST_LISTS, round(n ** 0.5), len(sample) // 4))
    rng = np.random.default_rng(11)
    centres = sample[rng.choice(len(sample), lists, replace=False)]
    for _ in range(FIT_STEPS):
        nearest = nearest_lists(sample, centres, 1)[:, 0]
        count = np.bincount(nearest, minlength=lists)
        sums = np.stack([np.bincount(nearest, sample[:, j], lists) for j in range(sample.shape[1])], axis=1)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return centres


def nearest_lists(x: np.ndarray, centres: np.ndarray, most: int) -> np.ndarray:
    distance = (centres ** 2).sum(1) - 2 * x @ centres.T
    return np.argsort(distance, axis=1, kind="stable")[:, :most]


def rotation(d: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(5).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def scan(query: np.ndarray, turned: np.ndarray, columns: list[np.ndarray], vectors: np.ndarray, original: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, squared distances) of the nearest candidates kept, k + 1 at least if there are so many.

    ``columns`` are blocks of the candidates' rotated columns; ``turned`` is
    the rotated query, ``original`` the query on ``vectors``.
    """
    n, d = vectors.shape
    first = min(n, 4 * (k + 1))
    exact = ((vectors[:first] - original) ** 2).sum(1)
    bound = np.partition(exact, k)[k] if first > k else np.inf
    alive = np.arange(first, n)
    partial, seen = np.zeros(len(alive)), 0
    for block in columns:
        if not len(alive):
            break
        partial = partial + ((block[alive] - turned[seen:seen + block.shape[1]]) ** 2).sum(1)
        seen += block.shape[1]
        allowed = bound * (1 + WIDTH / np.sqrt(seen)) ** 2 * seen / d if seen < d else bound * (1 + 1e-9)
        going = partial <= allowed
        alive, partial = alive[going], partial[going]
    rows = np.concatenate([np.arange(first), alive])
    distance = np.concatenate([exact, ((vectors[alive] - original) ** 2).sum(1)])
    if len(rows) > k + 1:
        near = distance <= np.partition(distance, k)[k]  # equal distances stay
        rows, distance = rows[near], distance[near]
    return rows, distance


class Index:
    """Centroids, rotation and the counts by list that bound the units of work."""

    def __init__(self, centres: np.ndarray):
        self.centres, self.turn = centres, rotation(centres.shape[1])


def _assign(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lists = nearest_lists(_matrix(batch.column(0)), index.value.centres, 1)[:, 0]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists.astype(np.int32))], names=[*batch.schema.names, "list"])

    return run


def _trial(index, queries: np.ndarray, own: list[int], k: int):
    """Exact nearest of a few queries in each part of the index: (query, distance, id, list)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, lists, ids = _matrix(batch.column(0)), batch.column("list").to_pylist(), batch.column("ids").to_pylist()
            out = []
            for i, q in enumerate(queries if batch.num_rows else []):
                distance = ((x - q) ** 2).sum(1)
                near = np.argsort(distance, kind="stable")[:k + 1]
                out += [(i, float(distance[j]), ids[j][0], lists[j]) for j in near if ids[j] != [own[i]]]
            columns = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.float64(), pa.int64(), pa.int32()))],
                                             names=["query", "distance", "id", "list"])

    return run


def probes_needed(filed: DataFrame, index, sample: list, k: int, coverage: float) -> int:
    """Lists to probe so that ``coverage`` of the sampled queries' true neighbours lie in them."""
    queries, own = np.array([r["v"] for r in sample]), [r["id"] for r in sample]
    nearest = Window.partitionBy("query").orderBy("distance", "id")
    found = (filed.mapInArrow(_trial(index, queries, own, k), "query int, distance double, id long, list int")
             .withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k).collect())  # TRIAL_QUERIES x k rows
    order = nearest_lists(queries, index.value.centres, len(index.value.centres))
    place = np.argsort(order, axis=1)
    ranks = sorted(int(place[r["query"], r["list"]]) + 1 for r in found)
    return ranks[min(len(ranks) - 1, int(np.ceil(coverage * len(ranks))) - 1)] if ranks else 1


def _probe(index, probes: int, sizes: np.ndarray, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0))
            order = nearest_lists(x, index.value.centres, len(sizes)) if batch.num_rows else np.zeros((0, 0), int)
            rows, lists = [], []
            for i, row in enumerate(order):
                held = np.cumsum(sizes[row])
                most = max(probes, int(np.searchsorted(held, least)) + 1)
                chosen = [int(p) for p in row[:most] if sizes[p]]
                rows += [i] * len(chosen)
                lists += chosen
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(rows, pa.int64())) for c in batch.columns), pa.array(lists, pa.int32())],
                                             names=[*batch.schema.names, "list"])

    return run


def _search(index, k: int):
    def run(key, candidates: pa.Table, queries: pa.Table) -> pa.Table:
        out = []
        if candidates.num_rows and queries.num_rows:
            vectors, wanted = _matrix(candidates["v"].combine_chunks()), _matrix(queries["v"].combine_chunks())
            turned, turned_queries = vectors @ index.value.turn, wanted @ index.value.turn
            columns = [np.ascontiguousarray(turned[:, i:i + COLUMNS]) for i in range(0, turned.shape[1], COLUMNS)]
            ids = candidates["ids"].to_pylist()
            for qid, q, t in zip(queries["qid"].to_pylist(), wanted, turned_queries):
                rows, distance = scan(q, t, columns, vectors, q, k)
                nearest = sorted((float(d), i) for r, d in zip(rows, distance) for i in ids[r])[:k + 1]
                out += [(qid, d, i) for d, i in nearest]
        columns = list(zip(*out)) or [[]] * 3
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.float64(), pa.int64()))], names=["qid", "squared", "id"])

    return run


def nearest(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", embedding: str = "embedding", k: int = K,
            coverage: float = COVERAGE, block_rows: int = BLOCK_ROWS, chunk_queries: int = CHUNK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row that ``is_query`` (of id) admits."""
    spark = vectors.sparkSession
    result = "query_id long, rank int, vec_id long, score double"
    rows = written(_rows(vectors, vec_id, embedding), "nn-rows")
    distinct = written(distinct_vectors(rows, k), "nn-vectors")
    n = distinct.count()
    asked = rows.where(is_query)
    searched = written(asked.groupBy("v").agg(F.min("id").alias("qid")), "nn-queries")
    trial = hash_sample(searched.withColumnRenamed("qid", "id"), F.col("id"), TRIAL_QUERIES, searched.count()).collect()
    if not trial:
        return spark.createDataFrame([], result)
    fit = hash_sample(distinct, F.col("v"), FIT_ROWS, n).select("v").toPandas()["v"].tolist()
    index = spark.sparkContext.broadcast(Index(fit_centroids(np.array(sorted(map(tuple, fit))), n)))
    filed = written(distinct.mapInArrow(_assign(index), "v array<double>, ids array<long>, list int"), "nn-filed")
    probes = probes_needed(filed, index, trial, k, coverage)

    # Counts by list, MOST_LISTS rows at most.
    sizes = np.zeros(len(index.value.centres), np.int64)
    held = sizes.copy()
    for r in filed.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("ids")).alias("ids")).collect():
        sizes[r["list"]], held[r["list"]] = r["n"], r["ids"]
    probed = written(searched.mapInArrow(_probe(index, probes, held, k + 1), "v array<double>, qid long, list int"), "nn-probes")
    wanted = np.zeros_like(sizes)
    for r in probed.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect():
        wanted[r["list"]] = r["n"]
    blocks = F.array(*[F.lit(int(-(-s // block_rows))) for s in sizes])
    chunks = F.array(*[F.lit(int(-(-w // chunk_queries))) for w in wanted])
    n_blocks, n_chunks = F.greatest(F.get(blocks, F.col("list")), F.lit(1)), F.get(chunks, F.col("list"))
    candidates = (filed.withColumn("n_chunks", n_chunks).where("n_chunks > 0")
                  .withColumn("block", F.pmod(F.xxhash64("ids"), n_blocks).cast("int"))
                  .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1))).drop("n_chunks"))
    queries = (probed.withColumn("chunk", F.pmod(F.xxhash64("qid"), n_chunks).cast("int"))
               .withColumn("block", F.explode(F.sequence(F.lit(0), n_blocks - 1))))
    unit = ["list", "block", "chunk"]
    found = (candidates.groupBy(*unit).cogroup(queries.groupBy(*unit))
             .applyInArrow(_search(index, k), "qid long, squared double, id long"))
    kept = written(found.withColumn("n", F.row_number().over(Window.partitionBy("qid").orderBy("squared", "id")))
                   .where(F.col("n") <= k + 1).drop("n"), "nn-found")
    # Back from the different query vectors to the query rows; a query's own id goes.
    named = asked.select(F.col("id").alias("query_id"), "v").join(searched, "v").drop("v")
    order = Window.partitionBy("query_id").orderBy("squared", "id")
    return (named.join(kept, "qid").where(F.col("id") != F.col("query_id")).withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), F.sqrt("squared").alias("score")))


def op3_adaptive_scan(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("id") % QUERY_STEP == 0)
