"""Nearest neighbours against brute force."""

import numpy as np
from pyspark.sql import functions as F

from tavolo.llm import neighbours as N


def _brute(rows, query, k):
    q = dict(rows)[query]
    near = sorted({(float(np.sqrt(((np.array(v) - np.array(q)) ** 2).sum())), i) for i, v in rows if i != query})
    return near[:k]


def test_recall_and_scores_on_a_whole_table(spark):
    sf = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").toPandas()
    x, ids = np.stack(table["embedding"]).astype(float), table["vec_id"].to_numpy()
    got = {}
    for r in N.op3_adaptive_scan(spark, sf).collect():
        got.setdefault(r["query_id"], []).append(r)
    assert sorted(got) == [i for i in ids if i % 100 == 0]
    hits = 0
    for query, rows in got.items():
        rows.sort(key=lambda r: r["rank"])
        distance = np.sqrt(((x - x[ids == query]) ** 2).sum(1))
        distance[ids == query] = np.inf
        best = set(ids[np.lexsort((ids, distance))[:10]])
        hits += len(best & {r["vec_id"] for r in rows})
        assert [r["rank"] for r in rows] == list(range(1, 11)) and [r["score"] for r in rows] == sorted(r["score"] for r in rows)
        assert all(abs(r["score"] - distance[ids == r["vec_id"]][0]) < 1e-12 for r in rows)
    assert hits >= 0.95 * 10 * len(got)


def test_copies_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=4).round(1).tolist()) for i in range(1, 60)]
    rows += [(100 + i, [1.0, 0.0, 0.0, 0.0]) for i in range(60)] + [(300 + i, [float(i), 0.0, 0.0, 0.0]) for i in range(1, 5)]
    bad = [(400, None), (500, [0.0] * 4), (600, [1.0, None, 0.0, 0.0]), (700, [float("nan"), 1.0, 0.0, 0.0]), (800, [float("inf"), 1.0, 0.0, 0.0]),
           (900, [1.0, 2.0]), (None, [1.0, 1.0, 1.0, 1.0]), (1000, [])]
    df = spark.createDataFrame([(i, v, 0.1) for i, v in rows + bad + rows[:3]], "vec_id long, embedding array<float>, score double")
    usable = [(i, np.array(v, dtype=np.float32).astype(float).tolist()) for i, v in rows]
    for sizes in ({}, {"block_rows": 7, "chunk_queries": 2}):
        got = {}
        for r in N.nearest(df, F.col("id") % 20 == 0, coverage=1.0, **sizes).collect():
            got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
        assert sorted(got) == sorted(i for i, _ in rows if i % 20 == 0)
        for query, found in got.items():
            want = _brute(usable, query, 10)
            assert [i for _, _, i in sorted(found)] == [i for _, i in want], query
            assert np.allclose([s for _, s, _ in sorted(found)], [s for s, _ in want])


def test_few_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 2.0])], schema)
    got = N.nearest(few, F.col("id") == 0).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [1, 2]
    assert N.nearest(few, F.col("id") == 77).count() == 0
    assert N.nearest(spark.createDataFrame([], schema), F.col("id") == 0).count() == 0
