"""K-means and PCA: equal on any partitions, and right."""

import random

import numpy as np
from pyspark.sql import functions as F

from tavolo.operators import kmeans as K
from tavolo.operators import segments as S


def _rows(n, d, seed):
    rng = random.Random(seed)
    return [(i, *[round(rng.gauss(3 * (i % 4) * (j + 1), 1), 3) for j in range(d)]) for i in range(n)]


def _plain(rows, k, sample=100):
    import hashlib

    pts = {r[0]: tuple(int(np.floor(x * K.GRID + 0.5)) for x in r[1:]) for r in rows}
    first = [pts[i] for i in sorted(pts, key=lambda i: hashlib.md5(str(i).encode()).hexdigest())[:sample]]
    far = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c))
    centres = [first[0]]
    while len(centres) < k:
        centres.append(max(first, key=lambda x: (min(far(x, c) for c in centres), -first.index(x))))
    while True:
        own = [[] for _ in centres]
        for x in pts.values():
            own[min(range(k), key=lambda j: (far(x, centres[j]), j))].append(x)
        new = [tuple(sum(col) // len(o) for col in zip(*o)) if o else c for o, c in zip(own, centres)]
        if new == centres:
            return centres, sum(min(far(x, c) for c in centres) for x in pts.values())
        centres = new


def test_same_result_on_any_partitions(spark):
    rows = _rows(300, 3, 1)
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    results = []
    for parts in (1, 8):
        points = K.on_grid(df.repartition(parts), ["a", "b", "c"], "id")
        results.append(K.kmeans(points, [1, 3, 5]))
    assert results[0] == results[1]
    for k in (1, 3, 5):
        centres, sse = _plain(rows, k)
        assert results[0][0][k] == centres and results[0][1][k] == sse


def test_large_coordinates_copies_and_few_rows(spark):
    big = spark.createDataFrame([(i, float(i % 3) * 1e9, 0.5) for i in range(30)], "id long, a double, b double")
    centres, sse = K.kmeans(K.on_grid(big, ["a", "b"], "id"), [2, 5])
    assert len(centres[5]) == 3 and sse[5] == 0 and sse[2] > 0
    one = K.on_grid(big.limit(1), ["a", "b"], "id")
    centres, _ = K.kmeans(one, [4])
    assert len(centres[4]) == 1 and K.assign(one, centres[4]).first()["Cluster"] == 0
    assert K.kmeans(K.on_grid(big.limit(0), ["a", "b"], "id"), [2]) == ({}, {})


def test_axes_equal_an_eigensolver():
    rng = np.random.default_rng(3)
    for _ in range(20):
        x = rng.normal(size=(200, 6)) @ rng.normal(size=(6, 6))
        cov = np.cov(x.T, bias=True)
        variances, axes = S.principal_axes(cov, 6)
        values, vectors = np.linalg.eigh(cov)
        assert np.allclose(variances, values[::-1], rtol=1e-6, atol=1e-9 * values[-1])
        assert all(abs(abs(a @ v) - 1) < 1e-5 for a, v in zip(axes[:3], vectors.T[::-1]))
    assert S.principal_axes(np.zeros((3, 3)), 2)[0] == [0.0, 0.0]


def test_elbow_and_segments_on_any_partitions(spark):
    rows = _rows(200, 8, 4)
    df = spark.createDataFrame(rows, "CUST_ID long, " + ", ".join(f"{c} double" for c in S.FEATURES))
    out = []
    for parts in (1, 6):
        scaled = S.standardize(df.repartition(parts))
        out.append((sorted(map(tuple, S.elbow(scaled).collect())), sorted(map(tuple, S.segments(scaled).collect()))))
    assert out[0] == out[1]
    curve = [s for _, s in out[0][0]]
    assert len(curve) == 9 and curve[0] > curve[3] > curve[8]
    total = S.total_sse(S.standardize(df)).select(F.round("sse", 4)).first()[0]
    assert abs(curve[0] - total) < 1e-2
