"""Forests from one canonical table: the same on any partitions."""

import random

import numpy as np
from pyspark.sql import functions as F

from tavolo.operators import forest as G
from tavolo.operators import models as M

FEATURES = ["a", "b", "c"]


def _cards(spark, n=400):
    rng = random.Random(9)
    rows = [(i, rng.gauss(i % 3, 0.6), rng.random(), rng.choice([0.0, 1.0, None]) if i % 9 == 0 else float(i % 3 == 1), i % 3) for i in range(n)]
    return spark.createDataFrame(rows, "CUST_ID long, a double, b double, c double, Cluster int")


def test_bins_are_exact_quantiles(spark):
    df = spark.createDataFrame([(i, float(i), 1.0) for i in range(101)], "CUST_ID long, a double, b double")
    bins = M.fit_bins(df, ["a", "b"], 4)
    assert bins == {"a": [25.0, 50.0, 75.0], "b": [1.0]}
    cut = {r["CUST_ID"]: (r["a"], r["b"]) for r in M.binned(df, ["a", "b"], bins).collect()}
    assert cut[0] == (0.0, 1.0) and cut[24][0] == 0.0 and cut[25][0] == 1.0 and cut[100][0] == 3.0


def test_canonical_tables_have_equal_partitions(spark):
    df = _cards(spark)
    layout = lambda x: [list(map(tuple, p)) for p in M.canonical(x, "CUST_ID", 60).rdd.glom().collect()]
    one = layout(df.repartition(1))
    assert one == layout(df.repartition(8)) and sum(map(len, one)) == 400 and sum(map(bool, one)) > 1


def test_forest_and_selection_on_one_and_eight_partitions(spark):
    out = []
    for parts in (1, 8):
        df = _cards(spark).repartition(parts)
        train = M.canonical(M.binned(df, FEATURES, M.fit_bins(df, FEATURES)), "CUST_ID", 60)
        model = M.fit_forest(train, FEATURES, num_trees=8, max_depth=6)
        chosen = M.rfecv(df, FEATURES, folds=3, num_trees=6, max_depth=5)
        out.append((M.importances(model, FEATURES), sorted(map(tuple, chosen.collect()))))
    assert out[0] == out[1]
    rank = {f: r for f, r, *_ in out[0][1]}
    assert rank["a"] == 1 and {r[2] for r in out[0][1]} <= {True, False}
    assert M.binned(_cards(spark).where(F.lit(False)), FEATURES, {c: [] for c in FEATURES}).count() == 0


def test_a_forest_of_many_trees_is_fitted_in_parts(spark, monkeypatch):
    monkeypatch.setattr(M, "FIT_TREES", 5)
    monkeypatch.setattr(M, "ONE_FIT_ROWS", 399)
    df = _cards(spark)
    train = M.canonical(M.binned(df, FEATURES, M.fit_bins(df, FEATURES)), "CUST_ID", 60)
    model = M.fit_forest(train, FEATURES, num_trees=12, max_depth=6)
    assert [len(p.trees) for p in model.parts] == [5, 5, 2]
    assert len({t.toDebugString.split("\n", 1)[1] for p in model.parts for t in p.trees}) > 5  # no part repeats another
    imp = dict(M.importances(model, FEATURES))
    assert abs(sum(imp.values()) - 1) < 1e-9 and max(imp, key=imp.get) == "a"
    got = M.forest_predict(model, train, FEATURES)
    assert got.count() == 400 and got.where("label = prediction").count() > 360
    monkeypatch.setattr(M, "ONE_FIT_ROWS", 400)
    assert [len(p.trees) for p in M.fit_forest(train, FEATURES, num_trees=12, max_depth=6).parts] == [12]


def _grown(spark, monkeypatch, train, **bounds):
    monkeypatch.setattr(M, "ONE_FIT_ROWS", 0)
    for name, value in bounds.items():
        monkeypatch.setattr(G, name, value)
    return M.fit_forest(train, FEATURES, num_trees=6, max_depth=20)


def _shown(model):
    return [t.toDebugString for p in model.parts for t in p.trees]


def test_a_grown_forest_is_the_same_however_its_nodes_are_split(spark, monkeypatch):
    df = _cards(spark)
    train = M.canonical(M.binned(df, FEATURES, M.fit_bins(df, FEATURES)), "CUST_ID", 60)
    one = _grown(spark, monkeypatch, train)
    assert one.top == {} and not one.table.where("heap > 1").count()
    by_sums = _grown(spark, monkeypatch, train.repartition(3), LOCAL_ROWS=30)
    assert sum(map(len, by_sums.top.values())) > 20 and by_sums.table.count() > 20  # nodes on the driver and pieces of tasks
    assert _shown(by_sums) == _shown(one) == _shown(_grown(spark, monkeypatch, train, LOCAL_ROWS=500_000, FEW_ROWS=()))
    assert M.importances(by_sums, FEATURES) == M.importances(one, FEATURES)
    rows = lambda m: sorted(map(tuple, M.forest_predict(m, train, FEATURES).collect()))
    assert rows(by_sums) == rows(one)
    monkeypatch.setattr(G, "PREDICT_ROWS", 50)
    assert rows(by_sums) == rows(one) and len(rows(one)) == 400


def test_a_grown_forest_is_like_that_of_spark(spark, monkeypatch):
    df = _cards(spark)
    train = M.canonical(M.binned(df, FEATURES, M.fit_bins(df, FEATURES)), "CUST_ID", 60)
    found = []
    for rows in (400, 0):
        monkeypatch.setattr(M, "ONE_FIT_ROWS", rows)
        model = M.fit_forest(train, FEATURES, num_trees=60)
        sizes = [t.numNodes for p in model.parts for t in p.trees]
        found.append((sum(sizes) / 60, dict(M.importances(model, FEATURES))))
    (spark_nodes, of_spark), (nodes, own) = found
    assert abs(nodes - spark_nodes) < 3 and max(abs(own[f] - of_spark[f]) for f in FEATURES) < 0.03


def test_no_tree_of_a_grown_forest_comes_to_the_driver(spark, monkeypatch):
    df = _cards(spark)
    train = M.canonical(M.binned(df, FEATURES, M.fit_bins(df, FEATURES)), "CUST_ID", 60)
    monkeypatch.setattr(M, "ONE_FIT_ROWS", 399)
    monkeypatch.setattr(M.RandomForestClassifier, "fit", lambda *a: 1 / 0)
    model = M.fit_forest(train, FEATURES, num_trees=5, max_depth=8)
    assert M.forest_predict(model, train, FEATURES).where("label = prediction").count() > 360
    assert not any("trees" in vars(p) for p in model.parts) and model.table.count() == 5


def test_leaves_hold_the_rows_that_come_to_them():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 12, (3000, 4)).astype(np.uint8)
    x[:, 3] %= 5
    y = (x[:, 0] // 5 + (x[:, 1] > 6) + (rng.random(3000) < 0.1)).astype(np.int64)
    w = G.bag(G._stirred(np.arange(3000)), 0, 0)
    assert abs(w.mean() - 1) < 0.1 and abs((w == 0).mean() - np.exp(-1)) < 0.05
    x, y, w = x[w > 0], y[w > 0], w[w > 0]
    for kinds in ([G.NUMBERS] * 4, [G.CATEGORIES] * 4, [G.CATEGORIES, G.NUMBERS, G.CATEGORIES, 5]):
        piece, gains = G.grow(x, y, w, np.array(kinds), 1, 0, 0, 2, 5, 30, 13)
        votes = np.zeros_like(piece["votes"])
        np.add.at(votes, (G._leaves(piece, x), y), w)
        assert (votes == piece["votes"]).all() and len(votes) > 10 and (gains > 0).all()
        total = np.bincount(y, weights=w)
        rest = sum(v.sum() - (v * v).sum() / v.sum() for v in piece["votes"].astype(float))
        assert abs(gains.sum() / G.GAIN_GRID - (total.sum() - (total * total).sum() / total.sum() - rest)) < 0.01


def test_balanced_accuracy_is_that_of_the_report(spark):
    from tavolo.operators.evaluate import balanced_accuracy, classification_report
    rows = [(i % 4, (i * i) % 5) for i in range(97)] + [(7, 1), (None, 2), (3, None)]
    df = spark.createDataFrame(rows, "label int, prediction int")
    report = classification_report(df, places=12).where("label = 'balanced accuracy'").first()["recall"]
    assert abs(balanced_accuracy(df) - report) < 1e-12
    assert classification_report(df).where("label = '7'").count() == 1
