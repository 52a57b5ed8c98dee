"""Quality classifier: held-out accuracy and messy input."""

import zlib

import numpy as np

from tavolo.llm import quality as Q

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy_and_repeatability(spark):
    rows = {r["doc_id"]: r for r in Q.op5_quality_gam(spark, SF).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for i, r in rows.items())
    held = [(rows[i]["predicted"], y) for i, y in labels.items() if rows[i]["held_out"]]
    good, junk = [p for p, y in held if y == 1], [p for p, y in held if y == 0]
    assert len(held) > 300 and np.mean(good) > 0.99 and np.mean(junk) < 0.05
    again = {r["doc_id"]: r["score"] for r in Q.op5_quality_gam(spark, SF).collect()}
    assert all(again[i] == r["score"] for i, r in rows.items())


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(0)
    x = rng.random((3000, len(Q.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = Q.fit_additive(x[:2000], y[:2000])
    assert ((model.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.9 and (0, 1) in model.pairs


def test_messy_rows(spark, clashing, nothing):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)] + [(0, 1, 0), (None, 1, 0), (3, None, 0), (999, 1, 0)], "doc_id long, quality int, toxic int")
    model = Q.fit_quality(clashing, labels)
    got = Q.score_quality(clashing, model)
    assert got.columns.count("score") == got.columns.count("held_out") == 1 and got.count() == clashing.count()
    assert got.where("score is null or held_out is null or predicted is null").count() == 0
    assert Q.score_quality(nothing, model).count() == 0
    unlabelled = Q.fit_quality(clashing, labels.limit(0))
    assert {r["score"] for r in Q.score_quality(clashing, unlabelled).select("score").distinct().collect()} == {0.5}
    one = Q.fit_quality(clashing, labels.where("quality = 1"))
    assert min(r["score"] for r in Q.score_quality(clashing, one).select("score").collect()) > 0.5


def test_a_repeated_id_is_one_row_of_the_fit(spark, monkeypatch):
    docs = spark.createDataFrame([(1, f"text {i % 9}") for i in range(900)] + [(i, f"other words {i}") for i in range(2, 60)], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 60)], "doc_id long, quality int, toxic int")
    seen = []
    fit = Q.fit_additive
    monkeypatch.setattr(Q, "fit_additive", lambda x, y: seen.append(len(x)) or fit(x, y))
    Q.fit_quality(docs, labels)
    Q.fit_quality(docs, labels, fit_rows=10)
    assert seen[0] < 60 and seen[1] <= 10
