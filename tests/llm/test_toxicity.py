"""Toxicity classifier: held-out accuracy, unseen spellings, messy input."""

import random
import zlib

import numpy as np

from tavolo.llm import toxicity as X

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    rows = {r["doc_id"]: r for r in X.op8_toxicity_subwords(spark, SF).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) and r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for i, r in rows.items())
    held = [(rows[i]["predicted"], y) for i, y in labels.items() if rows[i]["held_out"]]
    toxic, clean = [p for p, y in held if y == 1], [p for p, y in held if y == 0]
    assert len(toxic) > 80 and np.mean(toxic) > 0.6 and np.mean(clean) < 0.04


def test_unseen_misspellings():
    rng = random.Random(1)
    plain = ["".join(rng.choice("aeioubdfglmnrst") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    variants = [f"zwerkx{e}" for e in ("a", "on", "ers", "ig", "um", "ish", "est", "ar")]
    texts, labels = [], []
    for i in range(300):
        words = [rng.choice(plain) for _ in range(rng.randint(30, 120))]
        if i % 3 == 0:
            words.insert(rng.randrange(len(words)), rng.choice(variants[:5]))
        texts.append(" ".join(words)), labels.append(int(i % 3 == 0))
    model = X.fit_subwords(texts, np.array(labels))
    def fresh(word=None):
        words = [rng.choice(plain) for _ in range(60)]
        return " ".join(words if word is None else [*words[:30], word, *words[30:]])
    assert model.score([fresh(v) for v in variants[5:]] * 4).min() > 0.5 > model.score([fresh() for _ in range(30)]).max()


def test_subwords_do_not_cross_words():
    chunk, bucket, document = X.subwords(["abc, de", None, "", "x " * 40])
    alone = [X.subwords([w])[1] for w in ("abc", "de", "x")]
    assert sorted(bucket[chunk == 0]) == sorted(np.concatenate(alone[:2])) and document.tolist() == [0, 1, 2, 3]
    assert sorted(bucket[chunk == 3]) == sorted(alone[2])


def test_messy_rows(spark, clashing, nothing):
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(25)] + [(0, 1, 1), (None, 1, 1), (3, 1, None), (206, 1, 0)], "doc_id long, quality int, toxic int")
    model = X.fit_toxicity(clashing, labels)
    got = X.score_toxicity(clashing, model)
    assert got.count() == clashing.count() and got.where("score is null or held_out is null").count() == 0
    assert X.score_toxicity(nothing, model).count() == 0
    assert {r["score"] for r in X.score_toxicity(clashing, X.fit_toxicity(clashing, labels.limit(0))).select("score").distinct().collect()} == {0.5}


def test_a_repeated_id_is_one_text_of_the_fit(spark, monkeypatch):
    docs = spark.createDataFrame([(3, f"text {i % 9}") for i in range(900)] + [(i, f"other words {i}") for i in range(4, 60)], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(3, 60)], "doc_id long, quality int, toxic int")
    seen = []
    fit = X.fit_subwords
    monkeypatch.setattr(X, "fit_subwords", lambda texts, y: seen.append(len(texts)) or fit(texts, y))
    X.fit_toxicity(docs, labels)
    X.fit_toxicity(docs, labels, fit_rows=10)
    assert 0 < seen[0] < 60 and 0 < seen[1] <= 10
