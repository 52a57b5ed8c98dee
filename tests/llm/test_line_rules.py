"""Quality rules: counts and Viterbi against plain versions."""

import itertools
import random
import re
from collections import Counter

import numpy as np

from tavolo.llm import rules as R

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _plain(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_base_counts():
    rng = random.Random(3)
    for _ in range(1500):
        text = "".join(rng.choice(["a", "b", "a b", " ", "\n", "\x1c", "|", "é", "\x0b", "\x85", "#"]) for _ in range(rng.randint(0, 60)))
        assert R.base_counts(text) == _plain(text)
    many = " ".join(str(rng.randint(0, 9000)) for _ in range(12_000)) + " a b c d e x a b c d e"  # too many words for one number
    assert R.base_counts(many) == _plain(many)


def test_viterbi_against_all_sequences():
    rng = np.random.default_rng(1)
    for n in range(1, 8):
        field = R.ChainField(rng.normal(size=(len(R.FEATURES), 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
        x = (rng.random((n, len(R.FEATURES))) < 0.3).astype(float)
        e = x @ field.emit + [R.CAUTION, 0]
        best = max(itertools.product((0, 1), repeat=n), key=lambda p: field.start[p[0]] + sum(e[i, s] for i, s in enumerate(p)) + sum(field.move[a, b] for a, b in zip(p, p[1:])))
        assert tuple(field.decode(x)) == best
    assert field.decode(np.zeros((0, len(R.FEATURES)))) == []


def test_field_learns_runs():
    rng = np.random.default_rng(2)
    xs, ys = [], []
    for _ in range(300):
        y = np.cumsum(rng.random(12) < 0.2) % 2
        x = np.zeros((12, len(R.FEATURES)))
        x[:, 0], x[:, 5] = 1, np.where(rng.random(12) < 0.85, y, 1 - y)
        xs.append(x), ys.append(y)
    field = R.fit_field(xs, ys)
    assert field.move[0, 0] + field.move[1, 1] > field.move[0, 1] + field.move[1, 0] and field.emit[5, 1] > field.emit[5, 0]


def test_clean_documents_stay_and_junk_goes(spark):
    sf = "/root/testdata/sf0.1"
    rows = {r["doc_id"]: r for r in R.op7_crf_rules(spark, sf).collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == len(texts)
    for i in list(rows)[::40]:
        r, want = rows[i], _plain(texts[i])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (r["base_failed"] and r["kept"])
    good = [rows[i]["kept"] for i, y in labels.items() if y == 1 and not rows[i]["base_failed"]]
    junk = [rows[i]["kept"] for i, y in labels.items() if y == 0]
    assert np.mean(good) > 0.995 and np.mean(junk) < 0.3


def test_messy_rows(spark, clashing, nothing):
    field = R.fit_on_corpus(clashing)
    got = R.judge(clashing, field)
    assert got.columns.count("kept") == 1 and got.count() == clashing.count() and got.where("kept is null").count() == 0
    assert got.where("text is null and kept").count() == 0
    assert R.judge(nothing, R.fit_on_corpus(nothing)).count() == 0


def test_labels_come_from_marks_not_from_features(spark):
    """Two kinds of lines that plain marks cannot tell apart; only the documents' marks can."""
    rng = random.Random(7)
    good = lambda: " ".join("".join(rng.choice("abcde") for _ in range(5)) for _ in range(12)) + "."
    low = lambda: " ".join("".join(rng.choice("vwxyz") for _ in range(2)) for _ in range(12))
    rows = [(i, "\n".join((low if i % 2 else good)() for _ in range(6))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, 1 - i % 2) for i in range(160)], "doc_id long, quality int")
    field = R.fit_on_corpus(docs, labels=marks)
    kept = {r["doc_id"]: r["kept"] for r in R.judge(docs, field).collect()}
    assert np.mean([kept[i] for i in range(160, 200) if i % 2 == 0]) == 1 and np.mean([kept[i] for i in range(160, 200) if i % 2]) < 0.1
    again = R.fit_on_corpus(docs.repartition(5), labels=marks)
    assert np.allclose(field.emit, again.emit)


def test_the_sample_is_bounded(spark, monkeypatch):
    rows = [(1, "\n".join(f"line {i} of a very long text" for i in range(5000)))] + [(i, f"text {i}\nwith two lines") for i in range(2, 50)]
    docs = spark.createDataFrame(rows * 3, "doc_id long, text string")
    seen = []
    monkeypatch.setattr(R, "fit_field", lambda xs, ys: seen.append((len(xs), max(map(len, xs)))) or R.ChainField(np.zeros((len(R.FEATURES), 2)), np.zeros((2, 2)), np.zeros(2)))
    R.fit_on_corpus(docs, fit_sequences=20)
    assert seen[0][0] <= 20 and seen[0][1] <= R.SEQUENCE
