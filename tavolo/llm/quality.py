"""Quality classifier: a generalised additive model with pairwise interactions.

The score of a document is the logistic of a sum of lookup tables: one for
each feature of its text, cut into quantile bins, and one for each chosen pair
of features. The tables are learned by cyclic boosting: round after round,
each feature in turn gets a small step along a shallow tree (three splits) on
its own bins; then the pairs that still explain most of the residual get the
same with trees of one split on either feature. Scoring looks the bins up and
adds, whole batches at a time.

The model is fitted on at most ``fit_rows`` labelled documents, taken in hash
order of their ids; only their feature rows reach the driver. Features come
from the text alone.

Defined results: null text counts as empty; empty texts are scored like any
other; without labelled rows (or with one label only) the score is the
smoothed share of label 1; a document with several labels has their rounded
mean; repeated rows are scored each; null ids are kept and never held out. An
empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tavolo.llm.shared import hash_sample, table, text_fold, without

FIT_ROWS = 20_000
FOLDS, HELD_OUT_FOLD, THRESHOLD = 5, 0, 0.3
BINS, PAIR_BINS, N_PAIRS = 32, 8, 8
ROUNDS, PAIR_ROUNDS, RATE = 150, 60, 0.15

FEATURES = ["words", "word_bytes", "distinct_words", "distinct_pairs", "equal_neighbours", "capitals", "symbols", "marks",
            "digits", "end_marks", "repeated_lines", "line_words", "lone_symbols", "foreign_bytes", "longest_word"]

_CAPITALS = bytes(range(65, 91))
_SYMBOLS = b"#*$%&|<>@^~_=+{}[]\\/"
_MARKS = b"!?"
_DIGITS = b"0123456789"
_ENDS = b".,;:"
_HIGH = bytes(range(128, 256))
_LONE = re.compile(rb"(?<![^\s])[^\sA-Za-z0-9\x80-\xff](?![^\s])")


def text_features(text: str | None) -> list[float]:
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    n, size = len(words), max(len(raw), 1)
    if not n:
        return [0.0] * len(FEATURES)

    def share(letters: bytes) -> float:
        return (len(raw) - len(raw.translate(None, letters))) / size

    lines = [x for x in raw.split(b"\n") if x.strip()]
    equal = sum(map(bytes.__eq__, words, words[1:]))
    return [np.log1p(n), sum(map(len, words)) / n, len(set(words)) / n ** 0.9, len(set(zip(words, words[1:]))) / max(n - 1, 1),
            equal / n, share(_CAPITALS), share(_SYMBOLS), share(_MARKS), share(_DIGITS), share(_ENDS),
            1 - len(set(lines)) / len(lines), np.log1p(n / len(lines)), len(_LONE.findall(raw)) / n, share(_HIGH), np.log1p(max(map(len, words)))]


def _bin(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(cuts)], axis=1) if len(x) else np.zeros((0, len(cuts)), int)


def _best_split(g: np.ndarray, h: np.ndarray, lo: int, hi: int) -> tuple[float, int]:
    """Gain and place of the best split of bins lo..hi-1; the place is the first bin on the right."""
    if hi - lo < 2:
        return 0.0, lo
    gl, hl = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
    gt, ht = g[lo:hi].sum(), h[lo:hi].sum()
    gain = gl ** 2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt ** 2 / (ht + 1)
    i = int(np.argmax(gain))
    return float(gain[i]), lo + i + 1


def _tree_step(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf values, by bin, of a tree with up to three splits on one feature."""
    leaves = [(0, len(g))]
    for _ in range(3):
        gains = [(*_best_split(g, h, lo, hi), i) for i, (lo, hi) in enumerate(leaves)]
        gain, at, i = max(gains)
        if gain <= 1e-9:
            break
        lo, hi = leaves[i]
        leaves[i:i + 1] = [(lo, at), (at, hi)]
    step = np.zeros(len(g))
    for lo, hi in leaves:
        step[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + 1)
    return step


def _pair_step(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of a tree with one split on each of two features."""
    gc, hc = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    gt, ht = gc[-1, -1], hc[-1, -1]
    a_g, a_h = gc[:-1, :-1], hc[:-1, :-1]
    b_g, b_h = gc[:-1, -1:] - a_g, hc[:-1, -1:] - a_h
    c_g, c_h = gc[-1:, :-1] - a_g, hc[-1:, :-1] - a_h
    d_g, d_h = gt - a_g - b_g - c_g, ht - a_h - b_h - c_h
    gain = sum(x ** 2 / (y + 1) for x, y in ((a_g, a_h), (b_g, b_h), (c_g, c_h), (d_g, d_h))) - gt ** 2 / (ht + 1)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    step = np.empty_like(g)
    step[:i + 1, :j + 1] = a_g[i, j] / (a_h[i, j] + 1)
    step[:i + 1, j + 1:] = b_g[i, j] / (b_h[i, j] + 1)
    step[i + 1:, :j + 1] = c_g[i, j] / (c_h[i, j] + 1)
    step[i + 1:, j + 1:] = d_g[i, j] / (d_h[i, j] + 1)
    return float(gain[i, j]), step


class AdditiveModel:
    """Lookup tables over feature bins: ``score`` adds them up."""

    def __init__(self, bias: float, cuts: list[np.ndarray], tables: list[np.ndarray], coarse: list[np.ndarray],
                 pairs: list[tuple[int, int]], pair_tables: list[np.ndarray]):
        self.bias, self.cuts, self.tables, self.coarse, self.pairs, self.pair_tables = bias, cuts, tables, coarse, pairs, pair_tables

    def logit(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        bins = _bin(x, self.cuts)
        for j, values in enumerate(self.tables):
            total += values[bins[:, j]]
        rough = _bin(x, self.coarse)
        for (a, b), values in zip(self.pairs, self.pair_tables):
            total += values[rough[:, a], rough[:, b]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def fit_additive(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Cyclic boosting on the logistic loss: features first, then the strongest pairs."""
    n, d = x.shape
    share = (y.sum() + 1) / (n + 2)
    bias = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return AdditiveModel(bias, [np.array([])] * d, [np.zeros(1)] * d, [np.array([])] * d, [], [])
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(d)]
    coarse = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, PAIR_BINS + 1)[1:-1])) for j in range(d)]
    bins, rough = _bin(x, cuts), _bin(x, coarse)
    tables = [np.zeros(len(c) + 1) for c in cuts]
    logit = np.full(n, bias)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-logit))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(d):
            g, h = slopes()
            step = RATE * _tree_step(np.bincount(bins[:, j], g, len(tables[j])), np.bincount(bins[:, j], h, len(tables[j])))
            tables[j] += step
            logit += step[bins[:, j]]

    def grid(a: int, b: int, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows, cols = len(coarse[a]) + 1, len(coarse[b]) + 1
        flat = rough[:, a] * cols + rough[:, b]
        return np.bincount(flat, g, rows * cols).reshape(rows, cols), np.bincount(flat, h, rows * cols).reshape(rows, cols)

    usable = [j for j in range(d) if len(coarse[j])]
    g, h = slopes()
    gains = sorted(((_pair_step(*grid(a, b, g, h))[0], a, b) for a, b in combinations(usable, 2)), reverse=True)
    pairs = [(a, b) for _, a, b in gains[:N_PAIRS]]
    pair_tables = [np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1)) for a, b in pairs]
    for _ in range(PAIR_ROUNDS):
        for i, (a, b) in enumerate(pairs):
            step = RATE * _pair_step(*grid(a, b, *slopes()))[1]
            pair_tables[i] += step
            logit += step[rough[:, a], rough[:, b]]
    return AdditiveModel(bias, cuts, tables, coarse, pairs, pair_tables)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [text_features(t.as_py()) for t in batch.column(0)]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1), batch.column(2)], names=["x", "y", "id"])


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, training: Column, rows: int, doc_id: str, text: str) -> DataFrame:
    """(text, y, id) of the rows of at most ``rows`` labelled ids that ``training`` (of doc_id) admits.

    The labels are cut down first, in hash order, so the side of the join that is broadcast has ``rows`` rows at most.
    """
    marks = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & training)
             .groupBy(F.col("doc_id").alias("__id")).agg(F.round(F.avg(label)).cast("int").alias("__y")))
    marks = hash_sample(marks, F.col("__id"), rows, marks.count())
    return (docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text"))
            .join(F.broadcast(marks), "__id").select("__text", "__y", "__id"))


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
                fit_rows: int = FIT_ROWS) -> AdditiveModel:
    training = text_fold(F.col("doc_id"), FOLDS) != HELD_OUT_FOLD
    sample = labelled_sample(docs, labels, label, training, fit_rows, doc_id, text)
    of_id = f"id {sample.schema['__id'].dataType.simpleString()}"
    # Of a repeated id one row stays, so ``fit_rows`` rows of features at most reach the driver.
    sample = sample.mapInArrow(_feature_rows, f"x array<double>, y int, {of_id}").groupBy("id").agg(F.min(F.struct("x", "y")).alias("row"))
    rows = sample.select("row.x", "row.y").toPandas()
    rows = rows.assign(order=rows["x"].map(tuple)).sort_values(["order", "y"])  # the fit does not depend on partitions
    x = np.array(rows["x"].tolist(), float).reshape(-1, len(FEATURES))
    return fit_additive(x, rows["y"].to_numpy(float))


def score_quality(docs: DataFrame, model: AdditiveModel, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                  keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with held_out, score and predicted."""
    docs = without(docs, "held_out", "score", "predicted").withColumn("held_out", F.coalesce(text_fold(F.col(doc_id), FOLDS) == HELD_OUT_FOLD, F.lit(False)))
    kept = [c for c in docs.columns if keep is None or c in keep or c == "held_out"]
    schema = docs.select([F.col(f"`{c}`") for c in kept]).withColumn("score", F.lit(0.0)).schema
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                x = np.array([text_features(t.as_py()) for t in batch.column(text)], float).reshape(-1, len(FEATURES))
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(sent.value.score(x))], names=[*kept, "score"])

    return docs.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op5_quality_gam(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model, keep=["doc_id"])
