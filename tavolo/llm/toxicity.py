"""Toxicity classifier: subword-bag embeddings averaged into a linear softmax.

A text is cut into chunks of ``CHUNK`` words. Every character n-gram of a word
(with a mark at both ends of the word) has an embedding, by hash bucket. The
mean embedding of a chunk goes through a linear softmax over two classes; the
chunks' margins pool into the document's by a soft maximum, as a document is
toxic when one passage is. Embeddings and softmax are trained jointly, by
gradient descent in numpy. A misspelling that training never saw shares most n-grams with words
it did see, so it lies near them.

For scoring, embedding and softmax weights multiply out to one number a bucket
(the margin of the second class over the first), so a chunk's margin is the
mean of its buckets' numbers.

The model is fitted on at most ``fit_rows`` labelled documents, a third of them
toxic where there are so many, in hash order of their ids, with their whole
texts. Scores hold for that share, not for the corpus's.

Defined results: null text counts as empty; a text without words has the
margin of the bias; without labelled rows (or with one label only) the score is
the smoothed share of label 1; a document with several labels has their rounded
mean; repeated rows are scored each; null ids are kept and never held out. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavolo.llm.shared import hash_sample, table, text_fold, without

FIT_ROWS = 6600
FOLDS, HELD_OUT_FOLD, THRESHOLD = 3, 1, 0.7
CHUNK = 16
SIZES = (3, 4, 5, 6)
BUCKETS, DIMENSIONS = 1 << 17, 8
SHARPNESS = 3.0
#: Full-batch descent with momentum; it ends early once the fitted documents' loss is low.
STEPS, RATE, MOMENTUM, DECAY, LOW_LOSS = 100, 2.0, 0.9, 1e-5, 0.02
#: The mean embedding is scaled up, as few n-grams of a chunk tell.
SCALE = 50.0
#: N-grams that fewer words of the fitted documents hold (counted once a document) stay at zero.
LEAST_SEEN = 3

#: Punctuation parts words here, so that a word's end mark is its own.
_PARTING = bytes.maketrans(b".,;:!?\"()[]{}", b" " * 13)


def parted(text: str | None) -> list[bytes]:
    """Lower-case words; a word repeated at once counts once, else a run of one word would fill a chunk."""
    words = (text or "").encode("utf-8", "replace").lower().translate(_PARTING).split()
    return [w for w, before in zip(words, [None, *words]) if w != before]


def subwords(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(chunk of each n-gram, its bucket, document of each chunk). Every text has at least one chunk."""
    words = [parted(t) for t in texts]
    n_chunks = np.array([max(1, -(-len(w) // CHUNK)) for w in words], np.int64)
    first_chunk = np.cumsum(n_chunks) - n_chunks
    document = np.repeat(np.arange(len(words)), n_chunks)
    lengths = np.fromiter((len(x) for w in words for x in w), np.int64)
    if not len(lengths):
        return np.zeros(0, np.int32), np.zeros(0, np.int32), document
    chunk_of_word = np.concatenate([first_chunk[i] + np.arange(len(w)) // CHUNK for i, w in enumerate(words) if w])
    buffer = np.frombuffer(b" " + b" ".join(b" ".join(w) for w in words if w) + b" ", dtype=np.uint8)
    chunk_of_byte = np.append(np.repeat(chunk_of_word, lengths + 1), chunk_of_word[-1]).astype(np.int32)
    space = buffer == 32
    chunks, buckets = [], []
    value = buffer.astype(np.uint64)
    rolled, inner = value.copy(), np.zeros(len(buffer), bool)
    for n in range(2, max(SIZES) + 1):
        if len(buffer) < n:
            break
        # The n-gram from byte i: no space strictly inside it.
        rolled = rolled[:-1] * np.uint64(0x9E3779B97F4A7C15) + value[n - 1:]
        inner = inner[:-1] | (space[n - 2:-1] if n > 2 else False)
        if n in SIZES:
            kept = np.flatnonzero(~inner)
            mixed = rolled[kept] * np.uint64(0xD6E8FEB86659FD93) + np.uint64(n)
            buckets.append(((mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(47)).astype(np.int32))
            chunks.append(chunk_of_byte[kept + 1])
    return np.concatenate(chunks), np.concatenate(buckets), document


class SubwordModel:
    def __init__(self, margins: np.ndarray, bias: float):
        self.margins, self.bias = margins, bias

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not self.margins.any():  # nothing learned: the share alone
            return np.full(len(texts), 1 / (1 + np.exp(-self.bias)))
        chunk, bucket, document = subwords(texts)
        n = np.maximum(np.bincount(chunk, minlength=len(document)), 1)
        margin = np.bincount(chunk, self.margins[bucket], len(document)) / n + self.bias
        return 1 / (1 + np.exp(-np.clip(soft_maximum(margin, document, len(texts))[0], -30, 30)))


def soft_maximum(margin: np.ndarray, document: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Pooled margin of each document, and each chunk's share in it."""
    starts = np.searchsorted(document, np.arange(n))
    top = np.maximum.reduceat(margin, starts) if n else np.zeros(0)
    e = np.exp(SHARPNESS * (margin - top[document]))
    total = np.bincount(document, e, n)
    return top + np.log(total) / SHARPNESS, e / total[document]


def _bag_of_words(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, and by word occurrence its word and chunk; the document of each chunk, the documents of each word."""
    known: dict[bytes, int] = {}
    word, chunk, document, seen = [], [], [], []
    chunks = 0
    for d, text in enumerate(texts):
        ids = np.array([known.setdefault(w, len(known)) for w in parted(text)], np.int32)
        n = max(1, -(-len(ids) // CHUNK))
        word.append(ids)
        chunk.append((chunks + np.arange(len(ids)) // CHUNK).astype(np.int32))
        document.append(np.full(n, d))
        seen.append(np.unique(ids))
        chunks += n
    of_word = np.bincount(np.concatenate(seen), minlength=len(known))
    return [w.decode("utf-8", "replace") for w in known], np.concatenate(word), np.concatenate(chunk), np.concatenate(document), of_word


def _gathered(index: np.ndarray, values: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Sums of ``values[at]`` by ``index``, in slices, so that no temporary is as long as they are."""
    total = np.zeros(size)
    for i in range(0, len(index), 1 << 20):
        total += np.bincount(index[i:i + (1 << 20)], values[at[i:i + (1 << 20)]], size)
    return total


def fit_subwords(texts: list[str | None], labels: np.ndarray) -> SubwordModel:
    y = np.asarray(labels, float)
    share = (y.sum() + 1) / (len(y) + 2)
    if len(np.unique(y)) < 2:
        return SubwordModel(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share))))
    # A distinct word's n-grams are the same wherever it stands.
    words, word, chunk, document, of_word = _bag_of_words(texts)
    slices = [subwords(words[i:i + 50_000]) for i in range(0, len(words), 50_000)]
    bucket = np.concatenate([b for _, b, _ in slices])
    owner = np.concatenate([(first[own] + 50_000 * i).astype(np.int32) for i, (own, _, first) in enumerate(slices)])
    n_words = len(words)
    del slices, words
    size = np.bincount(owner, minlength=n_words)
    n_grams = np.maximum(np.bincount(chunk, size[word], len(document)), 1)
    seen = _gathered(bucket, of_word, owner, BUCKETS) >= LEAST_SEEN
    owner, bucket = owner[seen[bucket]], bucket[seen[bucket]]
    rng = np.random.default_rng(7)
    embeddings = rng.normal(0, 0.001, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights = rng.normal(0, 1 / np.sqrt(2 * DIMENSIONS), (DIMENSIONS, 2)).astype(np.float32)
    bias = np.array([1.0, -1.0])
    pace = [np.zeros_like(embeddings), np.zeros_like(weights), np.zeros(2)]
    balance = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    for _ in range(STEPS):
        towards = weights[:, 1] - weights[:, 0]
        of_words = _gathered(owner, embeddings @ towards, bucket, n_words)
        margin = SCALE * _gathered(chunk, of_words, word, len(document)) / n_grams + (bias[1] - bias[0])
        pooled, part = soft_maximum(margin, document, len(y))
        if (balance * np.logaddexp(0, np.where(y == 1, -pooled, pooled))).sum() < LOW_LOSS:
            break
        # Softmax of two classes: the gradient of both logits is the same but for its sign.
        error = (1 / (1 + np.exp(-np.clip(pooled, -30, 30))) - y) * balance
        of_chunk = SCALE * error[document] * part / n_grams
        to_words = _gathered(word, of_chunk, chunk, n_words)
        to_buckets = _gathered(bucket, to_words, owner, BUCKETS).astype(np.float32)
        to_weights = embeddings.T @ to_buckets
        slopes = [to_buckets[:, None] * towards + DECAY * embeddings, 0.1 * np.stack([-to_weights, to_weights], axis=1),
                  0.1 * np.array([-error.sum(), error.sum()])]
        for value, speed, slope in zip((embeddings, weights, bias), pace, slopes):
            speed *= MOMENTUM
            speed -= RATE * slope
            value += speed
    towards = weights[:, 1] - weights[:, 0]
    return SubwordModel((SCALE * (embeddings @ towards) * seen).astype(np.float32), float(bias[1] - bias[0]))


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text",
                 fit_rows: int = FIT_ROWS) -> SubwordModel:
    """Labels are cut down first, by class and hash order, and of a repeated id the smallest text stays: ``fit_rows`` texts at most reach the driver."""
    marks = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (text_fold(F.col("doc_id"), FOLDS) != HELD_OUT_FOLD))
             .groupBy(F.col("doc_id").alias("__id")).agg(F.round(F.avg(label)).cast("int").alias("__y")))
    n = {r["__y"]: r["n"] for r in marks.groupBy("__y").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic = hash_sample(marks.where("__y = 1"), F.col("__id"), fit_rows // 3, n.get(1, 0))
    clean = hash_sample(marks.where("__y = 0"), F.col("__id"), fit_rows - fit_rows // 3, n.get(0, 0))
    rows = (docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text"))
            .join(F.broadcast(toxic.unionByName(clean)), "__id").groupBy("__id", "__y").agg(F.min("__text").alias("__text")).toPandas())
    rows = rows.assign(__text=rows["__text"].fillna("")).sort_values(["__id", "__text"])
    return fit_subwords(rows["__text"].tolist(), rows["__y"].to_numpy())


def score_toxicity(docs: DataFrame, model: SubwordModel, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                   keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with held_out, score and predicted."""
    docs = without(docs, "held_out", "score", "predicted").withColumn("held_out", F.coalesce(text_fold(F.col(doc_id), FOLDS) == HELD_OUT_FOLD, F.lit(False)))
    kept = [c for c in docs.columns if keep is None or c in keep or c == "held_out"]
    schema = docs.select([F.col(f"`{c}`") for c in kept]).withColumn("score", F.lit(0.0)).schema
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 64):
                batch = whole.slice(start, 64)
                scores = sent.value.score(batch.column(text).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(scores)], names=[*kept, "score"])

    return docs.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op8_toxicity_subwords(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model, keep=["doc_id"])
