"""Quality rules, and line labels by a linear-chain conditional random field.

Counts of a text decide first (too few words, too many words in repeated
5-word windows). For the rest, every line with a word is labelled content or
boilerplate: the field scores each line's features for either label and each
pair of neighbouring labels, and Viterbi decoding finds the best sequence. A
document is kept when at least ``keep_share`` of its words stand in content
lines.

The field is trained here, on at most ``fit_sequences`` runs of up to ``SEQUENCE``
lines (smallest hashes of id, text and place) of as many marked documents (smallest hashes of id). A line's label comes from
what its own features do not hold: from the company it keeps. Lines of
documents marked as low quality are boilerplate, unless documents marked as good
have the same line; lines of good documents are content. Either way a short line that
stands between at least ``least_contexts`` different pairs of neighbours over all
documents is boilerplate (copies of a document have the same neighbours and
prove nothing). The marks are of whole documents, so both kinds hold lines of the other;
the field learns what prevails. Features look at the text only, so documents
without a mark and lines that occur once are judged like the others; no mark is used in judging.
Without a table of marks, plain marks of the lines (symbols, capitals, one repeated word) stand in.

Tasks turn the lines into features and hashes; no text reaches the driver.

Defined results: null text has no words, fails the base rules and is not kept;
repeated rows are judged each; null ids are kept in the result; a document
marked several times counts as low if any mark is; ties between label
sequences go to content; a corpus without two kinds of lines gives a field that calls
every line content; an empty table gives an empty result. Texts are read whole;
a very long document is decoded in one pass, linear in its lines. Input columns may have any
names; those that the output uses are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tavolo.llm.shared import hash_sample, table, without, written

FIT_SEQUENCES = 4000
LEAST_WORDS, MOST_REPEATED = 10, 20
KEEP_SHARE = 0.3
#: Boilerplate must score this much above content: single short lines look like either.
CAUTION = 3.0
LEAST_CONTEXTS, SHORT_LINE = 5, 15
#: Training sequences are cut at this many lines.
SEQUENCE = 64
STEPS, RATE, DECAY = 250, 0.15, 1e-4

_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_CAPITALS = bytes(range(65, 91))
_DIGITS = b"0123456789"
_OTHER_MARKS = b"!?^~_=+{}[]\\/@"
#: Words that license lines, menus and notices share.
CUES = frozenset(b"license licensed licence copyright reserved cookie cookies subscribe privacy terms login javascript newsletter share".split())


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 5-word window found twice or more."""
    n = len(words)
    if n < 6:
        return 0
    known: dict[bytes, int] = {}
    code = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    k = len(known)
    if k == n:
        return 0
    if k < 6000:  # five codes fit one number
        window = (((code[:-4] * k + code[1:-3]) * k + code[2:-2]) * k + code[3:-1]) * k + code[4:]
    else:
        two = np.unique(code[:-1] * k + code[1:], return_inverse=True)[1]
        four = np.unique(two[:-2] * (two.max() + 1) + two[2:], return_inverse=True)[1]
        window = four[:-1] * k + code[4:]
    _, where, count = np.unique(window, return_inverse=True, return_counts=True)
    again = count[where] > 1
    return int((np.convolve(again, np.ones(5, np.int64)) > 0).sum()) if again.any() else 0


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    raw = text.encode("utf-8", "replace")
    words = raw.split()  # bytes: ASCII white space only
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (len(words), len(text) - (len(raw) - len(raw.translate(None, _SPACE))), len(raw) - len(raw.translate(None, _SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words))


FEATURES = ["always", "words<4", "words<10", "words>=30", "sentence end", "symbols>2%", "symbols>6%", "marks>5%", "digits>10%", "capitals>30%",
            "capitals>45%", "same neighbours>10%", "same neighbours>50%", "distinct words<60%", "distinct words<30%", "cue", "short words", "long words",
            "first line", "last line", "line again"]


def line_features(lines: list[bytes]) -> np.ndarray:
    """0/1 features of the lines with a word of one document, in order."""
    seen: set[bytes] = set()
    rows = []
    for i, line in enumerate(lines):
        words = line.split()
        n, size = len(words), len(line)
        symbols = size - len(line.translate(None, _SYMBOLS))
        marks = size - len(line.translate(None, _OTHER_MARKS))
        digits = size - len(line.translate(None, _DIGITS))
        capitals = size - len(line.translate(None, _CAPITALS))
        equal = sum(map(bytes.__eq__, words, words[1:]))
        distinct = len(set(words)) / n if n >= 8 else 1.0
        mean = size / n
        rows.append((1, n < 4, n < 10, n >= 30, line.rstrip()[-1:] in b".!?:;", symbols > 0.02 * size, symbols > 0.06 * size, marks > 0.05 * size,
                     digits > 0.1 * size, capitals > 0.3 * (size - n), capitals > 0.45 * (size - n), equal > 0.1 * n, equal > 0.5 * n, distinct < 0.6, distinct < 0.3,
                     n < 30 and not CUES.isdisjoint(w.strip(b".,;:").lower() for w in words), mean < 4, mean > 12,
                     i == 0, i == len(lines) - 1, line in seen))
        seen.add(line)
    return np.array(rows, np.float64).reshape(-1, len(FEATURES))


def marked_as_junk(x: np.ndarray) -> np.ndarray:
    """Lines that their own features give away."""
    on = {name: x[:, i] > 0 for i, name in enumerate(FEATURES)}
    return on["symbols>6%"] | on["marks>5%"] | on["capitals>45%"] | on["same neighbours>50%"] | (on["distinct words<30%"] & on["same neighbours>10%"]) | on["cue"]


class ChainField:
    """Two labels: 0 content, 1 boilerplate. ``emit`` (features, 2), ``move`` (2, 2), ``start`` (2)."""

    def __init__(self, emit: np.ndarray, move: np.ndarray, start: np.ndarray):
        self.emit, self.move, self.start = emit, move, start

    def decode(self, x: np.ndarray) -> list[int]:
        """The best label sequence (Viterbi), with ``CAUTION`` for content, which also wins ties."""
        if not len(x):
            return []
        scores = (x @ self.emit + [CAUTION, 0.0]).tolist()
        (m00, m01), (m10, m11) = self.move.tolist()
        a, b = scores[0][0] + float(self.start[0]), scores[0][1] + float(self.start[1])
        back = []
        for e0, e1 in scores[1:]:
            to0, to1 = (1 if b + m10 > a + m00 else 0), (1 if b + m11 > a + m01 else 0)
            a, b = (b + m10 if to0 else a + m00) + e0, (b + m11 if to1 else a + m01) + e1
            back.append((to0, to1))
        label = int(b > a)
        path = [label]
        for pointers in reversed(back):
            label = pointers[label]
            path.append(label)
        return path[::-1]


def fit_field(sequences: list[np.ndarray], labels: list[np.ndarray]) -> ChainField:
    """Maximum conditional likelihood by Adam; all sequences step together through the forward and backward sums."""
    d = len(FEATURES)
    parts = [(x[i:i + SEQUENCE], y[i:i + SEQUENCE]) for x, y in zip(sequences, labels) for i in range(0, len(x), SEQUENCE)]
    if not parts or len(np.unique(np.concatenate([y for _, y in parts]))) < 2:
        emit = np.zeros((d, 2))
        emit[0, 0] = 1.0
        return ChainField(emit, np.zeros((2, 2)), np.zeros(2))
    n, longest = len(parts), max(len(x) for x, _ in parts)
    x, y, real = np.zeros((n, longest, d)), np.zeros((n, longest), int), np.zeros((n, longest), bool)
    for i, (px, py) in enumerate(parts):
        x[i, :len(px)], y[i, :len(py)], real[i, :len(px)] = px, py, True
    one_hot = np.eye(2)[y] * real[..., None]
    pair_real = real[:, 1:]
    seen_move = np.einsum("nta,ntb->ab", one_hot[:, :-1], one_hot[:, 1:])
    theta = np.zeros(2 * d + 6)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)

    def log_sum(a: np.ndarray) -> np.ndarray:
        top = a.max(axis=-2, keepdims=True)
        return (top + np.log(np.exp(a - top).sum(axis=-2, keepdims=True)))[..., 0, :]

    for step in range(1, STEPS + 1):
        emit, move, start = theta[:2 * d].reshape(d, 2), theta[2 * d:2 * d + 4].reshape(2, 2), theta[-2:]
        e = x @ emit
        forward, backward = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        forward[:, 0] = e[:, 0] + start
        for t in range(1, longest):
            forward[:, t] = np.where(real[:, t, None], log_sum(forward[:, t - 1, :, None] + move) + e[:, t], forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            ahead = log_sum(np.swapaxes(move[None] + (e[:, t + 1] + backward[:, t + 1])[:, None, :], 1, 2))
            backward[:, t] = np.where(real[:, t + 1, None], ahead, 0.0)
        total = log_sum(forward[:, -1, :, None])[:, 0]
        p = np.exp(forward + backward - total[:, None, None]) * real[..., None]
        pair = np.exp(forward[:, :-1, :, None] + move + (e + backward)[:, 1:, None, :] - total[:, None, None, None]) * pair_real[..., None, None]
        slope = np.concatenate([np.einsum("ntf,nta->fa", x, one_hot - p).ravel(), (seen_move - pair.sum((0, 1))).ravel(), (one_hot[:, 0] - p[:, 0]).sum(0)])
        slope = slope / real.sum() - DECAY * theta
        mean += 0.1 * (slope - mean)
        square += 0.01 * (slope ** 2 - square)
        theta = theta + RATE * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    return ChainField(theta[:2 * d].reshape(d, 2), theta[2 * d:2 * d + 4].reshape(2, 2), theta[-2:])


def _worded(text: str | None) -> list[bytes]:
    return [x for x in (text or "").encode("utf-8", "replace").split(b"\n") if x.strip()]


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, place, mark, x, lines, short): features (0/1, row by row) and hashes of runs of lines, and which lines are short."""
    for batch in batches:
        for first in range(0, batch.num_rows, 64):
            some = batch.slice(first, 64)
            keys, places, marks, xs, hashes, short = [], [], [], [], [], []
            for key, mark, text in zip(*(some.column(c).to_pylist() for c in ("key", "mark", "text"))):
                lines = _worded(text)
                x = line_features(lines).astype(np.uint8)
                for i in range(0, len(lines), SEQUENCE):
                    part = lines[i:i + SEQUENCE]
                    keys.append(key), places.append(i), marks.append(mark), xs.append(x[i:i + SEQUENCE].tobytes())
                    hashes.append([_signed(xxhash.xxh64_intdigest(line, seed=42)) for line in part])
                    short.append([len(line.split()) < SHORT_LINE for line in part])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(places, pa.int32()), pa.array(marks, pa.int32()), pa.array(xs, pa.binary()),
                                              pa.array(hashes, pa.list_(pa.int64())), pa.array(short, pa.list_(pa.bool_()))],
                                             names=["key", "place", "mark", "x", "lines", "short"])


def _signed(h: int) -> int:
    """As Spark's xxhash64."""
    return h - (1 << 64) if h >= 1 << 63 else h


def _line_hashes(text: str) -> Column:
    return F.transform(F.filter(F.split(F.col(f"`{text}`"), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), lambda x: F.xxhash64(x))


def fit_on_corpus(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", labels: DataFrame | None = None, label: str = "quality",
                  fit_sequences: int = FIT_SEQUENCES, least_contexts: int = LEAST_CONTEXTS) -> ChainField:
    """Labels sampled runs of lines by the documents' marks and by their contexts over all documents, and trains."""
    texts = docs.where(F.col(f"`{text}`").isNotNull()).select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    key = F.xxhash64("id", "text").alias("key")
    marks = None
    if labels is None:
        marked = texts.select(key, F.lit(None).cast("int").alias("mark"), "text")
    else:
        marks = written(labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy(F.col("doc_id").alias("of"))
                        .agg((F.min(label) == 0).cast("int").alias("mark")), "crf-marks")
        n = {r["mark"]: r["n"] for r in marks.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).collect()}  # low and good
        chosen = marks.where(F.lit(False))
        for m, k in sorted(n.items()):
            chosen = chosen.unionByName(hash_sample(marks.where(F.col("mark") == m), F.col("of"), fit_sequences // 2, k))
        # fit_sequences documents at most, so the texts stay where they are
        marked = texts.join(F.broadcast(chosen), F.col("id") == F.col("of")).select(key, "mark", "text")
    runs = written(marked.mapInArrow(_sequences, "key long, place int, mark int, x binary, lines array<long>, short array<boolean>").distinct(), "crf-runs")
    n = {r["mark"]: r["n"] for r in runs.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).collect()}  # low, good, or neither
    spread = F.xxhash64("key", "place")
    parts = [hash_sample(runs.where(F.col("mark").eqNullSafe(F.lit(m).cast("int"))), spread, fit_sequences // len(n), k).collect() for m, k in sorted(n.items(), key=str)]
    sample = sorted((r for part in parts for r in part), key=lambda r: (r["key"], r["place"], r["x"]))
    if not sample:
        return fit_field([], [])
    spark = docs.sparkSession
    hashed = lambda of: spark.createDataFrame([(h,) for h in sorted(of)], "h long")
    # Lines of the sample: the broadcast sides are bounded by it.
    wanted = {h for r in sample for h, s in zip(r["lines"], r["short"]) if s}
    placed = F.transform("a", lambda h, i: F.struct(h.alias("h"), F.xxhash64(F.when(i > 0, F.get("a", i - 1)), F.get("a", i + 1)).alias("context")))
    standing = docs.select(_line_hashes(text).alias("a")).select(F.inline(placed))
    contexts = (standing.join(F.broadcast(hashed(wanted)), "h", "left_semi").distinct()
                .groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_contexts))
    common = {r["h"] for r in contexts.select("h").toLocalIterator()}
    low = {h for r in sample if r["mark"] == 1 for h in r["lines"]}
    if marks is not None:  # whole corpus, as hashes
        same = docs.select(F.col(f"`{doc_id}`").alias("id"), F.explode(_line_hashes(text)).alias("h")).join(F.broadcast(hashed(low)), "h", "left_semi").distinct()
        also_good = same.join(marks.where("mark = 0"), F.col("id") == F.col("of")).select("h").distinct()
    else:
        also_good = hashed(set())
    good = {r["h"] for r in also_good.toLocalIterator()}
    features = [np.frombuffer(r["x"], np.uint8).reshape(-1, len(FEATURES)).astype(float) for r in sample]

    def line_labels(r, x: np.ndarray) -> np.ndarray:
        own = marked_as_junk(x) if r["mark"] is None else np.array([r["mark"] == 1 and h not in good for h in r["lines"]], bool)
        return (own | np.array([s and h in common for h, s in zip(r["lines"], r["short"])], bool)).astype(int)

    return fit_field(features, [line_labels(r, x) for r, x in zip(sample, features)])


def judge(docs: DataFrame, field: ChainField, text: str = "text", keep_share: float = KEEP_SHARE, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the base counts, base_failed, labels (a letter a line: c or b), content_share and kept."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    docs = without(docs, *names, "base_failed", "labels", "content_share", "kept")
    kept = [c for c in docs.columns if keep is None or c in keep]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select([F.col(f"`{c}`") for c in kept]).schema]
    schema = ", ".join([*fields, *(f"{n} long" for n in names), "base_failed boolean", "labels string", "content_share double", "kept boolean"])
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 256):
                batch = whole.slice(first, 256)
                rows = []
                for value in batch.column(text).to_pylist():
                    counts = base_counts(value or "")
                    failed = counts[0] < LEAST_WORDS or 100 * counts[4] > MOST_REPEATED * counts[0]
                    lines = _worded(value)
                    path = sent.value.decode(line_features(lines))
                    content = sum(len(x.split()) for x, label in zip(lines, path) if label == 0)
                    share = content / counts[0] if counts[0] else 0.0
                    rows.append((*counts, failed, "".join("cb"[p] for p in path), share, not failed and share >= keep_share))
                columns = list(zip(*rows))
                types = [pa.int64()] * 5 + [pa.bool_(), pa.string(), pa.float64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array(c, t) for c, t in zip(columns, types))],
                                                 names=[*kept, *names, "base_failed", "labels", "content_share", "kept"])

    return docs.mapInArrow(run, schema)


def op7_crf_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    field = fit_on_corpus(docs, labels=table(spark, sf_dir, "labels"))
    return judge(docs, field, keep=["doc_id"]).drop("labels")
