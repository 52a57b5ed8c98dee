r"""Source divergence audit: a frequent-pattern tree of term rows.

For every language, how far do its sources differ from each other, and in which
terms from the language as a whole? A term is a run of ASCII letters and
characters beyond ASCII, with A-Z lower-cased; a language keeps the terms of at
least ``MIN_DOCS`` of its documents, V of them. A (lang, source) group gives
each kept term p = 1 + floor(UNIT * (count + 1) / (N + V)), N its occurrences
of kept terms; so does the whole language. The divergence of p from q is
floor((p - q)^2 / q), summed over the kept terms for a pair of sources.

Summed plainly, that is every term for every pair of sources. Most counts are 0,
and a zero count gives the same p in all terms of a group. So the sum starts as V
times the divergence of the two zero values, and each term corrects it: once for each
source that has the term, against every other source's zero value, and once more
for each two sources that both have it. The latter go through a frequent-pattern
tree: a term's row is its (source, count) items, ordered by source; equal rows are
one with a multiplicity; rows sorted by their items lay out the tree,
where rows with the same beginning share a path. A node stands for a source
with a count in as many terms as its multiplicity says, and its ancestors are
the sources before it that have those terms. Each node corrects the pair with each ancestor
once, whatever the number of terms that share the path.

Terms are counted in bounded tables in the tasks before they are shuffled, so a
very common word is one row a table and source. Rows are dealt by ranges of
their items; a range's tree is laid out in slices of bounded size, and a path cut at
the border of a slice is corrected in both with its share of the multiplicity. Only N
and V of the groups are sent to the tasks: that is the square root of the
result, which has a row for every two sources of a language.

Defined results: null text, lang and source are empty strings; every occurring
(lang, source) has its pairs, also without terms (with V = 0 all values are 0);
repeated rows are documents of their own; ties rank by item in UTF-8
order; a language with one source has no pairs; an empty table gives an empty result.
Other columns are not read. Texts are counted in slices, however long.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tavolo.llm.shared import table, written

#: Documents of a language that a kept term occurs in, at least.
MIN_DOCS = 3
#: A share of 1 in fixed point.
UNIT = 1_000_000_000
#: Terms listed for each group.
TOP_TERMS = 200

TERM = re.compile(rb"[a-z\x80-\xff]+")
BREAK = re.compile(rb"[^a-z\x80-\xff]")
#: Bytes of text that are cut into terms at once; different terms held before they are sent on.
SLICE_BYTES, HELD_TERMS = 1 << 20, 200_000
#: Items (row places) of a slice of the tree.
TREE_CELLS = 1 << 18


# ---------------------------------------------------------------- counting

def _slices(text: bytes) -> Iterator[bytes]:
    start = 0
    while start < len(text):
        cut = BREAK.search(text, start + SLICE_BYTES) if len(text) - start > SLICE_BYTES else None
        end = cut.start() if cut else len(text)
        yield text[start:end]
        start = end


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple, tuple[Counter, Counter]] = {}

    def sent() -> pa.RecordBatch:
        terms, n, having = [], [], []
        for count, docs in held.values():
            terms += count
            n += count.values()
            having += map(docs.__getitem__, count)
        of = pa.array(np.repeat(np.arange(len(held)), [len(count) for count, _ in held.values()]))
        groups = [pa.array([k[i] for k in held], pa.string()).take(of) for i in range(2)]
        held.clear()
        return pa.RecordBatch.from_arrays([*groups, pa.array(terms, pa.binary()), pa.array(n, pa.int64()), pa.array(having, pa.int64())],
                                          names=["lang", "source", "term", "n", "docs"])

    n_held = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(c) for c in ("lang", "source", "text"))):
            count, docs = held.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
            before, seen = len(count), set()
            for piece in _slices(text.as_py().lower()):  # bytes: only A-Z change
                terms = TERM.findall(piece)
                count.update(terms)
                seen.update(terms)
            docs.update(seen)
            n_held += len(count) - before
            if n_held >= HELD_TERMS:
                yield sent()
                n_held = 0
    yield sent()


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that have the term."""
    named = docs.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"))],
                        F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"))
    counted = named.mapInArrow(_count_terms, "lang string, source string, term binary, n long, docs long")
    return (counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
            .withColumn("term", F.col("term").cast("string")))


def kept_terms(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, items, total): items are (source, n), by source; one for each source at most."""
    return (counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"),
                                               F.array_sort(F.collect_list(F.struct("source", "n"))).alias("items"))
            .where(F.col("docs") >= min_docs).drop("docs"))


def _share(n: str, total: str, v: str) -> Column:
    return F.expr(f"1 + (cast({UNIT} as decimal(38,0)) * ({n} + 1)) div ({total} + {v})")


def _divergence(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


# ---------------------------------------------------------------- the tree

class Groups:
    """N, V and the zero value of each language's sources; sources are numbered in order."""

    def __init__(self, rows: list):
        self.names: dict[str, list[str]] = {}
        self.number: dict[str, dict[str, int]] = {}
        self.total: dict[str, np.ndarray] = {}
        for r in sorted(rows, key=lambda r: (r["lang"], r["source"].encode())):
            self.names.setdefault(r["lang"], []).append(r["source"])
            self.total.setdefault(r["lang"], []).append(int(r["total"]) + int(r["v"]))
        for lang, names in self.names.items():
            self.number[lang] = {s: i for i, s in enumerate(names)}
            self.total[lang] = np.array(self.total[lang], dtype=object)

    def share(self, lang: str, sources: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """p of each count; exact, as the products are unbounded integers where 64 bits might not do."""
        total = self.total[lang][sources]
        if counts.max(initial=0) < 1 << 32:
            return 1 + UNIT * (counts + 1) // total.astype(np.int64)
        return (1 + UNIT * (counts.astype(object) + 1) // total).astype(np.int64)


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


class Sums:
    """Exact sums by pair of sources."""

    def __init__(self, n: int):
        self.n, self.of = n, Counter()

    def add(self, a: np.ndarray, b: np.ndarray, value: np.ndarray, times: np.ndarray) -> None:
        pair, at = np.unique(a * self.n + b, return_inverse=True)
        wide = float(np.abs(value).max(initial=0)) * float(times.sum()) >= 2.0 ** 62
        total = np.zeros(len(pair), object if wide else np.int64)
        np.add.at(total, at, (value.astype(object) if wide else value) * times)
        for k, t in zip(pair.tolist(), total.tolist()):
            self.of[k] += t


def tree_corrections(lang: str, groups: Groups, source: np.ndarray, count: np.ndarray, length: np.ndarray, times: np.ndarray) -> Counter:
    """Corrections by pair (a * number of sources + b) of the tree of some sorted rows.

    ``source`` and ``count`` are rows x places, -1 beyond a row's ``length``.
    """
    n = len(groups.names[lang])
    every = np.arange(n)
    zero = groups.share(lang, every, np.zeros(n, np.int64))
    sums, single = Sums(n), Counter()
    # Places that a row shares with the row before: there the path goes on, behind them nodes begin.
    same = (source[1:] == source[:-1]) & (count[1:] == count[:-1]) & (source[1:] >= 0)
    shared = np.concatenate([[0], np.cumprod(same, axis=1).sum(1)]) if len(source) else np.zeros(0, int)
    share = np.zeros(source.shape, np.int64)
    inside = source >= 0
    share[inside] = groups.share(lang, source[inside], count[inside])
    for depth in range(source.shape[1]):
        rows = np.flatnonzero(length > depth)
        if not len(rows):
            break
        begins = shared[rows] <= depth
        begins[0] = True
        node = np.cumsum(begins) - 1
        first = rows[begins]
        multiplicity = np.zeros(len(first), np.int64)
        np.add.at(multiplicity, node, times[rows])
        own, p = source[first, depth], share[first, depth]
        for s, c, m in zip(own.tolist(), p.tolist(), multiplicity.tolist()):
            single[s, c] += m
        if depth:
            b, pb = np.repeat(own, depth), np.repeat(p, depth)
            a, pa_ = source[first, :depth].ravel(), share[first, :depth].ravel()
            za, zb, m = zero[a], zero[b], np.repeat(multiplicity, depth)
            sums.add(a, b, _f(pa_, pb) - _f(pa_, zb) - _f(za, pb) + _f(za, zb), m)
            sums.add(b, a, _f(pb, pa_) - _f(pb, za) - _f(zb, pa_) + _f(zb, za), m)
    for (s, p), m in single.items():
        others, times_ = np.full(n, s), np.full(n, m)
        value = np.full(n, p)
        sums.add(others, every, _f(value, zero) - _f(zero[s], zero), times_)
        sums.add(every, others, _f(zero, value) - _f(zero, zero[s]), times_)
    return sums.of


def _corrections(groups, tree_cells: int):
    def laid_out(lang: str, rows: list) -> pa.RecordBatch:
        known = groups.value
        number, width = known.number[lang], max(len(items) for items, _ in rows)
        source, count = np.full((len(rows), width), -1), np.zeros((len(rows), width), np.int64)
        for i, (items, _) in enumerate(rows):
            source[i, :len(items)] = [number[x["source"]] for x in items]
            count[i, :len(items)] = [x["n"] for x in items]
        found = tree_corrections(lang, known, source, count, np.array([len(items) for items, _ in rows]), np.array([m for _, m in rows]))
        names, n = known.names[lang], len(known.names[lang])
        pairs = [(names[k // n], names[k % n], str(v)) for k, v in found.items() if k // n != k % n]
        columns = list(zip(*pairs)) or [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(pairs), pa.string()), *(pa.array(c, pa.string()) for c in columns)],
                                          names=["lang", "source", "item", "value"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, rows, width = None, [], 0
        for batch in batches:
            for at, items, times in zip(*(batch.column(c).to_pylist() for c in ("lang", "items", "times"))):
                # The widest row makes the whole slice as wide.
                width = max(width, len(items))
                if rows and (at != lang or (len(rows) + 1) * width > tree_cells):
                    yield laid_out(lang, rows)
                    rows, width = [], len(items)
                lang = at
                rows.append((items, times))
        if rows:
            yield laid_out(lang, rows)

    return run


# ---------------------------------------------------------------- the audit

def divergences(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS,
                top_terms: int = TOP_TERMS, tree_cells: int = TREE_CELLS) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` for each other source, part ``term`` for the terms above the language's share."""
    spark = docs.sparkSession
    terms = written(kept_terms(term_counts(docs, lang, source, text), min_docs), "audit-terms")
    v = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_total"))
    found = (terms.select("lang", F.explode("items").alias("i")).groupBy("lang", F.col("i.source").alias("source")).agg(F.sum("i.n").alias("total")))
    all_groups = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit("")).alias("lang"), F.coalesce(F.col(f"`{source}`"), F.lit("")).alias("source")).distinct()
    groups = written(all_groups.join(found, ["lang", "source"], "left").join(v, "lang", "left")
                     .select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "v", "lang_total")]), "audit-groups")

    # Pairs: the zero values, then the corrections of the tree.
    known = spark.sparkContext.broadcast(Groups(groups.where("v > 0").collect()))
    rows = written(terms.groupBy("lang", "items").agg(F.count(F.lit(1)).alias("times")), "audit-rows")
    sorted_rows = rows.repartitionByRange("lang", "items").sortWithinPartitions("lang", "items")
    corrections = (sorted_rows.mapInArrow(_corrections(known, tree_cells), "lang string, source string, item string, value string")
                   .groupBy("lang", "source", "item").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("corrected")))
    zero = groups.select("lang", "source", "v", F.when(F.col("v") > 0, _share("0", "total", "v")).alias("p"))
    other = zero.select(F.col("lang").alias("lang_"), F.col("source").alias("item"), F.col("p").alias("q"))
    pairs = (zero.join(other, (F.col("lang") == F.col("lang_")) & (F.col("source") != F.col("item"))).drop("lang_")
             .join(corrections, ["lang", "source", "item"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item",
                     (F.coalesce(F.col("v") * _divergence("p", "q").cast("decimal(38,0)"), F.lit(0)) + F.coalesce("corrected", F.lit(0))).cast("long").alias("value")))

    # Terms: each group's against the language's.
    shares = (terms.select("lang", "term", "total", F.explode("items").alias("i"))
              .select("lang", F.col("i.source").alias("source"), "term", F.col("i.n").alias("n"), F.col("total").alias("of_lang"))
              .join(groups, ["lang", "source"])
              .select("lang", "source", "term", _share("n", "total", "v").alias("p"), _share("of_lang", "lang_total", "v").alias("q")))
    above = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _divergence("p", "q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    return ranked(pairs).unionByName(ranked(above).where(F.col("rank") <= top_terms))


def op12_source_divergence(spark, sf_dir):
    return divergences(table(spark, sf_dir, "documents").select("text", "lang", "source"))


#: Every kept term for every two groups, by the definition: no tree, no zero values.
ORACLE = {"op12_source_divergence": rf"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (
  SELECT doc, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
kept AS (
  SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT doc) >= {MIN_DOCS}),
langs AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
grp AS (
  SELECT DISTINCT lang, source FROM d),
cnt AS (
  SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN kept k ON t.lang = k.lang AND t.term = k.term GROUP BY t.lang, t.source, t.term),
tot AS (
  SELECT lang, source, sum(n) AS total FROM cnt GROUP BY lang, source),
share AS (
  SELECT k.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         CAST(1 + CAST({UNIT} AS HUGEINT) * (coalesce(c.n, 0) + 1) // (coalesce(s.total, 0) + l.v) AS HUGEINT) AS p,
         CAST(1 + CAST({UNIT} AS HUGEINT) * (k.n + 1) // (l.total + l.v) AS HUGEINT) AS q
  FROM kept k JOIN langs l ON k.lang = l.lang JOIN grp g ON k.lang = g.lang
  LEFT JOIN tot s ON g.lang = s.lang AND g.source = s.source
  LEFT JOIN cnt c ON g.lang = c.lang AND g.source = c.source AND k.term = c.term),
pair AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
all_parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(p.value, 0) AS BIGINT) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair p ON a.lang = p.lang AND a.source = p.source AND b.source = p.item
  UNION ALL
  SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM share WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM all_parts)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}"""}
