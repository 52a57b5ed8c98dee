r"""Personal data: pattern spans, and information-theoretic sanitisation around them.

Base kinds, leftmost and non-overlapping per kind, offsets in code points:

* email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+``
* ip ``[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)``, parts at most 255
* card ``[0-9]([\x20-]?[0-9])+``, 12 to 19 digits passing Luhn
* phone ``\+[0-9][\x20().0-9-]+[0-9]``, 9 to 15 digits

A match that fails its check is dropped and not tried again from within.

The values found are the protected entities. A term (a word outside the spans,
without outer punctuation, lower case) reveals an entity as far as knowing the
term makes the entity likely. Over all N documents, with n(e), n(t) and n(e, t)
the documents that hold the entity, that hold the term, and that hold both,
wherever they stand:

    information of the entity   IC(e)     = log2(N / n(e))
    given away by the term      PMI(e, t) = log2(N n(e, t) / (n(e) n(t)))
    disclosure                  PMI(e, t) / IC(e),  at most 1

In every document that holds the entity, a term whose disclosure reaches
``remove_at`` is removed wherever it stands, one that reaches ``generalise_at``
is replaced by its general form (a number, a name, a word). A pair must be seen
in at least ``least_contexts`` *different* contexts, so copies of one text prove
nothing. The context of a mention is the ``NEAR`` words on either side. What
counts is the contexts near which the term stands, or, of the documents that
hold both, one context each (the one with the smallest hash). Documents without
a protected entity are never changed.

Counts run over all documents. Pairs are counted only for entities seen in
enough contexts; the tables of mentions, terms and pairs are joined and
aggregated by Spark, nothing of them reaches the driver but three counts. The
word joins broadcast the candidate terms and the disclosing pairs when they are
few (checked).

Defined results: null text has no spans; a term inside a base span is no term;
repeated rows are documents of their own; null ids are kept; an empty table
gives an empty result. Time is linear in the text for every pattern. A term has 3
to 64 characters: shorter words are too common and longer runs (keys, encoded
data, addresses of pages) no words; neither is ever removed. Ties need no rule:
every pair that reaches a threshold counts. Input columns may have any names; those
that the output uses are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tavolo.llm.shared import table, without, written

KINDS = ("email", "ip", "card", "phone", "generalised", "removed")
#: Words on either side of a mention that are its context.
NEAR = 8
#: Characters on either side in which they are looked for.
REACH = 40 * NEAR
GENERALISE_AT, REMOVE_AT, LEAST_CONTEXTS = 0.9, 0.97, 3
#: Candidate terms or disclosing pairs up to this number are broadcast to the words (terms have at most LONGEST_TERM characters).
SMALL_TERMS, LONGEST_TERM = 100_000, 64

_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_TRIM = ".,;:!?\"'()[]{}<>"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The run of local characters before each ``@``, taken from the end of the last match on."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _NOT_LOCAL.match(text, start - 1) is None:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        else:
            done = at + 1  # nothing can start before this sign and reach over it
        at = text.find("@", max(done, at + 1))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) in order of start, then kind; the value is normalised."""
    spans = [(a, 0, b, text[a:b].lower()) for a, b in emails(text)]
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") for p in m[0].split(".")]
            if all(len(p) < 4 and int(p or 0) <= 255 for p in parts):
                spans.append((m.start(), 1, m.end(), ".".join(p or "0" for p in parts)))
        for m in _CARD.finditer(text):
            digits = re.sub(r"[\x20-]", "", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), 2, m.end(), digits))
        if "+" in text:
            for m in _PHONE.finditer(text):
                digits = re.sub(r"[^0-9]", "", m[0])
                if 9 <= len(digits) <= 15:
                    spans.append((m.start(), 3, m.end(), digits))
    return sorted(spans)


def mentions(text: str, spans: list[tuple[int, int, int, str]]) -> list[dict]:
    """For each base span its entity, a hash of its context, and the terms near it with their places."""
    found = []
    covered = bytearray(len(text) if spans else 0)
    for start, _, end, _ in spans:
        covered[start:end] = b"\1" * (end - start)
    for start, kind, end, value in spans:
        words, at, near = [], start, 0
        left = text[max(0, start - REACH):start]
        before = [m for m in _WORD.finditer(left) if m.start() or len(left) == start][-NEAR:]  # a word cut by the window is none
        shift = start - len(left)
        right = text[end:end + REACH]
        after = [m for m in _WORD.finditer(right) if m.end() < REACH][:NEAR]
        terms = []
        for m, offset in [(m, shift) for m in before] + [(m, end) for m in after]:
            a, b = m.start() + offset, m.end() + offset
            term = m[0].lstrip(_TRIM)
            a += len(m[0]) - len(term)
            term = term.rstrip(_TRIM)
            b = a + len(term)
            words.append(term)
            if 3 <= len(term) <= LONGEST_TERM and 1 not in covered[a:b]:
                terms.append({"term": term.lower(), "start": a, "end": b})
        found.append({"entity": f"{KINDS[kind]}:{value}", "context": xxhash.xxh64_intdigest(" ".join(words)) - (1 << 63), "terms": terms})
    return found


def terms_of(text: str, spans: list[tuple[int, int]]) -> Iterator[tuple[str, int, int]]:
    """(term, start, end) of the words between the spans (start, end), which are in order of start."""
    done = 0
    for first, last in [*spans, (len(text), len(text))]:
        for m in _WORD.finditer(text, done, max(done, first)):
            term = m[0].lstrip(_TRIM)
            a = m.end() - len(term)
            term = term.rstrip(_TRIM)
            if 3 <= len(term) <= LONGEST_TERM:
                yield term.lower(), a, a + len(term)
        done = max(done, last)


_MENTIONS = "array<struct<entity: string, context: long, terms: array<struct<term: string, start: int, end: int>>>>"
_ARROW_MENTIONS = pa.list_(pa.struct([("entity", pa.string()), ("context", pa.int64()), ("terms", pa.list_(pa.struct(
    [("term", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))]))
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))


def _span_batches(text: str, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 512):
                batch = whole.slice(first, 512)
                texts = [t or "" for t in batch.column(text).to_pylist()]
                spans = [base_spans(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in kept),
                     pa.array([[{"start": a, "kind": k, "end": b} for a, k, b, _ in s] for s in spans], _ARROW_SPANS),
                     pa.array([mentions(t, s) for t, s in zip(texts, spans)], _ARROW_MENTIONS),
                     pa.array([t if s else None for t, s in zip(texts, spans)], pa.string())], names=[*kept, "__base", "__mentions", "__held"])

    return run


def _term_batches(places: bool):
    """Of each row of (__row, of, __held, __base) its different terms, or with ``places`` a row per word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 256):
                some = whole.slice(first, 256)
                found = ([(i, *t) for t in terms_of(text, [(s["start"], s["end"]) for s in base])]
                         for i, (text, base) in enumerate(zip(some.column(2).to_pylist(), some.column(3).to_pylist())))
                if not places:
                    yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array([sorted({t for _, t, _, _ in f}) for f in found], pa.list_(pa.string()))],
                                                     names=["__row", "of", "terms"])
                    continue
                held: list[tuple] = []
                for terms in found:
                    held += terms
                    while len(held) >= 4096:
                        yield _places(some, held[:4096])
                        held = held[4096:]
                yield _places(some, held)

    return run


def _places(rows: pa.RecordBatch, words: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([rows.column(0).take(pa.array([i for i, *_ in words], pa.int32())), pa.array([t for _, t, _, _ in words], pa.string()),
                                       pa.array([a for _, _, a, _ in words], pa.int32()), pa.array([b for *_, b in words], pa.int32())],
                                      names=["__row", "term", "start", "end"])


def disclosing_terms(docs: DataFrame, text: str, found: DataFrame, held: DataFrame, near: DataFrame, n_docs: int, generalise_at: float, remove_at: float, least_contexts: int) -> DataFrame:
    """(entity, term, kind) of the pairs that disclose too much; ``held`` has a row per entity of a document, ``near`` per term near a mention."""
    close = (near.groupBy("entity", "term", "context").agg(F.min("__row").alias("a"), F.max("__row").alias("b"))
             .groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_close")).where(F.col("n_close") >= least_contexts))
    close = written(close, "pii-close")
    n = F.lit(float(max(n_docs, 1)))
    of_entity = held.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    often = held.select("entity", "context").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_contexts)
    # A pair reaches the threshold only if the term stands in few enough documents: n(t) <= n(e, t) (N / n(e)) ^ (1 - threshold), n(e, t) <= n(e).
    possible = written(often.select("entity").union(close.select("entity")).distinct().join(of_entity, "entity")
                       .withColumn("limit", F.col("n_e") * F.pow(n / F.col("n_e"), F.lit(1 - generalise_at)) * (1 + 1e-9)), "pii-possible")
    highest = possible.agg(F.max("limit")).first()[0] or 0.0
    of_row = held.join(possible.select("entity", "limit"), "entity").groupBy("__row").agg(F.collect_list(F.struct("entity", "context", "limit")).alias("of"))
    together = written(found.select("__row", "__held", "__base").join(of_row, "__row").select("__row", "of", "__held", "__base").mapInArrow(
        _term_batches(False), "__row long, of array<struct<entity: string, context: long, limit: double>>, terms array<string>"), "pii-together")
    # Terms go before they meet the entities of their documents: the rare ones prove nothing, the common ones give nothing away.
    around = written(together.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_near"))
                     .where((F.col("n_near") >= least_contexts) & (F.col("n_near") <= highest)), "pii-around")
    able = F.broadcast(around) if around.count() <= SMALL_TERMS else around
    both = (together.select("of", F.explode("terms").alias("term")).join(able, "term").select("term", "n_near", F.explode("of").alias("o"))
            .where(F.col("n_near") <= F.col("o.limit")).select("o.entity", "o.context", "term")
            .groupBy("entity", "term", "context").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("entity", "term").agg(F.count(F.lit(1)).alias("contexts"), F.sum("n").alias("n_et"))
            .join(close, ["entity", "term"], "left").where((F.col("contexts") >= least_contexts) | F.col("n_close").isNotNull()))

    def disclosure(holding: str) -> Column:
        information = F.log2(n / F.col("n_e"))
        return F.when(information > 0, F.log2(n * F.col("n_et") / (F.col("n_e") * F.col(holding))) / information).otherwise(F.lit(0.0))

    # At least the documents that hold the term and an entity hold it: pairs that cannot reach the threshold go before the count.
    pairs = written(both.join(of_entity, "entity").join(around, "term").where(disclosure("n_near") >= generalise_at), "pii-pairs")
    terms = written(pairs.select("term").distinct(), "pii-terms")
    words = docs.select(F.explode(F.array_distinct(F.transform(
        F.split(F.lower(F.col(text)), r"[\x20\x09-\x0D]+"), lambda w: F.btrim(w, F.lit(_TRIM))))).alias("term"))
    side = F.broadcast(terms) if terms.count() <= SMALL_TERMS else terms
    of_term = words.join(side, "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("n_all"))
    return (pairs.join(of_term, "term").withColumn("n_t", F.greatest("n_all", "n_near"))
            .withColumn("disclosure", disclosure("n_t")).where(F.col("disclosure") >= generalise_at)
            .select("entity", "term", F.when(F.col("disclosure") >= remove_at, KINDS.index("removed")).otherwise(KINDS.index("generalised")).alias("kind")))


def find_personal_data(docs: DataFrame, text: str = "text", generalise_at: float = GENERALISE_AT, remove_at: float = REMOVE_AT,
                       least_contexts: int = LEAST_CONTEXTS, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with base_spans and all_spans, arrays of (start, kind, end) in order; kind indexes ``KINDS``."""
    docs = without(docs, "base_spans", "all_spans")
    kept = [c for c in docs.columns if keep is None or c in keep]
    rows = docs.withColumn("__row", F.monotonically_increasing_id())
    carried = [*kept, "__row"]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select([F.col(f"`{c}`") for c in carried]).schema]
    schema = ", ".join([*fields, "__base array<struct<start: int, kind: int, end: int>>", f"__mentions {_MENTIONS}", "__held string"])
    found = written(rows.mapInArrow(_span_batches(text, carried), schema), "pii-spans")
    mention = found.where(F.size("__mentions") > 0).select("__row", F.explode("__mentions").alias("m"))
    near = mention.select("__row", "m.entity", "m.context", F.explode("m.terms").alias("t")).select(
        "__row", "entity", "context", F.col("t.term").alias("term"))
    held = written(mention.groupBy("__row", "m.entity").agg(F.min("m.context").alias("context")), "pii-held")
    disclosing = written(disclosing_terms(docs, text, found, held, near, found.count(), generalise_at, remove_at, least_contexts), "pii-disclosing")
    few = disclosing.count() <= SMALL_TERMS
    side, terms = [F.broadcast(x) if few else x for x in (disclosing, disclosing.select("term").distinct())]
    of_row = held.join(disclosing.select("entity").distinct(), "entity", "left_semi").groupBy("__row").agg(F.collect_list("entity").alias("of"))
    words = (found.select("__row", "__held", "__base").join(of_row, "__row").select("__row", "of", "__held", "__base")
             .mapInArrow(_term_batches(True), "__row long, term string, start int, end int").join(terms, "term", "left_semi")
             .join(of_row, "__row").select("__row", "term", "start", "end", F.explode("of").alias("entity")))
    spans = (words.join(side, ["entity", "term"]).groupBy("__row", "start", "end").agg(F.max("kind").cast("int").alias("kind"))
             .groupBy("__row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("__more")))
    return (found.join(spans, "__row", "left")
            .withColumn("all_spans", F.array_sort(F.concat("__base", F.coalesce("__more", F.expr("cast(array() as array<struct<start: int, kind: int, end: int>>)")))))
            .withColumnRenamed("__base", "base_spans").select([*(F.col(f"`{c}`") for c in kept), "base_spans", "all_spans"]))


def general_form(term: str) -> str:
    return "<number>" if any(c.isdigit() for c in term) else "<name>" if term[:1].isupper() else "<word>"


def sanitised(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    """``text`` with base spans named by kind, terms generalised or removed. Overlapping spans: the first one stands."""
    if text is None:
        return None
    out, done = [], 0
    for start, kind, end in sorted(spans):
        if start < done:
            continue
        name = KINDS[kind]
        out += [text[done:start], general_form(text[start:end]) if name == "generalised" else "" if name == "removed" else f"<{name}>"]
        done = end
    return "".join([*out, text[done:]])


def sanitise(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with base_spans, all_spans and the sanitised text in place of ``text``."""
    found = find_personal_data(docs, text, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [sanitised(t, [(s["start"], s["kind"], s["end"]) for s in spans])
                     for t, spans in zip(batch.column(text).to_pylist(), batch.column("all_spans").to_pylist())]
            yield batch.set_column(batch.schema.get_field_index(text), text, pa.array(clean, batch.schema.field(text).type))

    return found.mapInArrow(run, found.schema)


def _joined(spans: str):
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op6_pii_disclosure(spark, sf_dir):
    found = find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])

    def number(kind: int):
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    counts = [number(k) for k in range(4)]
    return found.select("doc_id", *counts, F.sha2(_joined("base_spans"), 256).alias("base_sha256"), _joined("all_spans").alias("spans"))
