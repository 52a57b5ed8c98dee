"""Mixing: targets by repeated resharing, balanced draws."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from tavolo.llm import mixing as M


def _targets(sizes):
    """Shares by weight; what lies above twice a source's size goes to the others by weight, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: M.WEIGHTS[i % 3] for i, s in enumerate(order)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(2 * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] > 2 * sizes[s]}
        if not above:
            return {s: 2 * sizes[s] if s in capped else share[s] for s in order}
        capped |= above


def test_targets(spark):
    rng = random.Random(3)
    for n in (1, 2, 5, 12):
        sizes = {f"s{i}": rng.choice([0, 1, 10, 1000, 50_000]) for i in range(n)} | {None: 70}
        units = spark.createDataFrame([(s, v) for s, v in sizes.items()], "source string, size long")
        got = {r["source"]: r["target"] for r in M.source_targets(units).collect()}
        want = _targets(sizes)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in want), (got, want)


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(1)
    for _ in range(50):
        n = int(rng.integers(1, 300))
        p, size = rng.random(n), rng.integers(0, 500, n)
        x = M.flight(p, size, rng)
        open_ = (x > 0) & (x < 1)
        assert open_.sum() <= 2 and abs(x.sum() - p.sum()) < 1e-6 and abs(x @ size - p @ size) < 1e-3
        y = M.fly_and_land(p, size, rng)
        assert set(y) <= {0.0, 1.0}


def test_inclusion_is_fair():
    rng = np.random.default_rng(2)
    size = np.array([1, 5, 5, 9, 100, 3, 3, 3, 50, 2])
    p = np.full(10, 0.4)
    mean = np.mean([(M.flight(p, size, rng)) for _ in range(4000)], axis=0)
    assert np.abs(mean - 0.4).max() < 0.03


def _words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_query_balances_every_source(spark):
    sf = "/root/testdata/sf0.01"
    rows = M.op10_source_mixing(spark, sf).collect()
    assert sorted(map(str, rows)) == sorted(map(str, M.op10_source_mixing(spark, sf).collect()))
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()}
    sizes, taken, target = {}, {}, {}
    for r in rows:
        s = docs[r["doc_id"]]["source"]
        assert r["size"] == _words(docs[r["doc_id"]]["text"]) and 0 <= r["taken"] <= 2 * r["size"]
        sizes[s], taken[s], target[s] = sizes.get(s, 0) + r["size"], taken.get(s, 0) + r["taken"], r["target"]
    want = _targets(sizes)
    assert len(rows) == len(docs)
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-3 and abs(taken[s] - target[s]) <= 0.005 * sizes[s]


def test_several_rounds(spark):
    units = (spark.range(6000).select(F.when(F.col("id") % 3 > 0, "big").alias("source"), (F.col("id") * 37 % 101).alias("size"),
                                      F.xxhash64("id").alias("__key"), F.col("id").alias("doc_id")))
    got = M.cube_copies(units, block=16).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g"), F.count("*").alias("n")).collect()
    assert sum(r["n"] for r in got) == 6000 and all(abs(r["t"] - r["g"]) < 60 for r in got)


def test_messy_rows(spark, messy, clashing, nothing):
    mixed = M.mix_documents(clashing)
    assert mixed.columns == clashing.columns
    times = {}
    for r in mixed.collect():
        times[(r["doc_id"], r["text"])] = times.get((r["doc_id"], r["text"]), 0) + 1
    given = {}
    for r in messy.collect():
        given[(r["doc_id"], r["text"])] = given.get((r["doc_id"], r["text"]), 0) + 1
    assert times.keys() <= given.keys() and all(n <= 2 * given[k] for k, n in times.items())
    assert M.mix_documents(nothing).count() == 0
    wordless = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert M.mix_documents(wordless).count() == 0


def test_equal_rows_spread_over_the_blocks(spark):
    units = (spark.range(20_000).select(F.lit("a").alias("source"), F.lit(7).cast("long").alias("size"), F.lit(5).cast("long").alias("__key"), F.col("id"))
             .unionByName(spark.range(300).select(F.lit("b").alias("source"), F.col("id").alias("size"), F.xxhash64("id").alias("__key"), F.col("id")))).repartition(5)
    got = M.numbered(units)
    assert got.count() == 20_300 and got.select("__key").distinct().count() == 20_300
    blocks = got.where("source = 'a'").groupBy(F.pmod(F.xxhash64("__key", F.lit(0)), F.lit(20))).count()
    assert blocks.agg(F.max("count")).first()[0] < 1300
    # The same keys whatever the partitions.
    keys = lambda df: sorted(r[0] for r in M.numbered(df).select("__key").collect())
    assert keys(units) == keys(units.repartition(3))


def test_names_of_helper_columns(spark):
    names = ("copies", "row", "doc", "copy", "size", "target", "taken", "__row", "__copy", "__key", "source_size", "a.b")
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words "), "id").alias("text"), F.lit("s").alias("source"),
                                  *[F.lit(3).alias(c) for c in names])
    got = M.mix_documents(docs)
    assert got.columns == docs.columns and 70 <= got.count() <= 80
    assert got.where("copies = 3 and row = 3 and doc = 3 and `a.b` = 3").count() == got.count()
