"""Vector codes by Orchard's search against a brute-force search over all entries."""

import hashlib
import math
import random

import numpy as np

from tavolo.llm import codes as C

SF = "/root/testdata/sf0.001"


def _brute(rows, parts=4, entries=256, rounds=4):
    """{(id, label): codes and error} and the codebooks, in plain Python integers."""
    fine = [(i, lab, v) for i, lab, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    lengths = [len(v) for _, _, v in fine]
    usual = min(set(lengths), key=lambda d: (-lengths.count(d), d)) if fine else 0
    fine = sorted((r for r in fine if len(r[2]) == usual), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    w = usual // parts
    cut = [[[math.floor(1024 * x) for x in v[p * w:(p + 1) * w]] for p in range(parts)] for _, _, v in fine]
    books = [[list(x[p]) for x in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            chosen = [nearest(x[p], books[p])[1] for x in cut]
            for e in range(len(books[p])):
                own = [x[p] for x, c in zip(cut, chosen) if c == e]
                if own:
                    books[p][e] = [sum(col) // len(own) for col in zip(*own)]
    out = []
    for (i, lab, _), x in zip(fine, cut):
        found = [nearest(x[p], books[p]) for p in range(parts)]
        out.append((i, lab, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    return out, hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()


def _want(rows):
    out, digest = _brute(rows)
    per_label = {}
    for _, lab, _, e in out:
        per_label[lab] = per_label.get(lab, 0) + e
    return sorted((i, c, e, per_label[lab], digest) for i, lab, c, e in out)


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    got = C.op11_orchard_codes(spark, SF)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(tuple(r) for r in got.collect()) == _want(rows)


def _compressed(spark, rows, **how):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(3)
    coded, books = C.compress(df, **how)
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[3])
    return sorted((tuple(r) for r in coded.collect()), key=key), C.codebook_digest(books)


def test_ties_repeats_nulls_and_large_values(spark):
    rng = random.Random(5)
    rows = [(i, i % 3, [rng.choice((-0.01, 0.0, 0.001, 0.01)) for _ in range(8)]) for i in range(400)]
    rows += [(i, None, [0.01] * 8) for i in range(500, 800)]  # a third equal
    rows += [(7, 1, rows[7][2]), (7, 2, [0.5] * 8), (None, 1, [0.25] * 8)]
    rows += [(900, 1, None), (901, 1, []), (902, 1, [0.1] * 7), (903, 1, [0.1] * 7 + [None]), (904, 1, [0.1] * 7 + [float("nan")]),
             (905, 1, [float("-inf")] * 8), (906, 1, [1e300] + [0.0] * 7)]
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[3])
    fine = [r for r in rows if r[0] != 906]
    out, digest = _brute(fine)
    assert _compressed(spark, rows) == (sorted(out, key=key), digest)
    large = [r for r in fine if r[0] is None or r[0] < 60] + [(i, 1, [rng.uniform(-1e30, 1e30) for _ in range(8)]) for i in range(60, 90)]
    out, digest = _brute(large)
    got, sha = _compressed(spark, large)
    assert sha == digest and got == sorted(((i, lab, c, e if e < 1 << 63 else None) for i, lab, c, e in out), key=key)


def test_lengths_that_parts_do_not_divide(spark):
    rows = [(i, 0, [float(i), 1.0, 2.0, i / 7, 3.0, 9.0]) for i in range(20)]
    out, digest = _brute(rows)
    assert _compressed(spark, rows) == (out, digest)
    assert _compressed(spark, [(1, 0, [1.0, 2.0])])[0] == [] == _compressed(spark, [])[0]


def test_search_stops_early_and_is_exact():
    rng = np.random.default_rng(2)
    centres = rng.integers(-10_000, 10_000, (64, 4))
    x = (centres[rng.integers(0, 64, 500)] + rng.integers(-300, 300, (500, 4)))
    book = C.Codebook(centres)
    code, distance = C.orchard(x, book)
    every = ((x[:, None] - centres[None]) ** 2).sum(2)
    assert (code == every.argmin(1)).all() and (distance == every.min(1)).all()
    # The lists are by distance, own entry first.
    assert (book.lists[:, 0] == np.arange(64)).all() and (np.diff(book.along, axis=1) >= 0).all()


def test_extra_columns_that_clash(spark):
    rows = [(i, i % 2, [float(i % 5)] * 4, i, "x") for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>, id long, v string")
    coded, _ = C.compress(df)
    assert coded.columns == ["vec_id", "label", "code", "error"] and coded.count() == 30
