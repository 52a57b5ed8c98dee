"""Source divergence by the tree of term rows against SQL and plain sums over all terms."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tavolo.llm import divergence as D
from tavolo.plans.check import compare, duck

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string"


def test_query_matches_sql(spark):
    r = compare(spark, SF, "op12", D.op12_source_divergence, D.ORACLE["op12_source_divergence"], duck(SF))
    assert r["status"] == "match", r


def _brute(rows, min_docs=3, top=200):
    docs = [(i, t or "", lang or "", s or "") for i, (_, t, lang, s) in enumerate(rows)]
    out = []
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    for lang in {d[2] for d in docs}:
        count, having = {}, Counter()
        for _, text, of, source in docs:
            if of != lang:
                continue
            terms = [w.translate(lower) for w in re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
            count.setdefault(source, Counter()).update(terms)
            having.update(set(terms))
        kept = [t for t, n in having.items() if n >= min_docs]
        whole = sum(count.values(), Counter())

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 1) // (n + len(kept)) for t in kept}

        p = {s: shares(c) for s, c in count.items()}
        q = shares(whole)
        for s in count:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode(), o) for o in count if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t.encode(), t) for t in kept if count[s][t] > 0 and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item, -v, i) for i, (v, _, item) in enumerate(found, 1)]
    return sorted(out)


def _rows(seed, n):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "GAMMA", "été", "ÉTÉ", "日本", "x", "y_z", "don't", "a1b", "É", "zeta"] + [f"w{chr(97 + i)}" for i in range(15)]
    rows = [(i, " ".join(rng.choice(words[:rng.randint(1, len(words))]) for _ in range(rng.randint(0, 40))), rng.choice(["en", "en", "fr", None, ""]),
             rng.choice(["s1", "s1", "s10", "s2", "é", "z", None, ""])) for i in range(n)]
    return rows + [(900, None, "en", "empty"), (901, "", "xx", "only"), (902, "1 2 3", "yy", "a"), (903, "7", "yy", "b")] + rows[:4] * 2


@pytest.mark.parametrize("cells", [D.TREE_CELLS, 24])
def test_against_plain_sums(spark, cells):
    rows = _rows(3, 160)
    got = D.divergences(spark.createDataFrame(rows, SCHEMA).repartition(3), tree_cells=cells)
    assert sorted(tuple(r) for r in got.collect()) == _brute(rows)
    assert [f"{f.name} {f.dataType.simpleString()}" for f in got.schema.fields] == ["lang string", "source string", "part string", "item string",
                                                                                    "value bigint", "rank int"]


def test_long_texts_and_held_tables(monkeypatch):
    rng = random.Random(1)
    text = " ".join(rng.choice(["ab", "cd", "éé", "Q"]) + rng.choice(["", "1", "_x"]) for _ in range(5000))
    monkeypatch.setattr(D, "SLICE_BYTES", 64)
    assert b"".join(D._slices(text.encode())) == text.encode()
    pieces = [t for p in D._slices(text.encode().lower()) for t in D.TERM.findall(p)]
    assert pieces == D.TERM.findall(text.encode().lower())


def test_hot_group_empty_and_clashing(spark):
    rows = [(i, "common word here", "en", "hot") for i in range(400)] + [(500 + i, "common other there", "en", f"s{i % 3}") for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("x").alias(c) for c in ("term", "n", "docs", "items", "total", "v", "value", "rank", "item", "part")])
    assert sorted(tuple(r) for r in D.divergences(df).collect()) == _brute(rows)
    assert D.divergences(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sums_are_exact_beyond_64_bits():
    sums = D.Sums(2)
    sums.add(np.array([0, 0]), np.array([1, 1]), np.array([2 ** 60, 2 ** 60 - 1]), np.array([2 ** 20, 3]))
    assert sums.of[1] == 2 ** 80 + 3 * (2 ** 60 - 1)
    groups = D.Groups([{"lang": "", "source": "s", "total": 10 ** 13, "v": 10 ** 9}])
    assert groups.share("", np.array([0]), np.array([10 ** 12]))[0] == 1 + 10 ** 9 * (10 ** 12 + 1) // (10 ** 13 + 10 ** 9)
