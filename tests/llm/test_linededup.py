"""Line dedup against DuckDB and against the plain definition."""

import random

from pyspark.sql import functions as F

from tavolo.llm import linededup as L
from tavolo.plans.check import compare, duck

SF = "/root/testdata/sf0.001"


def test_matches_sql(spark):
    r = compare(spark, SF, "op2", L.op2_line_dedup, L.ORACLE["op2_line_dedup"], duck(SF))
    assert r["status"] == "match", r


def _plain(docs, min_words):
    """{(id, text): kept text}. A line goes if a run of at least ``min_words`` words around it also starts earlier.

    A run from a line on that starts earlier, too, begins with the same shortest run of so many words.
    """
    starts, out = {}, {}
    for doc, text in sorted({d for d in docs if d[1] is not None}, key=lambda d: (d[0] is None, d[0] or 0)):
        lines = text.split("\n")
        worded = [(i, x, len(x.split())) for i, x in enumerate(lines) if x.split()]
        gone, plain = set(), [x for _, x, _ in worded]
        for at in range(len(worded)):
            total, to = 0, at
            while to < len(worded) and total < min_words:
                total += worded[to][2]
                to += 1
            if total < min_words:
                break
            earlier = starts.setdefault(tuple(plain[at:to]), [])
            for other, place in earlier:
                n = to - at
                while at + n < len(plain) and place + n < len(other) and plain[at + n] == other[place + n]:
                    n += 1
                gone |= set(range(worded[at][0], worded[at + n - 1][0] + 1))
            earlier.append((plain, at))
        out[doc, text] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def test_random_lines(spark):
    rng = random.Random(8)
    pool = [" ".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 4))) for _ in range(9)] + ["", " "]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 14)))) for i in range(150)]
    want = _plain(docs, 6)
    got = L.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), min_words=6).collect()
    assert sum(r["n_removed"] > 0 for r in got) > 30
    texts = dict(docs)
    assert all(r["text"] == want[r["doc_id"], texts[r["doc_id"]]] for r in got)


def test_passages_of_several_lines_and_one_line(spark):
    long_line = " ".join(f"w{i}" for i in range(60))
    run = "\n".join(" ".join(f"r{i}{j}" for j in range(10)) for i in range(6))
    short = " ".join(f"s{i}" for i in range(49))
    docs = [(1, f"own one\n{long_line}\n\nend one"), (2, f"{run}\nown two"), (3, f"own three\n{run}\n{long_line}\n{short}"), (4, f"{short}\nown four")]
    got = {r["doc_id"]: r for r in L.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[3]["text"] == f"own three\n{short}" and [tuple(x) for x in got[3]["removed"]] == [(1, 6), (7, 7)]
    assert all(got[i]["text"] == dict(docs)[i] for i in (1, 2, 4))


def test_messy_rows(spark, messy, clashing, nothing):
    rows = messy.collect()
    got = L.dedup_lines(clashing)
    assert set(messy.columns) <= set(got.columns)
    want = _plain([(r["doc_id"], r["text"]) for r in rows], L.MIN_WORDS)
    values = sorted((r["doc_id"], want[r["doc_id"], r["text"]]) if r["text"] is not None else (r["doc_id"], None) for r in rows if r["doc_id"] is not None)
    assert sorted((r["doc_id"], r["text"]) for r in got.collect() if r["doc_id"] is not None) == values
    assert got.where("doc_id is null").count() == 2 and got.where("doc_id = 300 and n_removed > 0").count() == 2
    assert L.dedup_lines(nothing).count() == 0


def test_names_of_helper_columns(spark):
    run = " ".join(f"r{i}" for i in range(60))
    df = spark.createDataFrame([(1, run), (2, f"own\n{run}")], "doc_id long, text string")
    names = ("id", "th", "__th", "__id", "__of", "__lines", "__runs", "line", "words", "h", "g", "start", "end", "fp", "place", "first", "removed", "n_lines", "a.b")
    got = L.dedup_lines(df.select("*", *[F.lit(7).alias(c) for c in names]))
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {1: run, 2: "own"}
    assert got.where("id = 7 and th = 7 and line = 7 and fp = 7 and start = 7 and `a.b` = 7").count() == 2


def test_same_line_in_other_surroundings(spark):
    """Positions that disagree with the first one, but agree with each other."""
    line = lambda name, n=20: " ".join(f"{name}{i}" for i in range(n))
    mid = [line(f"m{i}") for i in range(6)]
    docs = [(i, "\n".join([line(f"a{i % 3}"), mid[i % 2], line(f"b{i % 4}"), f"own{i}", mid[i % 5], line("tail", 40)])) for i in range(40)]
    want = _plain(docs, 50)
    got = L.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["text"] for r in got} == {i: want[i, t] for i, t in docs}


def test_a_third_of_rows_equal(spark):
    docs = [(5, "\n".join(" ".join(f"k{i}{j}" for j in range(9)) for i in range(40)))] * 300 + [(i, f"one {i}\n" + " ".join(f"u{i}_{j}" for j in range(70))) for i in range(10, 40)]
    got = L.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"))
    assert got.count() == 330 and got.where("n_removed > 0").count() == 0


def test_plan_has_no_python(spark, capsys):
    L.op2_line_dedup(spark, SF).explain()
    assert not any(w in capsys.readouterr().out for w in ("Python", "Pandas", "Arrow"))
