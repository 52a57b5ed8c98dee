"""Line dedup: runs go whole, whatever follows the last window in them."""

import random

from tavolo.llm import linededup as L


def _any_run(docs, min_words):
    """{id: kept text}. A line goes if a run of at least ``min_words`` words around it also starts earlier."""
    seen, out = set(), {}
    for doc, text in sorted(docs):
        lines = text.split("\n")
        worded = [(i, x, len(x.split())) for i, x in enumerate(lines) if x.split()]
        gone = set()
        for at in range(len(worded)):
            total = 0
            for to in range(at, len(worded)):
                total += worded[to][2]
                key = tuple(x for _, x, _ in worded[at:to + 1])
                if total >= min_words and key in seen:
                    gone |= set(range(worded[at][0], worded[to][0] + 1))
                seen.add(key)
        out[doc] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def _line(name, n):
    return " ".join(f"{name}{i}" for i in range(n))


def test_lines_after_the_last_window(spark):
    shared = f"{_line('a', 60)}\n{_line('b', 20)}"
    docs = [(1, f"{shared}\nown one"), (2, f"own two\n{shared}\n\nown three"),
            (3, f"{_line('a', 60)}\n{_line('c', 20)}\nown four"),
            (4, f"{_line('a', 60)}\n{_line('c', 20)}\nown five")]  # goes on as in 3, not as in the first copy
    got = {r["doc_id"]: r for r in L.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[2]["text"] == "own two\n\nown three" and [tuple(x) for x in got[2]["removed"]] == [(1, 2)]
    assert got[1]["text"] == docs[0][1] and got[3]["text"] == f"{_line('c', 20)}\nown four" and got[4]["text"] == "own five"


def test_random_runs(spark):
    rng = random.Random(3)
    pool = [" ".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 9))) for _ in range(9)] + ["", " "]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 14)))) for i in range(150)]
    want = _any_run(docs, 6)
    got = L.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), min_words=6).collect()
    assert all(r["text"] == want[r["doc_id"]] for r in got)
