import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns of the input whose names operators use for their own.
CLASHING = {"score": 0.5, "target": 1.0, "kept": True, "sequence_id": 7, "removed": "x", "host": "h", "component_id": -1, "held_out": True}


def prose(rng: random.Random, n: int) -> str:
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(n)]
    return "\n".join(" ".join(words[i:i + 25]) + "." for i in range(0, n, 25))


def messy_rows() -> list[tuple]:
    rng = random.Random(4)
    base = prose(rng, 120)
    rows = [(i, prose(rng, rng.randint(12, 200)), "en", f"s{i % 3}", 0) for i in range(30)]
    rows += [(100 + i, base, "en", "s0", 0) for i in range(5)]  # copies
    rows += [(200, None, None, None, None), (201, "", "en", None, 0), (202, " \n\t\n ", "en", "s1", 3), (None, base, "en", "s2", 0),
             (None, None, None, None, None), (203, "one two", "en", "s1", 7), (204, "x" * 200_000, "en", "s1", 0),
             (205, "word " * 40_000, "en", "s2", 0), (206, prose(rng, 20_000), "en", "s2", 0)]
    rows += [(300, base + "\nlast words here", "en", "s1", 0)] * 2  # the same row twice
    return rows


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(messy_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def clashing(messy):
    from pyspark.sql import functions as F

    return messy.select("*", *[F.lit(v).alias(c) for c, v in CLASHING.items()])


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
