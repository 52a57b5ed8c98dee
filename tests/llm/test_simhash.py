"""SimHash near-duplicates against all pairs."""

import random

import numpy as np
import xxhash

from tavolo.llm import simhash as S


def _plain_fingerprint(text, shingle=3):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ")
             .replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _groups(fps):
    """Component of each fingerprint, by all pairs."""
    fps = sorted(set(fps))
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {f: find(f) for f in fps}


def test_fingerprint():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("aB c\té\x85\x1c\n") for _ in range(rng.randint(0, 60)))
        assert S.fingerprint(text) == _plain_fingerprint(text)
    assert S.fingerprint(None) == 0 == S.fingerprint(" \n")


def test_golay_keys_meet_within_one_bit():
    own, near = S.golay_tables()
    rng = np.random.default_rng(0)
    words = rng.integers(0, 1 << 16, 2000)
    for bit in range(16):
        assert all(own[w ^ (1 << bit)] in near[w] for w in words)
    assert (own[words][:, None] == near[words]).any(axis=1).all()


def _near_fingerprints(n=600):
    rng = random.Random(3)
    fps = set()
    while len(fps) < n:
        f = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 8])):
            fps.add(f)
            for bit in rng.sample(range(64), rng.choice([1, 2, 3, 3, 4])):
                f ^= 1 << bit
    return sorted(fps)


def test_groups_are_those_of_all_pairs_on_either_path(spark):
    fps = _near_fingerprints()
    want = _groups(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    for hot in (S.HOT_KEY, 1):
        got = {r["fp"] % (1 << 64): r["root"] for r in S.fingerprint_groups(df, hot_key=hot).collect()}
        assert len(got) == len(fps)
        pairs = {(want[f], got[f]) for f in fps}
        assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_messy_rows(spark, messy, nothing):
    rows = messy.collect()
    got = S.near_duplicates(messy).collect()
    assert len(got) == len(rows)
    fps = {(r["doc_id"], r["text"]): _plain_fingerprint(r["text"]) for r in rows}
    groups = _groups(fps.values())
    ids = {}
    for (doc, _), f in fps.items():
        if doc is not None:
            ids[groups[f]] = min(doc, ids.get(groups[f], doc))
    want = sorted(((r["doc_id"], f"{fps[r['doc_id'], r['text']]:016x}", ids.get(groups[fps[r["doc_id"], r["text"]]])) for r in rows), key=str)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=str) == want
    assert S.near_duplicates(nothing).count() == 0


def test_one_of_each_stays(spark, messy, clashing, nothing):
    kept = S.keep_one_of_each(clashing)
    assert kept.columns == clashing.columns
    rows = kept.collect()
    all_fps = {_plain_fingerprint(r["text"]) for r in messy.collect()}
    assert len(rows) == len(set(_groups(all_fps).values()))
    ids = [r["doc_id"] for r in rows]
    assert {100, 200} <= set(ids) and not {101, None} & set(ids) and ids.count(300) <= 1
    nameless = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (None, None)], "doc_id long, text string")
    assert S.keep_one_of_each(nameless).count() == 2
    assert S.keep_one_of_each(nothing).count() == 0
