"""Packing: exact round trip of token ids, full bins, little padding."""

import random
import zlib

import numpy as np

from tavolo.llm import packing as P


def _ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.vocabulary_path()).encode(text or "", add_special_tokens=False).ids + [1]


def test_word_ids_equal_whole_text_ids():
    rng = random.Random(1)
    table = P.WordIds(P.vocabulary_path(), limit=40)
    letters = "aB é́  \u0085\x1c\t\n\x0b\x0c'’'sSΣσ 9٤!?.,😀İKJǰ̌ﬁ̇"
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) + rng.choice(["", "", " <|endoftext|>", "a<|STARTOFTEXT|>."])
        want = table.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(table.ids(text.encode()), "<u4").tolist() == want, text


def test_cut_covers_every_token_and_wastes_little():
    for n in [*range(1, 4200), 99_999]:
        pieces = P.cut(n)
        assert [s for s, _, _ in pieces] == [sum(x for _, x, _ in pieces[:i]) for i in range(len(pieces))] and sum(x for _, x, _ in pieces) == n
        for _, length, k in pieces:
            assert P.CAPACITY // (k + 1) < length <= P.CAPACITY // k


def test_first_fit():
    rng = random.Random(2)
    lengths = [rng.randint(1, 100) for _ in range(300)]
    bins = P.first_fit(lengths, 128)
    assert sorted(i for b in bins for i in b) == list(range(300)) and all(sum(lengths[i] for i in b) <= 128 for b in bins)
    assert len(bins) <= 1.25 * sum(lengths) / 128 and P.first_fit([], 128) == []


def _check(rows, texts):
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r["offset"])
        assert [p["offset"] for p in pieces] == [sum(x["length"] for x in pieces[:i]) for i in range(len(pieces))]
        assert sum(p["length"] for p in pieces) <= P.CAPACITY
    want = sorted(((doc, s, n, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes()), len(ids)) for doc, ids in texts for s, n, _ in P.cut(len(ids))), key=str)
    assert sorted(((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows), key=str) == want
    return by_sequence


def test_messy_rows_in_several_rounds(spark, messy, clashing, nothing):
    texts = [(r["doc_id"], _ids(r["text"])) for r in messy.collect()]
    for most in (P.ROUND_PIECES, 60):
        sequences = _check(P.pack_documents(clashing, round_pieces=most).collect(), texts)
        tokens = [sum(p["length"] for p in s) for s in sequences.values()]
        padding = sum(0 if n & (n - 1) == 0 else P.CAPACITY - n for n in tokens)
        assert padding <= 0.05 * sum(tokens)
    assert P.pack_documents(nothing).count() == 0


def test_sequences_hold_the_ids(spark, messy):
    packed = P.pack_documents(messy.where("doc_id < 40"), with_ids=True).cache()
    texts = {r["doc_id"]: _ids(r["text"]) for r in messy.where("doc_id < 40").collect()}
    pieces = {}
    for r in packed.collect():
        pieces.setdefault(r["sequence_id"], []).append(r)
    for s in P.sequences(packed, pad_id=9).collect():
        want = [t for r in sorted(pieces[s["sequence_id"]], key=lambda r: r["offset"]) for t in texts[r["doc_id"]][r["start"]:r["start"] + r["length"]]]
        n = s["n_tokens"]
        assert n == len(want) and s["ids"] == want + [9] * (0 if n & (n - 1) == 0 else P.CAPACITY - n)
    packed.unpersist()
