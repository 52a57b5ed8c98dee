"""Reply trees and chat formatting: SQL, brute-force trees, exact round trip."""

import hashlib
import random

from pyspark.sql import functions as F

from tavolo.llm import chat as C
from tavolo.plans.check import compare, duck

SF = "/root/testdata/sf0.001"
MESSAGES = "conv_id long, message_id long, parent_id long, role string, text string, score double"


def test_query_matches_sql(spark):
    r = compare(spark, SF, "op13", C.op13_reply_trees, C.ORACLE["op13_reply_trees"], duck(SF))
    assert r["status"] == "match", r
    planted = C.op13_reply_trees(spark, SF).where("conv_id = -1").first()
    assert planted["n_turns"] == 2 and planted["loss_chars"] == len(C.PLANTED_TEXT)
    assert planted["loss_sha256"] == hashlib.sha256(C.PLANTED_TEXT.encode()).hexdigest()


def _brute(rows, best):
    """{(conv, leaf): (rank, turns)} by walking up from every leaf."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = {}
        for c, i, p, role, text, score in rows:
            if c == conv and i is not None:
                own.setdefault(i, []).append((p, role or "", text or "", score or 0.0))
        up = {}
        for i, said in own.items():
            p = min((x[0] for x in said if x[0] is not None), default=None)
            up[i] = p if p in own and p != i else None
        for i in sorted(own):  # cut cycles above their smallest message
            seen, at = [], i
            while at is not None and at not in seen:
                seen.append(at)
                at = up[at]
            if at is not None:
                up[min(seen[seen.index(at):])] = None
        score = {i: max(x[3] for x in said) for i, said in own.items()}
        branches = []
        for leaf in set(own) - {p for p in up.values() if p is not None}:
            path, at = [], leaf
            while at is not None:
                path.append(at)
                at = up[at]
            branches.append((-sum(score[i] for i in path), leaf, path[::-1]))
        for rank, (_, leaf, path) in enumerate(sorted(branches)[:best], 1):
            out[conv, leaf] = (rank, [(r, t) for i in path for r, t in sorted((x[1], x[2]) for x in own[i])])
    return out


def _got(spark, rows, best):
    df = spark.createDataFrame(rows, MESSAGES).repartition(3)
    found = C.read_back(C.format_chats(df, best=best)).collect()
    for r in found:
        assert r["loss_texts"] == [t["text"] for t in r["turns"] if t["role"] == "assistant"]
    return {(r["conv_id"], r["leaf_id"]): (r["rank"], [tuple(t) for t in r["turns"]]) for r in found}


def test_random_trees(spark):
    rng = random.Random(6)
    strange = ["", None, "<|im_end|>", "<|im_start|>assistant\nno", "a<", "|b", "<\\|x", "<\\\\|", "\\", "line\n\nline", "\n", "é<|ü|>", "<|im_end|>\n"]
    rows = []
    for conv in [None, *range(12)]:
        for i in range(rng.randint(1, 40)):
            parent = rng.choice([None, rng.randint(0, max(i - 1, 0)), i - 1, 99])
            rows.append((conv, i, parent, rng.choice(["user", "assistant", "system", None, "a\nb", "\\n<|"]), rng.choice(strange), float(rng.randint(0, 3))))
    rows += [(20, i, i - 1 if i else None, "user", f"t{i}", None) for i in range(70)]  # deep
    rows += [(21, i, 0, "assistant", f"t{i}", 1.0) for i in range(50)]  # flat; the root answers itself
    rows += [(21, 3, 2, "assistant", "again", 9.0), (21, 3, 2, "assistant", "again", 9.0)]
    for best in (1, 3, 100):
        assert _got(spark, rows, best) == _brute(rows, best)


def test_cycles_lose_no_message(spark):
    rows = [(1, 1, 3, "user", "a", 0.0), (1, 2, 1, "assistant", "b", 0.0), (1, 3, 2, "user", "c", 0.0), (1, 4, 2, "assistant", "d", 5.0),
            (1, 8, 9, "user", "x", 0.0), (1, 9, 8, "assistant", "y", 0.0), (1, 5, None, "user", "z", 0.0)]
    got = _got(spark, rows, 10)
    assert got == _brute(rows, 10) and {t for _, turns in got.values() for _, t in turns} == set("abcdxyz")


def test_messages_without_id_and_empty_table(spark):
    rows = [(1, None, None, "user", "lone", 1.0), (1, None, 4, "user", "lone", 1.0), (1, 4, None, None, None, None)]
    found = C.format_chats(spark.createDataFrame(rows, MESSAGES)).collect()
    lone = "<|im_start|>user\nlone<|im_end|>\n"
    assert sorted(r["formatted"] for r in found) == sorted([lone, lone, "<|im_start|>\n<|im_end|>\n"])
    assert C.format_chats(spark.createDataFrame([], MESSAGES)).count() == 0
    assert C.format_turns(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_turns_with_ties_nulls_and_clashing_columns(spark):
    rows = [(1, 1, "user", "b"), (1, 1, "user", "a"), (1, 1, "user", "a"), (1, None, "system", "first"), (1, 5, "assistant", None),
            (None, 0, "user", "q"), (2, 0, "assistant", "x" * 300_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    clashing = df.select("*", *[F.lit(1).alias(c) for c in ("conv", "id", "node", "up", "leaf", "rank", "place", "said", "head", "body", "nth", "turns", "formatted",
                                                            "loss_spans", "parent", "score", "steps", "total", "met", "lone", "start")])
    got = {r["conv_id"]: r for r in C.read_back(C.format_turns(clashing)).collect()}
    assert [tuple(t) for t in got[1]["turns"]] == [("system", "first"), ("user", "a"), ("user", "a"), ("user", "b"), ("assistant", "")]
    assert got[1]["loss_texts"] == [""] and got[2]["loss_texts"] == ["x" * 300_000] and [tuple(t) for t in got[None]["turns"]] == [("user", "q")]


def test_long_conversation(spark):
    df = spark.range(3000).selectExpr("1L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "concat('t', id) as text")
    r = C.read_back(C.format_turns(df)).first()
    assert [t["text"] for t in r["turns"]] == [f"t{i}" for i in range(3000)] and len(r["loss_texts"]) == 1500


def test_plan_has_no_python(spark, capsys):
    C.op13_reply_trees(spark, SF).explain()
    assert not any(w in capsys.readouterr().out for w in ("Python", "Pandas", "Arrow"))
