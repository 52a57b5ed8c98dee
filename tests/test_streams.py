"""Streaming ledger and scoring: late events, restarts, replayed batches."""

import random

from pyspark.sql import functions as F

from tavolo.operators import ledger as L
from tavolo.session import scratch_path
from tavolo.streaming import ledger_stream as S
from tavolo.streaming import scoring_stream as C

SHOP = "seq long, op string, basket_id long, product string, quantity string, purchase_price string, selling_price string"


def _events(n, seed=3):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        op = "reset" if seq % 97 == 50 else rng.choice(["add", "add", "sale", "sale", "sale"])
        product = None if op == "reset" else rng.choice(["hot"] * 5 + [f"p{i}" for i in range(12)])
        rows.append((seq, op, seq // 3, product, str(rng.randint(1, 20)), rng.choice(["2", "2", None]), "3"))
    return rows


def _decided(spark, out):
    cols = [f.name for f in L.DECISION_SCHEMA]
    return sorted((tuple(r) for r in spark.read.parquet(out).select(*cols).collect()), key=str)


def _batch(spark, rows):
    got = L.decisions(spark.createDataFrame(rows, SHOP))
    cents = lambda c: (F.col(c) * 100).cast("long")
    return sorted((tuple(r) for r in got.select("seq", "epoch", "op", "basket_id", "product", cents("quantity"), "accepted", "reason", cents("purchase_price"),
                                                cents("selling_price"), cents("stock"), cents("state_purchase_price"), cents("state_selling_price"), "first_seq").collect()),
                  key=str)


def test_stream_equals_batch_and_restarts(spark):
    rows = _events(900)
    base = scratch_path(spark, "stream-test")
    S.stage_event_files(spark.createDataFrame(rows[:500], SHOP), f"{base}/in", steps=2, files=3)
    S.run_ledger_stream(spark, f"{base}/in", f"{base}/out", f"{base}/state", files_per_trigger=3, buckets=4)
    assert _decided(spark, f"{base}/out") == _batch(spark, rows[:500])
    # more events after a restart: the state goes on where it was
    S.stage_event_files(spark.createDataFrame(rows[500:], SHOP), f"{base}/in", steps=2, files=3)
    S.run_ledger_stream(spark, f"{base}/in", f"{base}/out", f"{base}/state", files_per_trigger=3, buckets=4)
    assert _decided(spark, f"{base}/out") == _batch(spark, rows)


def test_late_events_change_nothing(spark):
    rows = _events(300)
    late = [rows[7], rows[50], rows[120]]
    assert late[1][1] == "reset"
    in_time = [r for r in rows if r not in late]
    base = scratch_path(spark, "late-test")
    write = lambda part: spark.createDataFrame(part, SHOP).coalesce(1).write.mode("append").parquet(f"{base}/in")
    write(in_time[:200])
    write(late + in_time[200:])
    S.run_ledger_stream(spark, f"{base}/in", f"{base}/out", f"{base}/state", buckets=1)
    got = _decided(spark, f"{base}/out")
    assert [r for r in got if r[7] != S.LATE] == _batch(spark, in_time)
    assert sorted(r[0] for r in got if r[7] == S.LATE) == [7, 120] and not any(r[6] for r in got if r[7] == S.LATE)


def test_a_replayed_batch_leaves_one_copy(spark, monkeypatch):
    monkeypatch.setattr(C, "score_batch", lambda batch, *rest: batch.select("doc_id", F.lit(0.0).alias("predicted"), F.lit("ham").alias("verdict")))
    out = scratch_path(spark, "sink-test")
    each = C.batch_writer(out, None, None, None, None, None)
    first = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], C.EMAIL_STREAM_SCHEMA)
    each(first, 0)
    each(spark.createDataFrame([(3, "c")], C.EMAIL_STREAM_SCHEMA), 1)
    each(first, 0)  # the write was done, the commit was not
    each(spark.createDataFrame([], C.EMAIL_STREAM_SCHEMA), 2)
    assert sorted((r["batch_id"], r["doc_id"]) for r in C.read_scores(spark, out).collect()) == [(0, 1), (0, 2), (0, 2), (1, 3)]


def test_a_micro_batch_takes_a_file_for_each_core(spark, monkeypatch):
    monkeypatch.setattr(C, "score_batch", lambda batch, *rest: batch.select("doc_id", F.lit(0.0).alias("predicted"), F.lit("ham").alias("verdict")))
    monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", 3)
    base = scratch_path(spark, "files-test")
    spark.createDataFrame([(i, "a") for i in range(60)], C.EMAIL_STREAM_SCHEMA).repartition(6).write.parquet(f"{base}/in")
    vectors = spark.createDataFrame([("a", [1.0])], "word string, vector array<double>")
    C.run_scoring_stream(spark, f"{base}/in", f"{base}/out", f"{base}/state", None, None, vectors, None, None)
    got = C.read_scores(spark, f"{base}/out").groupBy("batch_id").count().collect()
    assert len(got) == 2 and sum(r["count"] for r in got) == 60


class _Held(dict):
    """State of a group, as its handle gives it."""

    def __init__(self):
        self.clock = None

    def getValueState(self, *_):
        held = self
        return type("Clock", (), {"exists": lambda s: held.clock is not None, "get": lambda s: held.clock, "update": lambda s, v: setattr(held, "clock", v)})()

    def getMapState(self, *_):
        return type("Products", (), {"getValue": lambda s, k: self.get(k), "updateValue": lambda s, k, v: self.update({k: v}),
                                     "iterator": lambda s: iter(list(self.items())), "removeKey": lambda s, k: self.pop(k)})()


def test_a_group_folds_a_micro_batch_at_once(monkeypatch):
    import pandas as pd

    calls, fold = [], S.fold_frame
    monkeypatch.setattr(S, "fold_frame", lambda *a, **k: (calls.append(len(a[0])), fold(*a, **k))[1])
    rows = [(e[0], e[1], e[2], e[3], int(e[4]) * 100, int(e[5]) * 100 if e[5] else None, 300) for e in _events(400)]
    frames = [pd.DataFrame(part, columns=["seq", "op", "basket_id", "product", "qty_c", "pp_c", "sp_c"]) for part in (rows, rows[:200], rows[200:])]

    def decided(*batches):
        group = S.LedgerProcessor()
        group.init(_Held())
        out = pd.concat([f for b in batches for f in group.handleInputRows(None, iter([b]), None)])
        return out.sort_values("seq").reset_index(drop=True).astype(str)

    pd.testing.assert_frame_equal(decided(frames[0]), decided(frames[1], frames[2]))
    moves = [sum(r[1] != "reset" for r in part) for part in (rows, rows[:200], rows[200:])]
    assert calls == moves
