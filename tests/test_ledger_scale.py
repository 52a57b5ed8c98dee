"""Epochs by place, and hot products split over partitions, against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from tavolo.operators import ledger as L

SHOP = "seq long, op string, basket_id long, product string, quantity string, purchase_price string, selling_price string"


def test_epochs_with_ties_nulls_and_many_resets(spark):
    rng = random.Random(2)
    rows = [(rng.randint(0, 400), rng.choice(["add", "sale", "reset", "reset"])) for _ in range(3000)] + [(None, "add"), (None, "reset")]
    resets = {s for s, op in rows if op == "reset" and s is not None}
    want = sorted([(s if s is not None else -1, op, sum(r <= s for r in resets) if s is not None else 0) for s, op in rows if op != "reset" or s is None]
                  + [(s, "reset", sum(r <= s for r in resets)) for s in resets])
    df = spark.createDataFrame(rows, "seq long, op string").repartition(7)
    got = sorted((r["seq"] if r["seq"] is not None else -1, r["op"], r["epoch"]) for r in L.with_epoch(df).collect())
    assert got == want
    assert L.with_epoch(df.limit(0)).count() == 0


def _plain(rows):
    """Decisions of (seq, op, product, quantity, pp, sp) event by event."""
    state, epoch, out = {}, 0, {}
    for seq, op, _, product, qty, pp, sp in sorted(rows, key=lambda r: r[0]):
        if op == "reset":
            state, epoch = {}, epoch + 1
            continue
        cents = lambda x: None if x is None else int(x) * 100
        state[product], ok, reason, upp, usp = L.step(state.get(product), op, int(qty) * 100, cents(pp), cents(sp), seq)
        s = state[product]
        out[seq] = (epoch, ok, reason, s["stock"] if s else 0, s["first_seq"] if s else None, upp)
    return out


def _hot_events(seed, n, demand):
    """Two hot products with hundreds of refusals, invalid first adds, and many cold ones."""
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        product = rng.choice(["hot"] * 6 + ["warm"] * 3 + [f"p{rng.randint(0, 30)}"])
        op = "sale" if rng.random() < demand else "add"
        price = None if seq < n // 3 and product == "warm" or rng.random() < 0.02 else "2"
        rows.append((seq, op, seq // 4, product, str(rng.randint(1, 30)), price, "3"))
    return rows


@pytest.mark.parametrize("demand", [0.2, 0.5, 0.8, 1.0])
def test_hot_products_split_over_partitions(spark, demand):
    rows = _hot_events(int(demand * 10), 12_000, demand)
    rows += [(20_000, "reset", None, None, None, None, None)] + [(30_000 + r[0], *r[1:]) for r in rows[:500]]
    want = _plain(rows)
    df = spark.createDataFrame(rows, SHOP).repartition(5)
    for parts in (1, 9):
        got = {r["seq"]: r for r in L.decisions(df, num_partitions=parts).collect()}
        assert got.keys() == want.keys()
        for seq, (epoch, ok, reason, stock, first, pp) in want.items():
            r = got[seq]
            assert (r["epoch"], r["accepted"], r["reason"], int(r["stock"] * 100), r["first_seq"]) == (epoch, ok, reason, stock, first), seq
            assert (r["purchase_price"] is None) == (pp is None)
    refused = sum(v[2] == L.INSUFFICIENT_STOCK for v in want.values())
    assert refused > 100 or demand in (0.2, 1.0)


def test_small_blocks(spark):
    rng = random.Random(1)
    rows = [(0, "add", None, "hot", "4000", "1", "2")]
    rows += [(i, "sale" if i % 2 else "add", i, "hot", str(rng.randint(1, 9)) if i % 3000 != 999 else "900000", "1", "2") for i in range(1, 20_000)]
    want = _plain(rows)
    got = {r["seq"]: r for r in L.decisions(spark.createDataFrame(rows, SHOP), num_partitions=8, block_shift=8).collect()}
    assert all((got[s]["accepted"], int(got[s]["stock"] * 100)) == (w[1], w[3]) for s, w in want.items())


def test_bounds_of_blocks():
    import pyarrow as pa

    rng = random.Random(4)
    for _ in range(200):
        blocks = [[rng.randint(-9, 9) or 1 for _ in range(rng.randint(1, 12))] for _ in range(8)]
        moves = pa.RecordBatch.from_pylist([{"epoch": 0, "product": "x", "block": i, "d": d} for i, b in enumerate(blocks) for d in b])
        sums = [b for b in L._block_sums(iter([moves])) if b.num_rows]
        flags = [r["covered"] for out in L._settled(iter(sums)) for r in out.to_pylist()]
        stock = 0
        for block, covered in zip(blocks, flags):
            refused = False
            for d in block:
                refused |= stock + d < 0
                stock += d if stock + d >= 0 else 0
            assert not (covered and refused)
