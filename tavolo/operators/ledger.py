"""Stock and sales ledger: the register's data job as a fold over an event
table (Q15; K1-K8, D12, D13, A8).

Events: ``(seq, op, basket_id, product, quantity, purchase_price,
selling_price)`` with ``op`` in ``add | sale | reset``.

* K1: names are ``lower(trim())``ed, numbers parsed exactly; events that
  can never be valid go to a quarantine with a reason.
* K7: ``epoch`` = number of resets up to the event, by an as-of step: all events
  are range-partitioned and sorted by seq once and written; an event's place among
  all events less its place among those that are no resets, plus the resets of
  earlier partitions (one number a partition), is its epoch. No reset list, no
  join on seq, nothing per event in Python.
* K2/K3: acceptance depends on earlier *accepted* sales (N35), so the fold is
  sequential per (epoch, product). Moves are range-partitioned on (key, seq) and
  walked partition by partition, batch by batch, carrying only the current
  key's state. A hot product spans several partitions; what it needs is its
  state where each of them begins. Its events are summed up in blocks: the net
  change, and the least stock at entry that covers every sale in it. Blocks
  compose, so one pass over these sums finds the blocks that are covered for certain
  (stock never falls below zero, and never below what accepting every sale
  leaves); such a block is one step. Only the others, which a refusal may lie in,
  are walked event by event. Amounts are exact integer cents inside the fold.
* K4/K5/K6: receipts, profits and stock are aggregates over the decisions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tavolo.functions.parse import parse_decimal
from tavolo.functions.text import left_pad, normalize_name
from tavolo.operators.ranking import global_rank
from tavolo.session import ensure_checkpoint_dir

# fixed values: decision reasons
UNKNOWN_PRODUCT = "unknown product"
INSUFFICIENT_STOCK = "insufficient stock"
INVALID_PRICE = "invalid price"
# fixed values: quarantine reasons
INVALID_QUANTITY = "invalid quantity"
MISSING_PRODUCT = "missing product"
UNKNOWN_OP = "unknown op"

AMOUNT = "decimal(38,2)"
MONEY = "decimal(38,4)"

DECISION_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("epoch", T.LongType()),
    T.StructField("op", T.StringType()),
    T.StructField("basket_id", T.LongType()),
    T.StructField("product", T.StringType()),
    T.StructField("qty_c", T.LongType()),
    T.StructField("accepted", T.BooleanType()),
    T.StructField("reason", T.StringType()),
    T.StructField("pp_c", T.LongType()),
    T.StructField("sp_c", T.LongType()),
    T.StructField("stock_c", T.LongType()),
    T.StructField("spp_c", T.LongType()),
    T.StructField("ssp_c", T.LongType()),
    T.StructField("first_seq", T.LongType()),
])


# ---------------------------------------------------------------- K1 normalize / validate

def normalize(events: DataFrame) -> DataFrame:
    """Typed events plus ``problem`` (null when the event is usable)."""
    op = F.lower(F.trim(F.col("op")))
    product = normalize_name(F.col("product"))
    qty = parse_decimal(F.col("quantity"))
    problem = (F.when(~op.isin("add", "sale", "reset") | op.isNull(), F.lit(UNKNOWN_OP))
               .when(op == "reset", F.lit(None).cast("string"))
               .when(product.isNull() | (product == ""), F.lit(MISSING_PRODUCT))
               .when(qty.isNull() | (qty <= 0), F.lit(INVALID_QUANTITY)))
    return events.select(
        F.col("seq").cast("bigint").alias("seq"), op.alias("op"),
        F.col("basket_id").cast("bigint").alias("basket_id"), product.alias("product"),
        qty.alias("quantity"), parse_decimal(F.col("purchase_price")).alias("purchase_price"),
        parse_decimal(F.col("selling_price")).alias("selling_price"), problem.alias("problem"))


def quarantine(events: DataFrame) -> DataFrame:
    """Events that can never take effect, with the reason."""
    n = normalize(events)
    return n.filter(F.col("problem").isNotNull()).select(
        "seq", "op", "basket_id", "product", F.col("problem").alias("reason"))


# ---------------------------------------------------------------- K7 epochs

# monotonically_increasing_id: the partition above, the place in it below
PART_SHIFT = 33
PLACE_BITS = (1 << PART_SHIFT) - 1


def with_epoch(events: DataFrame) -> DataFrame:
    """``events`` plus ``epoch``: the number of different resets with seq <= the
    event's seq. Resets of equal seq are one, and stay as one row; events without a seq
    have epoch 0, and a reset without one changes nothing. The result is written, so
    it can be read several times."""
    ensure_checkpoint_dir(events.sparkSession)
    is_reset = F.coalesce((F.col("op") == "reset") & F.col("seq").isNotNull(), F.lit(False))
    once = events.filter(~is_reset).unionByName(events.filter(is_reset).dropDuplicates(["seq"]))
    placed = (once.repartitionByRange("seq").sortWithinPartitions(F.col("seq").asc_nulls_first(), is_reset.desc())
              .withColumn("_mid", F.monotonically_increasing_id()).checkpoint(eager=True))
    part = F.shiftright(F.col("_mid"), PART_SHIFT)
    counts = placed.groupBy(part.alias("_part")).agg(F.count_if(is_reset).alias("_resets"))
    before = F.sum("_resets").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = F.broadcast(counts.select("_part", F.coalesce(before, F.lit(0)).alias("_before")))  # one row a partition

    def numbered(rows: DataFrame) -> DataFrame:
        """The rows with their place among themselves in their partition, which the filter leaves in order."""
        return (rows.withColumn("_among", F.monotonically_increasing_id().bitwiseAND(F.lit(PLACE_BITS)))
                .join(offsets, part == F.col("_part")))

    moves = numbered(placed.filter(~is_reset)).withColumn("epoch", F.col("_before") + F.col("_mid").bitwiseAND(F.lit(PLACE_BITS)) - F.col("_among"))
    resets = numbered(placed.filter(is_reset)).withColumn("epoch", F.col("_before") + F.col("_among") + 1)
    return moves.unionByName(resets).select(*events.columns, "epoch").checkpoint(eager=True)


def live_events(events: DataFrame) -> DataFrame:
    """The usable events, normalized, with their epochs; written once for all reports."""
    return with_epoch(normalize(events).filter(F.col("problem").isNull()))


def _live(events: DataFrame) -> DataFrame:
    return events if "epoch" in events.columns else live_events(events)


# ---------------------------------------------------------------- K2/K3 the fold

def step(state: dict | None, op: str, qty: int, pp: int | None, sp: int | None, seq: int):
    """One register command on one product's state (cents).

    Returns (new_state, accepted, reason, unit_pp, unit_sp). ``state`` is None
    while the product is unknown in the epoch.
    """
    if op == "add":
        if state is None:
            if pp is None or sp is None:
                return None, False, INVALID_PRICE, None, None
            state = {"stock": qty, "pp": pp, "sp": sp, "first_seq": seq}
            return state, True, None, pp, sp
        state["stock"] += qty  # a known product keeps its first prices (N34)
        return state, True, None, state["pp"], state["sp"]
    if state is None:
        return None, False, UNKNOWN_PRODUCT, None, None
    if state["stock"] >= qty:
        state["stock"] -= qty
        return state, True, None, state["pp"], state["sp"]
    return state, False, INSUFFICIENT_STOCK, None, None


# runs of one key at least this long take the vectorized path
VECTOR_MIN = 64
# events per cumulative-sum window of the vectorized path (bounds the cost of a restart)
VECTOR_WINDOW = 8192


def _scalar_run(state, is_add, qty, pp, sp, seq, out, lo, hi):
    """The plain step loop over positions lo..hi-1 of one key's run."""
    for i in range(lo, hi):
        p = None if out["_pp_null"][i] else int(pp[i])
        q = None if out["_sp_null"][i] else int(sp[i])
        state, ok, reason, upp, usp = step(state, "add" if is_add[i] else "sale", int(qty[i]), p, q, int(seq[i]))
        _record(out, i, state, ok, reason, upp, usp)
    return state


def _record(out, i, state, ok, reason, upp, usp):
    out["accepted"][i] = ok
    out["reason"][i] = reason
    if upp is not None:
        out["pp_c"][i], out["_upp_ok"][i] = upp, True
        out["sp_c"][i], out["_usp_ok"][i] = usp, True
    if state is not None:
        out["stock_c"][i] = state["stock"]
        out["spp_c"][i], out["ssp_c"][i], out["first_seq"][i] = state["pp"], state["sp"], state["first_seq"]
        out["_state_ok"][i] = True


def _undecided(n, pp_null, sp_null):
    return {
        "accepted": np.zeros(n, dtype=bool), "reason": np.full(n, None, dtype=object),
        "pp_c": np.zeros(n, dtype=np.int64), "sp_c": np.zeros(n, dtype=np.int64),
        "_upp_ok": np.zeros(n, dtype=bool), "_usp_ok": np.zeros(n, dtype=bool),
        "stock_c": np.zeros(n, dtype=np.int64), "spp_c": np.zeros(n, dtype=np.int64),
        "ssp_c": np.zeros(n, dtype=np.int64), "first_seq": np.zeros(n, dtype=np.int64),
        "_state_ok": np.zeros(n, dtype=bool), "_pp_null": pp_null, "_sp_null": sp_null,
    }


def fold_run(state, is_add, qty, pp, sp, seq, pp_null, sp_null,
             vector_min: int = VECTOR_MIN, window: int = VECTOR_WINDOW):
    """Decisions for one key's events in seq order; exact same results as
    applying ``step`` event by event.

    Long runs use a vectorized path: while the product is known, stock after
    each event is ``stock + cumsum(+add / -sale)`` as long as every sale is
    covered; the first sale that is not covered is refused, and the sum
    restarts after it (within a bounded window). Short runs, and stretches
    where refusals come thick and fast, use the scalar loop.
    """
    n = len(qty)
    out = _undecided(n, pp_null, sp_null)
    if n < vector_min:
        return _scalar_run(state, is_add, qty, pp, sp, seq, out, 0, n), out
    valid_add = is_add & ~pp_null & ~sp_null
    i = 0
    while i < n:
        if state is None:
            rest = np.flatnonzero(valid_add[i:])
            j = i + int(rest[0]) if len(rest) else n
            out["reason"][i:j] = np.where(is_add[i:j], INVALID_PRICE, UNKNOWN_PRODUCT)
            if j == n:
                break
            state = {"stock": int(qty[j]), "pp": int(pp[j]), "sp": int(sp[j]), "first_seq": int(seq[j])}
            _record(out, j, state, True, None, state["pp"], state["sp"])
            i = j + 1
            continue
        hi = min(n, i + window)
        d = np.where(is_add[i:hi], qty[i:hi], -qty[i:hi])
        after = state["stock"] + np.cumsum(d)
        before = after - d
        bad = np.flatnonzero(~is_add[i:hi] & (before < qty[i:hi]))
        k = int(bad[0]) if len(bad) else hi - i
        seg = slice(i, i + k)
        out["accepted"][seg] = True
        out["stock_c"][seg] = after[:k]
        out["pp_c"][seg], out["sp_c"][seg] = state["pp"], state["sp"]
        out["_upp_ok"][seg] = out["_usp_ok"][seg] = True
        if len(bad) == 0:
            state["stock"] = int(after[-1])
            lo = i + k
        else:
            state["stock"] = int(before[k])
            out["reason"][i + k] = INSUFFICIENT_STOCK
            lo = i + k + 1
        last = lo
        out["spp_c"][i:last], out["ssp_c"][i:last] = state["pp"], state["sp"]
        out["first_seq"][i:last], out["_state_ok"][i:last] = state["first_seq"], True
        out["stock_c"][i + k:last] = state["stock"]
        i = last
        if len(bad) and k < 8:
            # refusals close together: a scalar stretch is cheaper than restarts
            hi2 = min(n, i + 64)
            state = _scalar_run(state, is_add, qty, pp, sp, seq, out, i, hi2)
            i = hi2
    return state, out


def _nullable(values, ok):
    return pd.arrays.IntegerArray(values.astype(np.int64), ~ok)


def fold_frame(pdf: pd.DataFrame, key=None, state=None, entering: dict | None = None, ended: dict | None = None):
    """Decisions for a pandas frame of events sorted by (epoch, product, seq);
    ``key``/``state`` carry the last key's state in from an earlier frame, ``entering``
    the states of other keys; ``ended`` is given each key's last state.
    Returns (key, state, decision frame)."""
    epoch = pdf["epoch"].to_numpy()
    product = pdf["product"].to_numpy(dtype=object)
    change = np.ones(len(pdf), dtype=bool)
    change[1:] = (epoch[1:] != epoch[:-1]) | (product[1:] != product[:-1])
    starts = np.flatnonzero(change).tolist() + [len(pdf)]
    is_add = (pdf["op"] == "add").to_numpy()
    qty = pdf["qty_c"].to_numpy(dtype=np.int64)
    pp_null = pdf["pp_c"].isna().to_numpy()
    sp_null = pdf["sp_c"].isna().to_numpy()
    pp = pdf["pp_c"].fillna(0).to_numpy(dtype=np.int64)
    sp = pdf["sp_c"].fillna(0).to_numpy(dtype=np.int64)
    seq = pdf["seq"].to_numpy(dtype=np.int64)
    cat = _undecided(len(pdf), pp_null, sp_null)  # one set of columns for all keys, most of which are short
    for a, b in zip(starts[:-1], starts[1:]):
        k = (epoch[a], product[a])
        if k != key:
            key, state = k, (entering or {}).get(k)
        if b - a < VECTOR_MIN:
            state = _scalar_run(state, is_add, qty, pp, sp, seq, cat, a, b)
        else:
            state, o = fold_run(state, is_add[a:b], qty[a:b], pp[a:b], sp[a:b], seq[a:b],
                                pp_null[a:b], sp_null[a:b])
            for c in o:
                cat[c][a:b] = o[c]
        if ended is not None:
            ended[k] = state
    frame = pd.DataFrame({
        "seq": seq, "epoch": epoch, "op": pdf["op"].to_numpy(dtype=object),
        "basket_id": pd.array(pdf["basket_id"], dtype="Int64"),
        "product": product, "qty_c": qty, "accepted": cat["accepted"], "reason": cat["reason"],
        "pp_c": _nullable(cat["pp_c"], cat["_upp_ok"]), "sp_c": _nullable(cat["sp_c"], cat["_usp_ok"]),
        "stock_c": np.where(cat["_state_ok"], cat["stock_c"], 0),
        "spp_c": _nullable(cat["spp_c"], cat["_state_ok"]), "ssp_c": _nullable(cat["ssp_c"], cat["_state_ok"]),
        "first_seq": _nullable(cat["first_seq"], cat["_state_ok"]),
    })
    return key, state, frame


def _fold_partition(entries):
    """One sorted partition, batch by batch; only the current key's state
    crosses a batch boundary. ``entries`` (broadcast) holds the state of a
    partition's first key where that key began in an earlier partition."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = state = None
        for pdf in batches:
            if pdf.empty:
                continue
            if key is None:
                entry = entries.value.get(int(pdf["_mid"].iloc[0]) >> PART_SHIFT)
                if entry is not None:
                    key, state = (pdf["epoch"].iloc[0], pdf["product"].iloc[0]), dict(entry)
            key, state, frame = fold_frame(pdf, key, state)
            yield frame

    return run


def _cents(c: Column) -> Column:
    return (c * 100).cast("bigint")


def _from_cents(c: str) -> Column:
    return (F.col(c).cast(AMOUNT) / F.lit(100)).cast(AMOUNT)


KEYS = ["epoch", "product"]
# rows of a sorted partition whose moves are summed up together, as a power of two
BLOCK_SHIFT = 13
KEY_FIELDS = "epoch long, product string"


def _key_runs(batch: pa.RecordBatch, *more: str) -> Iterator[tuple]:
    """(key, first row, end) of the runs of equal keys (and ``more``) in a batch."""
    if not batch.num_rows:
        return
    epoch, product = batch.column("epoch").to_numpy(), np.array(batch.column("product").to_pylist(), dtype=object)
    change = np.ones(batch.num_rows, bool)
    change[1:] = (epoch[1:] != epoch[:-1]) | (product[1:] != product[:-1])
    for c in more:
        v = batch.column(c).to_numpy(zero_copy_only=False)
        change[1:] |= v[1:] != v[:-1]
    starts = np.flatnonzero(change)
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows]):
        yield (int(epoch[a]), product[a]), a, b


def _rows(rows: list[tuple], **kinds) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values())], names=list(kinds))


_LONG, _TEXT, _FLAG = pa.int64(), pa.string(), pa.bool_()


def _block_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per key and block, in order: net change, and ``low``: the deepest point below the
    entry after a sale, if all sales are accepted (0 if none)."""
    current, net, low = None, 0, 0
    for batch in batches:
        done = []
        for key, a, b in _key_runs(batch, "block"):
            at = (*key, batch.column("block")[a].as_py())
            if at != current:
                if current is not None:
                    done.append((*current, net, low))
                current, net, low = at, 0, 0
            d = batch.column("d").to_numpy()[a:b]
            run = net + np.cumsum(d)
            if (d < 0).any():
                low = min(low, int(run[d < 0].min()))
            net = int(run[-1])
        yield _rows(done, epoch=_LONG, product=_TEXT, block=_LONG, net=_LONG, low=_LONG)
    yield _rows([] if current is None else [(*current, net, low)], epoch=_LONG, product=_TEXT, block=_LONG, net=_LONG, low=_LONG)


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks of each key in order: is every sale covered, whatever the blocks before left over?

    ``least`` is what the stock is at the least: it grows by the net change, and never lies
    below what is left when it was 0 at the deepest point.
    """
    current, least = None, 0
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if (r["epoch"], r["product"]) != current:
                current, least = (r["epoch"], r["product"]), 0
            covered = least + r["low"] >= 0
            least = r["net"] + max(least, -r["low"])
            out.append((r["epoch"], r["product"], r["block"], r["net"], covered))
        yield _rows(out, epoch=_LONG, product=_TEXT, block=_LONG, net=_LONG, covered=_FLAG)


def _entry_stocks(block_shift: int):
    """The stock of each key where each partition begins. Rows, in order: a covered block's net change, or a move (``at`` >= 0)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, part, stock = None, None, 0
        for batch in batches:
            out = []
            for key, a, b in _key_runs(batch, "block", "is_move"):
                if key != current:
                    current, part, stock = key, None, 0
                here = batch.column("block")[a].as_py() >> (PART_SHIFT - block_shift)
                if here != part:
                    if part is not None:
                        out.append((*key, here, stock))
                    part = here
                d = batch.column("d").to_numpy()[a:b]
                if not batch.column("is_move")[a].as_py():
                    stock += int(d.sum())
                    continue
                for change in d.tolist():
                    if stock + change >= 0:
                        stock += change
            yield _rows(out, epoch=_LONG, product=_TEXT, part=_LONG, stock=_LONG)

    return run


def _entries(placed: DataFrame, block_shift: int) -> dict[int, dict]:
    """{partition: state of its first key at its begin}, for keys that span partitions.

    On the driver: a few values a partition, never a list of events or products.
    """
    spark = placed.sparkSession
    part = F.shiftright(F.col("_mid"), PART_SHIFT)
    key = F.struct(*KEYS)
    ends = sorted(placed.groupBy(part.alias("part")).agg(F.min(key).alias("first"), F.max(key).alias("last")).collect(), key=lambda r: r["part"])
    spanning = {tuple(b["first"]) for a, b in zip(ends, ends[1:]) if a["last"] == b["first"]}
    if not spanning:
        return {}
    keys = F.broadcast(spark.createDataFrame(sorted(spanning), placed.select(*KEYS).schema))
    hot = placed.join(keys, KEYS, "left_semi")
    first = (hot.filter((F.col("op") == "add") & F.col("pp_c").isNotNull() & F.col("sp_c").isNotNull()).groupBy(*KEYS)
             .agg(F.min_by(F.struct("_mid", "seq", "pp_c", "sp_c"), "_mid").alias("_f")).checkpoint(eager=True))  # one row a spanning key
    # from its first valid add on a product is known, with stock 0 before that add
    signed = (hot.join(F.broadcast(first), KEYS).filter(F.col("_mid") >= F.col("_f._mid"))
              .select(*KEYS, F.shiftright(F.col("_mid"), block_shift).alias("block"), "_mid",
                      F.when(F.col("op") == "add", F.col("qty_c")).otherwise(-F.col("qty_c")).alias("d")))
    sums = signed.select(*KEYS, "block", "d").mapInArrow(_block_sums, f"{KEY_FIELDS}, block long, net long, low long")
    blocks = (sums.repartition(*KEYS).sortWithinPartitions(*KEYS, "block")
              .mapInArrow(_settled, f"{KEY_FIELDS}, block long, net long, covered boolean").checkpoint(eager=True))
    open_ = blocks.filter(~F.col("covered")).select(*KEYS, "block")
    steps = (blocks.filter("covered").select(*KEYS, "block", F.lit(-1).cast("long").alias("at"), F.lit(False).alias("is_move"), F.col("net").alias("d"))
             .unionByName(signed.join(open_, [*KEYS, "block"], "left_semi").select(*KEYS, "block", F.col("_mid").alias("at"), F.lit(True).alias("is_move"), "d")))
    stocks = (steps.repartition(*KEYS).sortWithinPartitions(*KEYS, "block", "at")
              .mapInArrow(_entry_stocks(block_shift), f"{KEY_FIELDS}, part long, stock long").join(F.broadcast(first), KEYS))
    return {r["part"]: {"stock": r["stock"], "pp": r["_f"]["pp_c"], "sp": r["_f"]["sp_c"], "first_seq": r["_f"]["seq"]} for r in stocks.collect()}


def decisions(events: DataFrame, num_partitions: int | None = None, block_shift: int = BLOCK_SHIFT) -> DataFrame:
    """Every valid add/sale with its outcome, in amounts (K2, K3). ``events`` are raw,
    or ``live_events``. Without an explicit count AQE sizes the partitions."""
    moves = _live(events).filter(F.col("op").isin("add", "sale")).select(
        "seq", "epoch", "op", "basket_id", "product", _cents(F.col("quantity")).alias("qty_c"),
        _cents(F.col("purchase_price")).alias("pp_c"), _cents(F.col("selling_price")).alias("sp_c"))
    order = [*KEYS, "seq"]
    ranged = moves.repartitionByRange(num_partitions, *order) if num_partitions else moves.repartitionByRange(*order)
    placed = (ranged.sortWithinPartitions(*order, "op", "basket_id", "qty_c", "pp_c", "sp_c")
              .withColumn("_mid", F.monotonically_increasing_id()).checkpoint(eager=True))
    entries = placed.sparkSession.sparkContext.broadcast(_entries(placed, block_shift))
    folded = placed.mapInPandas(_fold_partition(entries), DECISION_SCHEMA)
    return folded.select(
        "seq", "epoch", "op", "basket_id", "product", _from_cents("qty_c").alias("quantity"),
        "accepted", "reason", _from_cents("pp_c").alias("purchase_price"),
        _from_cents("sp_c").alias("selling_price"), _from_cents("stock_c").alias("stock"),
        _from_cents("spp_c").alias("state_purchase_price"), _from_cents("ssp_c").alias("state_selling_price"),
        "first_seq")


# ---------------------------------------------------------------- K3-K8 reports

def sales(dec: DataFrame) -> DataFrame:
    """One row per sale line; unit prices only on accepted lines (K3)."""
    return dec.filter(F.col("op") == "sale").select(
        "seq", "epoch", "basket_id", "product", "quantity", "accepted", "reason",
        F.when(F.col("accepted"), F.col("selling_price")).alias("selling_price"),
        F.when(F.col("accepted"), F.col("purchase_price")).alias("purchase_price"))


def receipts(sale_lines: DataFrame) -> DataFrame:
    """Per basket: gross, cost of goods, net; all-refused baskets give 0."""
    acc = F.col("accepted")
    gross = F.sum(F.when(acc, F.col("quantity") * F.col("selling_price")))
    cost = F.sum(F.when(acc, F.col("quantity") * F.col("purchase_price")))
    zero = F.lit(0).cast(MONEY)
    out = sale_lines.groupBy("epoch", "basket_id").agg(
        F.coalesce(gross.cast(MONEY), zero).alias("gross"),
        F.coalesce(cost.cast(MONEY), zero).alias("cost"),
        F.count_if(acc).alias("accepted_lines"), F.count(F.lit(1)).alias("lines"))
    return out.withColumn("net", (F.col("gross") - F.col("cost")).cast(MONEY))


def profits(receipt_rows: DataFrame, events: DataFrame) -> DataFrame:
    """Gross and net per epoch; the latest epoch is the register's current
    report (K5, D13). Epochs without sales report 0."""
    epochs = _live(events).select("epoch").distinct()
    sums = receipt_rows.groupBy("epoch").agg(F.sum("gross").alias("g"), F.sum("net").alias("n"))
    latest = epochs.agg(F.max("epoch")).first()[0]
    zero = F.lit(0).cast(MONEY)
    return (epochs.join(sums, "epoch", "left")
            .select("epoch", F.coalesce(F.col("g").cast(MONEY), zero).alias("gross_profit"),
                    F.coalesce(F.col("n").cast(MONEY), zero).alias("net_profit"),
                    (F.col("epoch") == F.lit(latest)).alias("is_current")))


def stock(dec: DataFrame) -> DataFrame:
    """Final state of every product known in each epoch (K6)."""
    last = dec.filter(F.col("first_seq").isNotNull()).groupBy("epoch", "product").agg(
        F.max_by(F.struct("stock", "state_purchase_price", "state_selling_price", "first_seq"),
                 F.col("seq")).alias("s"))
    return last.select("epoch", "product", F.col("s.stock").alias("quantity"),
                       F.col("s.state_purchase_price").alias("purchase_price"),
                       F.col("s.state_selling_price").alias("selling_price"),
                       F.col("s.first_seq").alias("first_seq"))


# fixed values: the catalog header line
CATALOG_HEADER = "Product          Quantity         Purchase Price        Selling Price"


def catalog_lines(stock_rows: DataFrame) -> DataFrame:
    """The fixed-width catalog of the latest epoch: (line_no, line); line 0
    is the header, products follow in insertion order (A8, K8, N33)."""
    latest = stock_rows.agg(F.max("epoch").alias("epoch"))
    cur = stock_rows.join(latest, "epoch")
    ranked = global_rank(cur, [F.col("first_seq").asc()], "r")
    body = ranked.select(
        (F.col("r") + 1).alias("line_no"),
        F.concat_ws(" ", left_pad(F.col("product"), 17), left_pad(F.col("quantity").cast("string"), 17),
                    left_pad(F.col("purchase_price").cast("string"), 20),
                    F.col("selling_price").cast("string")).alias("line"))
    header = latest.select(F.lit(0).cast("bigint").alias("line_no"), F.lit(CATALOG_HEADER).alias("line"))
    return header.unionByName(body)
