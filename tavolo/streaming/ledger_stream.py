"""Streaming ledger (L1): the batch fold as keyed state, resets as events.

Events arrive as files (``maxFilesPerTrigger`` bounds a micro-batch). A product
belongs to one of ``buckets`` groups, and a reset goes to all of them, so every
group counts the epochs for itself: ``transformWithStateInPandas`` keeps for
each group the epoch, the last seq, and each product's (epoch, stock, prices,
first_seq). No list of resets is needed beforehand, and none is kept.

A group's rows of one micro-batch are taken in the order of seq, a reset
before other events of equal seq; resets of equal seq are one. An event is *late* when
its group has seen a higher seq in an earlier micro-batch. Late events change nothing:
a late add or sale is refused with the reason ``late event``, a late reset is
passed over. So the decisions equal the batch job's on the events that came in time.
An event without a seq comes before all others, and is late once its group has seen any.

The state store and the offsets live in the checkpoint folder, so a restarted
query resumes exactly; the number of groups is part of the state and must
stay the same. Output: decision rows, appended.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tavolo.operators.ledger import DECISION_SCHEMA, fold_frame, normalize
from tavolo.sources.fixtures import SHOP_EVENT_SCHEMA

# fixed value: decision reason
LATE = "late event"

BUCKETS = 64
CLOCK_SCHEMA = "epoch long, last long"
PRODUCT_KEY, PRODUCT_SCHEMA = "product string", "epoch long, stock long, pp long, sp long, first_seq long"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
COLUMNS = ["seq", "epoch", "op", "basket_id", "product", "qty_c", "pp_c", "sp_c"]


NO_SEQ = -(1 << 63)


def _late_frame(rows: pd.DataFrame, epoch: int) -> pd.DataFrame:
    out = rows[["seq", "op", "basket_id", "product", "qty_c"]].assign(epoch=epoch, accepted=False, reason=LATE, stock_c=0)
    for c in ("pp_c", "sp_c", "spp_c", "ssp_c", "first_seq"):
        out[c] = pd.array([None] * len(out), dtype="Int64")
    return out[[f.name for f in DECISION_SCHEMA]]


class LedgerProcessor(StatefulProcessor):
    """One group of products: epochs counted from the resets it is sent, a state per product."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.clock = handle.getValueState("clock", CLOCK_SCHEMA)
        self.products = handle.getMapState("products", PRODUCT_KEY, PRODUCT_SCHEMA)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        epoch, last = self.clock.get() if self.clock.exists() else (0, NO_SEQ)
        first_batch = not self.clock.exists()
        frame = pd.concat(list(rows), ignore_index=True)  # a group's share of one micro-batch
        late = (frame["seq"] < last) | ((frame["seq"] == NO_SEQ) & (not first_batch))
        if late.any():
            yield _late_frame(frame[late & (frame["op"] != "reset")], epoch)
            frame = frame[~late]
        if frame.empty:
            return
        frame = frame.assign(_reset=(frame["op"] == "reset") & (frame["seq"] != NO_SEQ))
        frame = frame.sort_values(["seq", "_reset"], ascending=[True, False], kind="stable")
        again = frame["seq"].duplicated() | (False if first_batch else frame["seq"] == last)
        frame = frame[~(frame["_reset"] & again)]
        if frame.empty:
            return
        frame["epoch"] = epoch + frame["_reset"].cumsum()
        latest = int(frame["epoch"].iloc[-1])
        moves = frame[frame["op"] != "reset"].sort_values(["epoch", "product"], kind="stable")
        if not moves.empty:
            # only the first epoch of a micro-batch goes on from the state, and only its last one is kept
            entering = {(epoch, p): self._state(epoch, p) for p in moves.loc[moves["epoch"] == epoch, "product"].unique()}
            ended: dict[tuple, dict | None] = {}
            yield fold_frame(moves[COLUMNS].reset_index(drop=True), entering=entering, ended=ended)[2]
            for (of, product), state in ended.items():
                if of == latest and state is not None:
                    self.products.updateValue((product,), (latest, state["stock"], state["pp"], state["sp"], state["first_seq"]))
        if latest > epoch:
            for gone in [k for k, v in self.products.iterator() if v[0] < latest]:
                self.products.removeKey(gone)
        self.clock.update((latest, int(frame["seq"].iloc[-1])))

    def _state(self, epoch: int, product: str) -> dict | None:
        found = self.products.getValue((product,))
        if found is None or found[0] != epoch:
            return None
        return {"stock": int(found[1]), "pp": int(found[2]), "sp": int(found[3]), "first_seq": int(found[4])}

    def close(self) -> None:
        pass


def ledger_decisions_stream(events: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Streaming decisions from a streaming DataFrame of raw events, resets included."""
    cents = lambda c: (F.col(c) * 100).cast("bigint")
    n = normalize(events).filter(F.col("problem").isNull())
    group = F.when(F.col("op") == "reset", F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(
        F.array(F.pmod(F.xxhash64("product"), F.lit(buckets)).cast("int")))
    moves = n.select(
        F.explode(group).alias("bucket"), F.coalesce("seq", F.lit(NO_SEQ)).alias("seq"), "op", "basket_id", "product",
        cents("quantity").alias("qty_c"), cents("purchase_price").alias("pp_c"), cents("selling_price").alias("sp_c"))
    decided = moves.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=LedgerProcessor(), outputStructType=DECISION_SCHEMA, outputMode="Append", timeMode="None")
    return decided.withColumn("seq", F.nullif("seq", F.lit(NO_SEQ)))


def run_ledger_stream(spark: SparkSession, events_dir: str, out_dir: str, checkpoint_dir: str,
                      files_per_trigger: int = 1, buckets: int = BUCKETS) -> None:
    """Process every event file now available, then stop (``availableNow``)."""
    src = (spark.readStream.schema(SHOP_EVENT_SCHEMA).option("maxFilesPerTrigger", files_per_trigger)
           .parquet(events_dir))
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKS)  # keyed map state needs it
    try:
        q = (ledger_decisions_stream(src, buckets).writeStream.format("parquet")
             .option("path", out_dir).option("checkpointLocation", checkpoint_dir)
             .outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.set(name, before)


def stage_event_files(events: DataFrame, folder: str, steps: int = 3, files: int = 8) -> None:
    """Write the events as ``steps`` appends in the order of seq, each of ``files`` files
    written in parallel, so that the file source (oldest files first, ``files`` a micro-batch) replays
    the appends in order. Within an append the order does not matter."""
    at = [i / steps for i in range(1, steps)]
    bounds = events.agg(F.percentile_approx("seq", at, 10_000)).first()[0] or []
    step = F.when(F.col("seq").isNull(), 0).otherwise(sum(((F.col("seq") > b).cast("int") for b in bounds), F.lit(0)))
    for i in range(steps):
        events.filter(step == i).repartition(files).write.mode("append").parquet(folder)
