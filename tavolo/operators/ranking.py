"""Distributed global rank and exact group quantiles.

``global_rank`` numbers rows in a total order without a one-partition
window: range-partition on the order, sort inside each partition, take the
position inside the partition from ``monotonically_increasing_id`` and add
the row count of all earlier partitions (a table of one row per partition).
The sorted data is checkpointed to the cluster's checkpoint folder first, so
both passes (counts and positions) read the very same partitions and the job
survives executor loss.

``group_quantiles`` gives exact, linearly interpolated quantiles per group
(pandas / ``quantile_cont`` semantics) from that rank: a group's values are
spread over as many partitions as the range partitioner gives them, so a hot
group with a third of all rows never sits in one task or one buffer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tavolo.session import ensure_checkpoint_dir

_LOW_BITS = (1 << 33) - 1


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "rank",
                num_partitions: int | None = None) -> DataFrame:
    """``df`` plus a 0-based ``name`` column: the row's place in ``order``.

    Ties get distinct, arbitrary places, as ``row_number`` does.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    # without an explicit count, AQE sizes the range partitions to the data
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    placed = (ranged.sortWithinPartitions(*order)
              .withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    part = F.shiftright(F.col("_mid"), 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.select(
        "_part",
        F.coalesce(F.sum("_cnt").over(Window.orderBy("_part").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    return (placed.join(F.broadcast(offsets), part == offsets["_part"])
            .withColumn(name, F.col("_off") + F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)))
            .drop("_mid", "_part", "_off"))


def group_quantiles(df: DataFrame, groups: Sequence[str], value: str,
                    probs: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per (group, p):
    columns ``*groups, p, q``. Null values are ignored; empty groups absent."""
    base = df.select(*groups, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    # equal values become one row with their count before anything is ordered
    ensure_checkpoint_dir(df.sparkSession)
    counted = (base.groupBy(*groups, "_v").agg(F.count(F.lit(1)).alias("_c"))
               .withColumn("_g", F.to_json(F.struct(*groups))).checkpoint(eager=True))
    run = global_cumsum(counted.select("_g", "_v", "_c"), ["_g"], "_v", "_c", "_cum")
    sizes = counted.groupBy("_g", *groups).agg(F.sum("_c").alias("_n"))
    h = (F.col("_n") - 1) * F.col("p")
    need = (sizes.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
            .withColumn("_h", h).withColumn("_lo", F.floor(h).cast("bigint"))
            .withColumn("_k", F.explode(F.array_distinct(F.array(F.floor(h).cast("bigint"), F.ceil(h).cast("bigint")))))
            .withColumnRenamed("_g", "_of"))
    # the value at place k is the one whose run of places holds k
    vals = need.join(run, (F.col("_of") == F.col("_g")) & (F.col("_k") >= F.col("_cum") - F.col("_c")) & (F.col("_k") < F.col("_cum")))
    agg = vals.groupBy("_of", *groups, "p", "_h", "_lo").agg(
        F.max(F.when(F.col("_k") == F.col("_lo"), F.col("_v"))).alias("_xlo"),
        F.max("_v").alias("_xhi"))
    return agg.select(*groups, "p",
                      (F.col("_xlo") + (F.col("_h") - F.col("_lo")) * (F.col("_xhi") - F.col("_xlo"))).alias("q"))


def global_cumsum(df: DataFrame, keys: Sequence[str], order: str, value: str, name: str = "cumsum",
                  num_partitions: int | None = None) -> DataFrame:
    """``df`` plus ``name`` = running sum of ``value`` per key in ``order``
    (inclusive), without putting a key into one task.

    Rows are range-partitioned on (keys, order), so a hot key spans many
    partitions. Inside a partition a ``mapInPandas`` step keeps the running
    sum per key (batch to batch); each (partition, key) total then yields the
    carry from the key's earlier partitions (a window over one row per
    partition and key). The sorted data is checkpointed first, so both passes
    see the same partitions.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    by = [*keys, order]
    ranged = df.repartitionByRange(num_partitions, *by) if num_partitions else df.repartitionByRange(*by)
    placed = (ranged.sortWithinPartitions(*by)
              .withColumn("_part", F.spark_partition_id().cast("bigint"))
              .checkpoint(eager=True))
    schema = T.StructType(list(placed.schema.fields) + [T.StructField("_local", T.LongType())])

    def local(batches):
        last_key, carry = None, 0
        for pdf in batches:
            if pdf.empty:
                continue
            kdf = pdf[list(keys)]
            grp = (kdf != kdf.shift()).any(axis=1).cumsum()
            run = pdf[value].astype("int64").groupby(grp).cumsum()
            first = tuple(kdf.iloc[0])
            if last_key == first:
                run = run + (grp == grp.iloc[0]) * carry
            last_key, carry = tuple(kdf.iloc[-1]), int(run.iloc[-1])
            yield pdf.assign(_local=run.to_numpy())

    with_local = placed.mapInPandas(local, schema)
    totals = placed.groupBy("_part", *keys).agg(F.sum(value).alias("_tot"))
    w = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carries = totals.select("_part", *keys, F.coalesce(F.sum("_tot").over(w), F.lit(0)).alias("_carry"))
    return (with_local.join(carries, ["_part", *keys])
            .withColumn(name, F.col("_carry") + F.col("_local"))
            .drop("_part", "_local", "_carry"))
