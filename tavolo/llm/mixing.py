"""Mixing sources to target weights by balanced sampling (the cube method).

Every source gets a target number of words. A document of a source whose
target is ``r`` times its size is taken ``floor(r)`` times, and once more with
probability ``r - floor(r)``. The extra copies are drawn by the cube method:
the fractional inclusion probabilities move along the null space of the two
balancing constraints (documents, words) until they are 0 or 1, so both totals
stay what they were.

The flight runs in blocks of about ``BLOCK`` documents of one source, each
block on its own. A block leaves at most two documents undecided; those of all
blocks meet in new blocks, and so on until one block per source is left. There
a dozen documents (six of them the largest) stay out of the flight and form, with the last undecided
ones, the landing problem: of all their subsets with the right document count
(within one), the one whose words come nearest to the target is taken.

Defined results: null text has size 0; documents of size 0 are drawn like the
others and take 0 words; a null source is a source of its own, the last one;
equal rows are drawn separately, and numbered so that they spread over the
blocks like different ones; ties of size and probability fall by that number; a
table without words has targets 0; an empty table gives an empty result. The draw
depends on the rows alone (document id and text), not on their order or
partitions. Texts are only counted here, however long. Input columns may have any
names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tavolo.llm.shared import table, word_count, written

#: Weights of the sources in order, repeating. Fixed by the query's contract.
WEIGHTS = (3, 1, 2)
#: All targets together, as a share of all sizes; a source's target is at most this many times its size.
TOTAL_SHARE, MOST = 1.5, 2.0
#: Documents in a block of the flight, about.
BLOCK = 1024
#: Documents of a source kept for the landing, which tries all their subsets with the two that the flight leaves.
RESERVE = 12
#: Source tables up to this size (rows, characters of names) are broadcast.
SMALL_SOURCES, SMALL_NAMES = 20_000, 2_000_000


def source_targets(units: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = TOTAL_SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target), one row per source.

    Targets are proportional to the weights up to ``most`` times the source's
    size. In order of that bound per weight, the first source whose bound lies
    above the level that the rest would share sets the level for all after it.
    The windows run over one row per source.
    """
    sizes = units.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    order = Window.orderBy("bound", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    level = ((share * F.sum("source_size").over(everything) - F.coalesce(F.sum(most * F.col("source_size")).over(before), F.lit(0.0)))
             / F.sum("weight").over(after))
    return (sizes.withColumn("weight", weight).withColumn("bound", most * F.col("source_size") / F.col("weight"))
            .withColumn("level", level).withColumn("place", F.row_number().over(order))  # equal bounds: the first of them
            .withColumn("level", F.min_by("level", F.when(F.col("bound") > F.col("level"), F.col("place"))).over(everything))
            .select("source", "source_size",
                    F.least(most * F.col("source_size"), F.coalesce(F.col("level") * F.col("weight"), F.lit(float("inf")))).alias("target")))


def flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move the probabilities until at most two are fractional.

    Three fractional units at a time: the cross product of (1, 1, 1) and their
    sizes keeps both totals. Equal sizes leave more freedom: then two units
    exchange probability.
    """
    x, s = p.astype(float).tolist(), size.astype(float).tolist()
    draws = iter(rng.random(2 * len(x) + 8).tolist())
    active: list[int] = []

    def move(units: list[int], u: list[float]) -> None:
        up = min((1 - x[i]) / d if d > 0 else x[i] / -d for i, d in zip(units, u) if d)
        down = min(x[i] / d if d > 0 else (1 - x[i]) / -d for i, d in zip(units, u) if d)
        step = up if next(draws) * (up + down) < down else -down
        for i, d in zip(units, u):
            x[i] += step * d
            if x[i] < 1e-9 or x[i] > 1 - 1e-9:
                x[i] = round(x[i])

    for i in range(len(x)):
        if not 0 < x[i] < 1:
            continue
        active.append(i)
        if len(active) < 3:
            continue
        a, b, c = active
        u = [s[c] - s[b], s[a] - s[c], s[b] - s[a]]
        widest = max(map(abs, u))
        move(active, [d / widest for d in u] if widest else [1.0, -1.0, 0.0])
        active = [i for i in active if 0 < x[i] < 1]
    if len(active) == 2 and s[active[0]] == s[active[1]]:
        move(active, [1.0, -1.0])
        active = [i for i in active if 0 < x[i] < 1]
    return np.array(x)


def landing(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """0 or 1 for each of a few units: the document total within one, then the words nearest to theirs."""
    picks = (np.arange(1 << len(p))[:, None] >> np.arange(len(p))) & 1
    documents = np.abs(picks.sum(1) - p.sum())
    words = np.abs(picks @ size.astype(float) - p @ size)
    return picks[np.lexsort((documents, words, documents >= 1))[0]].astype(float)


def fly_and_land(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The flight of all but ``RESERVE`` fractional units, then the landing of these and what the flight left.

    Half of the reserve are the largest units, which a flight would leave open at the greatest cost.
    """
    x = p.astype(float).copy()
    flying = np.ones(len(x), bool)
    open_ = np.flatnonzero((x > 0) & (x < 1))
    largest = open_[np.argsort(-size[open_], kind="stable")[:RESERVE // 2]]
    flying[largest] = False
    flying[open_[flying[open_]][:RESERVE - len(largest)]] = False
    x[flying] = flight(x[flying], size[flying], rng)
    rest = (x > 0) & (x < 1)
    x[rest] = landing(x[rest], size[rest])
    return x


def _flight_of_group(last: bool):
    def fly(block: pa.Table) -> pa.Table:
        order = np.lexsort((block["size"].to_numpy(), block["__key"].to_numpy()))
        block = block.take(pa.array(order))
        seed = [int(block["__block"][0].as_py()) & 0xFFFFFFFF, int(block["__round"][0].as_py()), int(block["__sid"][0].as_py()) & 0xFFFFFFFF]
        x = (fly_and_land if last else flight)(block["__p"].to_numpy(), block["size"].to_numpy(), np.random.default_rng(seed))
        return block.set_column(block.schema.get_field_index("__p"), "__p", pa.array(x, pa.float64()))

    return fly


def cube_copies(units: DataFrame, block: int = BLOCK) -> DataFrame:
    """``units`` (source, size and any other columns) with source_size, target, copies and taken.

    ``units`` also holds ``__key``, a long that spreads the rows of a source evenly.
    """
    spark = units.sparkSession
    units = written(units, "mix-units")
    targets = written(source_targets(units), "mix-targets")
    n_sources, n_chars = targets.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("source")), F.lit(0))).first()
    side = targets.withColumnRenamed("source", "__source")
    if n_sources <= SMALL_SOURCES and n_chars <= SMALL_NAMES:
        side = F.broadcast(side)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    start = (units.join(side, units["source"].eqNullSafe(F.col("__source"))).drop("__source")
             .withColumn("__ratio", ratio).withColumn("__base", F.floor("__ratio").cast("int"))
             .withColumn("__p", F.col("__ratio") - F.col("__base"))
             .withColumn("__sid", F.xxhash64("source")).drop("__ratio"))
    columns = start.columns
    open_units, done, round_no = start, [], 0
    undecided = (F.col("__p") > 0) & (F.col("__p") < 1)
    while True:
        # Undecided units of each source: one row per source, as small as the source table.
        counts = open_units.where(undecided).groupBy("source").agg(F.count(F.lit(1)).alias("__n"))
        counts = written(counts.withColumnRenamed("source", "__source"), "mix-counts")
        most = counts.agg(F.max("__n")).first()[0] or 0
        last = most <= block
        blocks = (F.broadcast(counts) if n_sources <= SMALL_SOURCES and n_chars <= SMALL_NAMES else counts)
        done.append(open_units.where(~undecided).select(columns))
        if most == 0:
            break
        dealt = (open_units.where(undecided).join(blocks, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
                 .withColumn("__round", F.lit(round_no))
                 .withColumn("__block", F.pmod(F.xxhash64("__key", F.lit(round_no)), F.ceil(F.col("__n") / block)).cast("long"))
                 .drop("__n"))
        flown = dealt.groupBy("__sid", "__block").applyInArrow(_flight_of_group(last), dealt.schema)
        flown = written(flown.select(columns), f"mix-round{round_no}")
        if last:
            done.append(flown)
            break
        open_units, round_no = flown, round_no + 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return (out.withColumn("copies", (F.col("__base") + F.round("__p")).cast("int"))
            .withColumn("taken", F.col("copies") * F.col("size"))
            .drop("__sid", "__base", "__p", "__key"))


def unit_key(doc_id: str, text: str):
    """Spreads the rows evenly; equal rows have the same one until they are numbered."""
    return F.xxhash64(F.lit("mix"), F.col(f"`{doc_id}`"), F.col(f"`{text}`"))


def numbered(units: DataFrame) -> DataFrame:
    """``units`` with a ``__key`` of its own for each of several equal rows.

    Rows with equal keys are interchangeable, so any numbering of them gives the same
    draw: each part of the written table numbers its own after the
    number of those in the parts before.
    """
    placed = written(units.withColumn("__part", F.spark_partition_id()).withColumn("__place", F.monotonically_increasing_id()), "mix-placed")
    held = placed.groupBy("__key", "__part").agg(F.count(F.lit(1)).alias("__held"))
    repeated = (held.groupBy("__key").agg(F.sum("__held").alias("__all")).where("__all > 1").select(F.col("__key").alias("__again")))
    repeated = written(repeated, "mix-repeated")
    alone = placed.join(repeated, F.col("__key") == F.col("__again"), "left_anti").drop("__part", "__place")
    several = placed.join(repeated, F.col("__key") == F.col("__again"), "left_semi")
    before = F.sum("__held").over(Window.partitionBy("__key").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = (held.join(repeated, F.col("__key") == F.col("__again"), "left_semi").withColumn("__before", F.coalesce(before, F.lit(0)))
               .select(F.col("__key").alias("__of"), F.col("__part").alias("__in"), "__before"))
    nth = F.row_number().over(Window.partitionBy("__key", "__part").orderBy("__place")) + F.col("__before")
    several = (several.join(offsets, (F.col("__key") == F.col("__of")) & (F.col("__part") == F.col("__in")))
               .withColumn("__key", F.xxhash64("__key", nth)).drop("__of", "__in", "__before", "__part", "__place"))
    return alone.unionByName(several)


def mix_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mixed corpus: each document as often as it is taken, with the input's columns.

    The input is written once with a row number, so the decisions meet their
    rows by that number and repeated ids stay apart.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = written(docs.select(F.monotonically_increasing_id().alias("row"), whole.alias("doc")), "mix-docs")
    body, of = F.col(f"doc.`{text}`"), F.col(f"doc.`{source}`")
    units = rows.select("row", of.alias("source"), word_count(body).alias("size"), F.xxhash64(F.lit("mix"), F.col(f"doc.`{doc_id}`"), body).alias("__key"))
    taken = cube_copies(numbered(units)).where("copies > 0").select("row", "copies")
    return rows.join(taken, "row").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")


def op10_source_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    units = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), unit_key("doc_id", "text").alias("__key"))
    return cube_copies(numbered(units)).select(
        "doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"), "copies")
