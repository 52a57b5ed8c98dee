"""Runs of words: mining the frequent ones, and finding listed ones in texts.

``frequent_ngrams`` mines level by level (Apriori): a run of n words can only be
frequent where the two runs of n - 1 words in it are. Each level, from pairs on, counts its
candidates in hashed buckets, about one for each word of the corpus: a task sends its
buckets sorted, with small counters, about three bytes each, and the counters are added up block
by block. Only runs whose bucket reaches the least count go
on, and only the last level's survivors are counted exactly, as text, first within
a task, so that a run is text once for many of its places. A bucket
counts every run that falls into it, so no frequent run is lost, whatever the
number of buckets; fewer buckets only let more rare runs through to the exact count, and beyond
``MOST_FOUND`` frequent buckets (too many to broadcast) all runs of a level go through.
Words are hashed once a pass, in Spark; their runs are hashed by whole batches.

``find_ngrams`` finds listed runs in token arrays without a shuffle: the list
becomes sorted arrays of hashes, shard by shard, each shard bounded and
broadcast on its own, and is looked up at each place whose first word begins a
listed run. Runs are compared by two 64-bit hashes of their words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tavolo.session import ensure_checkpoint_dir

#: Counters of buckets stop at this.
FULL = 255
#: Blocks that the buckets are cut into, as a power of two; buckets that a task holds before it sends them.
BLOCKS, HELD = 11, 1 << 22
#: Frequent buckets of a level up to this number are broadcast.
MOST_FOUND = 16_000_000
#: Rows of a batch that are worked on at a time.
SLICE_ROWS = 512
#: Different runs that a task holds to add up their numbers.
KEPT = 1_000_000
#: Listed runs of a shard, about.
SHARD_ROWS = 4_000_000


# ---------------------------------------------------------------- arrays of arrays

def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values, the row of each, and its place in the row; null rows are empty."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    length = np.asarray(lists.value_lengths().fill_null(0))
    values = lists.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lists)), length)
    first = np.concatenate([[0], np.cumsum(length)])
    return values, row, np.arange(len(values)) - first[row]


def _lists(row: np.ndarray, values: np.ndarray, rows: int, kind: pa.DataType) -> pa.ListArray:
    """One list a row, of the values whose (ascending) ``row`` it is."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)), pa.array(values, kind))


# ---------------------------------------------------------------- mining

def _places(words: pa.ListArray, levels: list, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, the row of each, and the places where a run may begin that all ``levels`` let through."""
    values, row, _ = _flat(words)
    values = values.astype(np.int64)
    at = np.arange(len(values))
    for level in levels:
        at = _runs(row, at, level.n)
        at = at[level.has(_buckets(values, at, level.n, bits))]
        # a longer run begins where the next place begins one of this level, too
        at = at[:-1][at[1:] == at[:-1] + 1] if len(at) else at
    return values, row, at


def _buckets(words: np.ndarray, starts: np.ndarray, n: int, bits: int) -> np.ndarray:
    return (_hashes(words, starts, n)[0] >> np.uint64(64 - bits)).astype(np.int64)


def _runs(row: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The places from which a run of ``n`` words fits in its row."""
    at = at[at + n <= len(row)]
    return at[row[at] == row[at + n - 1]]


class Found:
    """The frequent buckets of runs of ``n`` words, sorted."""

    def __init__(self, n: int, bits: int, buckets: np.ndarray):
        self.n, self.bits, self.buckets = n, bits, np.sort(buckets)

    def has(self, bucket: np.ndarray) -> np.ndarray:
        if not len(self.buckets):
            return np.zeros(len(bucket), bool)
        # a first look at the upper bits spares most of the search
        if not hasattr(self, "coarse"):
            self.shift = max(self.bits - 24, 0)
            self.coarse = np.zeros(1 << min(self.bits, 24), bool)
            self.coarse[self.buckets >> self.shift] = True
        maybe = self.coarse[bucket >> self.shift]
        if self.shift:
            at = np.searchsorted(self.buckets, bucket[maybe])
            maybe[maybe] = self.buckets[np.minimum(at, len(self.buckets) - 1)] == bucket[maybe]
        return maybe

    def __getstate__(self):
        return {"n": self.n, "bits": self.bits, "buckets": self.buckets}


def bucket_bits(words: float) -> int:
    """About a bucket a word, as a power of two."""
    return int(np.clip(np.ceil(np.log2(max(words, 1))), 16, 34))


def _block_shift(bits: int) -> int:
    return max(bits - BLOCKS, 1)


def _tables(sent, n: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift, held, size = _block_shift(bits), [], 0

        def sent_on() -> pa.RecordBatch:
            bucket = np.concatenate(held)
            held.clear()
            bucket.sort()
            first = np.flatnonzero(np.diff(bucket, prepend=-1))
            count = np.minimum(np.diff(first, append=len(bucket)), FULL).astype(np.uint8)
            bucket = bucket[first]
            cuts = np.flatnonzero(np.diff(bucket >> shift)) + 1
            starts = [0, *cuts.tolist()] if len(bucket) else []
            low = np.diff(bucket & ((1 << shift) - 1), prepend=0)
            low[starts] = bucket[starts] & ((1 << shift) - 1)  # steps from bucket to bucket, anew in each block
            packed = [zlib.compress(low[a:b].astype(np.uint32).tobytes() + count[a:b].tobytes(), 1) for a, b in zip(starts, [*starts[1:], len(bucket)])]
            return pa.RecordBatch.from_arrays([pa.array((bucket[starts] >> shift).astype(np.int32), pa.int32()), pa.array(packed, pa.binary())], names=["block", "counts"])

        for batch in batches:
            for i in range(0, batch.num_rows, SLICE_ROWS):
                words, row, at = _places(batch.column(0).slice(i, SLICE_ROWS), sent.value, bits)
                held.append(_buckets(words, _runs(row, at, n), n, bits))
                size += len(held[-1])
                if size >= HELD:
                    yield sent_on()
                    size = 0
        if size:
            yield sent_on()

    return run


def _merged(least: int, bits: int):
    """Blocks in order: the buckets that reach ``least``, over all parts of a block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = _block_shift(bits)
        block, total = None, None

        def done() -> pa.RecordBatch:
            found = np.flatnonzero(total >= least) + (block << shift)
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([found], pa.list_(pa.int64()))], names=["block", "found"])

        for batch in batches:
            for b, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
                raw = zlib.decompress(counts)
                n = len(raw) // 5
                if b != block:
                    if block is not None:
                        yield done()
                    block, total = b, np.zeros(1 << shift, np.uint16)
                low = np.cumsum(np.frombuffer(raw, np.uint32, n).astype(np.int64))
                total[low] = np.minimum(total[low] + np.frombuffer(raw, np.uint8, n, 4 * n), FULL)
        if block is not None:
            yield done()

    return run


def frequent_buckets(hashes: DataFrame, levels: list[Found], n: int, least: int, bits: int) -> Found | None:
    """The buckets that runs of ``n`` words reach ``least`` times (or ``FULL`` times); None if there are too many."""
    ensure_checkpoint_dir(hashes.sparkSession)
    sent = hashes.sparkSession.sparkContext.broadcast(levels)
    parts = hashes.mapInArrow(_tables(sent, n, bits), "block int, counts binary")
    merged = (parts.repartition("block").sortWithinPartitions("block").mapInArrow(_merged(min(least, FULL), bits), "block int, found array<long>")
              .checkpoint(eager=True))
    if (merged.agg(F.sum(F.size("found"))).first()[0] or 0) > MOST_FOUND:
        return None
    return Found(n, bits, np.concatenate([np.zeros(0, np.int64), *(np.array(r["found"], np.int64) for r in merged.select("found").toLocalIterator())]))


def frequent_ngrams(texts: DataFrame, words: Column, n: int, least: int, bits: int | None = None) -> DataFrame:
    """(name, n): every run of ``n`` words, joined by blanks, that stands ``least`` times in the arrays ``words`` of ``texts``.

    ``bits``: buckets as a power of two; by default from the number of words, which costs a pass to count.
    """
    split = texts.select(words.alias("_ws"))
    if bits is None:
        bits = bucket_bits(split.agg(F.sum(F.greatest(F.size("_ws"), F.lit(0)))).first()[0] or 0)
    hashed = F.transform("_ws", lambda w: F.xxhash64(w))
    levels: list[Found] = []
    for k in range(min(2, n), n + 1):
        found = frequent_buckets(split.select(hashed.alias("h")), levels, k, least, bits)
        if found is not None:
            levels = [*levels, found]
    counted = _counted(texts.sparkSession.sparkContext.broadcast(levels), n, bits)
    parts = split.select("_ws", hashed.alias("h")).mapInArrow(counted, "name string, n long")
    return parts.groupBy("name").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _counted(sent, n: int, bits: int):
    """Runs of ``n`` words, joined by blanks, whose bucket is frequent on every level; equal ones of a task are added up, ``KEPT`` at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shorter, last = [f for f in sent.value if f.n < n], [f for f in sent.value if f.n == n]

        def names_in(part: pa.RecordBatch) -> pa.RecordBatch:
            values, row, at = _places(part.column("h"), shorter, bits)
            at = _runs(row, at, n)
            for level in last:
                at = at[level.has(_buckets(values, at, n, bits))]
            words = part.column("_ws").flatten()
            names = pc.binary_join_element_wise(*(words.take(pa.array(at + j)) for j in range(n)), " ", null_handling="skip").dictionary_encode()
            return pa.RecordBatch.from_arrays([names.dictionary, pa.array(np.bincount(names.indices, minlength=len(names.dictionary)).astype(np.int64))], names=["name", "n"])

        def added_up(parts: list[pa.RecordBatch]) -> pa.Table:
            total = pa.Table.from_batches(parts).group_by("name", use_threads=False).aggregate([("n", "sum")])
            return total.rename_columns({"n_sum": "n"}).select(["name", "n"])

        held, size = [], 0
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE_ROWS):
                held.append(names_in(batch.slice(i, SLICE_ROWS)))
                size += held[-1].num_rows
                if size >= KEPT:
                    total = added_up(held)
                    held, size = total.to_batches(), total.num_rows
                    if size >= KEPT // 2:
                        yield from held
                        held, size = [], 0
        if size:
            yield from added_up(held).to_batches()

    return run


# ---------------------------------------------------------------- finding

_STEP_A, _STEP_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _hashes(words: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the ``n`` word hashes from each start on."""
    a, b = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
    words = words.view(np.uint64)
    for j in range(n):
        w = words[starts + j]
        a = (a ^ w) * _STEP_A
        b = (b + (w >> np.uint64(7) ^ w << np.uint64(3))) * _STEP_B
    return a, b


class Listed:
    """Runs of one length: hashes in order, and where those with the same upper bits begin."""

    def __init__(self, n: int, words: np.ndarray):
        a, b = _hashes(words.ravel(), np.arange(len(words)) * n, n)
        order = np.argsort(a, kind="stable")
        self.n, self.a, self.b = n, a[order], b[order]
        self.shift = np.uint64(64 - int(np.clip(np.ceil(np.log2(max(len(a), 1))), 1, 24)))
        upper = self.a >> self.shift
        self.first = np.searchsorted(upper, np.arange((1 << (64 - int(self.shift))) + 1, dtype=np.uint64)).astype(np.int32)

    def places(self, words: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Indexes where a listed run begins that lies in one row."""
        if len(words) < self.n or not len(self.a):
            return np.zeros(0, np.int64)
        begins = np.flatnonzero(row[:len(row) - self.n + 1] == row[self.n - 1:])
        a, b = _hashes(words, begins, self.n)
        upper = (a >> self.shift).astype(np.int64)
        at, end = self.first[upper], self.first[upper + 1]
        left, found = np.flatnonzero(at < end), np.zeros(len(begins), bool)
        while len(left):  # on to the next listed hash with these upper bits, of which there are few
            hit = (self.a[at[left]] == a[left]) & (self.b[at[left]] == b[left])
            found[left[hit]] = True
            at[left] += 1
            left = left[~hit & (at[left] < end[left])]
        return begins[found]


def _look_up(sent):
    def found_in(words: pa.Array) -> pa.Array:
        values, row, place = _flat(words)
        values = values.astype(np.int64)
        where = [(listed.places(values, row), listed.n) for listed in sent.value]
        at = np.concatenate([w for w, _ in where] or [np.zeros(0, np.int64)])
        n = np.concatenate([np.full(len(w), k) for w, k in where] or [np.zeros(0, np.int64)])
        order = np.lexsort((n, at))
        at, n = at[order], n[order]
        pairs = pa.StructArray.from_arrays([pa.array(place[at], pa.int32()), pa.array(n, pa.int32())], names=["pos", "n"])
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(row[at], np.arange(len(words) + 1)).astype(np.int32)), pairs)

    @F.arrow_udf("array<struct<pos: int, n: int>>")
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for words in batches:
            for i in range(0, len(words), SLICE_ROWS):
                yield found_in(words.slice(i, SLICE_ROWS))

    return find


def find_ngrams(texts: DataFrame, words: str, names: DataFrame, out: str, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``texts`` plus ``out``: (pos, n) of the listed runs in the array column ``words``, by pos, then n.

    ``names`` has one column ``words``, an array each; rows repeat, null and empty ones are passed over.
    """
    spark = texts.sparkSession
    ensure_checkpoint_dir(spark)
    hashed = (names.select(F.transform("words", lambda w: F.xxhash64(w)).alias("h")).where("size(h) > 0").distinct().checkpoint(eager=True))
    shards = max(1, -(-hashed.count() // shard_rows))
    texts = texts.withColumn(out, F.expr("cast(array() as array<struct<pos: int, n: int>>)"))
    for s in range(shards):
        listed = hashed.where(F.pmod(F.xxhash64("h"), F.lit(shards)) == s).toArrow()["h"].combine_chunks()  # shard_rows, about
        values, row, _ = _flat(listed)
        length = np.bincount(row, minlength=len(listed))
        sent = spark.sparkContext.broadcast([Listed(int(n), values[length[row] == n].astype(np.int64).reshape(-1, n)) for n in np.unique(length)])
        found = _look_up(sent)(F.transform(words, lambda w: F.xxhash64(w)))
        texts = texts.withColumn(out, found if shards == 1 else F.concat(F.col(out), found))
        if shards > 1:  # one shard in memory at a time
            texts = texts.checkpoint(eager=True)
    return texts if shards == 1 else texts.withColumn(out, F.array_sort(out))
