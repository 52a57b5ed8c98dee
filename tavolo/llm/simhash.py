r"""SimHash near-duplicates with Golay-code fuzzy keys.

A document's fingerprint has 64 bits: bit i is 1 if it is set in over half of
the XXH64 values (seed 42) of the 3-word shingles. Two documents are linked
when their fingerprints differ in at most ``max_bits`` = 3 bits.

Links are found among the *different* fingerprints, so copies of one text cost
one row. The fingerprint has four 16-bit segments. With three errors or fewer
at least one segment is equal, and then

* either a second one is equal (errors 3, or 2 + 1, in the others): key of two
  whole segments, six choices;
* or the other three have one error each: key of the equal segment and of the
  *decoded* next one, four choices. The Golay code (23, 12) is perfect, every
  23-bit word lies within 3 bits of exactly one codeword. A segment, padded
  with zeros, decodes to one codeword index; the words within one bit of it
  decode to at most six. One side of the join is filed under the index of its
  own segment, the other under all nearby ones, so words one bit apart meet.

Every candidate pair is verified by its bit distance, inside the join. Keys
that more than ``hot_key`` fingerprints share are left out of that join; their
fingerprints link through common midpoints instead: files under all words
within one bit and under all words within two bits meet exactly when they
differ in three bits or fewer, and everything filed under a word then links to
one fingerprint there. So a dense group costs a fixed number of rows for each
fingerprint instead of all its pairs. Both ways find the same components.

Defined results: null and wordless texts have fingerprint 0 and link like any
other; fewer than three words make one shingle; repeated rows are documents of
their own; a component's id is its smallest non-null document id, null if it
has none; an empty table gives an empty result. Texts are hashed whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavolo.llm.components import components
from tavolo.llm.shared import table, without, written

SHINGLE, MAX_BITS, SEED = 3, 3, 42
#: Keys with more fingerprints than this link through midpoints.
HOT_KEY = 10_000

#: Generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 of the binary Golay code.
GOLAY = 0xC75


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII space only
    if not words:
        return 0
    if len(words) < shingle:
        joined = [b" ".join(words)]
    else:
        joined = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in joined), dtype="<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):  # bounded memory for very long texts
        bits = np.unpackbits(hashes[i:i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text: str, shingle: int = SHINGLE, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``__fp``, the fingerprint as a signed long."""
    kept = docs if keep_text else docs.select([c for c in docs.columns if c != text])
    schema = kept.withColumn("__fp", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                fps = [fingerprint(t.as_py(), shingle) for t in batch.column(text)]
                signed = pa.array(np.array(fps, dtype=np.uint64).view(np.int64))
                names = [n for n in batch.schema.names if keep_text or n != text]
                yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [signed], names=[*names, "__fp"])

    return docs.mapInArrow(run, schema)


def _syndrome(words: np.ndarray) -> np.ndarray:
    rest = words.astype(np.int64)
    for i in range(22, 10, -1):
        rest = rest ^ np.where((rest >> i) & 1, GOLAY << (i - 11), 0)
    return rest


@lru_cache(maxsize=1)
def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """For each 16-bit segment: its codeword index, and the sorted indices of all words within one bit (-1: repeated)."""
    errors = np.array([sum(1 << i for i in c) for w in range(4) for c in combinations(range(23), w)])
    leader = np.zeros(2048, np.int64)
    leader[_syndrome(errors)] = errors
    words = np.arange(1 << 16)
    own = (words ^ leader[_syndrome(words)]) >> 11
    near = np.sort(np.stack([own] + [own[words ^ (1 << i)] for i in range(16)], axis=1), axis=1)
    near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
    near = -np.sort(-near, axis=1)[:, :6]  # at most six different ones
    return own, near


def fuzzy_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in ``fps``, key, side). Side 0 and side 1 fingerprints of a key are candidates.

    A key is template (4 bits), a whole segment (16 bits) and a second whole
    segment (16) or codeword index (12). Keys of two whole segments are on side 1 only: there
    both sides are alike, so side 1 is joined with itself.
    """
    own, near = golay_tables()
    u = fps.view(np.uint64)
    seg = [((u >> np.uint64(16 * i)) & np.uint64(0xFFFF)).astype(np.int64) for i in range(4)]
    n = np.arange(len(u))
    place, keys, side = [], [], []
    for t, (a, b) in enumerate(combinations(range(4), 2)):
        key = (t << 32) | (seg[a] << 16) | seg[b]
        for s in (0, 1):
            place.append(n), keys.append(key), side.append(np.full(len(u), s))
    for a in range(4):
        b = (a + 1) % 4
        high = ((6 + a) << 32) | (seg[a] << 16)
        place.append(n), keys.append(high | own[seg[b]]), side.append(np.zeros(len(u), np.int64))
        index = near[seg[b]]
        row, col = np.nonzero(index >= 0)
        place.append(row), keys.append(high[row] | index[row, col]), side.append(np.ones(len(row), np.int64))
    return np.concatenate(place), np.concatenate(keys), np.concatenate(side)


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start in range(0, whole.num_rows, 4096):
            fps = whole.column("fp").slice(start, 4096).to_numpy(zero_copy_only=False)
            place, keys, side = fuzzy_keys(fps)
            yield pa.RecordBatch.from_arrays([pa.array(fps[place]), pa.array(keys), pa.array(side.astype(np.int8))], names=["fp", "key", "side"])


def _midpoint_batches(max_bits: int):
    """Side 0: the words within max_bits // 2 bits; side 1: within the rest of them."""
    def masks(most: int) -> np.ndarray:
        return np.array([sum(1 << i for i in c) for w in range(most + 1) for c in combinations(range(64), w)], dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach = [masks(max_bits // 2), masks(max_bits - max_bits // 2)]
        for whole in batches:
            for start in range(0, whole.num_rows, 64):
                fps = whole.column("fp").slice(start, 64).to_numpy(zero_copy_only=False)
                for s, m in enumerate(reach):
                    words = (fps.view(np.uint64)[:, None] ^ m[None, :]).ravel().view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(fps, len(m))), pa.array(words), pa.array(np.full(len(words), s, np.int8))], names=["fp", "key", "side"])

    return run


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, hot_key: int = HOT_KEY) -> DataFrame:
    """(a, b): edges whose components are those of all pairs of ``fps`` (fp, distinct) within ``max_bits``."""
    if max_bits > 3:
        raise ValueError("four segments find at most 3 differing bits")
    schema = "fp long, key long, side byte"
    keyed = written(fps.mapInArrow(_key_batches, schema), "simhash-keys")
    sizes = keyed.groupBy("key").agg(F.sum("side").alias("n"), F.count(F.lit(1)).alias("m"))
    hot = written(sizes.where(F.greatest("n", F.col("m") - F.col("n")) > hot_key).select("key"), "simhash-hot")
    dense_keys = not hot.isEmpty()
    shared = keyed.join(hot, "key", "left_anti") if dense_keys else keyed
    left = shared.where("side = 0").select("key", F.col("fp").alias("a"))
    right = shared.where("side = 1").select("key", F.col("fp").alias("b"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    whole = F.shiftright("key", 32) < 6  # there both orders of a pair meet
    pairs = left.join(right, "key").where(close & (F.col("a") != F.col("b")) & (~whole | (F.col("a") < F.col("b"))))
    links = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    if not dense_keys:
        return links
    dense = keyed.join(hot, "key", "left_semi").select("fp").distinct()
    words = written(dense.mapInArrow(_midpoint_batches(max_bits), schema), "simhash-midpoints")
    centre = words.where("side = 0").groupBy("key").agg(F.min("fp").alias("centre"))
    stars = words.join(centre, "key").where("fp <> centre").select(F.least("fp", "centre").alias("a"), F.greatest("fp", "centre").alias("b"))
    return links.unionByName(stars.distinct())


def fingerprint_groups(fps: DataFrame, max_bits: int = MAX_BITS, hot_key: int = HOT_KEY) -> DataFrame:
    """(fp, root) for every row of ``fps`` (fp, distinct): root names its component."""
    roots = components(fingerprint_links(fps, max_bits, hot_key)).withColumnRenamed("node", "fp")
    return fps.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, hot_key: int = HOT_KEY) -> DataFrame:
    """One row per input row: its id, fingerprint (16 hex digits), component_id, and n_near.

    ``n_near`` is the number of documents in the component, itself included.
    """
    rows = docs.select(F.col(doc_id).alias(doc_id), F.col(text).alias("__text"))
    printed = written(with_fingerprints(rows, "__text", shingle, keep_text=False), "simhash-docs")
    return (_grouped(printed, doc_id, max_bits, hot_key)
            .withColumn("fingerprint", F.lower(F.lpad(F.hex("__fp"), 16, "0")))
            .select(doc_id, "fingerprint", "component_id", "n_near"))


def _grouped(printed: DataFrame, doc_id: str, max_bits: int, hot_key: int) -> DataFrame:
    """``printed`` (with ``__fp``) plus component_id and n_near. Copies join as one row per fingerprint."""
    per_fp = written(printed.groupBy(F.col("__fp").alias("fp")).agg(F.min(doc_id).alias("first"), F.count(F.lit(1)).alias("n")), "simhash-fps")
    roots = fingerprint_groups(per_fp.select("fp"), max_bits, hot_key).withColumnRenamed("fp", "__of")
    member = per_fp.join(roots, F.col("fp") == F.col("__of")).drop("__of")
    ids = member.groupBy("root").agg(F.min("first").alias("component_id"), F.sum("n").alias("n_near"))
    classes = written(member.select("fp", "root").join(ids, "root"), "simhash-classes")
    return printed.join(classes, F.col("__fp") == F.col("fp")).drop("fp")


def keep_one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                     max_bits: int = MAX_BITS, hot_key: int = HOT_KEY) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest id, the first of equal ids.

    The input is written once with a row number and its fingerprint; the rows
    to drop, few against all, meet it by that number.
    """
    rows = written(with_fingerprints(docs.withColumn("__row", F.monotonically_increasing_id()), text, shingle), "simhash-docs")
    grouped = written(_grouped(rows.select("__row", F.col(doc_id).alias("__id"), "__fp"), "__id", max_bits, hot_key)
                      .where("n_near > 1").select("__row", "__id", "root"), "simhash-rows")
    first = grouped.groupBy("root").agg(F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", "__row")).alias("keep"))
    dropped = grouped.join(first, "root").where(F.col("__row") != F.col("keep.__row")).select("__row")
    return rows.join(dropped, "__row", "left_anti").select([F.col(f"`{c}`") for c in docs.columns])


def op4_simhash_golay(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
