"""Harmonic packing of documents into training sequences of ``capacity`` tokens.

A piece of length l belongs to class k when capacity / (k + 1) < l <=
capacity / k; a bin of class k takes exactly k pieces, whatever their lengths.
So every worker fills its bins on its own, one piece after the other, and keeps
only its open bins (at most k - 1 pieces a class).

Documents are cut first so that classes waste little: whole sequences, then the
rest, cut at the next class's exact length as long as k copies of it would
leave more than ``slack`` tokens of a sequence unused. A cut depends on the
document's own length alone, so one pass over the texts tokenizes, cuts, packs
and takes checksums.

What stays in a worker's open bins is dealt to fewer workers, about
``round_pieces`` pieces each, and packed the same way, until one worker holds
all open bins: less than one bin a class. Their pieces are then packed
first-fit by decreasing length, into less than one sequence a class.

Tokens: ids of the vocabulary file for the whole text, then ``end_id``. Its
rules never join across ASCII white space, so each different word is encoded
once and kept in a bounded table (``CACHED_WORDS`` a generation).

Defined results: null and empty texts have the end id only; repeated rows are
documents of their own, each packed; null ids are kept; an empty table gives an
empty result. Extra input columns are not part of the result.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavolo.llm.shared import table, written

CAPACITY = 2048
VOCABULARY = "word_bpe_49k.json"
END_ID = 1
#: Unused tokens of a full sequence up to which a rest is not cut further.
SLACK = 32
#: Open pieces that one worker of a later round takes.
ROUND_PIECES = 50_000
#: Words kept with their ids, in each of two generations.
CACHED_WORDS = 400_000
#: Longer words (bytes) are encoded each time.
LONGEST_KEPT = 100


def cut(n: int, capacity: int = CAPACITY, slack: int = SLACK) -> list[tuple[int, int, int]]:
    """(start, length, class) of the pieces of a document of ``n`` tokens."""
    pieces = [(s, capacity, 1) for s in range(0, n - capacity + 1, capacity)]
    start = len(pieces) * capacity
    while rest := n - start:
        k = capacity // rest
        if capacity - k * rest <= slack:
            pieces.append((start, rest, k))
            break
        length = capacity // (k + 1)
        pieces.append((start, length, capacity // length))
        start += length
    return pieces


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 characters stand for themselves, the rest for 256, 257, ..."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordIds(dict):
    """Token ids of words, and of whole texts, as little-endian unsigned 32-bit bytes.

    Ids are kept by word in two generations: when the young one (this dict) is
    full it becomes the old one, so words in use survive. A new word is reduced
    first: ASCII words to lower case (the vocabulary has lower case only; a
    special token's spelling is left alone), and a last punctuation mark after
    a letter is taken off, as it is a token of its own there. What is left goes
    to the merge model itself when it is letters only, normalized and in lower
    case, as the steps before the model then change nothing; else it is encoded
    as a text.
    """

    def __init__(self, path: str, limit: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.limit, self.old = Tokenizer.from_file(path), limit, {}
        self.merge, self.letters = self.tokenizer.model.tokenize, byte_letters()
        self.marks = {m.encode(): self._text(m) for m in ".,;:!?"}

    def _text(self, text: str) -> bytes:
        return pack_ids(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _encode(self, stem: bytes) -> bytes:
        text = stem.decode()
        if text.isalpha() and text == text.lower() and is_normalized("NFC", text):
            return pack_ids([t.id for t in self.merge(stem.decode("latin-1").translate(self.letters))])
        return self._text(text)

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            stem = word.lower() if word.isascii() and b"<|" not in word else word
            mark = stem[-1:]
            if mark in self.marks and stem[-2:-1].isalpha():
                ids = self[stem[:-1]] + self.marks[mark]
            elif stem != word:
                ids = self[stem]
            else:
                ids = self._encode(stem)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        if len(word) <= LONGEST_KEPT:
            self[word] = ids
        return ids

    def ids(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.split()))  # bytes: ASCII white space only


def pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One table for each Python worker, kept from task to task."""
    return WordIds(path)


class Packer:
    """Fills bins and yields finished rows as record batches of ``rows`` pieces."""

    def __init__(self, capacity: int, round_no: int, schema: pa.Schema, rows: int = 8192):
        self.capacity, self.schema, self.rows = capacity, schema, rows
        # Sequence ids are unique by round, worker and count.
        self.next_id = (round_no << 56) | (TaskContext.get().partitionId() << 32)
        self.open: dict[int, list[tuple]] = defaultdict(list)
        self.columns: list[list] = [[] for _ in schema]

    def _close(self, pieces: list[tuple], placed: bool = True) -> None:
        offset = 0
        for piece in pieces:
            for column, value in zip(self.columns, (*piece, self.next_id if placed else None, offset if placed else None)):
                column.append(value)
            offset += piece[LENGTH]
        self.next_id += placed

    def add(self, piece: tuple) -> None:
        bin_, k = self.open[piece[CLASS]], piece[CLASS]
        bin_.append(piece)
        if len(bin_) == k:
            self._close(bin_)
            self.open[k] = []

    def batches(self, least: int | None = None) -> Iterator[pa.RecordBatch]:
        """What is finished, once it is ``least`` rows."""
        if len(self.columns[0]) >= (self.rows if least is None else least):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(self.columns, self.schema)], schema=self.schema)
            self.columns = [[] for _ in self.schema]

    def finish(self, last: bool) -> Iterator[pa.RecordBatch]:
        rest = [piece for k in sorted(self.open) for piece in self.open[k]]
        if last:
            for bin_ in first_fit([p[LENGTH] for p in rest], self.capacity):
                self._close([rest[i] for i in bin_])
        else:
            self._close(rest, placed=False)
        yield from self.batches(1)


#: Fields of a piece after the document id; ``ids`` follows if asked for.
FIELDS = ["start", "length", "ids_crc32", "doc_tokens", "__class"]
LENGTH, CLASS = 2, 5


def first_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of positions: by decreasing length, each into the fullest bin that has room."""
    free: list[tuple[int, int]] = []
    bins: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = bisect_left(free, (lengths[i], -1))
        if at < len(free):
            room, b = free.pop(at)
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        insort(free, (room - lengths[i], b))
    return bins


def _pack_texts(path: str, end_id: int, capacity: int, slack: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, end, packer = word_ids(path), pack_ids([end_id]), None
        for whole in batches:
            packer = packer or Packer(capacity, 0, _arrow_schema(whole.schema.field(0).type, with_ids))
            for first in range(0, whole.num_rows, 256):
                batch = whole.slice(first, 256)
                texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
                for doc, text in zip(batch.column(0).to_pylist(), texts):
                    ids = known.ids(text) + end
                    n = len(ids) // 4
                    for start, length, k in cut(n, capacity, slack):
                        part = ids[4 * start:4 * (start + length)]
                        piece = (doc, start, length, zlib.crc32(part), n, k)
                        packer.add((*piece, np.frombuffer(part, dtype="<u4").tolist()) if with_ids else piece)
                yield from packer.batches()
        if packer:
            yield from packer.finish(False)

    return run


def _pack_pieces(capacity: int, round_no: int, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = None
        for batch in batches:
            packer = packer or Packer(capacity, round_no, batch.schema)
            columns = [c.to_pylist() for c in batch.columns[:-2]]
            for piece in zip(*columns):
                packer.add(piece)
            yield from packer.batches()
        if packer:
            yield from packer.finish(last)

    return run


def _arrow_schema(id_type: pa.DataType, with_ids: bool) -> pa.Schema:
    fields = [("doc_id", id_type), *((f, pa.int64()) for f in FIELDS)] + ([("ids", pa.list_(pa.int32()))] if with_ids else [])
    return pa.schema([*fields, ("sequence_id", pa.int64()), ("offset", pa.int64())])


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, end_id: int = END_ID,
                   capacity: int = CAPACITY, slack: int = SLACK, round_pieces: int = ROUND_PIECES, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with ``with_ids`` its ids."""
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string"))
    id_type = texts.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {id_type}, " + ", ".join(f"{f} long" for f in FIELDS) + (", ids array<int>" if with_ids else "")
              + ", sequence_id long, offset long")
    packed = written(texts.mapInArrow(_pack_texts(path or vocabulary_path(), end_id, capacity, slack, with_ids), schema), "pack-0")
    rounds, round_no, last, workers = [packed.where("sequence_id is not null")], 0, False, 1 << 62
    while not last:
        rest = packed.where("sequence_id is null")
        workers = min(-(-rest.count() // round_pieces), workers // 2)  # fewer each round, so the rounds end
        last, round_no = workers <= 1, round_no + 1
        dealt = rest.repartition(max(1, workers), "doc_id", "start", "ids_crc32").sortWithinPartitions("__class", "doc_id", "start")
        packed = written(dealt.mapInArrow(_pack_pieces(capacity, round_no, last), schema), f"pack-{round_no}")
        rounds.append(packed.where("sequence_id is not null"))
    out = rounds[0]
    for part in rounds[1:]:
        out = out.unionByName(part)
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else []))


def sequences(pieces: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """(sequence_id, n_tokens, ids): the ids of each sequence, from ``pack_documents(with_ids=True)``.

    A group holds one sequence. It is padded to the capacity unless its length is a power of two.
    """
    whole = (pieces.groupBy("sequence_id")
             .agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids"))
             .withColumn("n_tokens", F.size("ids")))
    power = F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1) == 0
    padding = F.when(power, 0).otherwise(capacity - F.col("n_tokens"))
    return whole.withColumn("ids", F.concat("ids", F.array_repeat(F.lit(pad_id), padding)))


def op1_harmonic_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"))
