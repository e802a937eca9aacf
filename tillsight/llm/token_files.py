"""Token ids of a corpus in binary segments with Elias-Fano document boundaries.

The documents are range-partitioned and sorted by ``doc_id``. Each task encodes
its rows and emits segments: a blob with all ids of consecutive documents one
after the other, 16 bits wide if the vocabulary allows it, and two Elias-Fano
sequences, the end of each document in that array and the document ids. An
Elias-Fano sequence of n values below u takes about 2 + log2(u / n) bits a value
and finds value i by a select on its upper bits; there is no table of 64-bit
offsets. The blobs are rows of a Parquet folder, written and read by Spark, so
they live in any store that Spark reaches.

Where a segment begins in the whole corpus is the sum of the tasks before its
own (one total a task) and of the segments before it in its task.

Defined results: a null text is an empty document, which has the end id alone.
Null ids come first. Rows with equal ids are documents of their own and stand in
the order of their text's hash. No rows give no segments. Columns other than
``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.workspace import new_path
from .tokens import encoder
from .workers import mapped

MAGIC = b"TSEF"
#: Ids after which a segment is closed, and ones between two select samples.
SEGMENT, SAMPLED = 1 << 20, 64

_HEADER = struct.Struct("<4sBBxxIIq")  # magic, id bytes, has sampled ends, nulls, documents, first doc_id
_EF = struct.Struct("<IQB")  # values, universe, low bits
_POPCOUNT = np.array([bin(b).count("1") for b in range(256)], dtype=np.int64)

#: In a byte, where its k-th one stands.
_PLACE = np.array([[*(k for k in range(8) if b >> k & 1), *[0] * 8][:8] for b in range(256)], dtype=np.int64)

SEGMENTS = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("before", pa.int64()),
                      ("n_ids", pa.int64()), ("blob", pa.binary())])
_SEGMENTS_DDL = "part int, segment int, before long, n_ids long, blob binary"


class EliasFano:
    """A sequence of numbers that never falls, in near-minimal space."""

    def __init__(self, count: int, universe: int, low_bits: int,
                 low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.count, self.universe, self.low_bits = count, universe, low_bits
        self.low, self.high, self.samples = low, high, samples

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        """Of values from 0 to ``universe``, which may be as large as 64 bits hold."""
        n = len(values)
        low_bits = max(0, int(universe // max(n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        low = np.packbits(((values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8),
                          bitorder="little")
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(n + (universe >> low_bits) + 1, dtype=np.uint8)
        bits[ones] = 1
        return cls(n, universe, low_bits, low, np.packbits(bits, bitorder="little"),
                   ones[::SAMPLED].astype("<u4"))

    def dump(self) -> bytes:
        return b"".join([_EF.pack(self.count, self.universe, self.low_bits),
                         self.low.tobytes(), self.high.tobytes(), self.samples.tobytes()])

    @classmethod
    def load(cls, blob: memoryview, at: int) -> tuple[EliasFano, int]:
        """The sequence at a position of the blob, and the position behind it."""
        n, universe, low_bits = _EF.unpack_from(blob, at)
        at += _EF.size
        parts = []
        for kind, length in (("u1", -(-n * low_bits // 8)),
                             ("u1", -(-(n + (universe >> low_bits) + 1) // 8)),
                             ("<u4", -(-n // SAMPLED))):
            parts.append(np.frombuffer(blob, kind, length, at))
            at += parts[-1].nbytes
        return cls(n, universe, low_bits, *parts), at

    def select(self, i: int) -> int:
        """Value i: from the sample before it, skip whole bytes by their ones."""
        at = int(self.samples[i // SAMPLED])
        left, byte = i % SAMPLED, at // 8
        word = int(self.high[byte]) >> at % 8 << at % 8
        while left >= (ones := int(_POPCOUNT[word])):
            left, byte = left - ones, byte + 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        one = 8 * byte + (word & -word).bit_length() - 1
        bits = range(i * self.low_bits, (i + 1) * self.low_bits)
        low = sum((int(self.low[b // 8]) >> b % 8 & 1) << k for k, b in enumerate(bits))
        return (one - i) << self.low_bits | low

    def select_many(self, which: np.ndarray) -> np.ndarray:
        """Values of so many places at once (uint64): counts of ones over the bytes lead to the byte of each."""
        if not len(which):
            return np.zeros(0, dtype=np.uint64)
        which = which.astype(np.int64)
        until = np.cumsum(_POPCOUNT[self.high])
        byte = np.searchsorted(until, which, side="right")
        left = which - (until[byte] - _POPCOUNT[self.high[byte]])
        ones = 8 * byte + _PLACE[self.high[byte], left]
        upper = (ones - which).astype(np.uint64) << np.uint64(self.low_bits)
        if not self.low_bits:
            return upper
        bits = which[:, None] * self.low_bits + np.arange(self.low_bits)
        own = (self.low[bits // 8] >> (bits % 8).astype(np.uint8)) & 1
        return upper | (own.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


class Segment:
    """Reader of one blob."""

    def __init__(self, blob: bytes):
        view = memoryview(blob)
        magic, width, _, self.nulls, self.count, self.first = _HEADER.unpack_from(view)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        self.ends, at = EliasFano.load(view, _HEADER.size)
        self.names, at = EliasFano.load(view, at)
        self.ids = np.frombuffer(view, f"<u{width}", self.ends.universe, at)

    def bounds(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where documents of the segment begin and end in its ids."""
        ends = self.ends.select_many(which).astype(np.int64)
        starts = np.zeros_like(ends)
        starts[which > 0] = self.ends.select_many(which[which > 0] - 1).astype(np.int64)
        return starts, ends

    def doc_ids(self, which: np.ndarray) -> list[int | None]:
        # Differences are modulo 2^64, so ids may span the whole range of longs.
        with np.errstate(over="ignore"):
            known = self.names.select_many(which[which >= self.nulls] - self.nulls) + np.int64(self.first).astype(np.uint64)
        return [None] * int((which < self.nulls).sum()) + known.astype(np.int64).tolist()

    def start(self, i: int) -> int:
        return self.ends.select(i - 1) if i else 0

    def document(self, i: int) -> np.ndarray:
        """Ids of document i of the segment, its end id included."""
        return self.ids[self.start(i):self.ends.select(i)]

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.names.select(i - self.nulls) + self.first


def segment_blob(names: list[int | None], documents: list[np.ndarray], width: int) -> bytes:
    """Blob of documents in ascending order of their names, null names first."""
    nulls = sum(n is None for n in names)
    first = names[nulls] if nulls < len(names) else 0
    with np.errstate(over="ignore"):
        known = np.array(names[nulls:], dtype=np.int64).astype(np.uint64) - np.int64(first).astype(np.uint64)
    ends = np.cumsum([len(d) for d in documents])
    return b"".join([
        _HEADER.pack(MAGIC, width, 1, nulls, len(names), first),
        EliasFano.of(ends, int(ends[-1])).dump(),
        EliasFano.of(known, int(known[-1]) if len(known) else 0).dump(),
        np.concatenate(documents).astype(f"<u{width}").tobytes()])


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2,
          vocabulary: int = 1 << 16, parts: int | None = None) -> None:
    """Encode all documents and write their segments to a new folder."""
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = 2 if max(vocabulary, end_id + 1) <= 1 << 16 else 4

    def segments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(tokenizer, "spaced"), TaskContext.get().partitionId()
        end = np.array([end_id], dtype=np.uint32)
        names: list[int | None] = []
        documents: list[np.ndarray] = []
        segment = before = size = 0

        def close() -> pa.RecordBatch:
            nonlocal segment, before, size
            row = [part], [segment], [before], [size], [segment_blob(names, documents, width)]
            segment, before, size = segment + 1, before + size, 0
            names.clear()
            documents.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip(row, SEGMENTS)], schema=SEGMENTS)

        for batch in batches:
            for at in range(0, len(batch), 256):
                some = batch.slice(at, 256)
                for name, ids in zip(some["doc_id"].to_pylist(), encode.many(some["text"].to_pylist())):
                    names.append(name)
                    documents.append(np.concatenate([ids, end]))
                    size += len(ids) + 1
                    if size >= SEGMENT:
                        yield close()
        if names:
            yield close()

    # Equal ids are dealt on by text and row, so that one id never fills a task.
    rows = docs.select(F.col("doc_id").cast("long"), "text").withColumns({
        "_text": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    ordered = rows.repartitionByRange(parts, "doc_id", "_text", "_row").sortWithinPartitions("doc_id", "_text", "_row")
    (mapped(ordered.select("doc_id", "text"), segments, _SEGMENTS_DDL, "tokens")
         .write.option("compression", "zstd").parquet(path))


def read(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files.

    ``ids`` is little-endian unsigned 32-bit.
    """
    stored = spark.read.schema(_SEGMENTS_DDL).parquet(path)
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row a writing task: the window and the broadcast see task totals only.
    bases = stored.groupBy("part").agg(F.sum("n_ids").alias("_all")).select(
        "part", F.coalesce(F.sum("_all").over(order), F.lit(0)).alias("_base"))
    placed = stored.join(F.broadcast(bases), "part").select(
        (F.col("_base") + F.col("before")).alias("base"), "blob")
    out = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                     ("ids", pa.binary())])

    def documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, blob in zip(batch["base"].to_pylist(), batch["blob"]):
                found = Segment(blob.as_buffer())
                for at in range(0, found.count, 1024):
                    which = np.arange(at, min(at + 1024, found.count))
                    starts, ends = found.bounds(which)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(found.doc_ids(which), pa.int64()), pa.array(base + starts), pa.array(ends - starts),
                        pa.array([found.ids[a:b].astype("<u4").tobytes() for a, b in zip(starts.tolist(), ends.tolist())],
                                 pa.binary())], schema=out)

    return placed.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary")


def through_files(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write the segments below the shared folder and read them back."""
    spark = docs.sparkSession
    path = new_path(spark, "token-segments")
    write(docs, path, tokenizer, end_id)
    return read(spark, path)
