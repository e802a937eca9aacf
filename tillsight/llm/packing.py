"""Sum-of-squares packing of tokenised documents into sequences of a fixed length.

A document's ids are cut into pieces no longer than a sequence. Pieces that fill
a sequence need no choice. The others are dealt by a hash over shards of bounded
size, and each shard packs its pieces, longest first: a piece goes where the sum
of the squared numbers of open sequences per gap becomes smallest, into a new
sequence or one whose gap is at least its length. That sum stays small only while
no gap piles up, so gaps of every size stay at hand and few sequences stay open.

Defined results: a null text is an empty document of one piece, the end id.
Rows with a null or repeated ``doc_id`` are documents of their own. No rows give
no rows. Columns other than ``doc_id`` and ``text`` are not read. Equal choices
go to the smaller gap, and equal lengths in the order of their row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import new_path
from .tokens import encoder
from .workers import mapped

#: Pieces that one task packs. More changes little: the sequences left open are few.
SHARD = 20_000

PIECES = pa.schema([("part", pa.int32()), ("row", pa.int64()), ("doc_id", pa.int64()),
                    ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids", pa.binary())])
_PIECES_DDL = ("part int, row long, doc_id long, piece int, start long, length long, "
               "ids binary")


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """Write the ids of all documents, cut to ``capacity``, and read them back.

    ``ids`` holds unsigned 32-bit little-endian ids; (part, row, piece) is a key.
    """
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, row = encoder(tokenizer, "words"), TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            for at in range(0, len(batch), 256):
                some, out = batch.slice(at, 256), []
                for doc, ids in zip(some["doc_id"].to_pylist(), encode.many(some["text"].to_pylist())):
                    ids = np.concatenate([ids.astype("<u4", copy=False), end])
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        own = ids[start:start + capacity]
                        out.append((part, row, doc, piece, start, len(own), own.tobytes()))
                    row += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out), PIECES)], schema=PIECES)

    path = new_path(docs.sparkSession, "pieces")
    (mapped(docs.select(F.col("doc_id").cast("long"), "text"), cut, _PIECES_DDL, "tokens")
     .write.option("compression", "zstd").parquet(path))
    return docs.sparkSession.read.schema(_PIECES_DDL).parquet(path)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, placed in the given order.

    With N(g) open sequences of gap g, filling a gap g with a piece of length s
    changes the sum of squares by 1 - 2 N(g) for the gap that goes and
    1 + 2 N(g - s) for the one that comes; a gap of 0 counts for nothing.
    """
    number, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_now = np.zeros(capacity + 1, dtype=np.int64)
    at_gap: dict[int, list[int]] = {}
    made = 0
    for k, s in enumerate(lengths.tolist()):
        going, coming = open_now[s:capacity + 1], 2 * open_now[:capacity - s + 1] + 1
        coming[0] = 0
        change = coming + np.where(going > 0, 1 - 2 * going, capacity << 40)
        change[-1] = coming[-1]  # a new sequence: its whole length is the gap, and none goes
        gap = s + int(change.argmin())
        if gap == capacity:
            number[k], made = made, made + 1
        else:
            number[k] = at_gap[gap].pop()
            open_now[gap] -= 1
        offset[k] = capacity - gap
        if gap > s:
            open_now[gap - s] += 1
            at_gap.setdefault(gap - s, []).append(int(number[k]))
    return number, offset


def place(items: DataFrame, capacity: int, key: list[Column], shard: int = SHARD) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``; ``key`` tells rows apart.

    Needs a column ``length`` from 1 to ``capacity``, and a written ``items``: it is read twice.
    """
    short = F.col("length") < capacity
    shards = max(1, -(-items.where(short).count() // shard))
    full = items.where(~short).withColumns({
        "sequence_id": -1 - F.abs(F.xxhash64(*key).bitwiseAND(F.lit((1 << 62) - 1))),
        "offset": F.lit(0).cast("long")})
    names = [f"_key{k}" for k in range(len(key))]
    dealt = items.where(short).withColumns({
        "_shard": F.pmod(F.xxhash64(*key), F.lit(shards)), **dict(zip(names, key))})
    kept = [f for f in dealt.schema if f.name not in {"_shard", *names}]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", *names], ascending=[False] + [True] * len(names))
        number, offset = sum_of_squares(rows["length"].to_numpy(), capacity)
        return rows[[f.name for f in kept]].assign(
            sequence_id=number * shards + rows["_shard"].to_numpy(), offset=offset)

    packed = dealt.groupBy("_shard").applyInPandas(
        pack, f"{ddl}, sequence_id long, offset long")
    return packed.unionByName(full)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 4096) -> DataFrame:
    """Every piece with its ids and its place in a sequence."""
    cut = pieces(docs, tokenizer, end_id, capacity)
    key = ["part", "row", "piece"]
    placed = place(cut.select(*key, "length"), capacity, [F.col(c) for c in key])
    return cut.join(placed.drop("length"), key)
