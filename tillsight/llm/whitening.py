"""Whitened embeddings: principal components of whole-number vectors by contour integration.

Vectors become whole numbers, floor(64 * entry) + 1,000,000. Sums, and products of the
entries less the rounded mean, are taken in tasks without rounding and added up by
Spark as DECIMAL, so the covariance does not depend on the order of the rows and the
large offset cancels nothing. What the driver gets has the vectors' length squared,
whatever the number of rows. ``spectrum`` finds the components and verifies their number.
A last pass over the whitened rows measures how far their covariance is from the identity.

Defined results: rows without a vector, or with an entry that is null or not finite, take
no part, nor do vectors of another length than the most frequent one. All other rows take
part, also without ``vec_id`` or with an equal one. Components without variance (less
than ``LEAST`` of the total) are not returned; where all vectors are equal, or there are
none, no rows are. A deviation beyond a long raises. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import written
from .spectrum import largest
from .vectors import matrix, products, quantised

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 32
#: Share of the total variance below which a component has none.
LEAST = 1e-12

_PARTIAL = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("s", pa.decimal128(38, 0))])


@dataclass
class Fit:
    """n, exact sums of the vectors (without the offset), eigenvalues, components, trace."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def _totals(rows: DataFrame, of) -> dict[tuple[int, int], int]:
    """Sums over all rows of (i, j) entries of the object matrix ``of(x)`` of each batch."""
    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if len(batch):
                own = of(batch["x"]).astype(object)
                total = own if total is None else total + own
        if total is not None:
            i, j = np.indices(total.shape)
            upper = (j >= i) | (total.shape[0] == 1)
            yield pa.RecordBatch.from_arrays([
                pa.array(i[upper], pa.int32()), pa.array(j[upper], pa.int32()),
                pa.array(map(Decimal, total[upper].tolist()), pa.decimal128(38, 0))], schema=_PARTIAL)

    sums = rows.select("x").mapInArrow(partial, "i int, j int, s decimal(38,0)").groupBy("i", "j").agg(
        F.sum("s").alias("s"))
    return {(r["i"], r["j"]): int(r["s"]) for r in sums.collect()}  # the length squared at most


def fit(rows: DataFrame, length: int, components: int = COMPONENTS) -> Fit:
    """Components of the rows of ``vectors.quantised``."""
    sums_of = _totals(rows, lambda x: np.concatenate([[len(x)], matrix(x, length).sum(axis=0, dtype=object)])[None, :])
    n = sums_of.get((0, 0), 0)
    sums = np.array([sums_of.get((0, j + 1), 0) for j in range(length)], dtype=object)
    if not n:
        return Fit(0, sums, np.zeros(0), np.zeros((length, 0)), 0.0)
    # The rounded mean is taken off before multiplying; what it lacks of the mean is mended exactly.
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)

    def moments(x: pa.ListArray) -> np.ndarray:
        z = matrix(x, length) - centre
        return products(z.T, z)

    parts = _totals(rows, moments)
    rest = sums - n * centre.astype(object)
    v = np.empty((length, length))
    for (i, j), s in parts.items():
        v[i, j] = v[j, i] = (n * s - rest[i] * rest[j]) / (n * n)
    trace = float(np.trace(v))
    values, vectors = largest(v, min(components, length))
    kept = values > LEAST * trace
    return Fit(n, sums, values[kept], vectors[:, kept], trace)


def whitened(rows: DataFrame, found: Fit, *kept: str) -> DataFrame:
    """The kept long columns, ``deviation`` and the array ``whitened`` of every row, written."""
    n, sums, length = found.n, found.sums, len(found.sums)
    turn = found.vectors / np.sqrt(found.values) / n
    schema = pa.schema([*((k, pa.int64()) for k in kept), ("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1024):
                some = batch.slice(at, 1024)
                x = matrix(some["x"], length)
                most = n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, sums))
                # n * x - S, and the sum of its squares, in longs where these hold them.
                own = n * x - sums.astype(np.int64) if most < 1 << 62 else x.astype(object) * n - sums
                wide = own if most * most * length < 1 << 62 else own.astype(object)
                deviation = pa.array((wide * wide).sum(axis=1).tolist(), pa.int64())
                out = own.astype(np.float64) @ turn
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(some) + 1, dtype=np.int32) * out.shape[1]), pa.array(out.ravel()))
                yield pa.RecordBatch.from_arrays([*(some[k] for k in kept), deviation, lists], schema=schema)

    ddl = ", ".join([*(f"{k} long" for k in kept), "deviation long", "whitened array<double>"])
    return written(rows.select(*kept, "x").mapInArrow(work, ddl), "whitened")


def identity_error(rows: DataFrame, n: int, components: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` minus the identity, over the rows."""
    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((components + 1, components))
        for batch in batches:
            w = batch["whitened"].flatten().to_numpy().reshape(-1, components)
            total += np.vstack([w.sum(axis=0), w.T @ w])
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_pydict({"i": i.ravel().astype(np.int32), "j": j.ravel().astype(np.int32), "s": total.ravel()})

    parts = rows.select("whitened").mapInArrow(partial, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    total = np.zeros((components + 1, components))
    for r in parts.collect():  # bounded by the number of components squared
        total[r["i"], r["j"]] = r["s"]
    mean = total[0] / n  # of vectors that are centred already, so taking it off loses nothing
    return float(np.abs(total[1:] / n - np.outer(mean, mean) - np.eye(components)).max())


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every row and component."""
    table, length = quantised(rows, SCALE, "embedding", F.col("vec_id").cast("long").alias("vec_id"))
    found = fit(table, length, components)
    many = len(found.values)
    if not many:
        return rows.sparkSession.createDataFrame(
            [], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    done = whitened(table, found, "vec_id")
    error = identity_error(done, found.n, many)
    shares = F.array(*(F.lit(float(e / found.trace)) for e in found.values))
    return done.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(found.n).cast("long").alias("n"), "deviation",
        "whitened", shares[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"))
