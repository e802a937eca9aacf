"""Connected components of a graph given by its edges."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import written
from .workers import mapped

_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def matrix_labels(linked: np.ndarray, left: np.ndarray, right: np.ndarray, size: int) -> np.ndarray:
    """The smallest vertex that each of 0 to size - 1 reaches; linked: rows of left, columns of right.

    Works on whole rows of the matrix, so dense links cost no list of pairs.
    """
    label = np.full(size, -1)
    for start in range(size):
        if label[start] >= 0:
            continue
        front = np.zeros(size, dtype=bool)
        front[start] = True
        while front.any():
            label[front] = start
            after = np.zeros(size, dtype=bool)
            if (rows := front[left]).any():
                after[right] |= linked[rows].any(axis=0)
            if (columns := front[right]).any():
                after[left] |= linked[:, columns].any(axis=1)
            front = after & (label < 0)
    return label


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(smallest vertex, vertex) for the components of some edges."""
    vertices, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    low, high = flat[:len(a)], flat[len(a):]
    label = np.arange(len(vertices))
    while True:
        smaller = np.minimum(label[low], label[high])
        np.minimum.at(label, label[low], smaller)
        np.minimum.at(label, label[high], smaller)
        while (label[label] != label).any():
            label = label[label]
        if (label[low] == label[high]).all():
            return vertices[label], vertices


def _contracted(edges: DataFrame) -> DataFrame:
    """Each task's edges as stars, which keeps the components and shortens their paths."""
    def contract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                centre, vertex = stars(batch["a"].to_numpy(), batch["b"].to_numpy())
                apart = centre != vertex
                yield pa.RecordBatch.from_arrays(
                    [pa.array(centre[apart]), pa.array(vertex[apart])], schema=_EDGES)

    return mapped(edges, contract, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(v, label) for every vertex of edges (a, b); the label is the smallest vertex it reaches.

    In each round a vertex takes the smallest label among its neighbours and then
    the label of that label. Paths halve, so the rounds grow with the logarithm of
    a component's diameter. Each round is written, so a lost executor costs one round.
    """
    edges = written(_contracted(edges.select("a", "b").where("a <> b")).distinct(), "edges")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = written(both.groupBy(F.col("a").alias("v")).agg(
        F.least(F.min("b"), F.col("v")).alias("label")), "labels")
    while True:
        # Minima are combined before the shuffle, so a vertex with many neighbours is no load.
        heard = both.join(labels, F.col("a") == F.col("v")).groupBy("b").agg(F.min("label").alias("heard"))
        lower = labels.join(heard, F.col("v") == F.col("b")).select(
            "v", F.col("label").alias("old"), F.least("label", "heard").alias("label"))
        jump = labels.select(F.col("v").alias("at"), F.col("label").alias("further"))
        found = written(lower.join(jump, F.col("label") == F.col("at")).select(
            "v", "old", F.least("label", "further").alias("label")), "labels")
        labels = found.select("v", "label")
        if found.where("label <> old").isEmpty():
            return labels
