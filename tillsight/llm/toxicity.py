"""Toxicity by cumulative-link ordinal regression on sparse text features.

Features are words and their beginnings, lower-cased (A-Z), each as three steps:
it occurs, twice, four times. One weight vector w serves all thresholds t1 < t2 < ...:
P(grade >= k) = sigmoid(w.x - tk), and the expected severity is the sum of these.

The labels say toxic or not. Toxic documents of the sample are graded 1 to
``GRADES`` by how often features typical of toxic documents occur in them, in
equal parts. A document is toxic if P(grade >= 1) is at least one half.

Fitting uses a bounded sample of labelled rows, ``TOXIC`` toxic and ``OTHER`` other
ones, drawn by a hash of the id from all labels. Typical features are counted over
the sample by Spark; the ``FEATURES`` strongest go to the driver, as do the
sample's vectors over them, and the fit is a few hundred steps on that matrix.
Scoring reads every document once, whole, and moves nothing.

Defined results: a null or empty text has no features, so it has the severity of
the thresholds alone. Conflicting labels of one id count as toxic; labels without
an id or a verdict are left out; of several documents with a labelled id one is
used. Without toxic or without other labelled documents no document is toxic and
severities are 0. Rows with equal ``doc_id`` are scored one by one. Other columns are
not read, or kept as they are where documents are filtered.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import written
from .workers import column_of, mapped

#: The bound of the sample, of the features, and the number of severity grades above 0.
TOXIC, OTHER, FEATURES, GRADES = 2_000, 4_000, 1_024, 3
#: A typical feature is in so many toxic documents of the sample at least, so many times
#: as often in them as in others, and with so large a likelihood ratio statistic.
SUPPORT, TYPICAL, EVIDENCE = 3, 8.0, 12.0
#: Counts from which a feature's steps apply.
COUNTS = (1, 2, 4)
#: Lengths of word beginnings, in bytes.
BEGINNINGS = range(4, 10)
#: Of the fit: weight decay, steps and their size.
DECAY, STEPS, RATE = 2e-5, 400, 0.05
#: Words whose features a worker keeps.
KEPT = 60_000

_NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32
                for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_NORMAL).split()


def features(word: bytes) -> list[bytes]:
    """The word, marked as whole, and its beginnings."""
    return [word + b"$", *(word[:n] for n in BEGINNINGS if len(word) > n)]


@dataclass
class Model:
    #: For each feature, what it adds to the score from each of COUNTS on.
    weights: dict[bytes, tuple[float, ...]]
    thresholds: list[float]
    known: dict[bytes, tuple[bytes, ...]] = field(default_factory=dict)

    def counts(self, text: str | None) -> Counter[bytes]:
        """How often each feature of the model occurs."""
        own = words(text)
        distinct = set(own)
        if len(self.known) > KEPT:
            self.known.clear()
        for word in distinct:
            if word not in self.known:
                self.known[word] = tuple(f for f in features(word) if f in self.weights)
        telling = {w for w in distinct if self.known[w]}
        found: Counter[bytes] = Counter()
        if telling:
            for word in own:
                if word in telling:
                    found.update(self.known[word])
        return found

    def exceed(self, text: str | None) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..."""
        if not self.thresholds:
            return np.zeros(GRADES)
        score = sum(self.weights[f][bisect_right(COUNTS, n) - 1] for f, n in sorted(self.counts(text).items()))
        return 1 / (1 + np.exp(np.clip(np.array(self.thresholds) - score, -60, 60)))

    def toxic(self, text: str | None) -> bool:
        return bool(self.exceed(text)[0] >= 0.5)


def fit_thresholds(x: np.ndarray, grade: np.ndarray, grades: int = GRADES) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and ordered thresholds of the largest penalised likelihood.

    Thresholds are a first one and positive steps, kept positive by their logarithms;
    steps are Adam's.
    """
    n, k = x.shape
    theta = np.concatenate([np.zeros(k), [1.0], np.zeros(grades - 1)])
    first, second = np.zeros_like(theta), np.zeros_like(theta)

    def thresholds(t: np.ndarray) -> np.ndarray:
        return np.cumsum(np.concatenate([t[k:k + 1], np.exp(t[k + 1:])]))

    for step in range(1, STEPS + 1):
        w, cuts = theta[:k], thresholds(theta)
        above = 1 / (1 + np.exp(np.clip(cuts - (x @ w.astype(x.dtype))[:, None], -60, 60)))
        # P(grade = j) = above_j - above_{j+1}; gradients of its logarithm by both bounds.
        edges = np.hstack([np.ones((n, 1)), above, np.zeros((n, 1))])
        slopes = edges * (1 - edges)
        row = np.arange(n)
        mass = np.maximum(edges[row, grade] - edges[row, grade + 1], 1e-9)
        by_score = (slopes[row, grade] - slopes[row, grade + 1]) / mass
        by_cut = np.zeros((n, grades))
        for j in range(1, grades + 1):
            by_cut[:, j - 1] = ((grade == j - 1) * slopes[:, j] - (grade == j) * slopes[:, j]) / mass
        cut_sums = by_cut.mean(axis=0)
        tail = cut_sums[::-1].cumsum()[::-1]  # a step moves every later threshold
        gradient = np.concatenate([
            x.T @ by_score.astype(x.dtype) / n - DECAY * w, tail[:1], tail[1:] * np.exp(theta[k + 1:])])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient ** 2
        theta = theta + RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return theta[:k], thresholds(theta)


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic, text) of the sample, written below the shared folder."""
    verdicts = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
                .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
                .agg((F.max(F.col("toxic").cast("int")) > 0).alias("toxic")))
    texts = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id IS NOT NULL")
    drawn = [verdicts.where(F.col("toxic") == toxic)
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
             for toxic, bound in ((True, TOXIC), (False, OTHER))]
    chosen = written(drawn[0].unionByName(drawn[1]), "labelled")
    # TOXIC + OTHER rows at most are broadcast, and as many texts come out.
    found = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(
        F.min("text").alias("text"))
    return written(found, "labelled-texts")


def _typical(sample: DataFrame, toxic: int, other: int) -> list[bytes]:
    """The features that tell toxic documents of the sample most, strongest first."""
    def present(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for is_toxic, text in zip(batch["toxic"].to_pylist(), batch["text"].to_pylist()):
                own = list({f for w in set(words(text)) for f in features(w)})
                yield pa.RecordBatch.from_pydict({
                    "feature": pa.array(own, pa.binary()), "toxic": pa.array([is_toxic] * len(own), pa.bool_())})

    counts = mapped(sample, present, "feature binary, toxic boolean").groupBy("feature").agg(
        F.count_if("toxic").alias("a"), F.count_if(~F.col("toxic")).alias("b"))
    a, b, n = F.col("a"), F.col("b"), toxic + other

    def part(seen, row, column):
        return F.when(seen > 0, seen * F.log(seen * n / (row * column))).otherwise(0.0)

    evidence = 2 * (part(a, a + b, F.lit(toxic)) + part(b, a + b, F.lit(other))
                    + part(toxic - a, n - a - b, F.lit(toxic)) + part(other - b, n - a - b, F.lit(other)))
    rows = counts.where((a >= SUPPORT) & (a / toxic >= TYPICAL * (b + 0.5) / other)).withColumn(
        "evidence", evidence).where(F.col("evidence") >= EVIDENCE).orderBy(
        F.desc("evidence"), "feature").limit(FEATURES).select("feature").collect()
    return [bytes(r["feature"]) for r in rows]


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    sample = _sample(docs, labels)
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return Model({}, [])
    chosen = _typical(sample, sizes[True], sizes[False])
    if not chosen:
        return Model({}, [])
    vocabulary = Model(dict.fromkeys(chosen, ()), [0.0])
    place = {f: i for i, f in enumerate(chosen)}

    def vectors(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for doc, toxic, text in zip(rows["doc_id"], rows["toxic"], rows["text"]):
                at = sorted((place[f], float(c)) for f, c in vocabulary.counts(text).items())
                out.append((doc, toxic, [a for a, _ in at], [c for _, c in at]))
            yield pd.DataFrame(out, columns=["doc_id", "toxic", "at", "counts"])

    rows = sample.mapInPandas(vectors, "doc_id long, toxic boolean, at array<int>, counts array<double>").orderBy("doc_id").collect()
    x = np.zeros((len(rows), len(chosen), len(COUNTS)), dtype=np.float32)
    often = np.zeros(len(rows))
    for i, r in enumerate(rows):
        x[i, r["at"]] = np.array(r["counts"])[:, None] >= np.array(COUNTS)
        often[i] = sum(r["counts"])
    toxic = np.array([r["toxic"] for r in rows])
    cuts = np.quantile(often[toxic], np.arange(1, GRADES) / GRADES)
    grade = np.where(toxic, 1 + (often[:, None] > cuts).sum(axis=1), 0)
    weights, thresholds = fit_thresholds(x.reshape(len(rows), -1), grade)
    steps = weights.reshape(len(chosen), -1).cumsum(axis=1)
    return Model({f: tuple(w) for f, w in zip(chosen, steps.tolist())}, thresholds.tolist())


_OUT = pa.schema([("doc_id", pa.int64()), ("severity", pa.float64()), ("grade", pa.int32()),
                  ("p_toxic", pa.float64()), ("toxic", pa.bool_())])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Expected severity, most likely reached grade and verdict of every document."""
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*sent.value)
        for batch in batches:
            p = np.array([own.exceed(t.as_py()) for t in batch["text"]]).reshape(-1, GRADES)
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"], pa.array(p.sum(axis=1)),
                pa.array((p >= 0.5).sum(axis=1).astype(np.int32)), pa.array(p[:, 0]),
                pa.array(p[:, 0] >= 0.5)], schema=_OUT)

    return mapped(docs.select(F.col("doc_id").cast("long"), "text"), scored,
                  "doc_id long, severity double, grade int, p_toxic double, toxic boolean")


def clean(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are not toxic, unchanged."""
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))

    def fine(texts: Iterable[pa.Array]) -> Iterator[pa.Array]:
        own = Model(*sent.value)
        for some in texts:
            yield pa.array([not own.toxic(t.as_py()) for t in some], pa.bool_())

    return docs.where(column_of("boolean", fine, "text"))
