"""Hard negatives by a multiway hyperplane tree with distance ranges (GNAT).

The tree: a node has up to ``FANOUT`` split points, and a row goes to the nearest one.
For every split point and every sibling subtree the node keeps the smallest and the largest
distance from the point to the subtree's rows, taken over all rows. A window of
scores (inner products) is, with the lengths of a subtree's vectors, an annulus of
distances around the query; a subtree goes if, for any split point, its range
misses what the triangle inequality leaves of the annulus. Rows of leaves are
compared exactly, so results are exact whatever the tree is like.

Split points come from a sample of ``SAMPLE`` rows, which bounds the tree; all rows are
put into it. A leaf's rows lie in blocks of about ``LEAF`` rows, chosen by a hash, so a leaf
of very many, or equal, rows is many blocks. A search is two visits. The first, of the query's home
leaf, finds k rows; the worst of their scores narrows the window. The second is of all leaves
that are left. Queries travel in packs to the blocks, and a block returns k rows a window.

Scores are whole numbers and exact, by Python's numbers where longs do not hold them; a score
beyond a long raises.

Defined results: rows without a label, a ``vec_id`` or a vector, or with an entry that is null or
not finite, take no part, nor do vectors of another length than the most frequent one. Rows
with equal ``vec_id`` are rows of their own, in any order among equal scores; so a row can
be a positive of another row of its id. No rows, or no anchors, give no rows. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.workspace import written
from .vectors import matrix, products, quantised

SCALE, POSITIVES, NEGATIVES = 256, 5, 3
#: Rows the tree is fitted on, split points of a node, rows of a block, queries of a pack.
SAMPLE, FANOUT, LEAF, PACK = 4_096, 8, 2_048, 256
#: Windows compared at once.
AT_ONCE = 512
#: Stand for no bound of a window.
LOWEST, HIGHEST = -(1 << 62), 1 << 62


def _squares(x: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)


def _far(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances of rows to points. Floats suffice: bounds made of them are given room."""
    x, points = x.astype(np.float64), points.astype(np.float64)
    return np.sqrt(np.maximum(_squares(x)[:, None] + _squares(points)[None, :] - 2 * (x @ points.T), 0))


class Tree:
    """Split points and children of the nodes; ranges are put in when all rows are known."""

    def __init__(self, sample: np.ndarray, rows: int):
        self.points: list[np.ndarray] = []
        self.children: list[list[int]] = []  # node, or -1 - leaf
        self.leaves = 0
        share = rows / max(len(sample), 1)
        if len(sample):
            self.root = self._grown(np.unique(sample, axis=0, return_counts=True), share)
        else:
            self.root = self._leaf()

    def _leaf(self) -> int:
        self.leaves += 1
        return -self.leaves

    def _grown(self, sample: tuple[np.ndarray, np.ndarray], share: float) -> int:
        x, counts = sample
        if len(x) < 2 * FANOUT or counts.sum() * share <= LEAF:
            return self._leaf()
        # Split points far from each other: each next one is the farthest from those before.
        chosen = [0]
        nearest = _far(x, x[:1])[:, 0]
        while len(chosen) < FANOUT:
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, _far(x, x[chosen[-1:]])[:, 0])
        node = len(self.points)
        self.points.append(x[chosen])
        self.children.append([])
        own = _far(x, x[chosen]).argmin(axis=1)
        self.children[node] = [self._grown((x[own == c], counts[own == c]), share) for c in range(FANOUT)]
        return node

    def placed(self, x: np.ndarray) -> tuple[np.ndarray, dict[tuple[int, int], np.ndarray]]:
        """Leaf of every row, and by (node, child) the ranges of the rows put there: rows of
        (least, most), one a split point and a last one of the vectors' own lengths."""
        leaf, ranges = np.zeros(len(x), dtype=np.int32), {}
        waiting = [(self.root, np.arange(len(x)))]
        while waiting:
            node, rows = waiting.pop()
            if node < 0:
                leaf[rows] = -1 - node
                continue
            far = _far(x[rows], self.points[node])
            own = far.argmin(axis=1)
            lengths = np.sqrt(_squares(x[rows].astype(np.float64)))
            every = np.hstack([far, lengths[:, None]])
            for child, below in enumerate(self.children[node]):
                some = own == child
                if some.any():
                    ranges[node, child] = np.stack([every[some].min(axis=0), every[some].max(axis=0)], axis=1)
                    waiting.append((below, rows[some]))
        return leaf, ranges

    def visited(self, x: np.ndarray, lo: np.ndarray, hi: np.ndarray,
                ranges: dict[tuple[int, int], np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows): the windows (rows of x, lo, hi) whose annulus meets the leaf's ranges."""
        lengths = np.sqrt(_squares(x.astype(np.float64)))
        low = np.where(lo <= LOWEST, -np.inf, lo.astype(np.float64))
        high = np.where(hi >= HIGHEST, np.inf, hi.astype(np.float64))
        waiting = [(self.root, np.flatnonzero(lo <= hi))]
        while waiting:
            node, rows = waiting.pop()
            if not len(rows):
                continue
            if node < 0:
                yield -1 - node, rows
                continue
            far = _far(x[rows], self.points[node])
            for child, below in enumerate(self.children[node]):
                if (node, child) not in ranges:
                    continue  # no row went there
                least, most = ranges[node, child][:, 0], ranges[node, child][:, 1]
                # Distances around the query at which the window's scores can lie.
                inner = lengths[rows] ** 2 + least[-1] ** 2 - 2 * high[rows]
                outer = lengths[rows] ** 2 + most[-1] ** 2 - 2 * low[rows]
                room = 1e-6 * (lengths[rows] + most[-1] + 1)
                inner, outer = (np.sqrt(np.maximum(d, 0)) for d in (inner, outer + room))
                left = np.maximum(far - outer[:, None], inner[:, None] - far) - room[:, None]
                right = far + outer[:, None] + room[:, None]
                meets = ((left <= most[None, :-1]) & (right >= least[None, :-1])).all(axis=1)
                waiting.append((below, rows[meets]))


class Index:
    """All rows in the blocks of a tree's leaves."""

    def __init__(self, rows: DataFrame, length: int):
        """``rows``: written (key, vec_id, label, x)."""
        self.length = length
        total = rows.count()
        drawn = rows.select("x").orderBy(F.xxhash64("vec_id"), "key").limit(SAMPLE).collect()  # SAMPLE rows
        tree = Tree(np.array([r["x"] for r in drawn], dtype=np.int64).reshape(len(drawn), length), total)
        spark = rows.sparkSession
        sent = spark.sparkContext.broadcast(tree)  # SAMPLE vectors at most

        def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                leaf, _ = sent.value.placed(matrix(batch["x"], length))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=[*batch.schema.names, "leaf"])

        def ranges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                for at, own in sent.value.placed(matrix(batch["x"], length))[1].items():
                    old = found.get(at, own)
                    found[at] = np.stack([np.minimum(old[:, 0], own[:, 0]), np.maximum(old[:, 1], own[:, 1])], axis=1)
            rows = [(n, c, p, *r) for (n, c), own in found.items() for p, r in enumerate(own.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows) if rows else [[]] * 5, [pa.int32()] * 3 + [pa.float64()] * 2)],
                names=["node", "child", "point", "least", "most"])

        bounds = rows.select("x").mapInArrow(ranges, "node int, child int, point int, least double, most double")
        # As many rows as the tree has split points, times FANOUT + 1.
        self.ranges: dict[tuple[int, int], np.ndarray] = {}
        for r in bounds.groupBy("node", "child", "point").agg(F.min("least").alias("least"), F.max("most").alias("most")).collect():
            own = self.ranges.setdefault((r["node"], r["child"]), np.zeros((FANOUT + 1, 2)))
            own[r["point"]] = r["least"], r["most"]
        placed = written(rows.mapInArrow(place, "key long, vec_id long, label long, x array<long>, leaf int"), "placed")
        sizes = {r["leaf"]: r["count"] for r in placed.groupBy("leaf").count().collect()}  # the leaves
        self.blocks_of = {leaf: -(-n // LEAF) for leaf, n in sizes.items()}
        self.sent = spark.sparkContext.broadcast((tree, self.ranges, self.blocks_of))
        # By the leaf's number, as one list: an expression nested by leaves would grow with the rows.
        blocks = F.lit([self.blocks_of.get(leaf, 1) for leaf in range(tree.leaves)])
        dealt = placed.withColumn("block", F.pmod(F.xxhash64("key"), F.get(blocks, F.col("leaf"))).cast("int"))
        schema = pa.schema([("leaf", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("ids", pa.binary()),
                            ("labels", pa.binary()), ("kind", pa.string()), ("x", pa.binary())])

        def stacked(table: pa.Table) -> pa.Table:
            table = table.sort_by([("vec_id", "ascending"), ("key", "ascending")]).combine_chunks()
            x, kind = _narrow(matrix(table["x"].combine_chunks(), length))
            return pa.Table.from_arrays([
                table["leaf"][:1], table["block"][:1],
                *(pa.array([table[c].to_numpy().astype(np.int64).tobytes()], pa.binary()) for c in ("key", "vec_id", "label")),
                pa.array([kind]), pa.array([x], pa.binary())], schema=schema)

        self.blocks = written(dealt.groupBy("leaf", "block").applyInArrow(
            stacked, "leaf int, block int, keys binary, ids binary, labels binary, kind string, x binary"), "blocks")

    def search(self, queries: DataFrame, take: int, same: bool) -> DataFrame:
        """(key, window, found, vec_id, score, rank): for every window of every query the ``take`` rows
        of the highest scores, of equal ones those of the smallest ``vec_id``.

        ``queries``: written (key, label, x, windows array<struct<window int, lo long, hi long>>). Rows
        of the query's own label, but for itself, are searched, or those of other labels.
        """
        best = Window.partitionBy("key", "window").orderBy(F.desc("score"), "vec_id", "found")

        def top(rows: DataFrame) -> DataFrame:
            return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= take)

        home = top(self._visit(queries, take, same, home=True))
        narrower = home.where(F.col("rank") == take).groupBy("key").agg(
            F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("reached"))  # one a window
        second = written(queries.join(narrower, "key", "left").select("key", "label", "x", F.transform(
            "windows", lambda w: F.struct(
                w["window"].alias("window"),
                F.coalesce(F.greatest(w["lo"], F.try_element_at("reached", w["window"])), w["lo"]).alias("lo"),
                w["hi"].alias("hi"))).alias("windows")), "narrowed")
        return top(self._visit(second, take, same, home=False))

    def _visit(self, queries: DataFrame, take: int, same: bool, home: bool) -> DataFrame:
        """The best ``take`` rows of every visited block for every window."""
        length, sent = self.length, self.sent
        pack = pa.schema([("leaf", pa.int32()), ("block", pa.int32()), ("q_keys", pa.binary()), ("q_labels", pa.binary()),
                          ("q_kind", pa.string()), ("q_x", pa.binary()), ("q_windows", pa.binary())])

        def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tree, ranges, blocks_of = sent.value
            for batch in batches:
                for at in range(0, len(batch), PACK):
                    some = batch.slice(at, PACK)
                    x, keys = matrix(some["x"], length), some["key"].to_numpy()
                    labels = some["label"].to_numpy()
                    listed = some["windows"]
                    own = np.repeat(np.arange(len(some)), np.diff(listed.offsets.to_numpy()))
                    flat = listed.flatten()
                    number, lo, hi = (flat.field(n).to_numpy().astype(np.int64) for n in ("window", "lo", "hi"))
                    if home:
                        leaf = tree.placed(x)[0][own]
                        visits = [(k, np.flatnonzero((leaf == k) & (lo <= hi))) for k in np.unique(leaf).tolist()]
                    else:
                        visits = tree.visited(x[own], lo, hi, ranges)
                    for leaf, rows in visits:
                        if not len(rows) or leaf not in blocks_of:
                            continue
                        used, which = np.unique(own[rows], return_inverse=True)
                        packed, kind = _narrow(x[used])
                        windows = np.stack([which, number[rows], lo[rows], hi[rows]]).astype(np.int64)
                        for block in range(blocks_of[leaf]):
                            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((
                                leaf, block, keys[used].tobytes(), labels[used].astype(np.int64).tobytes(), kind, packed,
                                windows.tobytes()), pack)], schema=pack)

        out = pa.schema([("key", pa.int64()), ("window", pa.int32()), ("found", pa.int64()), ("vec_id", pa.int64()),
                         ("score", pa.int64())])

        def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in batch.to_pylist():
                    keys, ids, labels, q_keys, q_labels = (
                        np.frombuffer(r[c], np.int64) for c in ("keys", "ids", "labels", "q_keys", "q_labels"))
                    x = np.frombuffer(r["x"], r["kind"]).reshape(-1, length).astype(np.int64)
                    q = np.frombuffer(r["q_x"], r["q_kind"]).reshape(-1, length).astype(np.int64)
                    windows = np.frombuffer(r["q_windows"], np.int64).reshape(4, -1)
                    fits = (q_labels[:, None] == labels[None, :]) == same
                    fits &= q_keys[:, None] != keys[None, :]
                    scores = products(q, x.T)
                    for at in range(0, windows.shape[1], AT_ONCE):
                        own, number, lo, hi = windows[:, at:at + AT_ONCE]
                        row, column = best_of(scores[own], fits[own], lo, hi, take)
                        if len(row):
                            yield pa.RecordBatch.from_arrays([
                                pa.array(q_keys[own[row]]), pa.array(number[row].astype(np.int32)), pa.array(keys[column]),
                                pa.array(ids[column]), pa.array(scores[own[row], column].tolist(), pa.int64())], schema=out)

        packs = queries.mapInArrow(route, "leaf int, block int, q_keys binary, q_labels binary, q_kind string, "
                                          "q_x binary, q_windows binary")
        # A block meets many packs: it is dealt out with them, one at a time in a task. Packs are many times
        # larger than the queries' file, which their size is guessed from: without the hint they are broadcast.
        return self.blocks.join(packs.hint("merge"), ["leaf", "block"]).mapInArrow(
            compare, "key long, window int, found long, vec_id long, score long")


def _narrow(x: np.ndarray) -> tuple[bytes, str]:
    """The numbers in the narrowest kind that holds them, and the kind."""
    most = max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
    kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
    return x.astype(kind).tobytes(), kind


def best_of(scores: np.ndarray, fits: np.ndarray, lo: np.ndarray, hi: np.ndarray, take: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``take`` highest scores of every row that fit and lie in its window;
    of equal scores those of the first columns."""
    fits = fits & (scores >= lo[:, None]) & (scores <= hi[:, None])
    some = np.flatnonzero(fits.any(axis=1))
    if not len(some):
        return some, some
    width = scores.shape[1]
    own = scores[some]
    if own.dtype == object or max(abs(int(own.min())), abs(int(own.max()))) >= (1 << 61) // width:
        own = np.unique(own, return_inverse=True)[1].reshape(own.shape)  # their order is all that counts
    # Score and column in one number, so that none are equal.
    order = np.where(fits[some], own * width + (width - 1 - np.arange(width)), np.iinfo(np.int64).min)
    take = min(take, width)
    columns = np.argpartition(order, width - take, axis=1)[:, width - take:]
    row = np.repeat(some, take)
    column = columns.ravel()
    good = fits[row, column]
    return row[good], column[good]


def mine(rows: DataFrame, anchor: Column, label: Column | None = None, scale: int = SCALE,
         positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = 50, most: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchor`` says which rows are anchors, by ``vec_id``. Negatives of an anchor and one of its
    positives score from ``least`` to ``most`` percent of the positive's score.
    """
    label = F.col("label") if label is None else label
    usable = rows.where("vec_id IS NOT NULL AND label IS NOT NULL")
    table, length = quantised(usable, scale, "embedding", F.monotonically_increasing_id().alias("key"),
                              F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"))
    index = Index(table, length)

    def windows(*fields: Column) -> Column:
        return F.struct(*(f.alias(n) for f, n in zip(fields, ("window", "lo", "hi"))))

    anchors = written(table.where(anchor), "anchors")
    every = F.array(windows(F.lit(0), F.lit(LOWEST).cast("long"), F.lit(HIGHEST).cast("long")))
    near = written(index.search(anchors.select("key", "label", "x", every.alias("windows")), positives, same=True),
                   "positives")
    # Of a positive's score p: least * p <= 100 * n <= most * p, in whole numbers.
    p = F.col("score").cast("decimal(20,0)")
    asked = written(near.groupBy("key").agg(F.collect_list(windows(
        F.col("rank"), F.ceil(p * least / 100).cast("long"),
        F.floor(p * most / 100).cast("long"))).alias("windows"))
        .join(anchors.select("key", "label", "x"), "key").select("key", "label", "x", "windows"), "asked")
    found = index.search(asked, negatives, same=False)
    pairs = near.select("key", F.col("rank").alias("window"), F.col("vec_id").alias("positive_id"),
                        F.col("score").alias("positive_score"))
    return (found.select("key", "window", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(pairs, ["key", "window"])
            .join(anchors.select("key", F.col("vec_id").alias("anchor_id")), "key")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def oracle(anchors: int = 50) -> str:
    """The same rows by comparing every anchor with every row."""
    return f"""
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor({SCALE} * e::DOUBLE) FOR e IN embedding] AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([1 FOR e IN embedding IF e IS NULL OR NOT isfinite(e)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_dot_product(a.x, r.x)::BIGINT AS score
  FROM rows a JOIN rows r ON a.vec_id <> r.vec_id
  WHERE a.vec_id % {anchors} = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}),
negatives AS (
  SELECT p.anchor_id, p.positive_id, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id)::INT AS rank
  FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
   AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= {NEGATIVES}
"""
