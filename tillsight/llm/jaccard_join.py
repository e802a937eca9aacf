"""Chosen-path similarity join of documents on the Jaccard similarity of word shingles.

Equal sets are one class from the start, so copies cost a count. Each class is
embedded as ``SKETCH`` tokens (i, smallest value of hash i over its set); two sets
share a token with a chance equal to their similarity. A run splits all sets by
sampled tokens: at a node, each of the token places is chosen with probability
1 / (similarity * SKETCH), by a hash of the node, and the sets with equal tokens
there go on together. Nodes of up to ``LEAF`` sets are compared by brute force,
larger ones are split again, up to ``DEPTH`` times. A pair at the threshold shares
at least one leaf of a run with a probability that follows from this recursion;
runs repeat until the target recall.

A leaf compares sketches only, with a margin, and passes on edges that span
its candidate pairs. Their connected components hold every candidate pair; within
a component all pairs are checked exactly on the shingle sets, once, so a link
counts once however many leaves it was in. Components beyond ``BLOCK`` sets or
``BLOCK_SHINGLES`` shingles are checked in pairs of blocks. No pair leaves a task:
tasks return numbers of links and spanning edges, and the components of those
are the final classes.

The sets of a larger node are first compared with one of them. Where at most
``LEAF`` are not alike to it, as among the near copies of one text, the others form
one component already and only those few are compared with all, in blocks; the node
is not split. The same is done, with more blocks, where a node is too large after the
last split.

Defined results: null and empty texts, and texts without words, have the empty
set; they are copies of each other. Rows with null or equal ``doc_id`` are documents
of their own. A document's links are the other documents at or above the
similarity, copies included. No rows give no rows. Other columns are not read, or
kept as they are by ``first_of_each``.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import written
from .components import components, matrix_labels
from .shingles import mix, shingle_sets
from .workers import column_of, mapped

SHINGLE, SIMILARITY, RECALL = 5, 0.8, 0.999
SKETCH, LEAF, DEPTH = 64, 1_000, 3
#: Standard deviations of the sketch's estimate below the threshold that still count.
MARGIN = 4.0
#: Sets and shingles of a component, or of two blocks of one, that one task compares.
BLOCK, BLOCK_SHINGLES = 1_000, 2_000_000

_SEEDS = np.random.default_rng(5).integers(0, 2**63, (2, SKETCH), dtype=np.uint64)
_SEEDS[1] |= np.uint64(1)


def least_matches(similarity: float) -> int:
    """Equal tokens of two sketches from which a pair is a candidate."""
    mean = similarity * SKETCH
    return max(1, math.ceil(mean - MARGIN * math.sqrt(mean * (1 - similarity))))


def run_recall(depth: int) -> float:
    """Chance that a pair at the threshold shares a leaf of a run that splits so often.

    Each of the SKETCH places is chosen and shared with probability 1 / SKETCH.
    """
    found = 1.0
    for _ in range(depth):
        found = 1 - (1 - found / SKETCH) ** SKETCH
    return found


def runs_for(recall: float, depth: int = DEPTH) -> int:
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - run_recall(depth))))


# --- sketches -------------------------------------------------------------------

def sketch_of(sets: list[np.ndarray]) -> np.ndarray:
    """One row of tokens (uint32) for each set; every set has a member."""
    flat = np.concatenate(sets)
    at = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), SKETCH), dtype=np.uint32)
    with np.errstate(over="ignore"):
        for i in range(SKETCH):
            values = ((flat ^ _SEEDS[0, i]) * _SEEDS[1, i]) >> np.uint64(32)
            out[:, i] = np.minimum.reduceat(values, at)
    return out


def sketched(docs: DataFrame, column: str, shingle: int = SHINGLE) -> DataFrame:
    """The documents with struct ``column``: key, digest of the set (d1, d2), size n, sketch; written.

    Texts alone are sent to the workers.
    """
    fields = [("d1", pa.int64()), ("d2", pa.int64()), ("n", pa.int64()), ("sketch", pa.binary())]

    def sketch(arrays: Iterable[pa.Array]) -> Iterator[pa.Array]:
        for texts in arrays:
            rows = []
            for at in range(0, len(texts), 256):
                sets = shingle_sets(texts[at:at + 256].to_pylist(), shingle)
                full = [s for s in sets if len(s)]
                tokens = iter(sketch_of(full) if full else ())
                with np.errstate(over="ignore"):
                    rows += [(s.sum(dtype=np.uint64).astype(np.int64).item(),
                              np.bitwise_xor.reduce(mix(s ^ np.uint64(0x5bd1e995))).astype(np.int64).item(),
                              len(s), next(tokens).tobytes() if len(s) else None) for s in sets]
            columns = zip(*rows) if rows else [[]] * len(fields)
            yield pa.StructArray.from_arrays(
                [pa.array(c, t) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])

    near = column_of("d1 long, d2 long, n long, sketch binary", sketch, "text")
    return written(docs.withColumn(column, near).withColumn(column, F.struct(
        F.monotonically_increasing_id().alias("key"), *(F.col(f"{column}.{n}") for n, _ in fields))), "sketched")


# --- chosen paths ---------------------------------------------------------------

def chosen_places(nodes: np.ndarray, similarity: float) -> np.ndarray:
    """For each node, which token places it splits on (bool, nodes x SKETCH)."""
    with np.errstate(over="ignore"):
        draw = mix(nodes[:, None] + _SEEDS[0][None, :] * np.uint64(3))
    return draw < np.uint64(min(1.0, 1 / (similarity * SKETCH)) * (2**64 - 1))


def children(nodes: np.ndarray, tokens: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, child node) for every place that the row's node splits on."""
    row, place = np.nonzero(chosen_places(nodes, similarity))
    with np.errstate(over="ignore"):
        child = mix(nodes[row] * np.uint64(0x9E3779B97F4A7C15)
                    ^ mix(tokens[row, place].astype(np.uint64) + (place.astype(np.uint64) << np.uint64(32))))
    return row, child


def _tokens(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, SKETCH)


def _split(rows: DataFrame, similarity: float, runs: int) -> DataFrame:
    """(node, key, size) of the nodes below that hold two sets at least, written.

    Rows (key, sketch) are at the roots of all runs, rows (node, key, sketch) at their nodes.
    """
    at_root = "node" not in rows.columns
    roots = mix(np.arange(1, runs + 1, dtype=np.uint64))
    out = pa.schema([("node", pa.int64()), ("key", pa.int64())])

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 4096):
                some = batch.slice(at, 4096)
                tokens, keys = _tokens(some["sketch"]), some["key"].to_numpy()
                starts = (np.full(len(keys), r) for r in roots) if at_root else [
                    some["node"].to_numpy().astype(np.uint64)]
                for nodes in starts:
                    row, child = children(nodes, tokens, similarity)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(child.astype(np.int64)), pa.array(keys[row])], schema=out)

    nodes = written(mapped(rows, split, "node long, key long"), "nodes")
    sizes = nodes.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
    return written(nodes.join(sizes, "node"), "shared-nodes")


def alike(tokens: np.ndarray, left: np.ndarray, right: np.ndarray, least: int) -> np.ndarray:
    """Which sketches of left (rows) and right (columns) have so many equal tokens at least."""
    if len(left) * len(right) <= 4096:
        return (tokens[left][:, None, :] == tokens[right][None, :, :]).sum(axis=2) >= least
    same = np.zeros((len(left), len(right)), dtype=np.uint8)
    for place in range(SKETCH):
        same += tokens[left, place][:, None] == tokens[right, place][None, :]
    return same >= least


_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _groups(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Tables of whole groups of rows, which come sorted by the column."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        ids = batch[column].to_numpy()
        if rest and rest[-1][column][-1].as_py() != ids[0]:
            yield pa.Table.from_batches(rest)
            rest = []
        others = np.flatnonzero(ids != ids[-1])
        last = int(others[-1]) + 1 if len(others) else 0
        if last:
            yield pa.Table.from_batches([*rest, batch.slice(0, last)])
            rest = []
        rest.append(batch.slice(last))
    if rest:
        yield pa.Table.from_batches(rest)


def _compared(groups: DataFrame, least: int) -> DataFrame:
    """Edges (a, b) that span the candidate pairs of every group (node, part, key, side, sketch).

    Side 0 is compared with itself and with side 1, and rows of side 1 not with each other.
    """
    dealt = groups.withColumn("group", F.xxhash64("node", "part"))
    parts = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = dealt.select("group", "key", "side", "sketch").repartition(parts, "group").sortWithinPartitions("group")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, "group"):
            ids, keys, sides = (table[c].to_numpy() for c in ("group", "key", "side"))
            tokens = _tokens(table["sketch"].combine_chunks())
            starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            sizes = np.diff(np.append(starts, len(ids)))
            two = starts[sizes == 2]
            hits = two[(tokens[two] == tokens[two + 1]).sum(axis=1) >= least]
            a, b = [hits], [hits + 1]
            for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                rows, side = np.arange(size), sides[start:start + size]
                left = rows[side == 0]
                label = matrix_labels(alike(tokens[start:start + size], left, rows, least), left, rows, size)
                joined = np.flatnonzero(label != rows)
                a.append(start + label[joined])
                b.append(start + joined)
            first, second = keys[np.concatenate(a)], keys[np.concatenate(b)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(first, second)), pa.array(np.maximum(first, second))], schema=_EDGES)

    return mapped(rows, compare, "a long, b long")


#: Centres up to so many, each of one node, are broadcast.
CENTRES = 20_000


def _judged(large: DataFrame, least: int) -> DataFrame:
    """Rows (node, key, size, sketch) of large nodes with the node's centre and whether they
    are alike to it, and ``far``, how many of the node's are not; written."""
    large = written(large, "large-nodes")
    centres = written(large.groupBy("node").agg(F.min(F.struct("key", "sketch")).alias("c")).select(
        "node", F.col("c.key").alias("centre"), F.col("c.sketch").alias("middle")), "centres")
    if centres.count() <= CENTRES:
        centres = F.broadcast(centres)
    schema = pa.schema([("node", pa.int64()), ("key", pa.int64()), ("size", pa.int64()),
                        ("sketch", pa.binary()), ("centre", pa.int64()), ("close", pa.bool_())])

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                close = (_tokens(batch["sketch"]) == _tokens(batch["middle"])).sum(axis=1) >= least
                yield pa.RecordBatch.from_arrays(
                    [*(batch[n] for n in schema.names[:5]), pa.array(close)], schema=schema)

    judged = written(mapped(large.join(centres, "node").select(*schema.names[:5], "middle"), judge,
                            "node long, key long, size long, sketch binary, centre long, close boolean"), "judged")
    far = written(judged.groupBy("node").agg(F.count_if(~F.col("close")).alias("far")), "far")
    if far.count() <= CENTRES:
        far = F.broadcast(far)
    return written(judged.join(far, "node"), "judged")


def _around_centres(judged: DataFrame, least: int) -> DataFrame:
    """Edges of whole nodes: each close set with the centre, each far one with all in blocks."""
    near = judged.where("close AND key <> centre").select(
        F.col("centre").alias("a"), F.col("key").alias("b"))
    dealt = judged.where("far > 0").withColumns({
        "blocks": F.ceil(F.col("size") / LEAF), "far_blocks": F.ceil(F.col("far") / LEAF)})
    if dealt.isEmpty():
        return near
    dealt = dealt.withColumns({"own": F.pmod(F.xxhash64("key"), F.col("blocks")),
                               "far_own": F.pmod(F.xxhash64("key"), F.col("far_blocks"))})

    def rows(which: str, side: int, block: str, far_block: str, spread: str | None = None) -> DataFrame:
        some = dealt if spread is None else dealt.withColumn("at", F.explode(F.expr(spread)))
        return some.where(which).select(
            "node", "key", F.lit(side).alias("side"), "sketch",
            F.struct(F.expr(block).alias("block"), F.expr(far_block).alias("far_block")).alias("part"))

    every = "sequence(0L, far_blocks - 1)"
    groups = (
        # Each block of far sets with itself and with each block of close ones.
        rows("NOT close", 0, "at", "far_own", "sequence(0L, blocks - 1)")
        .unionByName(rows("close", 1, "own", "at", every))
        # Two blocks of far sets.
        .unionByName(rows("NOT close AND at > far_own", 0, "-1 - at", "far_own", every))
        .unionByName(rows("NOT close AND at < far_own", 1, "-1 - far_own", "at", every)))
    return near.unionByName(_compared(groups, least))


def candidates(sketches: DataFrame, similarity: float, recall: float) -> DataFrame:
    """Edges (a, b) between keys whose components hold every candidate pair.

    ``sketches`` is a written (key, sketch).
    """
    least, runs = least_matches(similarity), runs_for(recall, DEPTH)
    level = _split(sketches, similarity, runs)
    leaves, found = level.where(F.col("size") <= LEAF), []
    for depth in range(1, DEPTH + 1):
        large = level.where(F.col("size") > LEAF)
        if large.isEmpty():
            break
        judged = _judged(large.join(sketches, "key"), least)
        last = depth == DEPTH
        found.append(_around_centres(judged if last else judged.where(F.col("far") <= LEAF), least))
        if last:
            break
        level = _split(judged.where(F.col("far") > LEAF).select("node", "key", "sketch"), similarity, runs)
        leaves = leaves.unionByName(level.where(F.col("size") <= LEAF))
    edges = _compared(leaves.join(sketches, "key").select(
        "node", "key", F.lit(0).alias("side"), F.lit(0).alias("part"), "sketch"), least)
    for more in found:
        edges = edges.unionByName(more)
    return edges


# --- exact check ----------------------------------------------------------------

def shared_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers of common members of sets of left and right (rows x columns).

    Members that lie in the same sets are one column with a weight, and those in one
    set only are none, so near copies come down to a narrow matrix.
    """
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    members, which = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(which, kind="stable")
    which, owner = which[order], owner[order]
    starts = np.searchsorted(which, np.arange(len(members)))
    counts = np.diff(np.append(starts, len(which)))
    marks = np.random.default_rng(3).integers(0, 2**63, len(sets), dtype=np.uint64)
    with np.errstate(over="ignore"):
        where = np.add.reduceat(marks[owner], starts) if len(starts) else np.zeros(0, np.uint64)
    shared = np.flatnonzero(counts > 1)
    _, first, weight = np.unique(where[shared], return_index=True, return_counts=True)
    columns = shared[first]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    for at in range(0, len(columns), 2048):
        some = columns[at:at + 2048]
        matrix = np.zeros((len(sets), len(some)), dtype=np.float32)
        sizes = counts[some]
        rows = np.concatenate([owner[s:s + n] for s, n in zip(starts[some], sizes)])
        matrix[rows, np.repeat(np.arange(len(some)), sizes)] = 1
        out += (matrix[left] * weight[at:at + 2048].astype(np.float32)) @ matrix[right].T
    return out


def linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, similarity: float) -> np.ndarray:
    """Which sets of left and right are at least so similar; a set is not linked to itself."""
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    common = shared_counts(sets, left, right)
    found = np.empty(common.shape, dtype=bool)
    for at in range(0, len(left), 256):
        some = slice(at, at + 256)
        union = sizes[left[some], None] + sizes[right][None, :] - common[some]
        found[some] = (common[some] >= similarity * union - 1e-9) & (left[some, None] != right[None, :])
    return found


def pivot_labels(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """The smallest set that each one is linked to over any path, without comparing all pairs.

    Sets are compared with all others, first one and then those outside the largest class so far;
    a link between two classes has an end outside the largest, so none is missed. Near
    copies of one text are one class after the first comparison.
    """
    label, compared = np.arange(len(sets)), np.zeros(len(sets), dtype=bool)
    every, some = np.arange(len(sets)), np.arange(min(1, len(sets)))
    while len(some):
        for i, row in zip(some.tolist(), linked(sets, some, every, similarity)):
            joined = np.unique(np.append(label[row], label[i]))
            label[np.isin(label, joined)] = joined[0]
        compared[some] = True
        some = np.flatnonzero(~compared & (label != np.bincount(label).argmax()))[:64]
    return label


def _checked(members: DataFrame, similarity: float, shingle: int, counted: bool = True) -> DataFrame:
    """(key, links, label, other): numbers of linked documents of each set of a group, with the
    smallest key it is linked to over any path where the group is whole; where it is two
    blocks of a component, rows with ``other`` span their links.

    members: (group, whole, key, side, copies, text). Links are 0 where they are not ``counted``.
    """
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = members.select("group", "whole", "key", "side", "copies", "text").repartition(
        parts, "group").sortWithinPartitions("group")
    out = pa.schema([(n, pa.int64()) for n in ("key", "links", "label", "other")])

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, "group"):
            ids, keys, sides, copies = (table[c].to_numpy() for c in ("group", "key", "side", "copies"))
            starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            for start, stop in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)]):
                sets = shingle_sets(table["text"][start:stop].to_pylist(), shingle)
                own, side, many = keys[start:stop], sides[start:stop], copies[start:stop]
                rows = np.arange(stop - start)
                links = np.zeros(len(rows), dtype=np.int64)
                left = rows[side == 0]
                right = rows[side == 1] if (side == 1).any() else left
                if counted or right is not left:
                    found = linked(sets, left, right, similarity)
                    label = matrix_labels(found, left, right, len(rows))
                else:
                    label = pivot_labels(sets, similarity)
                if counted:
                    links[left] += [int(many[right][row].sum()) for row in found]
                    if right is not left:
                        links[right] += [int(many[left][column].sum()) for column in found.T]
                first = np.full(len(rows), np.iinfo(np.int64).max)
                np.minimum.at(first, label, own)
                whole, label = table["whole"][start].as_py(), pa.array(first[label])
                none = pa.nulls(len(rows), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own), pa.array(links), *((label, none) if whole else (none, label))], schema=out)

    return mapped(rows, check, "key long, links long, label long, other long")


def _dealt(members: DataFrame) -> DataFrame:
    """Members (key, label, n, copies) with ``blocks``, how many their component has, and their ``block``."""
    sizes = members.groupBy("label").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks"), F.min("key").alias("hub"))
    return members.join(sizes, "label").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")))


def _linked_classes(members: DataFrame, texts: DataFrame, similarity: float, shingle: int) -> DataFrame:
    """(key, links, label, other) as ``_checked``, without counting links or comparing all blocks.

    Each block of a component is checked with one set of the component, its hub. Sets that are linked
    to it, be it over others, are one class; only the others are compared with all blocks.
    """
    dealt = written(_dealt(members), "dealt")
    hubs = dealt.where("key = hub AND blocks > 1").select(
        "label", "key", "copies", "block", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("at")).where("at <> block")
    near = dealt.select(F.xxhash64("label", "block").alias("group"), (F.col("blocks") == 1).alias("whole"), "key",
                        F.lit(0).alias("side"), "copies").unionByName(
        hubs.select(F.xxhash64("label", "at").alias("group"), F.lit(False).alias("whole"), "key", F.lit(0).alias("side"), "copies"))

    def check(groups: DataFrame, name: str) -> DataFrame:
        return written(_checked(groups.join(texts.hint("merge"), "key"), similarity, shingle, counted=False), name)

    first = check(near, "near-hubs")
    # ``other`` is the smallest key a set is linked to in its block, and the hub is the smallest of all.
    far = written(dealt.where("blocks > 1").join(first.where("other IS NOT NULL").select(
        F.col("key").alias("own"), "other"), (F.col("key") == F.col("own")) & (F.col("other") != F.col("hub")), "left_semi"), "far")
    if far.isEmpty():
        return first
    parts = written(far.groupBy("label").agg(
        F.ceil(F.count("*") / BLOCK).alias("far_blocks"), F.max("blocks").alias("blocks")), "far-parts")
    left = far.join(parts.select("label", "far_blocks"), "label").select(
        "label", "key", "copies", F.pmod(F.xxhash64("key"), F.col("far_blocks")).alias("far_block"),
        F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"), F.lit(0).alias("side"))
    right = dealt.join(parts.select("label", "far_blocks"), "label").select(
        "label", "key", "copies", F.explode(F.expr("sequence(0L, far_blocks - 1)")).alias("far_block"), "block",
        F.lit(1).alias("side"))
    second = check(left.unionByName(right).select(
        F.xxhash64("label", "far_block", "block", F.lit(1)).alias("group"), F.lit(False).alias("whole"), "key", "side", "copies"),
        "far-from-hubs")
    return first.unionByName(second)


def _blocked(members: DataFrame) -> DataFrame:
    """(group, whole, key, side, copies) for members (key, label, n, copies): whole
    components, or pairs of blocks of one."""
    dealt = _dealt(members)
    other = F.explode(F.expr("sequence(0L, blocks - 1)"))
    return dealt.select("label", "key", "copies", "block", "blocks", other.alias("other")).select(
        F.xxhash64("label", F.least("block", "other"), F.greatest("block", "other")).alias("group"),
        (F.col("blocks") == 1).alias("whole"), "key", "copies",
        F.when(F.col("other") >= F.col("block"), 0).otherwise(1).alias("side"))


def classes(table: DataFrame, column: str, *carried: str, similarity: float = SIMILARITY,
            recall: float = RECALL, shingle: int = SHINGLE, counted: bool = True) -> DataFrame:
    """(key, class_id, n_links) and the carried columns of every row of a table of ``sketched``.

    Links are not counted, and fewer sets compared, where only classes are wanted.
    """
    rows = table.select(f"{column}.*", *carried)
    # One row a set: its first document, how many have it, and the sketch they share.
    sets = written(rows.groupBy("d1", "d2").agg(
        F.min("key").alias("first"), F.count("*").alias("copies"), F.max("n").alias("n"),
        F.first("sketch").alias("sketch")), "sets")
    sketches = sets.where("n > 0").select(F.col("first").alias("key"), "sketch")
    found = components(candidates(sketches, similarity, recall))
    members = found.withColumnRenamed("v", "key").join(
        sets.select(F.col("first").alias("key"), "n", "copies"), "key")
    texts = table.select(F.col(f"{column}.key").alias("key"), "text")
    # One plan at every size: the texts meet their keys by a shuffle, never by a broadcast.
    members = written(members, "members")
    checked = (written(_checked(_blocked(members).join(texts.hint("merge"), "key"), similarity, shingle), "links")
               if counted else _linked_classes(members, texts, similarity, shingle))
    links = checked.groupBy(F.col("key").alias("first")).agg(
        F.sum("links").alias("links"), F.min("label").alias("label"))
    across = checked.where("other IS NOT NULL").select(F.col("key").alias("a"), F.col("other").alias("b"))
    if not across.isEmpty():
        labels = components(across).withColumnRenamed("label", "joined")
        links = links.join(labels, F.col("first") == F.col("v"), "left").withColumn(
            "label", F.coalesce("joined", "label"))
    judged = sets.select("d1", "d2", "first", "copies").join(links, "first", "left").select(
        "d1", "d2", F.coalesce("label", "first").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return rows.select("key", "d1", "d2", *carried).join(judged, ["d1", "d2"]).select(
        "key", "class_id", "n_links", *carried)


def _free_name(docs: DataFrame) -> str:
    name = "_near"
    while name in docs.columns:
        name += "_"
    return name


def join(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """(doc_id, class_id, n_links) of every document; class ids are any numbers."""
    column = _free_name(docs)
    table = sketched(docs.select(F.col("doc_id").cast("long"), "text"), column)
    return classes(table, column, "doc_id", similarity=similarity, recall=recall).drop("key")


def first_of_each(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """The document of the smallest ``doc_id`` of every class, unchanged."""
    column = _free_name(docs)
    table = sketched(docs, column)
    found = classes(table, column, "doc_id", similarity=similarity, recall=recall, counted=False)
    kept = found.groupBy("class_id").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first")).select(
        F.col("first.key").alias("_key"))
    return table.join(kept, F.col(f"{column}.key") == F.col("_key"), "left_semi").select(*docs.columns)
