"""Operators on embeddings against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from pyspark.sql import functions as F

from tillsight.llm import hard_negatives, spectrum, whitening
from tillsight.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, x string, size int, whitened int, deviation int"


def vectors(spark, *rows):
    """(vec_id, embedding, label): with extra columns whose names clash."""
    return spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA)


@pytest.mark.parametrize("seed", range(4))
def test_eigenvalues_that_crowd_just_outside_an_interval(seed):
    """Three of 64 lie above a crowd that touches the interval's end; once the rounds ran out there."""
    draw = np.random.default_rng(seed)
    turn, _ = np.linalg.qr(draw.standard_normal((64, 64)))
    known = np.concatenate([1 - 1e-5 * draw.random(61), 1 + 1e-4 * draw.random(3)])
    v = turn * known @ turn.T
    v = (v + v.T) / 2
    values, vectors = spectrum.largest(v, 32)
    np.testing.assert_allclose(values, np.sort(known)[::-1][:32], atol=1e-13)
    assert np.abs(v @ vectors - vectors * values).max() < 1e-12


def matrices():
    draw = np.random.default_rng(0)
    for size in (1, 2, 3, 17, 64):
        plain = draw.standard_normal((3 * size + 2, size))
        twice = np.repeat(plain[:, :size // 2 + 1], 2, axis=1)[:, :size]
        for rows in (plain, plain + 100 * draw.standard_normal(size), plain * 10.0 ** -np.arange(size).clip(0, 12),
                     np.vstack([np.eye(size)] * 3), twice):
            yield rows.T @ rows / len(rows)


@pytest.mark.parametrize("v", list(matrices()), ids=lambda v: str(len(v)))
def test_largest_eigenvalues_as_a_dense_solver_finds_them(v):
    expected = np.linalg.eigvalsh(v)[::-1]
    many = min(32, len(v))
    values, vectors = spectrum.largest(v, many)
    assert np.allclose(values, expected[:many], rtol=0, atol=1e-13 * expected[0])
    assert np.abs(v @ vectors - vectors * values).max() <= 1e-13 * expected[0]
    assert np.abs(vectors.T @ vectors - np.eye(many)).max() <= 1e-13
    for bound in (expected[0] * 1.1, expected[0] / 2, (expected[len(v) // 2] + expected[0]) / 2 + 1e-9):
        assert spectrum.above(v, bound) == (expected > bound).sum()


def test_a_missing_eigenvalue_is_noticed():
    with pytest.raises(ArithmeticError):
        spectrum.within(np.diag([1.0, 2.0, 3.0]), 1.5, 3.5, 3)


def check_whitened(rows, embeddings):
    kept = [(i, e) for i, e in embeddings if e is not None and all(x is not None and np.isfinite(x) for x in e)]
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in e] for _, e in kept], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    y = n * x - sums
    covariance = (y.T @ y).astype(float) / n ** 3
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    many = min(32, int((values > 1e-12 * values.sum()).sum()))
    assert len(rows) == n * many and {r.n for r in rows} == {n}
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error <= 1e-9
    table = np.empty((n, many))
    at = {i: k for k, (i, _) in enumerate(kept)}
    for r in rows:
        table[at[r.vec_id], r.component - 1] = r.whitened
        assert r.deviation == sum(int(a) ** 2 for a in y[at[r.vec_id]])
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
    assert np.abs(table.T @ table / n - np.eye(many)).max() <= 1e-9
    expected = (y.astype(float) / n) @ vectors[:, :many] / np.sqrt(values[:many])
    apart = np.abs(np.diff(values[:many + 1])) / values[0] if len(values) > many else np.abs(np.diff(np.append(values[:many], 0))) / values[0]
    for k in range(many):
        if (apart[k] > 1e-6) and (k == 0 or apart[k - 1] > 1e-6):
            sign = np.sign(table[:, k] @ expected[:, k])
            assert np.abs(table[:, k] * sign - expected[:, k]).max() <= 1e-7


def test_whitening_of_the_whole_table(spark):
    embeddings = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check_whitened(QUERIES["op13_whitening"](spark, FOLDER).collect(), embeddings)


def test_whitening_leaves_out_broken_vectors_and_keeps_repeated_ones(spark):
    draw = np.random.default_rng(4)
    good = [(i, [float(x) for x in np.float32(draw.standard_normal(5) * (1 + i % 3))]) for i in range(40)]
    good += [(100 + i, good[0][1]) for i in range(20)]
    bad = [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0]), (202, [float("nan")] * 5), (203, [float("inf")] * 5)]
    rows = vectors(spark, *((i, e, None) for i, e in good + bad), (204, [], 1), (205, [1.0, 2.0], 1))
    check_whitened(whitening.whiten(rows).collect(), good)


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [0.5, 0.25], 1)], [(1, [0.5], 1), (None, [0.5], None)]])
def test_whitening_without_variance_gives_no_rows(spark, rows):
    done = whitening.whiten(vectors(spark, *rows))
    assert done.collect() == [] and done.columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_whitening_with_wide_entries_is_exact(spark):
    good = [(i, [float(2 ** 14 * i), float(i * i), 1.0]) for i in range(30)]
    check_whitened(whitening.whiten(vectors(spark, *((i, e, 1) for i, e in good))).collect(), good)
    with pytest.raises(Exception, match="(?i)overflow|too large|out of"):
        whitening.whiten(vectors(spark, *((i, [2.0 ** 40 * i], 1) for i in range(9)))).collect()


def brute_negatives(rows, every=50):
    """The contract, by Python's numbers; equal ids are told apart by their place."""
    kept = []
    for i, e, label in rows:
        if i is None or label is None or e is None or not all(c is not None and np.isfinite(c) for c in e):
            continue
        kept.append((i, (label + 1) % 10 if i % 7 == 0 else label, [int(np.floor(256 * float(c))) for c in e]))
    out = []
    x = np.array([v for *_, v in kept], dtype=object)
    for a, (i, label, v) in enumerate(kept):
        if i % every:
            continue
        scores = (x @ np.array(v, dtype=object)).tolist()
        order = sorted((k for k in range(len(kept)) if k != a), key=lambda k: (-scores[k], kept[k][0]))
        same = [k for k in order if kept[k][1] == label][:5]
        for p in same:
            fits = [k for k in order if kept[k][1] != label and 50 * scores[p] <= 100 * scores[k] <= 95 * scores[p]][:3]
            out += [(i, kept[p][0], r, kept[k][0], scores[p], scores[k]) for r, k in enumerate(fits, 1)]
    return sorted(out)


@pytest.fixture
def small_blocks(monkeypatch):
    """Trees of several levels and leaves of several blocks on small tables."""
    for name, value in (("SAMPLE", 300), ("LEAF", 12), ("PACK", 4), ("AT_ONCE", 3), ("FANOUT", 3)):
        monkeypatch.setattr(hard_negatives, name, value)


def mined(rows):
    return sorted(tuple(r) for r in hard_negatives.mine(rows, F.expr("vec_id % 50 = 0"), F.expr(
        "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")).collect())


def test_hard_negatives_of_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    found = QUERIES["op12_hard_negatives"](spark, FOLDER).collect()
    assert sorted(tuple(r) for r in found) == brute_negatives(rows)


def clustered(n, size, seed):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((9, size)) * 3
    return [(i, [float(c) for c in np.float32(centres[i % 9] + 0.2 * draw.standard_normal(size))], int(draw.integers(4)))
            for i in range(n)]


@pytest.mark.parametrize("size", [1, 3, 16])
def test_hard_negatives_of_clustered_vectors_with_ties_copies_and_gaps(spark, small_blocks, size):
    rows = clustered(700, size, size)
    rows += [(1000 + i, rows[50][1], i % 3) for i in range(120)]  # a hot vector
    rows += [(None, rows[0][1], 1), (2000, None, 1), (2050, [None] * size, 1), (2100, [float("nan")] * size, 1),
             (2150, rows[0][1], None), (2200, rows[1][1] + [1.0], 2), (2250, [], 2)]
    assert mined(vectors(spark, *rows)) == brute_negatives([r for r in rows if r[0] is None or r[0] < 2200])


def test_subtrees_are_left_out_and_no_row_is_lost():
    x = np.array([[round(256 * c) for c in e] for _, e, _ in clustered(4000, 3, 5)], dtype=np.int64)
    tree = hard_negatives.Tree(x[:2000], 200_000)
    leaf, ranges = tree.placed(x)
    full = {}
    for at, own in ranges.items():
        full[at] = own
    scores = x[:40] @ x.T
    hi = np.sort(scores, axis=1)[:, -3]
    lo = np.sort(scores, axis=1)[:, -20]
    seen = {}
    for k, rows in tree.visited(x[:40], lo, hi, full):
        for r in rows:
            seen.setdefault(r, set()).add(k)
    for r in range(40):
        assert {int(k) for k in leaf[(scores[r] >= lo[r]) & (scores[r] <= hi[r])]} <= seen[r]
    assert sum(map(len, seen.values())) < 0.5 * 40 * len(np.unique(leaf))


def test_equal_ids_are_rows_of_their_own(spark):
    rows = [(50, [1.0, 0.0], 1), (50, [1.0, 0.0], 1), (3, [0.75, 0.0], 2), (4, [0.75, 0.0], 2)]
    assert mined(vectors(spark, *rows)) == [(50, 50, r, n, 65536, 49152) for r, n in ((1, 3), (1, 3), (2, 4), (2, 4))]


@pytest.mark.parametrize("rows", [[], [(50, [1.0], 1)], [(1, [1.0], 1), (2, [0.7], 2)], [(50, None, None)],
                                  [(50, [1.0], 1), (1, [-1.0], 1), (2, [-0.7], 2)]])
def test_hard_negatives_without_anchors_or_partners(spark, rows):
    assert mined(vectors(spark, *rows)) == []


def test_hard_negatives_beyond_floats_are_exact(spark):
    rows = [(50, [2.0 ** 22, 3.0], 1), (1, [2.0 ** 22, 1.0], 1), (2, [2.0 ** 22 * 0.75, 7.0], 2), (3, [2.0 ** 22 * 0.75, 6.0], 2)]
    assert mined(vectors(spark, *rows)) == brute_negatives(rows) != []


def test_packs_of_queries_are_never_broadcast(spark, small_blocks):
    """A visit's packs are many times larger than the file of the queries, which Spark guesses their size from."""
    rows = vectors(spark, *clustered(300, 3, 1)).select(F.col("vec_id").alias("key"), "vec_id", F.col("label").cast("long").alias(
        "label"), F.transform("embedding", lambda e: F.floor(256 * e).cast("long")).alias("x"))
    table = hard_negatives.written(rows, "vectors")
    index = hard_negatives.Index(table, 3)
    windows = F.array(F.struct(F.lit(0).alias("window"), F.lit(hard_negatives.LOWEST).cast("long").alias("lo"),
                               F.lit(hard_negatives.HIGHEST).cast("long").alias("hi")))
    queries = hard_negatives.written(table.select("key", "label", "x", windows.alias("windows")), "queries")
    for home in (True, False):
        plan = index._visit(queries, 2, True, home)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
    # Of leaves of several blocks every row is in one of them.
    assert index.blocks.agg(F.sum(F.length("keys"))).first()[0] == 8 * 300
    assert index.blocks.count() == sum(index.blocks_of.values())
