"""The similarity join, ordinal regression and the pipeline."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tillsight.llm import components, jaccard_join, secret_scan, toxicity
from tillsight.llm.queries import QUERIES
from tillsight.llm.shingles import shingle_sets

from .conftest import FOLDER, words

# --- similarity join ----------------------------------------------------------


def _set(text):
    own = words(text)
    return frozenset(tuple(own[k:k + 5]) for k in range(max(1, len(own) - 4))) if own else frozenset()


def _classes(texts, similarity=0.8):
    """Number of links and class of each text, by comparing every two."""
    sets = [_set(t) for t in texts]
    links, parent = Counter(), list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a == b or len(a & b) >= similarity * len(a | b) - 1e-9 and a and b:
                links[i] += 1
                links[j] += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [links[i] for i in range(len(sets))], [root(i) for i in range(len(sets))]


def _same_classes(found, expected):
    groups, others = defaultdict(set), defaultdict(set)
    for i, (a, b) in enumerate(zip(found, expected)):
        groups[a].add(i)
        others[b].add(i)
    return set(map(frozenset, groups.values())) == set(map(frozenset, others.values()))


def _check(frame, texts, **kw):
    rows = sorted(jaccard_join.join(frame(*enumerate(texts)), **kw).collect(), key=lambda r: r.doc_id)
    links, classes = _classes(texts)
    assert [r.n_links for r in rows] == links
    assert _same_classes([r.class_id for r in rows], classes)


def _edited(base, edits, rng):
    out = list(base)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"edit{rng.randrange(10**9)}"
    return " ".join(out)


def _corpus(rng, groups=6, copies=12):
    texts, passage = [], [f"shared{k}" for k in range(40)]
    for g in range(groups):
        base = [f"g{g}w{rng.randrange(10**6)}" for _ in range(rng.choice([60, 90, 200]))]
        texts += [_edited(base, rng.choice([0, 0, 1, 2, 3]), rng) for _ in range(copies)]
    texts += [" ".join([*passage, *(f"own{rng.randrange(10**9)}" for _ in range(60))]) for _ in range(25)]
    texts += ["", "short text", "Short text!", "short  text", "a b c d e", "a b c d e f", "?!"]
    return texts


def test_documents(spark, texts):
    rows = sorted(QUERIES["op5_jaccard_join"](spark, FOLDER).collect(), key=lambda r: r.doc_id)
    links, classes = _classes([texts[r.doc_id] for r in rows])
    assert [r.n_links for r in rows] == links and len(rows) == len(texts)
    assert _same_classes([r.class_id for r in rows], classes)


def test_planted_groups(frame):
    _check(frame, _corpus(random.Random(3)))


def test_small_leaves_and_blocks(frame, monkeypatch):
    """Leaves split to the last level, and components in many blocks."""
    monkeypatch.setattr(jaccard_join, "LEAF", 4)
    monkeypatch.setattr(jaccard_join, "BLOCK", 5)
    monkeypatch.setattr(jaccard_join, "DEPTH", 2)
    _check(frame, _corpus(random.Random(5), groups=3, copies=20))


def test_far_rows_of_a_large_node_meet(spark):
    """Rows unlike the node's centre are compared with all others, over blocks."""
    rng = np.random.default_rng(2)
    kinds = rng.integers(0, 2**32, (9, jaccard_join.SKETCH), dtype=np.uint32)
    keys = list(range(90))
    sketches = spark.createDataFrame([(k, bytearray(kinds[k % 9].tobytes())) for k in keys], "key long, sketch binary")
    node = sketches.select(F.lit(7).cast("long").alias("node"), "key", F.lit(90).cast("long").alias("size"))
    before = jaccard_join.LEAF
    try:
        jaccard_join.LEAF = 8
        edges = jaccard_join._around_centres(jaccard_join._judged(node.join(sketches, "key"), 40), 40)
        labels = components.components(edges).collect()
    finally:
        jaccard_join.LEAF = before
    assert {r.v: r.label for r in labels} == {k: k % 9 for k in keys}


def test_join_of_odd_rows(frame, odd):
    rows = jaccard_join.join(odd).collect()
    by_id = defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append(r)
    assert len(rows) == odd.count()
    assert sorted(r.n_links for r in by_id[5]) == [0, 1, 1] and by_id[4][0].n_links == 0
    assert by_id[1][0].n_links == 3 and by_id[1][0].class_id == by_id[3][0].class_id  # texts without words
    assert jaccard_join.join(odd.where("false")).count() == 0
    kept = jaccard_join.first_of_each(odd)
    assert kept.columns == odd.columns
    # Null, empty and blank texts are one class; the smallest id stays.
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 4, 5, 5, 6]
    assert jaccard_join.first_of_each(odd.where("false")).count() == 0


def _groups_of_copies(seed):
    """Texts in chains and stars of near copies, some of them joined by a bridge only."""
    draw = random.Random(seed)
    texts = []
    for group in range(6):
        own = [f"w{group}x{k}" for k in range(60)]
        for _ in range(draw.choice([1, 2, 40])):
            words_of = list(own)
            for _ in range(draw.choice([0, 0, 1, 2])):
                words_of[draw.randrange(60)] = f"new{draw.randrange(10 ** 6)}"
            texts.append(" ".join(words_of))
            if draw.random() < 0.3:  # the next ones follow this one
                own = words_of
    return texts + texts[:3] + ["", "short text", "short text"]


@settings(max_examples=40, deadline=None)
@given(seed=st.integers(0, 10 ** 6))
def test_pivots_find_the_classes_of_all_pairs(seed):
    texts = [t for t in _groups_of_copies(seed) if t]
    found = jaccard_join.pivot_labels(shingle_sets(texts, 5), 0.8)
    assert _same_classes(found.tolist(), _classes(texts)[1])


@pytest.mark.parametrize("block", [1000, 7, 3])
def test_first_of_each_with_components_of_many_blocks(frame, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    for seed in (1, 2, 3):
        texts = _groups_of_copies(seed)
        kept = sorted(r.doc_id for r in jaccard_join.first_of_each(frame(*enumerate(texts))).collect())
        assert kept == sorted({min(i for i, c in enumerate(cs) if c == x) for cs in [_classes(texts)[1]] for x in cs})


def test_recall_of_runs():
    """The share of pairs at the threshold that meet in some run agrees with the recursion."""
    rng = np.random.default_rng(8)
    first = rng.integers(0, 2**32, (1500, jaccard_join.SKETCH), dtype=np.uint32)
    second = np.where(rng.random(first.shape) < 0.8, first, first + 1).astype(np.uint32)
    for depth in (1, 2):
        met = np.zeros(len(first), dtype=bool)
        a = (np.arange(len(first)), np.arange(1, len(first) + 1, dtype=np.uint64) * np.uint64(2**40 + 1))
        b = a
        for _ in range(depth):
            step = []
            for (who, nodes), tokens in ((a, first), (b, second)):
                row, child = jaccard_join.children(nodes, tokens[who], 0.8)
                step.append((who[row], child))
            a, b = step
        ours, theirs = ({*zip(w.tolist(), n.tolist())} for w, n in (a, b))
        met[[w for w, _ in ours & theirs]] = True
        assert met.mean() == pytest.approx(jaccard_join.run_recall(depth), abs=0.05)
    missed = 1 - jaccard_join.run_recall(jaccard_join.DEPTH)
    assert 1 - missed ** jaccard_join.runs_for(0.999) >= 0.999


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcdefg"), max_size=14), min_size=1, max_size=8))
def test_linked_is_jaccard(parts):
    texts = [" ".join(p) for p in parts if p] or ["a"]
    sets, rows = shingle_sets(texts, 5), np.arange(len(texts))
    exact = [_set(t) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in exact]
    assert jaccard_join.linked(sets, rows, rows, 0.8).tolist() == [
        [i != j and len(a & b) >= 0.8 * len(a | b) - 1e-9 for j, b in enumerate(exact)] for i, a in enumerate(exact)]


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + [(200, 200)]
    found = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.v: r.label for r in found} == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100)}


# --- toxicity -----------------------------------------------------------------

def test_thresholds_are_ordered_and_recovered():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(4000, 3))
    score = x @ np.array([2.0, -1.0, 0.0]) + rng.logistic(size=4000)
    grade = (score[:, None] > np.array([0.5, 1.5, 3.0])).sum(axis=1)
    w, cuts = toxicity.fit_thresholds(x, grade, 3)
    assert np.allclose(w, [2, -1, 0], atol=0.2) and np.allclose(cuts, [0.5, 1.5, 3.0], atol=0.25)
    assert (np.diff(cuts) > 0).all()


def test_held_out_accuracy(spark, monkeypatch):
    """Fitted on a part of the labels, judged on the others."""
    monkeypatch.setattr(toxicity, "TOXIC", 300)
    monkeypatch.setattr(toxicity, "OTHER", 1200)
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    truth = labels.groupBy(F.col("doc_id").alias("id")).agg((F.max("toxic") > 0).alias("truth"))
    sample = toxicity._sample(docs, labels).select("doc_id")
    scored = toxicity.score(docs, toxicity.fit(docs, labels)).join(sample, "doc_id", "left_anti")
    counts = {(r.truth, r.toxic): r["count"] for r in scored.join(
        truth, F.col("doc_id") == F.col("id")).groupBy("truth", "toxic").count().collect()}
    assert counts[True, True] >= 0.9 * (counts[True, True] + counts.get((True, False), 0))
    assert counts.get((False, True), 0) <= 0.01 * counts[False, False]


def _severity(model, text):
    """P(grade >= k) by looking for each feature of the model in each word of the text."""
    if not model.thresholds:
        return [0.0] * toxicity.GRADES
    raw = "".join(c.lower() if "A" <= c <= "Z" else c if c.isascii() and "a" <= c <= "z" or not c.isascii() else " " for c in text or "")
    own = [w.encode() for w in raw.split(" ") if w]
    score = 0.0
    for feature, weights in sorted(model.weights.items()):
        whole = feature.endswith(b"$")
        n = sum(w == feature[:-1] if whole else w.startswith(feature) and len(w) > len(feature) for w in own)
        if n:
            score += weights[max(k for k, c in enumerate(toxicity.COUNTS) if n >= c)]
    return [1 / (1 + math.exp(min(max(t - score, -60), 60))) for t in model.thresholds]


def test_severity_of_every_document_by_plain_search(spark, documents):
    model = toxicity.fit(documents, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    assert model.weights and model.thresholds == sorted(model.thresholds)
    found = {r.doc_id: r for r in toxicity.score(documents, model).collect()}
    for r in documents.collect():
        p = _severity(model, r.text)
        got = found[r.doc_id]
        assert got.severity == pytest.approx(sum(p)) and got.p_toxic == pytest.approx(p[0])
        assert got.grade == sum(x >= 0.5 for x in p) and got.toxic == (p[0] >= 0.5)


def test_typical_features_by_plain_counting(spark, frame):
    bad = [f"vile filth number{k} {'scum' if k % 2 else 'plain'} here" for k in range(20)]
    good = [f"some plain words number{k} here" for k in range(40)]
    sample = spark.createDataFrame([(k, k < 20, t) for k, t in enumerate(bad + good)], "doc_id long, toxic boolean, text string")

    def present(text):
        return {f for w in toxicity.words(text) for f in toxicity.features(w)}

    a, b = Counter(f for t in bad for f in present(t)), Counter(f for t in good for f in present(t))

    def part(seen, row, column):
        return seen * math.log(seen * 60 / (row * column)) if seen else 0.0

    def evidence(f):
        x, y = a[f], b[f]
        return 2 * (part(x, x + y, 20) + part(y, x + y, 40) + part(20 - x, 60 - x - y, 20) + part(40 - y, 60 - x - y, 40))

    chosen = [f for f in a if a[f] >= toxicity.SUPPORT and a[f] / 20 >= toxicity.TYPICAL * (b[f] + 0.5) / 40
              and evidence(f) >= toxicity.EVIDENCE]
    expected = sorted(chosen, key=lambda f: (-round(evidence(f), 9), f))
    assert toxicity._typical(sample, 20, 40) == expected != []


def test_toxicity_of_odd_rows(spark, frame, odd):
    docs = frame(*((i, f"some plain words number {i} here and vile filth") for i in range(100, 120)),
                 *((i, f"some plain words number {i} here and there") for i in range(200, 240))).unionByName(odd)
    labels = spark.createDataFrame(
        [(i, 1, 1) for i in range(100, 119)] + [(i, 1, 0) for i in range(200, 239)]
        + [(None, 1, 1), (1, 1, None), (100, 0, 0), (999, 1, 1), (5, 1, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == docs.count()
    toxic = {r.doc_id for r in rows if r.toxic}
    assert toxic == set(range(100, 120))
    assert all(0 <= r.severity <= toxicity.GRADES for r in rows)
    left = toxicity.clean(docs, model)
    assert left.columns == docs.columns and left.count() == docs.count() - 20
    assert toxicity.score(docs.where("false"), model).count() == 0
    for nothing in (labels.where("toxic = 0"), labels.where("false")):
        assert toxicity.score(docs, toxicity.fit(docs, nothing)).where("toxic OR severity > 0").count() == 0


# --- pipeline -----------------------------------------------------------------

def test_stages_one_by_one(spark, documents):
    """Each stage takes what the one before kept and does what it says."""
    docs, seen = documents, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.schema.simpleString() == documents.schema.simpleString(), name
        path = f"{spark.conf.get('spark.checkpoint.dir')}/stage-{len(seen)}"
        out.write.parquet(path)
        seen[name] = docs, (docs := spark.read.parquet(path))
    before, after = seen["n-gram Jaccard join"]
    texts = [r.text for r in before.orderBy("doc_id").select("text").collect()]
    _, classes = _classes(texts)
    ids = [r.doc_id for r in before.orderBy("doc_id").select("doc_id").collect()]
    assert sorted(r.doc_id for r in after.collect()) == sorted({ids[c] for c in classes})
    before, after = seen["benchmark decontamination"]
    windows = set()
    for item in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect():
        own = words(item.text)
        windows |= {tuple(own[k:k + 10]) for k in range(max(1, len(own) - 9))} if own else set()
    clean = {r.doc_id for r in before.collect() if windows.isdisjoint(
        tuple(own[k:k + n]) for own in [words(r.text)] for n in {len(w) for w in windows} for k in range(len(own) - n + 1))}
    assert {r.doc_id for r in after.collect()} == clean and len(clean) < before.count()
    before, after = seen["secret scans"]
    spans = {r.doc_id: r.spans for r in secret_scan.scan(before).collect()}
    masked = {r.doc_id: r for r in after.collect()}
    assert masked.keys() == spans.keys() and any(spans.values())
    for r in before.collect():
        text, at, out = r.text or "", 0, ""
        for span in spans[r.doc_id]:
            if span.start >= at:
                out += text[at:span.start] + "[secret]"
            at = max(at, span.end)
        assert (masked[r.doc_id].text or "") == out + text[at:] and masked[r.doc_id].source == r.source
    before, after = seen["toxicity"]
    model = toxicity.fit(documents, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect() if not _severity(model, r.text)[0] >= 0.5}
    assert 0 < before.count() - after.count() < 0.2 * before.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}
    whole = corpus_pipeline.run(spark, FOLDER)
    assert whole.agg(F.sum("length")).first()[0] == packed.agg(F.sum("length")).first()[0]
