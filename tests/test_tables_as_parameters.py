"""Bands and keywords from tables, published tables, and questions to every report."""

from __future__ import annotations

import random

import pytest
from conftest import SF_DIR, values

from tillsight import registry
from tillsight.functions import bands, questions
from tillsight.operators import intervals, keywords
from tillsight.plans import answers
from tillsight.sources import files, workspace

BOUNDS = "set string, low double, high double, label string"


def bound_table(spark, *rows):
    return spark.createDataFrame(list(rows), BOUNDS)


@pytest.mark.parametrize("broadcast", [10, 0])
def test_labels_at_edges_as_the_chain_gives_them(spark, broadcast):
    limits, labels = (0, 10, 20, 40, None), ("a", "b", "c", "d")
    rows = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 0.5, 10.0, 10.5, 20.0, 40.0, 1e300, float("inf"), float("nan"), None)],
                                 "v double")
    table = intervals.checked(bound_table(spark, *[("x", float(a), None if b is None else float(b), n)
                                                   for a, b, n in zip(limits, limits[1:], labels)], ("y", 0.0, 5.0, "other")))
    got = intervals.labelled(rows, "v", table, "x", "label", broadcast).collect()
    expected = rows.select("v", bands.band("v", limits, labels).alias("label")).collect()
    assert sorted(map(str, got)) == sorted(map(str, expected))
    assert intervals.labelled(rows, "v", table, "none", "label", broadcast).where("label IS NOT NULL").count() == 0


@pytest.mark.parametrize("rows", [
    [("x", 0.0, 10.0, "a"), ("x", 9.0, 12.0, "b")], [("x", 0.0, None, "a"), ("x", 5.0, 6.0, "b")],
    [("x", 1.0, 1.0, "a")], [("x", None, 1.0, "a")], [("x", 0.0, 1.0, "a"), ("x", 0.0, 1.0, "b")]])
def test_overlapping_or_empty_bounds_are_refused(spark, rows):
    with pytest.raises(ValueError, match="set x"):
        intervals.checked(bound_table(spark, *rows))
    intervals.checked(bound_table(spark, ("x", 0.0, 10.0, "a"), ("x", 10.0, 12.0, "b"), ("y", 9.0, None, "a")))


def test_many_bounds_by_both_ways_against_brute_force(spark):
    draw = random.Random(2)
    ends = sorted(draw.sample(range(100_000), 4000))
    own = [("x", float(a), float(b), f"l{a}") for a, b in zip(ends[::2], ends[1::2])]
    hot = [ends[1] - 0.5] * 500
    rows = [draw.uniform(-10, 100_010) for _ in range(1500)] + [float(e) for e in ends[:500]] + hot + [None] * 300
    label = {v: next((n for _, a, b, n in own if a < v <= b), None) for v in {r for r in rows if r is not None}}
    frame, table = spark.createDataFrame([(r,) for r in rows], "v double"), intervals.checked(bound_table(spark, *own))
    expected = sorted(((r, label.get(r)) for r in rows), key=str)
    for broadcast in (10_000, 100):
        assert sorted(values(intervals.labelled(frame, "v", table, "x", "label", broadcast)), key=str) == expected


def brute_scores(texts, words):
    found = {}
    for key, text in texts:
        for topic, word in {(t, w.lower()) for t, w in words if w}:
            if text is not None and word in text.lower():
                found[key, topic] = found.get((key, topic), 0) + 1
    return sorted((k, t, n) for (k, t), n in found.items())


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_ten_thousand_keywords_against_brute_force(spark, broadcast):
    draw = random.Random(4)
    letters = "abcde é"
    words = [(f"t{draw.randint(0, 30)}", "".join(draw.choice(letters) for _ in range(draw.randint(1, 9)))) for _ in range(10_000)]
    words += [("t1", "ABC"), ("t2", "abc"), ("t2", ""), ("t2", None)]
    texts = [(k, "".join(draw.choice(letters + "XY") for _ in range(draw.randint(0, 120)))) for k in range(60)] + [(60, None), (61, "")]
    frame = spark.createDataFrame(texts, "id int, text string")
    table = spark.createDataFrame(words, "topic string, keyword string")
    plan = keywords.scores(frame, "id", table, broadcast=broadcast)
    assert sorted(values(plan)) == brute_scores(texts, words)
    assert len(plan._jdf.queryExecution().optimizedPlan().toString()) < 20_000


def test_fixed_keywords_by_table_as_by_projection(spark):
    texts = spark.createDataFrame([(0, "Which region has high discount, YoY and q3 kpi?"), (1, "nothing of it"), (2, None), (3, "mom")],
                                  "id int, text string")
    words = spark.createDataFrame([(t, w) for t, own in questions.TOPICS.items() for w in own], "topic string, keyword string")
    assert sorted(values(keywords.scores(texts, "id", words))) == sorted(values(questions.scores(texts.dropna(), "id")))
    none = words.limit(0)
    assert keywords.scores(texts, "id", none).count() == 0


@pytest.mark.parametrize("few", [1_000, 0])
def test_few_keywords_are_searched_for_where_the_texts_are(spark, few):
    """Odd keywords and texts; up to ``few`` keywords no text moves or is taken apart, and results are the same."""
    words = [("t1", "Top Region"), ("t1", "region"), ("t2", "region"), ("t2", "REGION"), ("t3", "a"), ("t3", " "), (None, "region"),
             ("t4", "regional sales"), ("t4", ""), ("t5", None), ("t6", "\u00e9t\u00e9")]
    texts = [("k", "regional SALES of the top region"), ("k", "regional SALES of the top region"), ("k", None), (None, "A \u00c9T\u00c9"),
             ("m", "xyz"), ("n", "")]
    frame = spark.createDataFrame(texts, "id string, text string")
    table = spark.createDataFrame(words, "topic string, keyword string")
    plan = keywords.scores(frame, "id", table, few=few)
    one = [("k", None, 1), ("k", "t1", 2), ("k", "t2", 1), ("k", "t3", 2), ("k", "t4", 1)]
    assert sorted(values(plan), key=str) == sorted([*one, *one, (None, "t3", 2), (None, "t6", 1)], key=str)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert ("Exchange" in text or "_grams" in text) == (few == 0)


def test_tags_by_table_reach_every_row_of_a_key(spark):
    """Rows of one key share the best topic of their texts; rows without a key or a hit are unknown."""
    words = spark.createDataFrame([("t1", "region"), ("t2", "region"), ("t2", "top")], "topic string, keyword string")
    places = spark.createDataFrame([("t1", 0), ("t2", 1)], "topic string, place int")
    texts = spark.createDataFrame([("k", "region"), ("k", "top region"), (None, "top"), ("m", None), ("n", "a region")],
                                  "id string, text string")
    got = keywords.tagged(texts, "id", words, places)
    assert sorted(values(got), key=str) == sorted([("k", "t2"), ("k", "t2"), (None, "unknown"), ("m", "unknown"), ("n", "t1")], key=str)
    assert "_grams" not in got._jdf.queryExecution().executedPlan().toString()


def test_made_questions_reach_nearly_all_topics_and_ties(spark):
    asked = registry.asked(spark, SF_DIR).where("id LIKE 'q%'")
    topics = {r.intent for r in questions.tag(asked).select("intent").distinct().collect()}
    assert len(topics - {questions.UNKNOWN}) >= 15
    scores = questions.scores(asked, "id").groupBy("id").pivot("score").count().where("`1` > 1")
    assert scores.count() > 0


def unique_words():
    """For each topic a keyword that no other topic's keyword is part of."""
    for topic, own in questions.TOPICS.items():
        for word in own:
            hits = {t: sum(w in word for w in words) for t, words in questions.TOPICS.items()}
            if max(hits, key=lambda t: (hits[t], -list(hits).index(t))) == topic:
                yield topic, word
                break


def test_every_report_is_reached_by_a_question(spark, prepared, monkeypatch):
    sales = prepared({}, {"category": "Office", "product_name": "Pen", "region": "West"})
    called = []
    for name, plan in answers.REPORTS.items():
        monkeypatch.setitem(answers.REPORTS, name, lambda s, name=name, **given: called.append((name, given)) or s)
    reached = dict(unique_words())
    assert reached.keys() == questions.TOPICS.keys()
    for topic, word in reached.items():
        answers.ask(sales, f"{word.upper()}?")
        if topic != "help":
            assert called[-1][0] == topic, (topic, word, called[-1])
    answers.ask(sales, "top customer, top 7, best customer")
    assert called[-1] == ("top_customers", {"n": 7})
    answers.ask(sales, "compare year 2022 with 2019, annual")
    assert called[-1] == ("yearly_comparison", {"year_1": 2022, "year_2": 2019})
    assert "keywords" in answers.ask(sales, "help").columns and len(called) == len(answers.REPORTS) + 2


def test_a_reader_between_two_publishes_has_the_old_rows_or_the_new(spark, prepared):
    rows = prepared({}, {}, {})
    name, path = "till_published", workspace.new_path(spark, "published")
    files.publish(rows.limit(1), name, path)
    before = spark.table(name)
    files.publish(rows, name, path)
    assert before.count() == 1 and spark.table(name).count() == 3 and spark.sql(f"SELECT * FROM {name}").count() == 3
    with pytest.raises(Exception, match="stop here"):
        files.publish(rows.selectExpr("*").where("raise_error('stop here') IS NULL"), name, path)
    assert spark.table(name).count() == 3
    with pytest.raises(ValueError, match="other columns"):
        files.publish(rows.select("sales"), name, path)
    assert files.drop_versions(spark, name, path) >= 1
    assert spark.table(name).count() == 3


def test_amounts_beyond_hundredths_raise_in_every_report(spark, prepared):
    from tillsight.plans import business, exploratory

    sales = prepared({"sales": 0.125}, {"sales": 1.0})
    for report in (exploratory.quarter_year_grid, business.first_and_latest_order, business.quarterly_by_category):
        with pytest.raises(Exception, match="hundredths"):
            report(sales).collect()
