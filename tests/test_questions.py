from __future__ import annotations

import pytest
from conftest import values

from tillsight.functions import questions

GOLDEN = {
    "Give me a summary of the business": "summary",
    "Which region has the highest revenue?": "revenue_by_region",
    "Show the top 5 customers by revenue": "top_customers",
    "What is the best performing category by profit margin?": "unknown",
    "How do discounts impact profit margin?": "discount_impact",
    "Show revenue trend month over month": "revenue_trend",
    "Compare 2021 and 2024 revenue": "yearly_comparison",
    "Which are the top 10 products?": "unknown",
    "Show quarterly breakdown": "quarterly",
    "Shipping mode analysis": "shipping",
    "which region has the highest profit margin?": "revenue_by_region",
    "Total profit for 2023": "profit_overall",
    "Which category is most profitable?": "unknown",
    "Profit margin by region": "unknown",
    "Show bottom 10 products by profit": "unknown",
    "Regional scorecard": "unknown",
    "Most profitable products": "product_margin",
    "what can you answer?": "summary",
}


def test_golden_topics(spark):
    # Keywords match as written: "top 5 customer" is one, "top 10 product" is not.
    frame = spark.createDataFrame([(q,) for q in GOLDEN], "text string")
    assert dict(values(questions.tag(frame))) == GOLDEN


def test_topic_and_keyword_counts():
    assert len(questions.TOPICS) == 21
    assert sum(len(w) for w in questions.TOPICS.values()) == 116


def brute(text):
    if text is None:
        return {}
    return {t: n for t, words in questions.TOPICS.items()
            if (n := sum(w in text.lower() for w in words))}


TEXTS = [*GOLDEN, None, "", "SHIP shipping Delivery fastest", "customer segment: consumer, corporate",
         "home office q1 q2 quarter", "high discount low discount discount band effect", "mom",
         "tell me about key metrics", "comeback of returning loyal customers " * 50]


def test_scores_and_tags_match_brute_force(spark):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    want = sorted((i, t, n) for i, x in enumerate(TEXTS) for t, n in brute(x).items())
    assert sorted(values(questions.scores(frame, "id"))) == want
    best = [max(s, key=s.get) if (s := brute(x)) else "unknown" for x in TEXTS]
    tagged = questions.tag(frame).orderBy("id").collect()
    assert [r.intent for r in tagged] == best


@pytest.mark.parametrize("key", list(questions.TOPICS))
def test_guards_are_parts_of_their_keywords(key):
    guards = questions._guards(questions.TOPICS)
    assert all(guards[w] in w for w in questions.TOPICS[key])


def test_own_topics(spark):
    frame = spark.createDataFrame([("stock is low",), ("hello",)], "text string")
    tagged = questions.tag(frame, topics={"stock": ("stock", "inventory")})
    assert [r.intent for r in tagged.collect()] == ["stock", "unknown"]


def test_volume(spark):
    frame = spark.createDataFrame([("ship",), ("shipping",), ("xyz",)], "text string")
    assert values(questions.volume(frame)) == [("shipping", 2), ("unknown", 1)]


def test_numbers_in_questions(spark):
    frame = spark.createDataFrame(
        [("Top 25 customers",), ("TOP   7 products",), ("best customers",), ("top five",), (None,)],
        "text string")
    assert [r[0] for r in frame.select(questions.top_n()).collect()] == [25, 7, 10, 10, 10]
    years = spark.createDataFrame([("2021 vs 2024 and 2022",), ("only 2020",), ("1999",)],
                                  "text string")
    one, two = questions.year_pair()
    assert values(years.select(one, two)) == [(2021, 2024), (2020, None), (None, None)]
