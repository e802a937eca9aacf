"""Reading plain-English questions: topic, row count and years.

A keyword scores when the lower-cased text contains it; the topic with the
most hits wins, the one listed first on a tie. All scores of a row come from
one projection: nothing is joined, exploded or shuffled to find the winner.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .exact import col

# Topics in order of priority, with their keywords.
TOPICS: dict[str, tuple[str, ...]] = {
    "revenue_by_region": ("revenue by region", "sales by region", "region revenue",
                          "region sales", "which region"),
    "revenue_by_category": ("revenue by category", "category revenue", "category sales",
                            "sales by category", "best category", "top category"),
    "revenue_trend": ("revenue trend", "monthly revenue", "monthly sales", "trend",
                      "month over month", "mom"),
    "total_revenue": ("total revenue", "total sales", "overall revenue", "overall sales",
                      "how much revenue", "how much sales"),
    "profit_by_category": ("profit by category", "most profitable category",
                           "category profit", "profit margin category"),
    "profit_by_region": ("profit by region", "region profit", "profit margin region",
                         "most profitable region"),
    "profit_overall": ("total profit", "overall profit", "how much profit", "net profit"),
    "top_customers": ("top customer", "best customer", "highest revenue customer",
                      "most valuable customer", "top 5 customer", "top 10 customer"),
    "customer_segments": ("segment", "consumer", "corporate", "home office",
                          "customer segment"),
    "customer_retention": ("retained", "returning", "loyal", "repeat customer", "comeback"),
    "top_products": ("top product", "best product", "best selling", "most sold",
                     "highest selling", "popular product"),
    "bottom_products": ("bottom product", "least profitable", "worst product",
                        "loss making", "losing money"),
    "product_margin": ("product margin", "most profitable product",
                       "highest margin product"),
    "discount_impact": ("discount", "discount impact", "high discount", "low discount",
                        "discount band", "discount effect"),
    "yearly_comparison": ("compare year", "year comparison", "2021", "2022", "2023", "2024",
                          "annual", "yoy", "year over year"),
    "quarterly": ("quarter", "q1", "q2", "q3", "q4", "quarterly"),
    "city_analysis": ("city", "cities", "which city", "top city", "best city"),
    "region_scorecard": ("region scorecard", "region performance", "region comparison",
                         "compare region"),
    "shipping": ("ship", "shipping", "delivery", "days to ship", "ship mode", "fastest",
                 "slowest"),
    "summary": ("summary", "overview", "dashboard", "kpi", "key metrics", "tell me about",
                "describe", "what can you"),
    "help": ("help", "what can", "what do you", "questions", "capabilities", "how to use"),
}
UNKNOWN = "unknown"
DEFAULT_TOP = 10
# Patterns for the row count and the years of a question.
TOP_PATTERN = r"top\s+(\d+)"
YEAR_PATTERN = r"20\d\d"


def _guards(topics: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """For each keyword one of its own words, chosen so that few differ.

    A text without the word cannot contain the keyword, so most texts are
    searched for the few words only, not for every keyword.
    """
    keywords = sorted({k for words in topics.values() for k in words})
    # very short words sit in almost any text and guard nothing
    words = {w for k in keywords for w in k.split() if len(w) > 3}
    # a word inside another word is the better guard: ship for shipping
    core = {w: min((x for x in words if x in w), key=lambda x: (len(x), x)) for w in words}
    used = Counter(core[w] for k in keywords for w in set(k.split()) if w in core)
    return {k: max({core[w] for w in k.split() if w in core},
                   key=lambda w: (used[w], len(w), w), default=k)
            for k in keywords}


def _prepared(texts: DataFrame, text: str, topics: Mapping[str, Sequence[str]],
              *keep: str) -> tuple[DataFrame, dict[str, Column]]:
    """Texts with their guard words looked up, and the score of each topic."""
    guards = _guards(topics)
    flags = {w: f"_has{i}" for i, w in enumerate(sorted(set(guards.values())))}
    lowered = texts.select(*keep, F.lower(F.col(text)).alias("_lowered"))
    looked_up = lowered.select("*", *[F.col("_lowered").contains(w).alias(f)
                                      for w, f in flags.items()])

    def hit(word: str) -> Column:
        guard = F.col(flags[guards[word]])
        if word == guards[word]:
            return guard.cast("int")
        return F.when(guard, F.col("_lowered").contains(word)).otherwise(False).cast("int")

    return looked_up, {topic: sum((hit(w) for w in words), F.lit(0))
                       for topic, words in topics.items()}


def tag(texts: DataFrame, text: str = "text", into: str = "intent",
        topics: Mapping[str, Sequence[str]] = TOPICS) -> DataFrame:
    """Add the topic of each text; texts without a hit are ``unknown``."""
    size = len(topics)
    looked_up, found = _prepared(texts, text, topics, *texts.columns)
    # score first, then the earlier topic: one integer per topic, one greatest().
    weighed = [score * size + (size - 1 - place) for place, score in enumerate(found.values())]
    best = F.greatest(*weighed) if size > 1 else weighed[0]
    names = F.array(*[F.lit(topic) for topic in topics])
    return looked_up.select(*texts.columns, best.alias("_best")).select(
        *texts.columns,
        F.when(F.col("_best") >= size, F.element_at(names, size - F.col("_best") % size))
        .otherwise(UNKNOWN).alias(into))


def scores(texts: DataFrame, key: str, text: str = "text",
           topics: Mapping[str, Sequence[str]] = TOPICS) -> DataFrame:
    """(key, intent, score) for every topic with at least one hit."""
    looked_up, found = _prepared(texts, text, topics, key)
    cells = F.array(*[F.struct(F.lit(topic).alias("intent"), score.alias("score"))
                      for topic, score in found.items()])
    return looked_up.select(key, F.inline(cells)).where(F.col("score") > 0)


def volume(texts: DataFrame, text: str = "text") -> DataFrame:
    """Number of texts per topic, most asked first."""
    return (tag(texts, text).groupBy("intent").agg(F.count("*").alias("questions"))
            .orderBy(F.desc("questions"), "intent"))


def top_n(text: Column | str = "text", default: int = DEFAULT_TOP) -> Column:
    """The number after "top", else the default; one beyond BIGINT becomes the largest BIGINT."""
    found = F.regexp_extract(F.lower(col(text)), TOP_PATTERN, 1)
    return F.coalesce(found.try_cast("long"),
                      F.when(found != "", F.lit(2**63 - 1)), F.lit(default).cast("long"))


def years(text: Column | str = "text") -> Column:
    """All years of the 2000s named in the text, in order."""
    return F.regexp_extract_all(col(text), F.lit(YEAR_PATTERN), F.lit(0))


def year_pair(text: Column | str = "text") -> tuple[Column, Column]:
    """First and second year named, NULL where there is none."""
    found = years(text)
    return (F.get(found, F.lit(0)).cast("int"), F.get(found, F.lit(1)).cast("int"))
