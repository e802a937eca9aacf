"""The data set behind each dashboard visual.

Every function takes the star and, as ``where``, the page filters (year,
region, category), which apply to any visual alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import bands
from ..operators.ranking import dense_ranked, top_with_ties
from .measures import Where, evaluate
from .star import Star


def slice_of(year: int | None = None, region: str | None = None,
             category: str | None = None) -> dict:
    """The three page filters as a condition for any visual."""
    chosen = {"year": year, "region": region, "category": category}
    return {name: value for name, value in chosen.items() if value is not None}


def kpis(star: Star, where: Where | None = None) -> DataFrame:
    return evaluate(star, ["total_revenue", "total_profit", "profit_margin", "total_orders"],
                    where=where)


def trend(star: Star, where: Where | None = None) -> DataFrame:
    return evaluate(star, ["total_revenue"], ["year_month"], where).orderBy("year_month")


def revenue_by(star: Star, *attributes: str, where: Where | None = None) -> DataFrame:
    """Revenue per value of one or more attributes, highest first."""
    return (evaluate(star, ["total_revenue"], attributes, where)
            .orderBy(F.desc("total_revenue"), *attributes))


def category_bar(star: Star, where: Where | None = None) -> DataFrame:
    return revenue_by(star, "category", where=where)


def category_treemap(star: Star, where: Where | None = None) -> DataFrame:
    return revenue_by(star, "category", where=where)


def region_donut(star: Star, where: Where | None = None) -> DataFrame:
    return revenue_by(star, "region", where=where)


def city_map(star: Star, where: Where | None = None) -> DataFrame:
    return revenue_by(star, "region", "city", where=where)


def region_compare(star: Star, where: Where | None = None) -> DataFrame:
    return evaluate(star, ["total_revenue", "total_profit"], ["region"], where) \
        .orderBy("region")


def region_matrix(star: Star, where: Where | None = None) -> DataFrame:
    lines = evaluate(star, ["total_revenue", "total_profit", "profit_margin",
                            "avg_order_value"], ["region"], where)
    rank = F.dense_rank().over(W.orderBy(F.desc("total_revenue")))
    return lines.withColumn("region_rank", rank).orderBy("region_rank", "region")


def region_aov(star: Star, where: Where | None = None) -> DataFrame:
    return evaluate(star, ["avg_order_value"], ["region"], where) \
        .orderBy(F.desc("avg_order_value"), "region")


def top_products(star: Star, n: int = 10, where: Where | None = None) -> DataFrame:
    lines = evaluate(star, ["total_revenue"], ["product_name"], where)
    return top_with_ties(lines, "total_revenue", n, "product_name")


def category_margin(star: Star, where: Where | None = None) -> DataFrame:
    return evaluate(star, ["profit_margin"], ["category"], where) \
        .orderBy(F.desc("profit_margin"), "category")


def product_table(star: Star, where: Where | None = None) -> DataFrame:
    lines = evaluate(star, ["total_revenue", "total_profit", "profit_margin"],
                     ["product_name", "category"], where)
    return dense_ranked(lines, "total_revenue", "product_rank") \
        .orderBy("product_rank", "product_name")


def segment_donut(star: Star, where: Where | None = None) -> DataFrame:
    return revenue_by(star, "segment", where=where)


def top_customers(star: Star, n: int = 15, where: Where | None = None) -> DataFrame:
    lines = evaluate(star, ["total_revenue"], ["customer_name"], where)
    return top_with_ties(lines, "total_revenue", n, "customer_name")


def discount_combo(star: Star, where: Where | None = None) -> DataFrame:
    return evaluate(star, ["total_orders", "profit_margin"], ["discount_band"], where) \
        .orderBy(bands.position("discount_band", bands.DISCOUNT_LABELS))


def tier_matrix(star: Star, where: Where | None = None) -> DataFrame:
    return evaluate(star, ["total_customers", "total_revenue", "avg_order_value"],
                    ["customer_tier"], where) \
        .orderBy(bands.position("customer_tier", bands.TIER_LABELS))


def drill_category(star: Star, category: str, where: Where | None = None) -> DataFrame:
    """Products of one category, reached by drilling through."""
    return product_table(star, {**(where or {}), "category": category})
