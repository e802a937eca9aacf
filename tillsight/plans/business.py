"""The fifteen business reports, and the ten shorter ones cut from them.

Input is ``sales`` with its date parts. A group whose key is NULL is kept.
Windows without a partition run over report lines (months, regions), never
over orders; customers and products are ranked within a partition and limited
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import bands
from ..functions.exact import amount, growth, mean, percent, ratio, sum_units, units

CUSTOMER = ("customer_id", "customer_name", "region", "segment")
MONTH = ("order_year", "order_month")


def _orders():
    return F.count("order_id")


def _sales():
    return sum_units("sales").alias("_s")


def _profit():
    return sum_units("profit").alias("_p")


def _priced():
    return F.count("sales").alias("_n")


# ---- reports in full -------------------------------------------------------

def category_summary(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("category")
        .agg(_orders().alias("total_orders"), _sales(), _profit(), _priced())
        .select("category", "total_orders", amount("_s", 0).alias("total_revenue"),
                amount("_p", 0).alias("total_profit"),
                percent("_p", "_s", 1).alias("profit_margin_pct"),
                mean("_s", "_n", 0).alias("avg_order_value"))
        .orderBy(F.desc("total_revenue"), "category")
    )


def high_value_customers(sales: DataFrame, min_ltv: float = 200_000) -> DataFrame:
    """Customers whose unrounded total is above ``min_ltv``."""
    return (
        sales.groupBy(*CUSTOMER)
        .agg(_orders().alias("total_orders"), _sales(), _profit(), _priced())
        .where(F.col("_s") > F.lit(round(min_ltv * 100)))
        .select("customer_id", "customer_name", "region", "segment", "total_orders",
                amount("_s", 0).alias("lifetime_value"),
                mean("_s", "_n", 0).alias("avg_order_value"),
                amount("_p", 0).alias("total_profit"))
        .orderBy(F.desc("lifetime_value"), "customer_name", "customer_id")
        .drop("customer_id")
    )


def monthly_trend(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy(*MONTH).agg(_orders().alias("orders"), _sales(), _profit(), _priced())
        .select(F.col("order_year").alias("year"), F.col("order_month").alias("month"),
                "orders", amount("_s", 0).alias("monthly_revenue"),
                mean("_s", "_n", 0).alias("avg_order_value"),
                percent("_p", "_s", 1).alias("margin_pct"))
        .orderBy("year", "month")
    )


def above_average_margin(sales: DataFrame) -> DataFrame:
    """Products whose mean margin exceeds the mean over all orders."""
    margins = [sum_units("profit_margin").alias("_m"), F.count("profit_margin").alias("_k")]
    per_product = sales.groupBy("product_name", "category").agg(
        _orders().alias("orders"), _sales(), *margins)
    overall = sales.agg(*margins).select(F.try_divide("_m", "_k")).scalar()
    return (
        per_product.where(F.try_divide("_m", "_k") > overall)
        .select("product_name", "category", "orders", amount("_s", 0).alias("total_sales"),
                mean("_m", "_k", 1).alias("avg_margin_pct"))
        .orderBy(F.desc("avg_margin_pct"), "product_name", "category")
    )


def top_customers_by_region(sales: DataFrame, k: int = 3) -> DataFrame:
    """Customers with the k highest rounded totals of each region, ties kept."""
    totals = (
        sales.groupBy("customer_id", "customer_name", "region")
        .agg(_sales(), _orders().alias("orders"))
        .select("customer_name", "region", amount("_s", 0).alias("total_sales"), "orders")
    )
    place = F.dense_rank().over(W.partitionBy("region").orderBy(F.desc("total_sales")))
    return (
        totals.withColumn("region_rank", place).where(F.col("region_rank") <= k)
        .orderBy("region", "region_rank", "customer_name")
    )


def _monthly_revenue(sales: DataFrame) -> DataFrame:
    return sales.groupBy(*MONTH).agg(_sales()).select(*MONTH, amount("_s", 0).alias("revenue"))


def month_over_month_all(sales: DataFrame) -> DataFrame:
    """Each month beside the month before it that has orders."""
    before = F.lag("revenue").over(W.orderBy(*MONTH))
    return (
        _monthly_revenue(sales).withColumn("prev_revenue", before)
        .withColumn("growth_pct", growth("revenue", "prev_revenue", 1))
        .orderBy(*MONTH)
    )


def month_over_month(sales: DataFrame) -> DataFrame:
    return (month_over_month_all(sales).where(F.col("prev_revenue").isNotNull())
            .withColumnRenamed("growth_pct", "mom_growth_pct").orderBy(*MONTH))


def best_product_by_category(sales: DataFrame) -> DataFrame:
    totals = (
        sales.groupBy("category", "product_name")
        .agg(_sales(), _orders().alias("orders"), _profit())
        .select("category", "product_name", amount("_s", 0).alias("total_sales"),
                "orders", amount("_p", 0).alias("total_profit"))
    )
    place = F.row_number().over(
        W.partitionBy("category").orderBy(F.desc("total_sales"), "product_name"))
    return (totals.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")
            .orderBy(F.desc("total_sales"), "category"))


def discount_impact(sales: DataFrame) -> DataFrame:
    return (
        sales.withColumn("_band", bands.discount_band_case()).groupBy("_band")
        .agg(_orders().alias("orders"), _sales(), _profit(),
             F.count("profit").alias("_n"), sum_units("profit_margin").alias("_m"),
             F.count("profit_margin").alias("_k"))
        .orderBy(bands.position("_band", bands.DISCOUNT_LABELS))
        .select(F.col("_band").alias("discount_band"), "orders",
                amount("_s", 0).alias("total_revenue"),
                mean("_m", "_k", 1).alias("avg_margin_pct"),
                mean("_p", "_n", 0).alias("avg_profit_per_order"),
                percent("_p", "_s", 1).alias("effective_margin"))
    )


def above_segment_average(sales: DataFrame, multiple: float = 3, limit: int = 15) -> DataFrame:
    """Customers who spent more than ``multiple`` mean orders of their segment.

    Segment means are rolled up from the customer lines, so the orders are read
    once: both sides use the same columns and hence the same shuffle.
    """
    per_customer = sales.groupBy(*CUSTOMER).agg(_sales(), _priced()).where(F.col("_n") > 0)
    per_segment = per_customer.groupBy("segment").agg(
        F.sum("_s").alias("_seg_s"), F.sum("_n").alias("_seg_n"))
    enough = F.col("_s") > F.lit(float(multiple)) * F.try_divide("_seg_s", "_seg_n")
    return (
        per_customer.join(per_segment, "segment").where(enough)
        .select("customer_id", "customer_name", "segment", "region",
                amount("_s", 0).alias("customer_revenue"),
                mean("_seg_s", "_seg_n", 0).alias("segment_avg_order_value"))
        .orderBy(F.desc("customer_revenue"), "customer_name", "customer_id")
        .limit(limit).drop("customer_id")
    )


def running_total(sales: DataFrame) -> DataFrame:
    so_far = W.partitionBy("order_year").orderBy("order_month").rowsBetween(
        W.unboundedPreceding, W.currentRow)
    return (
        _monthly_revenue(sales)
        .withColumn("cumulative_revenue_ytd", F.sum("revenue").over(so_far))
        .withColumnRenamed("revenue", "monthly_revenue").orderBy(*MONTH)
    )


def regional_scorecard(sales: DataFrame) -> DataFrame:
    """Margin, revenue per customer and both ranks use the rounded totals."""
    per_region = (
        sales.groupBy("region")
        .agg(F.countDistinct("customer_id").alias("unique_customers"),
             _orders().alias("total_orders"), _sales(), _profit(), _priced())
        .select("region", "unique_customers", "total_orders",
                amount("_s", 0).alias("total_revenue"), amount("_p", 0).alias("total_profit"),
                mean("_s", "_n", 0).alias("avg_order_value"))
    )
    return (
        per_region
        .withColumn("margin_pct", percent("total_profit", "total_revenue", 1))
        .withColumn("revenue_per_customer", ratio("total_revenue", "unique_customers", 0))
        .withColumn("revenue_rank", F.rank().over(W.orderBy(F.desc("total_revenue"))))
        .withColumn("margin_rank", F.rank().over(W.orderBy(F.desc("margin_pct"))))
        .select("region", "unique_customers", "total_orders", "total_revenue", "total_profit",
                "margin_pct", "avg_order_value", "revenue_per_customer", "revenue_rank",
                "margin_rank")
        .orderBy("revenue_rank", "region")
    )


def year_over_year(sales: DataFrame) -> DataFrame:
    yearly = (sales.groupBy("order_year", "category").agg(_sales())
              .select("order_year", "category", amount("_s", 0).alias("revenue")))
    before = F.lag("revenue").over(W.partitionBy("category").orderBy("order_year"))
    return (
        yearly.withColumn("prev_year_revenue", before)
        .where(F.col("prev_year_revenue").isNotNull())
        .withColumn("yoy_growth_pct", growth("revenue", "prev_year_revenue", 1))
        .orderBy("category", "order_year")
    )


def retained_customers(sales: DataFrame, first_year: int = 2022, later_year: int = 2024,
                       limit: int | None = 15) -> DataFrame:
    """Customers of the first year who also ordered in the later one."""
    first = sales.where(F.col("order_year") == first_year).select(*CUSTOMER).distinct()
    later = sales.where(F.col("order_year") == later_year).select("customer_id").distinct()
    kept = (first.join(later, "customer_id", "left_semi")
            .orderBy("customer_name", "customer_id", "region", "segment"))
    if limit is not None:
        kept = kept.limit(limit)
    return kept.select("customer_name", "region", "segment")


def first_and_latest_order(sales: DataFrame, limit: int = 15) -> DataFrame:
    """First and latest order value per customer, biggest rise first.

    Orders of one day are put in order by id, then value. Each customer is
    reduced before the shuffle; the window sees one row per customer, name and
    region.
    """
    order = F.struct("order_date", "order_id", "sales")
    per_name = sales.groupBy("customer_id", "customer_name", "region").agg(
        F.min(order).alias("_first"), F.max(order).alias("_last"))
    everything = W.partitionBy("customer_id")
    ends = per_name.select(
        "customer_name", "region",
        F.min("_first").over(everything)["sales"].alias("_from"),
        F.max("_last").over(everything)["sales"].alias("_to"))
    ends = ends.select("customer_name", "region",
                       units("_from").alias("_from"), units("_to").alias("_to"))
    return (
        ends.select("customer_name", "region",
                    amount("_from", 0).alias("first_order_value"),
                    amount("_to", 0).alias("latest_order_value"),
                    amount(F.col("_to") - F.col("_from"), 0).alias("value_change"))
        .distinct()
        .orderBy(F.desc("value_change"), "customer_name", "region", "first_order_value",
                 "latest_order_value")
        .limit(limit)
    )


def quarterly_by_category(sales: DataFrame) -> DataFrame:
    quarters = [F.sum(F.when(F.col("order_quarter") == q,
                             F.coalesce(units("sales"), F.lit(0)))
                      .otherwise(0)).alias(f"_q{q}") for q in (1, 2, 3, 4)]
    return (
        sales.groupBy("order_year", "category").agg(*quarters, _sales())
        .select("order_year", "category",
                *[amount(f"_q{q}", 0).alias(f"Q{q}") for q in (1, 2, 3, 4)],
                amount("_s", 0).alias("annual_total"),
                growth("_q4", "_q1", 1).alias("q4_vs_q1_growth_pct"))
        .orderBy("order_year", F.desc("annual_total"), "category")
    )


# ---- shorter reports -------------------------------------------------------

def category_summary_short(sales: DataFrame) -> DataFrame:
    return category_summary(sales).select(
        "category", "total_orders", "total_revenue", "total_profit",
        F.col("profit_margin_pct").alias("margin_pct"))


def high_value_customers_short(sales: DataFrame, min_ltv: float = 200_000,
                               limit: int = 10) -> DataFrame:
    return (
        sales.groupBy(*CUSTOMER).agg(_orders().alias("orders"), _sales())
        .where(F.col("_s") > F.lit(round(min_ltv * 100)))
        .withColumn("lifetime_value", amount("_s", 0))
        .orderBy(F.desc("lifetime_value"), "customer_name", "customer_id").limit(limit)
        .select("customer_name", "region", "segment", "orders", "lifetime_value")
    )


def first_months(sales: DataFrame, limit: int = 12) -> DataFrame:
    return (
        sales.groupBy(*MONTH).agg(_orders().alias("orders"), _sales())
        .select(*MONTH, "orders", amount("_s", 0).alias("monthly_revenue"))
        .orderBy(*MONTH).limit(limit)
    )


def above_average_margin_short(sales: DataFrame, limit: int = 10) -> DataFrame:
    return (above_average_margin(sales)
            .orderBy(F.desc("avg_margin_pct"), "product_name", "category").limit(limit)
            .select("product_name", "category", F.col("avg_margin_pct").alias("avg_margin")))


def top_customers_by_region_short(sales: DataFrame, k: int = 3) -> DataFrame:
    return top_customers_by_region(sales, k).drop("orders")


def month_over_month_short(sales: DataFrame, limit: int = 12) -> DataFrame:
    """The first months, the very first without growth included."""
    return month_over_month_all(sales).limit(limit)


def best_product_short(sales: DataFrame) -> DataFrame:
    return best_product_by_category(sales).select("category", "product_name", "total_sales")


def discount_impact_short(sales: DataFrame) -> DataFrame:
    return (discount_impact(sales)
            .select("discount_band", "orders", F.col("avg_margin_pct").alias("avg_margin"))
            .orderBy(F.desc("avg_margin"), "discount_band"))


def running_total_short(sales: DataFrame, limit: int = 12) -> DataFrame:
    # The default frame; a month occurs once per year, so it equals a row frame.
    so_far = W.partitionBy("order_year").orderBy("order_month")
    return (_monthly_revenue(sales).withColumn("running_total", F.sum("revenue").over(so_far))
            .orderBy(*MONTH).limit(limit))


def quarterly_short(sales: DataFrame, limit: int = 10) -> DataFrame:
    return (quarterly_by_category(sales).orderBy("order_year", "category").limit(limit)
            .select("order_year", "category", "Q1", "Q2", "Q3", "Q4"))
