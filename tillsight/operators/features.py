"""Columns derived from each order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bands
from ..functions.exact import amount, sum_units0
from ..sources.schema import CLEAN
from .lookup import attach


def with_date_parts(sales: DataFrame) -> DataFrame:
    return sales.withColumns({
        "order_year": F.year("order_date"),
        "order_month": F.month("order_date"),
        "order_quarter": F.quarter("order_date"),
    })


def with_date_labels(sales: DataFrame) -> DataFrame:
    return sales.withColumns({
        "order_month_name": F.date_format("order_date", "MMM"),
        "order_year_month": F.date_format("order_date", "yyyy-MM"),
    })


def with_days_to_ship(sales: DataFrame) -> DataFrame:
    return sales.withColumn("days_to_ship", F.datediff("ship_date", "order_date"))


def with_bands(sales: DataFrame) -> DataFrame:
    return sales.withColumns({
        "discount_band": bands.discount_band(),
        "sales_band": bands.sales_band(),
    })


def with_profit_flag(sales: DataFrame) -> DataFrame:
    profit = F.nanvl(F.col("profit").cast("double"), F.lit(None).cast("double"))
    return sales.withColumn("is_profitable", F.coalesce(profit > 0, F.lit(False)))


def with_row_features(sales: DataFrame) -> DataFrame:
    """Everything that needs only the row itself: one projection, no shuffle."""
    return with_profit_flag(with_bands(with_days_to_ship(
        with_date_labels(with_date_parts(sales)))))


def customer_value(sales: DataFrame) -> DataFrame:
    """(customer_id, customer_ltv, customer_rows): sales to date per customer."""
    return (
        sales.dropna(subset=["customer_id"]).groupBy("customer_id")
        .agg(sum_units0("sales").alias("_u"), F.count("*").alias("customer_rows"))
        .select("customer_id", amount("_u").alias("customer_ltv"), "customer_rows")
    )


def with_customer_value(sales: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Add ``customer_ltv``, by these or by all ``orders``; NULL for orders without a customer."""
    return attach(sales, customer_value(sales if orders is None else orders), "customer_id", "customer_ltv",
                  "customer_rows", spread_by=F.col("order_id"))


def with_customer_tier(sales: DataFrame,
                       limits: Sequence[float | None] = bands.TIER_LIMITS) -> DataFrame:
    return sales.withColumn("customer_tier", bands.customer_tier(limits=limits))


def with_features(sales: DataFrame,
                  tier_limits: Sequence[float | None] = bands.TIER_LIMITS, orders: DataFrame | None = None) -> DataFrame:
    """The clean table: 17 raw columns and 11 derived ones.

    Customers are worth what they spent in ``sales``, or in all ``orders`` that these are some of. Their value
    comes first, so that an order moves to it with its raw columns only.
    """
    full = with_customer_tier(with_row_features(with_customer_value(sales, orders)), tier_limits)
    return full.select(*CLEAN.fieldNames())
