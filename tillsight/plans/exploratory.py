"""The data sets behind the exploratory charts.

Rows whose group key is missing are left out, and a total without values is 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import bands
from ..functions.exact import amount, mean, percent, sum_units, sum_units0, units
from ..operators.correlation import NUMERIC, correlation_matrix, typical_values
from ..operators.features import with_customer_value
from ..sources.workspace import written


def by(sales: DataFrame, *keys: str):
    """Group by keys that are all present."""
    return sales.dropna(subset=list(keys)).groupBy(*keys)


def totals_by(sales: DataFrame, *keys: str, value: str = "sales") -> DataFrame:
    return (by(sales, *keys).agg(sum_units0(value).alias("_u"))
            .select(*keys, amount("_u").alias(value)))


def monthly_revenue(sales: DataFrame) -> DataFrame:
    return totals_by(sales, "order_year_month").orderBy("order_year_month")


def category_sales_profit(sales: DataFrame) -> DataFrame:
    return (
        by(sales, "category").agg(sum_units0("sales").alias("_s"),
                                  sum_units0("profit").alias("_p"))
        .select("category", amount("_s").alias("sales"), amount("_p").alias("profit"))
        .orderBy(F.desc("sales"), "category")
    )


def region_share(sales: DataFrame) -> DataFrame:
    everything = W.partitionBy()
    return (
        by(sales, "region").agg(sum_units0("sales").alias("_s"))
        .withColumn("share_pct", percent(F.col("_s"), F.sum("_s").over(everything), 1))
        .select("region", amount("_s").alias("sales"), "share_pct").orderBy("region")
    )


def margin_by_band(sales: DataFrame) -> DataFrame:
    """Mean margin of all five bands in order; NULL for a band without orders."""
    found = by(sales, "discount_band").agg(sum_units("profit_margin").alias("_m"),
                                           F.count("profit_margin").alias("_k"))
    every = sales.sparkSession.createDataFrame(
        [(i, label) for i, label in enumerate(bands.DISCOUNT_LABELS, 1)],
        "position int, discount_band string")
    return (
        every.join(found, "discount_band", "left").orderBy("position")
        .select("discount_band", mean("_m", "_k").alias("profit_margin"),
                mean("_m", "_k", 1).alias("profit_margin_1dp"))
    )


def top_customers(sales: DataFrame, n: int = 10) -> DataFrame:
    return (totals_by(sales, "customer_name")
            .orderBy(F.desc("sales"), "customer_name").limit(n))


def top_products_by_profit(sales: DataFrame, n: int = 10) -> DataFrame:
    return (totals_by(sales, "product_name", value="profit")
            .orderBy(F.desc("profit"), "product_name").limit(n))


def ship_mode_counts(sales: DataFrame) -> DataFrame:
    return (by(sales, "ship_mode").agg(F.count("*").alias("orders"))
            .orderBy(F.desc("orders"), "ship_mode"))


def segment_revenue(sales: DataFrame) -> DataFrame:
    return totals_by(sales, "segment").orderBy("segment")


#: A grid with more columns than this is refused, not cut.
GRID_COLUMNS = 1_000


def _present(sales: DataFrame, column: str) -> list:
    """The distinct values of a column that becomes the columns of a grid, in order."""
    found = [r[0] for r in sales.select(column).dropna().distinct().limit(GRID_COLUMNS + 1).collect()]
    if len(found) > GRID_COLUMNS:
        raise ValueError(f"{column} has more than {GRID_COLUMNS} values")
    return sorted(found)


def quarter_year_grid(sales: DataFrame, years: list[int] | None = None) -> DataFrame:
    """Quarter by year; a cell without orders is NULL. Without ``years``: all in the data.

    The orders are read once, for the cells; years and grid come from these few rows.
    """
    cells = written(
        by(sales.dropna(subset=["order_year"]), "order_quarter", "order_year")
        .agg(F.sum(F.coalesce(units("sales"), F.lit(0))).alias("_s")), "cells")
    years = _present(cells, "order_year") if years is None else years
    grid = cells.groupBy("order_quarter").pivot("order_year", years).agg(F.first("_s"))
    return grid.select("order_quarter", *[amount(f"`{y}`").alias(str(y)) for y in years]).orderBy("order_quarter")


def grid_cells(grid: DataFrame, column: str, value: str) -> DataFrame:
    """A grid as rows (its first column, column, value); empty cells are left out."""
    key, *names = grid.columns
    cells = F.array(*[F.struct(F.lit(n).alias(column), F.col(f"`{n}`").alias(value)) for n in names])
    if not names:
        cells = F.array().cast(f"array<struct<{column}:string,{value}:double>>")
    return grid.select(key, F.inline(cells)).where(F.col(value).isNotNull())


def year_category_grid(sales: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """Year by category; a cell without orders is NULL. Without ``categories``: all in the data."""
    categories = _present(sales, "category") if categories is None else categories
    cells = totals_by(sales, "order_year", "category")
    return cells.groupBy("order_year").pivot("category", categories).sum("sales") \
        .orderBy("order_year")


def correlations(sales: DataFrame, columns: tuple[str, ...] = NUMERIC) -> DataFrame:
    """Correlation matrix; customer value is attached when it is asked for.

    Typical values come from the orders as given, before that join.
    """
    centers = typical_values(sales, [c for c in columns if c in sales.columns])
    if "customer_ltv" in columns and "customer_ltv" not in sales.columns:
        sales = with_customer_value(sales)
    return correlation_matrix(sales, columns, centers)


def overall_kpis(sales: DataFrame) -> DataFrame:
    return (
        sales.agg(sum_units0("sales").alias("_s"), sum_units0("profit").alias("_p"))
        .select(amount("_s", 0).alias("total_revenue"), amount("_p", 0).alias("total_profit"),
                percent("_p", "_s", 1).alias("profit_margin"))
    )


def category_margin(sales: DataFrame) -> DataFrame:
    return (
        by(sales, "category").agg(sum_units0("sales").alias("_s"),
                                  sum_units0("profit").alias("_p"))
        .select("category", amount("_s").alias("revenue"), amount("_p").alias("profit"),
                percent("_p", "_s", 1).alias("margin"))
        .orderBy(F.desc("revenue"), "category")
    )


def fourth_quarter_share(sales: DataFrame) -> DataFrame:
    return (
        sales.agg(sum_units0("sales").alias("_s"),
                  sum_units0("sales", F.col("order_quarter") == 4).alias("_q4"))
        .select(percent("_q4", "_s", 1).alias("q4_share_pct"))
    )
