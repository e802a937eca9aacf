"""Price, profit and margin of an order line."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Profit multiplier by region, and how hard a discount cuts the margin.
REGION_FACTORS = {"North": 1.0, "South": 1.05, "East": 0.92, "West": 1.10}
DISCOUNT_WEIGHT = 1.8


def price_lines(lines: DataFrame, base_margin: Column,
                region_factors: Mapping[str, float] = REGION_FACTORS) -> DataFrame:
    """Set sales, profit and profit_margin from price, quantity and discount.

    DECIMAL arithmetic, each step rounded half away from zero to cents. A
    region without a factor yields NULL profit.
    """
    def money(value: Column) -> Column:
        return F.round(value, 2).cast("decimal(18,2)")

    exact = "decimal(10,4)"
    discount = F.col("discount").cast("decimal(5,4)")
    factor = F.create_map(*[F.lit(x) for name, share in region_factors.items()
                            for x in (name, share)])[F.col("region")]
    priced = lines.withColumn(
        "_sales", money(money(F.col("unit_price").cast("decimal(18,2)"))
                        * F.col("quantity") * (1 - discount)))
    kept = 1 - F.lit(DISCOUNT_WEIGHT).cast("decimal(2,1)") * discount
    priced = priced.withColumn(
        "_profit", money(F.col("_sales") * base_margin.cast(exact) * kept))
    priced = priced.withColumn(
        "_profit", money(F.col("_profit") * factor.cast("decimal(6,4)")))
    share = F.when(F.col("_sales") > 0,
                   F.round(F.col("_profit") * 100 / F.col("_sales"), 2).cast("double"))
    return priced.withColumns({
        "sales": F.col("_sales").cast("double"),
        "profit": F.col("_profit").cast("double"),
        "profit_margin": F.when(F.col("_sales") <= 0, F.lit(0.0)).otherwise(share),
    }).drop("_sales", "_profit")
