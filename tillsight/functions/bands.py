"""Bands: amounts to labels, and labels to their sort position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .exact import col

# Band limits and labels.
DISCOUNT_LIMITS = (-0.01, 0.0, 0.10, 0.20, 0.30, 1.0)
DISCOUNT_LABELS = ("No Discount", "Low (1-10%)", "Medium (11-20%)",
                   "High (21-30%)", "Very High (>30%)")
SALES_LIMITS = (0, 2000, 10000, 30000, 100000, None)
SALES_LABELS = ("< 2K", "2K-10K", "10K-30K", "30K-1L", "> 1L")
TIER_LIMITS = (0, 50000, 150000, 300000, None)
TIER_LABELS = ("Bronze", "Silver", "Gold", "Platinum")


def band(value: Column | str, limits: Sequence[float | None],
         labels: Sequence[str]) -> Column:
    """Label of the right-closed interval holding the value, else NULL.

    ``limits`` has one entry more than ``labels``; a last limit of None is
    open-ended.
    """
    value = col(value)
    chain = F.when(value <= float(limits[0]), None)
    for high, label in zip(limits[1:], labels):
        # NaN is above every limit, so only the open end has to turn it away.
        inside = value <= float(high) if high is not None \
            else value.isNotNull() & ~F.isnan(value.cast("double"))
        chain = chain.when(inside, label)
    return chain


def discount_band(discount: Column | str = "discount") -> Column:
    return band(discount, DISCOUNT_LIMITS, DISCOUNT_LABELS)


def sales_band(sales: Column | str = "sales") -> Column:
    return band(sales, SALES_LIMITS, SALES_LABELS)


def customer_tier(value: Column | str = "customer_ltv",
                  limits: Sequence[float | None] = TIER_LIMITS) -> Column:
    return band(value, limits, TIER_LABELS)


def discount_band_case(discount: Column | str = "discount") -> Column:
    """The reporting variant: anything not caught, NULL included, is very high."""
    discount = col(discount)
    return (
        F.when(discount == 0, DISCOUNT_LABELS[0])
        .when(discount <= 0.10, DISCOUNT_LABELS[1])
        .when(discount <= 0.20, DISCOUNT_LABELS[2])
        .when(discount <= 0.30, DISCOUNT_LABELS[3])
        .otherwise(DISCOUNT_LABELS[4])
    )


def position(label: Column | str, labels: Sequence[str]) -> Column:
    """1-based place of a label in its ordered list; NULL when absent."""
    place = F.array_position(F.array(*[F.lit(x) for x in labels]), col(label))
    return F.nullif(place, F.lit(0).cast("long")).cast("int")
