"""Text labels for amounts, shares and profit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .exact import col

# Lower limit, divisor, decimals and suffix of each amount label.
AMOUNT_STEPS = (
    (10_000_000, 10_000_000, 2, " Cr"),
    (100_000, 100_000, 1, " L"),
    (1_000, 1_000, 1, "K"),
)
AMOUNT_PREFIX = "Rs."


def _fixed(value: Column, places: int) -> Column:
    # DECIMAL rounds half away from zero and prints all its decimals.
    return F.round(value, places).cast(f"decimal(30,{places})").cast("string")


def amount_label(amount: Column | str) -> Column:
    """``Rs.1.25 Cr``, ``Rs.3.4 L``, ``Rs.5.6K`` or ``Rs.789``."""
    amount = col(amount)
    exact = amount.cast("decimal(20,2)")
    chain = None
    for limit, divisor, places, suffix in AMOUNT_STEPS:
        text = F.concat(F.lit(AMOUNT_PREFIX),
                        _fixed(exact / F.lit(divisor), places), F.lit(suffix))
        chain = F.when(amount >= limit, text) if chain is None \
            else chain.when(amount >= limit, text)
    return chain.otherwise(F.concat(F.lit(AMOUNT_PREFIX), _fixed(exact, 0)))


def percent_label(percent: Column | str) -> Column:
    """``12.3%`` from a percent value."""
    return F.concat(_fixed(col(percent).cast("decimal(30,10)"), 1), F.lit("%"))


def fraction_label(fraction: Column | str) -> Column:
    """``12.3%`` from a fraction."""
    return percent_label(col(fraction).cast("decimal(30,10)") * F.lit(100))


def profit_status(profit: Column | str = "profit") -> Column:
    return F.when(col(profit) > 0, "Profitable").otherwise("Loss")
