"""Pearson correlation of all pairs of columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The numeric columns compared.
NUMERIC = ("quantity", "unit_price", "discount", "sales", "profit", "profit_margin",
           "days_to_ship", "customer_ltv")


def _number(name: str) -> Column:
    return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))


#: Rows whose mean serves as a typical value.
SAMPLE = 1_000


def typical_values(rows: DataFrame, columns: Sequence[str], sample: int = SAMPLE) -> dict[str, float]:
    """A typical value of each column, the mean of a few rows: it reads no more than these."""
    means = rows.select(*columns).limit(sample).agg(*[F.avg(_number(c)).alias(c) for c in columns]).first()
    return {c: means[c] for c in columns if means[c] is not None}


def correlation_matrix(rows: DataFrame, columns: Sequence[str] = NUMERIC,
                       centers: Mapping[str, float] | None = None) -> DataFrame:
    """(col_a, col_b, r) for every ordered pair; no lines for an empty table.

    Each pair uses the rows where both values are present; r is NULL when one
    of them does not vary there.

    Rows are grouped by which columns they have: one group when nothing is
    missing, never more than 2 to the number of columns. Plain sums of products
    per group then serve all pairs (an eighth of the time of as many covariance
    aggregates), and a pair adds up the groups that have both columns.

    ``centers`` are subtracted first, so that the sums do not cancel when a column lies far
    from zero; any typical value will do, as what it lacks of the mean is taken off exactly
    once the sums are there. So there is one pass, whatever the scale. Sums of groups and tasks add up,
    and states of parts of the data can be merged.
    """
    names = list(columns)
    size = range(len(names))
    if centers is None:
        centers = typical_values(rows, names)
    values = rows.select(*[(_number(c) - F.lit(float(centers.get(c, 0.0)))).alias(f"v{i}")
                           for i, c in enumerate(names)])
    held = " + ".join(f"IF(v{i} IS NULL, 0, {1 << i})" for i in size)
    groups = values.groupBy(F.expr(held).alias("held")).agg(
        F.count("*").cast("double").alias("n"),
        *[f(f"v{i}").alias(f"{name}{i}") for i in size
          for name, f in (("s", F.sum), ("lo", F.min), ("hi", F.max))],
        *[F.expr(f"sum(v{i} * v{j})").alias(f"p{i}_{j}") for i in size for j in size if i <= j])

    def pair(i: int, j: int) -> str:
        both = (1 << i) | (1 << j)
        return (f"named_struct('col_a', '{names[i]}', 'col_b', '{names[j]}', "
                f"'both', (held & {both}) = {both}, 'n', n, 'x', s{i}, 'y', s{j}, "
                f"'xy', p{min(i, j)}_{max(i, j)}, 'xx', p{i}_{i}, 'yy', p{j}_{j}, "
                f"'x_lo', lo{i}, 'x_hi', hi{i}, 'y_lo', lo{j}, 'y_hi', hi{j})")

    pairs = ", ".join(pair(i, j) for i in size for j in size)
    added = {name: "sum" for name in ("n", "x", "y", "xy", "xx", "yy")}
    added |= {"x_lo": "min", "x_hi": "max", "y_lo": "min", "y_hi": "max"}
    pooled = groups.select(F.expr(f"inline(array({pairs}))")).groupBy("col_a", "col_b").agg(
        *[F.expr(f"{f}({name}) FILTER (WHERE both)").alias(name) for name, f in added.items()])
    r = ("try_divide(xy - try_divide(x * y, n), sqrt(greatest(xx - try_divide(x * x, n), 0D)) "
         "* sqrt(greatest(yy - try_divide(y * y, n), 0D)))")
    # Rounding may leave r a last digit beyond its range.
    return pooled.select("col_a", "col_b", F.expr(
        f"IF(x_lo < x_hi AND y_lo < y_hi, least(greatest({r}, -1D), 1D), NULL)").alias("r"))
