"""Global numbering and ranking without one task seeing all rows.

Rows are range-partitioned and sorted, numbered within their partition, and
shifted by the sizes of the partitions before. Only the table of partition
sizes (one row per shuffle partition) passes through a single task. Range
limits are sampled, so the numbered rows are written once; both later reads
then see the same split, also after an executor is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.exact import col
from ..sources.workspace import written

_IN_SLOT = (1 << 33) - 1   # low bits of monotonically_increasing_id


def numbered(rows: DataFrame, *order: Column | str, into: str = "position") -> DataFrame:
    """Add 1, 2, 3, ... in the given order, over the whole table."""
    ordered = written(
        rows.orderBy(*order)
        .withColumn("_slot", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_SLOT))),
        "numbered")
    sizes = ordered.groupBy("_slot").agg(F.count("*").alias("_size"))
    before = sizes.select("_slot", (
        F.sum("_size").over(W.orderBy("_slot").rowsBetween(W.unboundedPreceding, -1))
    ).alias("_before"))
    return (
        ordered.join(F.broadcast(before), "_slot")
        .withColumn(into, F.coalesce("_before", F.lit(0)) + F.col("_place") + 1)
        .select(*rows.columns, into)
    )


def dense_ranked(rows: DataFrame, value: str, into: str = "rank") -> DataFrame:
    """Add the dense rank by ``value``, highest first.

    Only distinct values are sorted and numbered; rows that share a value get
    its number by a join, whose hot values adaptive execution can split.
    """
    rows = written(rows, "totals")
    levels = rows.select(value).where(F.col(value).isNotNull()).distinct()
    ranks = numbered(levels, F.desc(value), into=into)
    return rows.join(ranks, value, "left").select(*rows.columns, F.col(into))


def top_with_ties(rows: DataFrame, value: str, n: int, *tie_break: str) -> DataFrame:
    """Rows whose rank by ``value``, highest first, is at most n; ties kept.

    The n-th value is found with a distributed top-n; the rest is a filter.
    """
    cut = (rows.select(value).where(F.col(value).isNotNull())
           .orderBy(F.desc(value)).limit(n).agg(F.min(value)).scalar())
    return rows.where(col(value) >= cut).orderBy(F.desc(value), *tie_break)
