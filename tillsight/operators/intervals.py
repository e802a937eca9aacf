"""Labels of values from a table of intervals.

A bound is (set, low, high, label): the label of values above low, up to and with high; a high of
NULL is open. Bounds of one set may not overlap; values outside all of them have no label.

Up to ``BROADCAST`` bounds, each set becomes one sorted array that is sent to all tasks and
searched by bisection, so the cost of a row grows with the logarithm of the number of bounds. Beyond
that the line of values is cut at quantiles of the lower ends, ``PER_BUCKET`` of them to a bucket;
an interval goes to every bucket it touches, which are as many as there are bounds and buckets in all,
and rows meet the bounds of their bucket in a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.exact import col
from ..sources.workspace import written

BROADCAST, PER_BUCKET = 100_000, 64


def checked(bounds: DataFrame) -> DataFrame:
    """The bounds, written; raises where one is empty, has no lower end or overlaps the next of its set."""
    kept = written(bounds.select("set", F.col("low").cast("double"), F.col("high").cast("double"), "label"), "bounds")
    # Equal lower ends overlap, so the order among them does not matter.
    after = F.lead("low").over(W.partitionBy("set").orderBy("low"))
    bad = kept.withColumn("_after", after).where(
        "low IS NULL OR isnan(low) OR isnan(high) OR high <= low OR _after < high OR (high IS NULL AND _after IS NOT NULL)")
    if (first := bad.first()) is not None:
        raise ValueError(f"empty or overlapping bounds in set {first['set']}: ({first['low']}, {first['high']}]")
    return kept


def below(limits: Column, value: Column) -> Column:
    """How many entries of a sorted array are less than a value, by bisection."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(limits) + 1)).cast("int"))

    def halved(at: Column, _: Column) -> Column:
        middle = F.floor((at["lo"] + at["hi"]) / 2).cast("int")
        more = (at["lo"] < at["hi"]) & (F.get(limits, middle) < value)
        return F.struct(F.when(more, middle + 1).otherwise(at["lo"]).alias("lo"),
                        F.when(more | (at["lo"] >= at["hi"]), at["hi"]).otherwise(middle).alias("hi"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size(limits).alias("hi")), halved, lambda at: at["lo"])


def _holds(value: Column, low: Column, high: Column) -> Column:
    return (value > low) & ~F.isnan(value) & (high.isNull() | (value <= high))


def _searched(rows: DataFrame, value: Column, bounds: DataFrame, which: str, into: str) -> DataFrame:
    arrays = bounds.where(F.col("set") == which).agg(
        F.sort_array(F.collect_list(F.struct("low", "high", "label"))).alias("_bounds")).select(
        F.transform("_bounds", lambda b: b["low"]).alias("_lows"), "_bounds")
    # One value each, of a size that was checked.
    beside = rows.withColumns({"_lows": arrays.select("_lows").scalar(), "_bounds": arrays.select("_bounds").scalar(),
                               "_value": value.cast("double")})
    found = beside.withColumn("_found", F.get("_bounds", below(F.col("_lows"), F.col("_value")) - 1))
    return found.select(*rows.columns, F.when(
        _holds(F.col("_value"), F.col("_found.low"), F.col("_found.high")), F.col("_found.label")).alias(into))


def _joined(rows: DataFrame, value: Column, bounds: DataFrame, which: str, into: str) -> DataFrame:
    own = bounds.where(F.col("set") == which)
    many = own.count()
    buckets = max(1, -(-many // PER_BUCKET))
    shares = [k / buckets for k in range(1, buckets)]
    edges = sorted(set(own.approxQuantile("low", shares, 0.1 / buckets))) if shares else []
    spark = rows.sparkSession
    cut = spark.createDataFrame([(edges,)], "_edges array<double>").scalar()  # a PER_BUCKETth of the bounds
    # Bucket k holds the values above k edges; an open interval goes on to the last one.
    spread = own.withColumn("_edges", cut).select(
        F.explode(F.sequence(below(F.col("_edges"), F.col("low")), F.coalesce(
            below(F.col("_edges"), F.col("high")), F.size("_edges")))).alias("_bucket"), "low", "high", F.col("label").alias(into))
    keyed = rows.withColumns({"_edges": cut, "_value": value.cast("double")}).withColumn(
        # Rows without a value match nothing; they are dealt out so that they fill no bucket.
        "_bucket", F.when(F.col("_value").isNull(), -1 - F.pmod(F.monotonically_increasing_id(), F.lit(4096)).cast("int"))
        .otherwise(below(F.col("_edges"), F.col("_value")))).drop("_edges")
    return keyed.join(spread.withColumnRenamed("_bucket", "_of"), (F.col("_bucket") == F.col("_of")) & _holds(
        F.col("_value"), F.col("low"), F.col("high")), "left").select(*[keyed[c] for c in rows.columns], F.col(into))


def labelled(rows: DataFrame, value: Column | str, bounds: DataFrame, which: str, into: str,
             broadcast: int = BROADCAST) -> DataFrame:
    """The rows with the label that set ``which`` of ``checked`` bounds gives the value; else NULL."""
    few = bounds.where(F.col("set") == which).count() <= broadcast
    return (_searched if few else _joined)(rows, col(value), bounds, which, into)
