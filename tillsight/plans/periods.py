"""Time measures for any choice of days.

``measures.time_measures`` answers by month. Here a line may be a single day, a week, the
Saturdays of a year or any other choice of days, and is compared with days that
follow from its own:

* now: the days themselves;
* prev_year: the same days a year before, 29 February becoming 28 February;
* prev_month: the whole month before the line's first day;
* ytd: from the first day of the year of the line's last day to that day;
* rolling: the months that end with the line's last day.

These day sets are made from the date table, so they are as large as the calendar, not the
orders. The facts are semi-joined to all their days, which prunes files and years, and
summed per day and group; only then are day totals joined to the sets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exact import units
from .measures import DIMENSIONS, Where, _condition, _divide, _keys, evaluate
from .star import Star

MONTHS = 3
_DAYS = DIMENSIONS["dim_date"][1]
_KINDS = ("now", "prev_year", "prev_month", "ytd", "rolling")


def _split(where: Where | None) -> tuple[dict, dict]:
    """Conditions on days, and on anything else."""
    where = where or {}
    return ({k: v for k, v in where.items() if k in _DAYS}, {k: v for k, v in where.items() if k not in _DAYS})


def lines(star: Star, by: Sequence[str], where: Where) -> DataFrame:
    """(by..., date): the days of every line; one line of all chosen days without ``by``."""
    days = star.dim_date
    chosen = _condition(where)
    # Attributes get names of their own: a line may be one of single dates.
    return (days if chosen is None else days.where(chosen)).select(
        *[F.col(c).alias(f"_{c}") for c in by], "date")


def day_sets(days: DataFrame, by: Sequence[str], months: int = MONTHS) -> DataFrame:
    """(by..., kind, date) for lines (by..., date): the days each kind of total adds up."""
    keys = [f"_{c}" for c in by]
    ends = days.groupBy(*keys).agg(F.min("date").alias("_first"), F.max("date").alias("_last")).where("_last IS NOT NULL")

    def spread(kind: str, start: Column, end: Column) -> DataFrame:
        return ends.select(*keys, F.lit(kind).alias("kind"), F.explode(
            F.sequence(start, end, F.expr("interval 1 day"))).alias("date"))

    first, last = F.col("_first"), F.col("_last")
    before = F.add_months(first, -1)
    return (
        days.select(*keys, F.lit("now").alias("kind"), "date")
        .unionByName(days.select(*keys, F.lit("prev_year").alias("kind"), F.add_months("date", -12).alias("date")).distinct())
        .unionByName(spread("prev_month", F.trunc(before, "month").cast("date"), F.last_day(before)))
        .unionByName(spread("ytd", F.trunc(last, "year").cast("date"), last))
        .unionByName(spread("rolling", F.date_add(F.add_months(last, -months), 1), last)))


def _day_totals(star: Star, by: Sequence[str], where: Where, days: DataFrame | None = None) -> DataFrame:
    """(by..., date, cents) of the orders, or of those on the given days."""
    if days is not None:
        keys = days.select(F.year("date").alias("order_year"),
                           F.date_format("date", "yyyyMMdd").cast("int").alias("date_key")).distinct()
        facts = star.facts(_keys([*by, *where, "date"]))
        on = [c for c in ("order_year", "date_key") if c in facts.columns]
        star = star.with_facts(facts.join(keys.select(*on).distinct(), on, "left_semi"))
    found = evaluate(star, ["total_revenue"], by=[*by, "date"], where=where)
    return found.select(*by, "date", units("total_revenue").alias("cents"))


def period_measures(star: Star, where: Where | None = None, by: Sequence[str] = (), months: int = MONTHS) -> DataFrame:
    """Revenue of each line beside that of its periods, and its growth over them.

    ``by`` and ``where`` may name any attribute. Those of dates say which days a line is made of; the
    others pick orders. A line without revenue in any of its periods is left out, but for the
    one line that there is without ``by``. Growth is 0 without a base.
    """
    of_days, of_orders = _split(where)
    own, others = [c for c in by if c in _DAYS], [c for c in by if c not in _DAYS]
    sets = day_sets(lines(star, own, of_days), own, months)
    totals = _day_totals(star, others, of_orders, sets).withColumnRenamed("date", "_on")
    joined = sets.join(totals, F.col("date") == F.col("_on"))
    # Days and groups are reduced once more before lines are put together.
    sums = joined.groupBy(*[F.col(f"_{c}").alias(c) for c in own], *others).agg(*[
        F.sum(F.when(F.col("kind") == kind, F.col("cents"))).alias(kind) for kind in _KINDS])

    def change(before: str) -> Column:
        return _divide(F.coalesce("now", F.lit(0)) - F.coalesce(before, F.lit(0)), F.col(before))

    measured = sums.select(
        *by, (F.col("now") / 100).alias("total_revenue"), (F.col("ytd") / 100).alias("revenue_ytd"),
        (F.col("prev_year") / 100).alias("revenue_prev_year"), (F.col("prev_month") / 100).alias("revenue_prev_month"),
        (F.col("rolling") / 100).alias("rolling_3m"), change("prev_year").alias("revenue_yoy"),
        change("prev_month").alias("revenue_mom"))
    return measured.orderBy(*by) if by else measured


def rolling_by_day(star: Star, where: Where | None = None, by: Sequence[str] = (), months: int = MONTHS) -> DataFrame:
    """(by..., date, total_revenue, rolling_3m) of every calendar day and combination of ``by``.

    The rolling total ends with the day and begins a day after the same day so many months
    before. A group has lines in the months in which it has such a total on some day. Conditions on
    attributes of days pick lines, after they have looked back; others pick orders.

    The frame is a range of dates in a window over (by, month): each day total is given to its
    own month and to those that look back on it, so no task holds all days of a group.
    """
    of_days, of_orders = _split(where)
    if any(c in _DAYS for c in by):
        raise ValueError("the lines are days already")
    totals = _day_totals(star, by, of_orders)
    block = (F.year("date") * 12 + F.month("date") - 1).alias("_block")
    ends = {name: star.dim_date.agg(f("date")).scalar() for name, f in (("_from", F.min), ("_to", F.max))}
    moved = totals.where("date IS NOT NULL").withColumns(ends).withColumn("_block", F.explode(F.sequence(
        block, F.least(block + months, F.year("_to") * 12 + F.month("_to") - 1))))
    moved = moved.repartition(*by, "_block")
    first = F.make_date(F.floor(F.col("_block") / 12).cast("int"), (F.col("_block") % 12 + 1).cast("int"), F.lit(1))
    spine = moved.groupBy(*by, "_block").agg(F.min("_from").alias("_from"), F.min("_to").alias("_to")).select(
        *by, "_block", F.explode(F.sequence(F.greatest(first, "_from"), F.least(F.last_day(first), "_to"),
                                            F.expr("interval 1 day"))).alias("date"), F.lit(None).cast("long").alias("cents"))
    every = moved.select(*by, "_block", "date", "cents").unionByName(spine).groupBy(*by, "_block", "date").agg(
        F.sum("cents").alias("cents"))
    part = ", ".join([f"`{c}`" for c in by] + ["_block"])
    frame = f"OVER (PARTITION BY {part} ORDER BY date RANGE BETWEEN INTERVAL '{months}' MONTH PRECEDING AND CURRENT ROW)"
    # The frame holds its lower end; a total on that very day is taken off again.
    looked = every.select(
        *by, "_block", "date", "cents", F.expr(f"sum(cents) {frame}").alias("_sum"),
        F.expr(f"count(cents) {frame}").alias("_n"),
        F.expr(f"min_by(named_struct('date', date, 'cents', cents), IF(cents IS NULL, NULL, date)) {frame}").alias("_low"))
    on_low = F.col("_low.date") == F.add_months("date", -months)
    lines_ = looked.where(F.col("_block") == F.year("date") * 12 + F.month("date") - 1).select(
        *by, "date", (F.col("cents") / 100).alias("total_revenue"),
        (F.when(F.col("_n") > F.when(on_low, 1).otherwise(0),
                F.col("_sum") - F.when(on_low, F.col("_low.cents")).otherwise(0)) / 100).alias("rolling_3m"))
    if of_days:
        lines_ = lines_.join(star.dim_date.where(_condition(of_days)).select("date"), "date", "left_semi").select(*lines_.columns)
    return lines_.orderBy(*by, "date")
