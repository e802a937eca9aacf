"""The reports that answer a question, one per topic.

Rows whose group key is missing are left out, and a total without values is 0.
A report's closing remark is a second, one-row report with the suffix
``_insight``, computed from the same grouped rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import bands, questions
from ..functions.exact import (amount, best_key, growth, mean, percent, ratio, sum_units,
                               sum_units0, units, worst_key)
from ..sources.workspace import written
from .business import retained_customers
from .exploratory import by


def _over_all(total):
    """A total over all report lines, beside each line."""
    return total.over(W.partitionBy())


def _sales():
    return sum_units0("sales").alias("_s")


def _profit():
    return sum_units0("profit").alias("_p")


def _margin(places: int | None = 1):
    return percent("_p", "_s", places)


def _month_name(month):
    return F.date_format(F.make_date(F.lit(2000), F.col(month), F.lit(1)), "MMM")


# ---- revenue ---------------------------------------------------------------

def _region_revenue(sales: DataFrame) -> DataFrame:
    return by(sales, "region").agg(
        _sales(), F.count("order_id").alias("total_orders"), F.count("sales").alias("_n"))


def revenue_by_region(sales: DataFrame, bar: int = 20) -> DataFrame:
    width = F.try_divide(F.col("_s") * bar, _over_all(F.max("_s"))).cast("int")
    return (
        _region_revenue(sales).withColumn("bar_length", width)
        .select("region", amount("_s").alias("total_revenue"), "total_orders",
                mean("_s", "_n").alias("avg_order_value"), "bar_length")
        .orderBy(F.desc("total_revenue"), "region")
    )


def revenue_by_region_insight(sales: DataFrame) -> DataFrame:
    found = _region_revenue(sales).agg(
        best_key("region", "_s").alias("leader"), F.max("_s").alias("_hi"),
        worst_key("region", "_s").alias("laggard"), F.min("_s").alias("_lo"))
    return found.select("leader", amount("_hi").alias("leader_revenue"), "laggard",
                        amount("_lo").alias("laggard_revenue"),
                        amount(F.col("_hi") - F.col("_lo")).alias("gap"))


def _category_lines(sales: DataFrame) -> DataFrame:
    return (
        by(sales, "category").agg(_sales(), _profit(), F.count("order_id").alias("orders"))
        .select("category", "_s", "_p", "orders", _margin().alias("margin"),
                percent(F.col("_s"), _over_all(F.sum("_s")), 1).alias("share"))
    )


def revenue_by_category(sales: DataFrame) -> DataFrame:
    return (
        _category_lines(sales)
        .select("category", amount("_s").alias("total_revenue"),
                amount("_p").alias("total_profit"), "orders", "margin", "share")
        .orderBy(F.desc("total_revenue"), "category")
    )


def revenue_by_category_insight(sales: DataFrame) -> DataFrame:
    return _category_lines(sales).agg(
        best_key("category", "_s").alias("top_category"),
        F.max("share").alias("top_share"),
        worst_key("category", "margin").alias("lowest_margin_category"),
        F.min("margin").alias("lowest_margin"))


def total_revenue(sales: DataFrame) -> DataFrame:
    found = sales.agg(_sales(), _profit(), F.count("*").alias("total_orders"),
                      F.countDistinct("customer_id").alias("unique_customers"),
                      F.min("order_date").alias("first_date"),
                      F.max("order_date").alias("last_date"))
    return found.select(
        amount("_s").alias("total_revenue"), amount("_p").alias("total_profit"),
        _margin(None).alias("profit_margin"), "total_orders", "unique_customers",
        mean("_s", "total_orders").alias("avg_order_value"), "first_date", "last_date")


def revenue_trend(sales: DataFrame, bar: int = 25) -> DataFrame:
    """Each month with its year's total and its bar against the best month."""
    months = by(sales, "order_year", "order_month").agg(_sales())
    return (
        months.withColumn("_y", F.sum("_s").over(W.partitionBy("order_year")))
        .withColumn("bar_length",
                    F.try_divide(F.col("_s") * bar, _over_all(F.max("_s"))).cast("int"))
        .select("order_year", "order_month", _month_name("order_month").alias("month_name"),
                amount("_s").alias("revenue"), amount("_y").alias("year_total"), "bar_length")
        .orderBy("order_year", "order_month")
    )


def revenue_trend_insight(sales: DataFrame) -> DataFrame:
    """Growth between consecutive years that have orders."""
    line = W.orderBy("order_year")
    return (
        by(sales, "order_year").agg(_sales())
        .select(F.lag("order_year").over(line).alias("from_year"),
                F.col("order_year").alias("to_year"),
                growth(F.col("_s"), F.lag("_s").over(line)).alias("growth_pct"))
        .where(F.col("from_year").isNotNull()).orderBy("to_year")
    )


# ---- profit ----------------------------------------------------------------

def _profit_by(sales: DataFrame, key: str) -> DataFrame:
    return (
        by(sales, key).agg(_profit(), _sales())
        .select(key, amount("_p").alias("total_profit"), amount("_s").alias("total_revenue"),
                _margin().alias("margin"))
        .orderBy(F.desc("margin"), key)
    )


def profit_by_category(sales: DataFrame) -> DataFrame:
    return _profit_by(sales, "category")


def profit_by_region(sales: DataFrame) -> DataFrame:
    return _profit_by(sales, "region")


def total_profit(sales: DataFrame) -> DataFrame:
    """Grouped by year first; orders without a year count in the totals only."""
    years = sales.groupBy("order_year").agg(_sales(), _profit())
    best = F.min_by("order_year", F.when(
        F.col("order_year").isNotNull(), F.struct(-F.col("_p"), F.col("order_year"))))
    return (
        years.agg(F.coalesce(F.sum("_s"), F.lit(0).cast("long")).alias("_s"),
                  F.coalesce(F.sum("_p"), F.lit(0).cast("long")).alias("_p"),
                  best.alias("best_year"))
        .select(amount("_p").alias("total_profit"), _margin(None).alias("profit_margin"),
                "best_year")
    )


# ---- customers and products ------------------------------------------------

def top_customers(sales: DataFrame, n: int = 10) -> DataFrame:
    return (
        by(sales, "customer_name", "region", "segment")
        .agg(_sales(), _profit(), F.count("order_id").alias("orders"))
        .orderBy(F.desc("_s"), "customer_name", "region", "segment").limit(n)
        .select("customer_name", "region", "segment", amount("_s").alias("total_revenue"),
                amount("_p").alias("total_profit"), "orders")
    )


def customer_segments(sales: DataFrame) -> DataFrame:
    return (
        by(sales, "segment")
        .agg(_sales(), _profit(), F.count("order_id").alias("orders"),
             F.countDistinct("customer_id").alias("customers"))
        .select("segment", amount("_s").alias("revenue"), amount("_p").alias("profit"),
                "orders", "customers", _margin().alias("margin"),
                mean("_s", "orders", 0).alias("aov"),
                ratio("orders", "customers", 1).alias("orders_per_customer"))
        .orderBy("segment")
    )


def retention(sales: DataFrame, first_year: int = 2022, later_year: int = 2024) -> DataFrame:
    """All customers of the first year who ordered again in the later one."""
    return retained_customers(sales, first_year, later_year, limit=None)


def _product_lines(sales: DataFrame) -> DataFrame:
    return by(sales, "product_name", "category").agg(
        _sales(), _profit(), F.count("order_id").alias("orders"),
        sum_units("profit_margin").alias("_m"), F.count("profit_margin").alias("_k"))


def _product_columns() -> list:
    return ["product_name", "category", amount("_s").alias("total_sales"),
            amount("_p").alias("total_profit"), "orders", mean("_m", "_k").alias("avg_margin")]


def top_products(sales: DataFrame, n: int = 10) -> DataFrame:
    return (_product_lines(sales).orderBy(F.desc("_s"), "product_name", "category").limit(n)
            .select(*_product_columns()))


def bottom_products(sales: DataFrame, n: int = 10) -> DataFrame:
    return (
        by(sales, "product_name", "category")
        .agg(_profit(), _sales(), F.count("order_id").alias("orders"))
        .orderBy("_p", "product_name", "category").limit(n)
        .select("product_name", "category", amount("_p").alias("total_profit"),
                amount("_s").alias("total_sales"), "orders",
                F.when(F.col("_p") < 0, "[LOSS]").otherwise("").alias("flag"))
    )


def product_margin(sales: DataFrame, n: int = 10) -> DataFrame:
    return (
        _product_lines(sales).select(*_product_columns())
        .orderBy(F.desc("avg_margin"), "product_name", "category").limit(n)
    )


# ---- discounts -------------------------------------------------------------

def _band_lines(sales: DataFrame) -> DataFrame:
    return by(sales, "discount_band").agg(
        F.count("order_id").alias("orders"), sum_units("profit_margin").alias("_m"),
        F.count("profit_margin").alias("_k"), sum_units("profit").alias("_p"),
        F.count("profit").alias("_n"), _sales())


def discount_impact(sales: DataFrame) -> DataFrame:
    return (
        _band_lines(sales)
        .orderBy(bands.position("discount_band", bands.DISCOUNT_LABELS))
        .select("discount_band", "orders", mean("_m", "_k").alias("avg_margin"),
                mean("_p", "_n").alias("avg_profit"), amount("_s").alias("total_revenue"))
    )


def discount_impact_insight(sales: DataFrame) -> DataFrame:
    """How many margin points the highest band loses against no discount."""
    def margin_of(label: str):
        return F.max(F.when(F.col("discount_band") == label, mean("_m", "_k")))

    first, last = bands.DISCOUNT_LABELS[0], bands.DISCOUNT_LABELS[-1]
    return _band_lines(sales).agg(
        margin_of(first).alias("no_discount_margin"),
        margin_of(last).alias("very_high_margin")
    ).withColumn("margin_drop", F.col("no_discount_margin") - F.col("very_high_margin"))


# ---- time ------------------------------------------------------------------

def _year_lines(sales: DataFrame) -> DataFrame:
    return by(sales, "order_year").agg(_sales(), _profit(), F.count("order_id").alias("orders"))


def yearly_comparison(sales: DataFrame, year_1: int | None = None,
                      year_2: int | None = None) -> DataFrame:
    """One line per year; with two years given, also the change between them."""
    lines = _year_lines(sales)
    extra = []
    if year_1 is not None and year_2 is not None:
        one, two = (_over_all(F.max(F.when(F.col("order_year") == y, F.col("_s"))))
                    for y in (year_1, year_2))
        extra = [growth(two, one).alias("change_pct")]
    return (
        lines.select("order_year", amount("_s").alias("revenue"), amount("_p").alias("profit"),
                     "orders", _margin().alias("margin"), *extra)
        .orderBy("order_year")
    )


def yearly_comparison_insight(sales: DataFrame, year_1: int, year_2: int) -> DataFrame:
    """Best revenue year, and the change from one year to the other."""
    def of(year: int):
        return F.max(F.when(F.col("order_year") == year, F.col("_s")))

    return (
        _year_lines(sales)
        .agg(best_key("order_year", "_s").alias("best_year"),
             of(year_1).alias("_a"), of(year_2).alias("_b"))
        .select("best_year", F.lit(year_1).alias("year_1"), F.lit(year_2).alias("year_2"),
                growth("_b", "_a").alias("change_pct"))
    )


def _quarter_lines(sales: DataFrame) -> DataFrame:
    cells = by(sales, "order_year", "order_quarter").agg(_sales())
    return cells.groupBy("order_year").pivot("order_quarter", [1, 2, 3, 4]).sum("_s")


def quarterly(sales: DataFrame) -> DataFrame:
    """Year by quarter; a quarter without orders counts 0."""
    lines = _quarter_lines(sales).fillna(0, subset=["1", "2", "3", "4"])
    change = F.when(F.col("1") > 0, growth("4", "1"))
    return (
        lines.select("order_year", *[amount(str(q)).alias(f"Q{q}") for q in (1, 2, 3, 4)],
                     change.alias("q4_vs_q1_pct"))
        .orderBy("order_year")
    )


def quarterly_insight(sales: DataFrame) -> DataFrame:
    """Mean fourth and first quarter over the years that have one."""
    found = _quarter_lines(sales).agg(
        F.sum("4").alias("_4"), F.count("4").alias("_n4"),
        F.sum("1").alias("_1"), F.count("1").alias("_n1"))
    q4, q1 = mean("_4", "_n4"), mean("_1", "_n1")
    return (found.select(q4.alias("q4_avg"), q1.alias("q1_avg"))
            .withColumn("higher_pct", F.try_divide(
                (F.col("q4_avg") - F.col("q1_avg")) * F.lit(100.0), F.col("q1_avg"))))


# ---- places and shipping ---------------------------------------------------

def city_analysis(sales: DataFrame, n: int = 15) -> DataFrame:
    return (
        by(sales, "city", "region")
        .agg(_sales(), F.count("order_id").alias("orders"),
             F.countDistinct("customer_id").alias("customers"))
        .orderBy(F.desc("_s"), "city", "region").limit(n)
        .select("city", "region", amount("_s").alias("revenue"), "orders", "customers")
    )


def _average_rank(value: str):
    """Rank, highest first; equal values share the mean place, cut to an integer."""
    place = F.rank().over(W.orderBy(F.desc(value)))
    equal = F.count("*").over(W.partitionBy(value))
    return F.floor(place + (equal - 1) / 2).cast("int")


def region_scorecard(sales: DataFrame) -> DataFrame:
    return (
        by(sales, "region")
        .agg(_sales(), _profit(), F.count("order_id").alias("orders"),
             F.countDistinct("customer_id").alias("customers"), F.count("sales").alias("_n"))
        .select("region", amount("_s").alias("revenue"), amount("_p").alias("profit"),
                "orders", "customers", mean("_s", "_n").alias("aov"), _margin().alias("margin"))
        .withColumn("rev_rank", _average_rank("revenue"))
        .withColumn("mgn_rank", _average_rank("margin"))
        .orderBy(F.desc("revenue"), "region")
    )


def _mode_lines(sales: DataFrame) -> DataFrame:
    return (
        by(sales, "ship_mode")
        .agg(F.count("order_id").alias("orders"), F.avg("days_to_ship").alias("avg_days"),
             _sales())
        .withColumn("share", percent(F.col("orders"), _over_all(F.sum("orders")), 1))
    )


def shipping(sales: DataFrame) -> DataFrame:
    return (
        _mode_lines(sales)
        .select("ship_mode", "orders", "avg_days", amount("_s").alias("revenue"), "share")
        .orderBy(F.desc("orders"), "ship_mode")
    )


def shipping_insight(sales: DataFrame) -> DataFrame:
    return _mode_lines(sales).agg(
        best_key("ship_mode", "orders").alias("most_used"),
        F.max("share").alias("most_used_share"),
        worst_key("ship_mode", "avg_days").alias("fastest"))


# ---- overview --------------------------------------------------------------

# What orders are grouped by first, and the sides read off those groups.
_GROUPS = (("customer_id", "customer_name", "region"), ("product_name", "category"),
           ("order_year",))
_SIDES = tuple(side for group in _GROUPS for side in group)


def _set_id(columns: tuple[str, ...]) -> int:
    """``grouping_id`` of a grouping set over all sides: a bit per absent side."""
    return sum(1 << (len(_SIDES) - 1 - i) for i, s in enumerate(_SIDES) if s not in columns)


def _side_totals(sales: DataFrame) -> DataFrame:
    """Totals overall and per side, told apart by ``_set``.

    The orders are multiplied three times only, once per group; the sides are
    then totalled from those much smaller groups. The overall figures come
    from the groups by year, which hold every order once.
    """
    cases = {"": F.lit(True), "_plain": F.col("discount") == 0,
             "_steep": F.col("discount") > 0.3}
    amounts = {"_rows": F.lit(1), "_s": units("sales"), "_p": units("profit"),
               "_q4": F.when(F.col("order_quarter") == 4, units("sales"))}
    for name, case in cases.items():
        amounts[f"_m{name}"] = F.when(case, units("profit_margin"))
        amounts[f"_k{name}"] = F.when(case & F.col("profit_margin").isNotNull(), 1)
    sides = [F.col(s) for s in _SIDES]
    groups = (
        sales.select(*_SIDES, *[a.alias(n) for n, a in amounts.items()])
        .groupingSets([[F.col(s) for s in group] for group in _GROUPS], *sides)
        .agg(*[F.sum(n).alias(n) for n in amounts], F.grouping_id().alias("_group"))
    )
    by_year = F.col("_group") == _set_id(("order_year",))
    return (
        groups.groupingSets([[]] + [[s] for s in sides], *sides)
        .agg(*[F.sum(n).alias(n) for n in ("_s", "_m", "_k")],
             *[F.sum(F.when(by_year, F.col(n))).alias(f"_all{n}") for n in amounts],
             F.grouping_id().alias("_set"))
    )


def summary(sales: DataFrame, category: str = "Electronics", region: str = "West",
            top: int = 20) -> DataFrame:
    """One row of headline figures from one pass over the orders.

    Customers and products are counted as groups, not as distinct values.
    """
    # Written: the leaders and the figures both come from it.
    totals = written(_side_totals(sales).fillna(0, subset=["_s", "_all_s", "_all_p", "_all_q4"]), "side-totals")
    whole = _set_id(())
    set_of = {side: _set_id((side,)) for side in _SIDES}

    def is_side(side: str):
        return (F.col("_set") == set_of[side]) & F.col(side).isNotNull()

    def overall(name: str):
        return F.max(F.when(F.col("_set") == whole, F.col(f"_all{name}")))

    def best(side: str):
        return F.min_by(side, F.when(is_side(side), F.struct(-F.col("_s"), F.col(side))))

    def of(side: str, key: str, name: str):
        return F.max(F.when(is_side(side) & (F.col(side) == key), F.col(name)))

    leaders = (totals.where(is_side("customer_name")).orderBy(F.desc("_s")).limit(top)
               .agg(F.sum("_s")).scalar())
    found = totals.agg(
        *[overall(n).alias(n) for n in ("_s", "_p", "_rows", "_q4", "_m_plain", "_k_plain",
                                        "_m_steep", "_k_steep")],
        F.count_if(is_side("customer_id")).alias("unique_customers"),
        F.count_if(is_side("product_name")).alias("products"),
        best("region").alias("best_region"), best("category").alias("best_category"),
        best("order_year").alias("best_year"), best("customer_name").alias("top_customer"),
        F.coalesce(of("category", category, "_s"), F.lit(0).cast("long")).alias("_cat_s"),
        of("category", category, "_m").alias("_cat_m"),
        of("category", category, "_k").alias("_cat_k"),
        of("region", region, "_m").alias("_reg_m"), of("region", region, "_k").alias("_reg_k"),
    )
    return found.select(
        amount("_s").alias("total_revenue"), amount("_p").alias("total_profit"),
        _margin(None).alias("overall_margin"), F.col("_rows").alias("total_orders"),
        "unique_customers", "products", "best_region", "best_category", "best_year",
        "top_customer", percent("_cat_s", "_s").alias("category_share"),
        mean("_cat_m", "_cat_k").alias("category_margin"),
        percent("_q4", "_s").alias("q4_share"),
        mean("_m_plain", "_k_plain").alias("no_discount_margin"),
        mean("_m_steep", "_k_steep").alias("steep_discount_margin"),
        mean("_reg_m", "_reg_k").alias("region_margin"),
        percent(leaders, F.col("_s")).alias("top_customers_share"),
    )


# ---- from a question to its report ----------------------------------------

def topics_table(spark: SparkSession) -> DataFrame:
    """What can be asked: every topic with the words that select it."""
    return spark.createDataFrame([(t, list(w)) for t, w in questions.TOPICS.items()],
                                 "intent string, keywords array<string>")


REPORTS: dict[str, Callable[..., DataFrame]] = {
    "revenue_by_region": revenue_by_region,
    "revenue_by_category": revenue_by_category,
    "revenue_trend": revenue_trend,
    "total_revenue": total_revenue,
    "profit_by_category": profit_by_category,
    "profit_by_region": profit_by_region,
    "profit_overall": total_profit,
    "top_customers": top_customers,
    "customer_segments": customer_segments,
    "customer_retention": retention,
    "top_products": top_products,
    "bottom_products": bottom_products,
    "product_margin": product_margin,
    "discount_impact": discount_impact,
    "yearly_comparison": yearly_comparison,
    "quarterly": quarterly,
    "city_analysis": city_analysis,
    "region_scorecard": region_scorecard,
    "shipping": shipping,
    "summary": summary,
}
COUNTED = ("top_customers", "top_products", "product_margin")
MOST_LINES = 2**31 - 1


def report(intent: str, sales: DataFrame, **parameters) -> DataFrame:
    """The report of a topic; help and unknown topics list what can be asked."""
    if intent not in REPORTS:
        return topics_table(sales.sparkSession)
    return REPORTS[intent](sales, **parameters)


def ask(sales: DataFrame, question: str) -> DataFrame:
    """Answer one question. Only the question itself is read on the driver."""
    read = (
        questions.tag(sales.sparkSession.createDataFrame([(question,)], "text string"))
        .select("intent", questions.top_n().alias("n"),
                *[y.alias(f"y{i}") for i, y in enumerate(questions.year_pair(), 1)])
        .first()
    )
    if read.intent in COUNTED:
        # A report cannot have more lines than an INT counts.
        return report(read.intent, sales, n=min(read.n, MOST_LINES))
    if read.intent == "yearly_comparison":
        return report(read.intent, sales, year_1=read.y1, year_2=read.y2)
    return report(read.intent, sales)
