from __future__ import annotations

import datetime as dt

import pytest
from conftest import values
from pyspark.sql import functions as F

from tillsight.operators import features, ranking
from tillsight.plans import dashboard, measures, star
from tillsight.sources import workspace


def on(day, **more):
    return {"order_date": dt.date.fromisoformat(day), "ship_date": dt.date.fromisoformat(day), **more}


@pytest.fixture(scope="module")
def build(spark, orders):
    def make(*changes):
        full = features.with_features(orders(*changes))
        return star.write_star(full, workspace.new_path(spark, "star"))
    return make


@pytest.fixture(scope="module")
def small(build):
    """Five orders, one month missing, one order split over two lines."""
    return build(
        on("2022-01-10", order_id="A", customer_id="1", customer_name="Ann", sales=100.0, profit=10.0,
           discount=0.25),
        on("2022-01-11", order_id="A", customer_id="1", customer_name="Ann", sales=50.0, profit=5.0),
        on("2022-03-01", order_id="B", customer_id="2", customer_name="Ann", sales=300.0, profit=60.0,
           region="West", city="Pune", segment="Corporate"),
        on("2023-01-05", order_id="C", customer_id="3", customer_name="Bob", sales=450.0, profit=-45.0,
           product_name="Pen", category="Office", discount=0.20),
        on("2023-02-05", order_id="D", customer_id="3", customer_name="Bob", sales=100.0, profit=20.0,
           quantity=4))


def test_dimensions(small):
    assert sorted(values(small.dim_geography)) == [("GEO-001", "North", "Delhi", 4),
                                                   ("GEO-002", "West", "Pune", 1)]
    assert sorted(values(small.dim_product)) == [("PROD-001", "Atlas", "Books", 100.0),
                                                 ("PROD-002", "Pen", "Office", 100.0)]
    customers = {r.customer_id: r for r in small.dim_customer.collect()}
    assert len(customers) == 3
    assert (customers["3"].customer_ltv, customers["3"].customer_tier,
            customers["3"].total_orders) == (550.0, "Bronze", 2)


def test_customer_takes_its_earliest_present_attributes(build):
    got = build(on("2022-05-01", region="West", city=None), on("2022-06-01", region="North", city="Delhi"),
                on("2022-06-01", region="East", city="Agra"))
    row = got.dim_customer.first()
    assert (row.home_region, row.home_city, row.total_orders) == ("West", "Agra", 3)


def test_numbers_beyond_three_digits_are_not_cut(spark, orders):
    frame = orders(*[{"product_name": f"p{i:05d}"} for i in range(1005)])
    ids = [r.product_id for r in star.dim_product(frame).orderBy("product_name").collect()]
    assert (ids[0], ids[998], ids[999], ids[1004]) == ("PROD-001", "PROD-999", "PROD-1000", "PROD-1005")
    assert len(set(ids)) == 1005


def test_calendar(spark, orders):
    days = {r.date: r for r in star.dim_date(orders(on("2024-02-27"), on("2024-12-31"))).collect()}
    assert len(days) == 309
    leap, last = days[dt.date(2024, 2, 29)], days[dt.date(2024, 12, 30)]
    assert (leap.date_key, leap.day_name, leap.quarter_name, leap.is_weekend) == (
        20240229, "Thursday", "Q1", False)
    assert (last.week, last.is_festive_q, last.month_name, last.month_short) == (
        1, True, "December", "Dec")
    assert days[dt.date(2024, 3, 2)].is_weekend and days[dt.date(2024, 3, 3)].is_weekend
    assert star.dim_date(orders({}).limit(0)).count() == 0


def test_facts_keep_every_order(build):
    got = build(on("2022-01-01"), on("2022-01-02", product_name=None, city=None))
    facts = got.fact_sales.orderBy("date_key").collect()
    assert [f.product_id for f in facts] == ["PROD-001", None]
    assert [f.geo_id for f in facts] == ["GEO-001", None]
    assert got.fact_sales.columns == [*star.FACT_COLUMNS, "order_year"]
    assert values(measures.evaluate(got, ["total_revenue"])) == [(200.0,)]


def test_measures(small):
    names = ["total_revenue", "total_profit", "total_quantity", "total_orders", "total_customers",
             "avg_order_value", "profit_margin", "avg_discount", "revenue_cr", "profit_l",
             "profit_margin_label", "high_discount_orders", "high_discount_pct"]
    row = measures.evaluate(small, names).first()
    assert tuple(row) == (1000.0, 50.0, 8, 4, 3, 250.0, 0.05, 0.09, 0.0001, 0.0005, "5.0%", 1, 0.25)


def test_measures_by_several_dimensions(small):
    got = measures.evaluate(small, ["total_revenue", "total_orders", "total_customers"],
                            by=["region", "year"])
    assert sorted(values(got)) == [("North", 2022, 150.0, 1, 1), ("North", 2023, 550.0, 2, 1),
                                   ("West", 2022, 300.0, 1, 1)]


def test_filters(small):
    assert values(dashboard.kpis(small, {"year": 2022})) == [(450.0, 75.0, 75 / 450, 2)]
    got = dashboard.segment_donut(small, where=dashboard.slice_of(2022, "West", "Books"))
    assert values(got) == [("Corporate", 300.0)]
    some = measures.evaluate(small, ["total_revenue"], where={"city": ["Delhi", "Pune"],
                                                              "discount_band": "No Discount"})
    assert values(some) == [(450.0,)]
    assert values(measures.evaluate(small, ["total_orders", "avg_order_value"],
                                    where={"year": 1999})) == [(0, 0.0)]


def test_unknown_names_are_refused(small):
    with pytest.raises(ValueError, match="unknown attribute"):
        measures.evaluate(small, ["total_revenue"], by=["colour"])
    with pytest.raises(KeyError):
        measures.evaluate(small, ["no such measure"])


def test_time_is_calendar_true(small):
    got = {r.year_month: r for r in measures.time_measures(small).collect()}
    assert len(got) == 14
    march, gap, jan = got["2022-03"], got["2022-02"], got["2023-01"]
    # February has no orders: March's previous month is empty, not January.
    assert gap.total_revenue is None and gap.revenue_mom == -1.0 and gap.revenue_ytd == 150.0
    assert (march.revenue_prev_month, march.revenue_mom) == (None, 0.0)
    assert (march.revenue_ytd, march.rolling_3m) == (450.0, 450.0)
    assert (jan.revenue_prev_year, jan.revenue_yoy, jan.revenue_ytd) == (150.0, 2.0, 450.0)
    assert got["2022-01"].revenue_yoy == 0.0
    assert got["2022-12"].revenue_ytd == 450.0 and got["2022-12"].rolling_3m is None


def test_ranks_merge_names_and_are_dense(small):
    assert sorted(values(measures.customer_rank(small))) == [("Ann", 450.0, 2), ("Bob", 550.0, 1)]
    assert [r.region_rank for r in measures.region_rank(small).orderBy("region").collect()] == [1, 2]


def test_top_customers_share(small):
    assert values(measures.top_customer_share(small, 1)) == [(550.0, 0.55)]


def test_segments(small):
    assert values(measures.segment_revenue(small)) == [(700.0, 300.0, None)]


def test_dashboard_tables(small):
    assert values(dashboard.discount_combo(small)) == [
        ("No Discount", 3, 85 / 450), ("Medium (11-20%)", 1, -0.1), ("High (21-30%)", 1, 0.1)]
    assert values(dashboard.tier_matrix(small)) == [("Bronze", 3, 1000.0, 250.0)]
    assert values(dashboard.drill_category(small, "Office")) == [
        ("Pen", "Office", 450.0, -45.0, -0.1, 1)]
    assert [r.region for r in dashboard.region_matrix(small).collect()] == ["North", "West"]
    assert values(dashboard.region_aov(small)) == [("West", 300.0), ("North", 700 / 3)]
    for table in (dashboard.category_bar, dashboard.category_treemap, dashboard.region_donut,
                  dashboard.city_map, dashboard.segment_donut, dashboard.trend):
        assert sum(r[-1] for r in table(small).collect()) == pytest.approx(1000.0)


def test_numbering_over_many_partitions(spark):
    frame = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("x"))
    got = ranking.numbered(frame, "x", into="n").collect()
    assert sorted((r.x, r.n) for r in got) == [(i, i + 1) for i in range(5000)]


def test_dense_rank_with_a_hot_value_equals_a_window(spark):
    frame = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 5.0).when(F.col("id") % 1000 == 1, None)
        .otherwise((F.col("id") % 97).cast("double")).alias("v"))
    got = {r.id: r["rank"] for r in ranking.dense_ranked(frame, "v").collect()}
    order = sorted({r.v for r in frame.collect() if r.v is not None}, reverse=True)
    assert len(got) == 3000
    for r in frame.collect():
        assert got[r.id] == (order.index(r.v) + 1 if r.v is not None else None)


def test_top_keeps_ties(spark):
    frame = spark.createDataFrame([("a", 3.0), ("b", 2.0), ("c", 2.0), ("d", 1.0), ("e", None)],
                                  "k string, v double")
    assert [r.k for r in ranking.top_with_ties(frame, "v", 2, "k").collect()] == ["a", "b", "c"]
    assert [r.k for r in ranking.top_with_ties(frame, "v", 9, "k").collect()] == ["a", "b", "c", "d"]


def test_a_date_filter_does_not_hide_earlier_months(small):
    """Every measure looks back over all months; the filter picks the lines."""
    everything = {r.year_month: r for r in measures.time_measures(small).collect()}
    some = {r.year_month: r for r in measures.time_measures(small, {"year": 2023}).collect()}
    assert set(some) == {m for m in everything if m.startswith("2023")}
    assert all(some[m] == everything[m] for m in some) and some["2023-01"].revenue_prev_year == 150.0
    march = measures.time_measures(small, {"month": [3]}).collect()
    assert [r.year_month for r in march] == ["2022-03"] and march[0] == everything["2022-03"]
    with pytest.raises(ValueError, match="finer"):
        measures.time_measures(small, {"day": 1})


def test_time_by_region(small):
    for region in ("North", "West"):
        alone = measures.time_measures(small, {"region": region}).collect()
        among = [r for r in measures.time_measures(small, by=["region"]).collect() if r.region == region]
        assert [tuple(r)[1:] for r in among] == [tuple(r) for r in alone]


def test_ranks_and_shares_follow_the_filter(small):
    where = {"year": 2022, "region": "West"}
    assert [r.customer_rank for r in measures.customer_rank(small, where).collect()] == [1]
    assert measures.top_customer_share(small, 1, where).first().top20_contribution == 1.0
    assert values(measures.region_rank(small, where)) == [("West", 300.0, 1)]
    assert measures.segment_revenue(small, where=where).first().revenue_corporate == 300.0


def test_discounts_keep_their_decimals(orders, spark):
    from tillsight.plans.measures import _SUMS
    frame = orders({"discount": 0.125}, {"discount": 0.125})
    assert float(frame.agg(_SUMS["_discount"]().alias("d")).first().d) == 0.25


def test_money_with_more_decimals_is_refused(orders):
    from tillsight.functions.exact import sum_units
    assert orders({"sales": 0.29}, {"sales": 1e11 + 0.01}).agg(sum_units("sales").alias("u")).first().u == 10**13 + 30
    with pytest.raises(Exception, match="hundredths"):
        orders({"sales": 1.005}).agg(sum_units("sales")).collect()
