from __future__ import annotations

import datetime as dt
import math

import pytest
from conftest import values
from pyspark.sql import functions as F

from tillsight.operators.correlation import correlation_matrix
from tillsight.plans import answers, business, exploratory


def on(day, **more):
    return {"order_date": dt.date.fromisoformat(day), "ship_date": dt.date.fromisoformat(day), **more}


def test_sql_reports_keep_the_null_group_and_answers_drop_it(prepared):
    frame = prepared({"category": None, "sales": 5.0}, {"sales": 7.0})
    assert [r[0] for r in values(business.category_summary(frame))] == ["Books", None]
    assert [r[0] for r in values(answers.revenue_by_category(frame))] == ["Books"]


def test_zero_revenue_gives_no_margin(prepared):
    row = business.category_summary(prepared({"sales": 0.0, "profit": 0.0})).first()
    assert row.profit_margin_pct is None and row.total_revenue == 0.0


def test_three_margins_differ(prepared):
    frame = prepared({"sales": 100.0, "profit": 50.0, "profit_margin": 50.0},
                     {"sales": 900.0, "profit": 90.0, "profit_margin": 10.0})
    assert answers.product_margin(frame).first().avg_margin == 30.0
    assert business.category_summary(frame).first().profit_margin_pct == 14.0


def test_high_value_uses_the_unrounded_total(prepared):
    frame = prepared({"customer_id": "a", "sales": 200000.0}, {"customer_id": "b", "sales": 200000.01})
    assert business.high_value_customers(frame).count() == 1
    assert business.high_value_customers_short(frame).columns == [
        "customer_name", "region", "segment", "orders", "lifetime_value"]


def test_lag_skips_a_missing_month_and_first_is_dropped(prepared):
    frame = prepared(on("2022-01-05", sales=100.0), on("2022-03-05", sales=150.0))
    assert values(business.month_over_month(frame)) == [(2022, 3, 150.0, 100.0, 50.0)]
    assert values(business.month_over_month_short(frame))[0] == (2022, 1, 100.0, None, None)


def test_running_total_restarts_each_year(prepared):
    frame = prepared(on("2022-11-01", sales=1.0), on("2022-12-01", sales=2.0),
                     on("2023-01-01", sales=4.0))
    assert [r[-1] for r in values(business.running_total(frame))] == [1.0, 3.0, 4.0]
    assert [r[-1] for r in values(business.running_total_short(frame))] == [1.0, 3.0, 4.0]


def test_top_customers_keep_ties(prepared):
    frame = prepared(*[{"customer_id": c, "customer_name": c, "sales": s} for c, s in
                       [("a", 9.0), ("b", 9.0), ("c", 8.0), ("d", 7.0), ("e", 6.0)]])
    got = business.top_customers_by_region(frame)
    assert [(r.customer_name, r.region_rank) for r in got.collect()] == [
        ("a", 1), ("b", 1), ("c", 2), ("d", 3)]


def test_best_product_takes_the_first_name_on_a_tie(prepared):
    frame = prepared({"product_name": "Zed"}, {"product_name": "Abe"})
    assert [r.product_name for r in business.best_product_by_category(frame).collect()] == ["Abe"]


def test_discount_report_groups_by_the_case_band(prepared):
    frame = prepared({"discount": 0.35}, {"discount": None}, {"discount": 0.0})
    assert [(r.discount_band, r.orders) for r in business.discount_impact(frame).collect()] == [
        ("No Discount", 1), ("Very High (>30%)", 2)]


def test_segment_average_is_per_order(prepared):
    frame = prepared(*[{"customer_id": "a", "sales": 10.0}] * 4,
                     {"customer_id": "b", "customer_name": "Bob", "sales": 10.0})
    got = business.above_segment_average(frame).collect()
    assert [(r.customer_name, r.customer_revenue, r.segment_avg_order_value) for r in got] == [
        ("Ann", 40.0, 10.0)]


def test_scorecard_ranks_with_gaps_and_rounded_totals(prepared):
    frame = prepared({"region": "A", "sales": 10.4}, {"region": "B", "sales": 9.6},
                     {"region": "C", "sales": 5.0})
    got = {r.region: (r.total_revenue, r.revenue_rank) for r in
           business.regional_scorecard(frame).collect()}
    assert got == {"A": (10.0, 1), "B": (10.0, 1), "C": (5.0, 3)}


def test_retained_customers(prepared):
    frame = prepared(on("2022-01-01", customer_id="a", customer_name="A"),
                     on("2022-02-01", customer_id="a", customer_name="A"),
                     on("2024-01-01", customer_id="a", customer_name="A"),
                     on("2022-01-01", customer_id="b", customer_name="B"),
                     on("2024-01-01", customer_id="c", customer_name="C"),
                     on("2022-01-01", customer_id=None), on("2024-01-01", customer_id=None))
    assert [r.customer_name for r in business.retained_customers(frame).collect()] == ["A"]
    assert answers.retention(frame).count() == 1


def test_first_and_latest_order(prepared):
    frame = prepared(on("2022-01-01", order_id="1", sales=10.5),
                     on("2023-01-01", order_id="2", sales=99.0),
                     on("2023-01-01", order_id="3", sales=20.0))
    assert values(business.first_and_latest_order(frame)) == [("Ann", "North", 11.0, 20.0, 10.0)]


def test_quarter_pivot_without_first_quarter(prepared):
    row = business.quarterly_by_category(prepared(on("2022-10-01"))).first()
    assert (row.Q1, row.Q4, row.q4_vs_q1_growth_pct) == (0.0, 100.0, None)


def test_year_over_year_is_per_category(prepared):
    frame = prepared(on("2021-01-01", category="A"), on("2022-01-01", category="A", sales=150.0),
                     on("2022-01-01", category="B"))
    assert values(business.year_over_year(frame)) == [(2022, "A", 150.0, 100.0, 50.0)]


def test_all_five_bands_even_without_orders(prepared):
    got = values(exploratory.margin_by_band(prepared({"discount": 0.15})))
    assert [r[1] for r in got] == [None, None, 20.0, None, None]


def test_customers_who_share_a_name_are_merged_by_name_reports(prepared):
    frame = prepared({"customer_id": "1"}, {"customer_id": "2"})
    assert values(exploratory.top_customers(frame)) == [("Ann", 200.0)]
    assert business.top_customers_by_region(frame).count() == 2


def test_grids_leave_empty_cells_null(prepared):
    frame = prepared(on("2022-01-01"), on("2023-05-01", category="Toys"))
    assert values(exploratory.quarter_year_grid(frame, [2022, 2023])) == [
        (1, 100.0, None), (2, None, 100.0)]
    assert values(exploratory.year_category_grid(frame, ["Books", "Toys"])) == [
        (2022, 100.0, None), (2023, None, 100.0)]


def test_shares_add_up(prepared):
    frame = prepared({"region": "A", "sales": 75.0}, {"region": "B", "sales": 25.0})
    assert [r.share_pct for r in exploratory.region_share(frame).collect()] == [75.0, 25.0]


def test_correlation_is_pairwise_complete(spark):
    data = [(1.0, 2.0, 5.0, None), (2.0, None, 5.0, 1.0), (3.0, 5.0, 5.0, 4.0),
            (4.0, 9.0, 5.0, None), (math.nan, 1.0, 5.0, 2.0), (7.0, 8.0, 5.0, 3.0)]
    frame = spark.createDataFrame(data, "a double, b double, c double, d double")
    got = {(r.col_a, r.col_b): r.r for r in correlation_matrix(frame, list("abcd")).collect()}
    pandas = frame.toPandas().corr()
    assert len(got) == 16
    for (x, y), r in got.items():
        want = pandas.loc[x, y]
        assert (r is None) == math.isnan(want), (x, y)
        assert r is None or r == pytest.approx(want, abs=1e-12)


def test_correlation_far_from_zero(spark):
    frame = spark.range(1000).select((F.col("id") * 0.5 + 1e9).alias("a"),
                                     (F.lit(3e8) - F.col("id")).alias("b"),
                                     F.lit(0.1).alias("k"))
    got = {(r.col_a, r.col_b): r.r for r in correlation_matrix(frame, ["a", "b", "k"]).collect()}
    assert got["a", "b"] == pytest.approx(-1.0, abs=1e-9)
    assert got["a", "k"] is None and got["k", "k"] is None


def test_average_ranks_are_cut(prepared):
    frame = prepared({"region": "A"}, {"region": "B"}, {"region": "C", "sales": 1.0, "profit": 0.1})
    got = {r.region: (r.rev_rank, r.mgn_rank) for r in answers.region_scorecard(frame).collect()}
    assert got == {"A": (1, 1), "B": (1, 1), "C": (3, 3)}


def test_quarterly_fills_missing_quarters(prepared):
    frame = prepared(on("2022-01-01", sales=50.0), on("2022-12-01"), on("2023-12-01", sales=300.0))
    assert values(answers.quarterly(frame)) == [
        (2022, 50.0, 0.0, 0.0, 100.0, 100.0), (2023, 0.0, 0.0, 0.0, 300.0, None)]
    assert values(answers.quarterly_insight(frame)) == [(200.0, 50.0, 300.0)]


def test_trend_and_years(prepared):
    frame = prepared(on("2022-01-01", sales=50.0), on("2022-02-01", sales=100.0),
                     on("2023-02-01", sales=300.0))
    assert values(answers.revenue_trend(frame)) == [
        (2022, 1, "Jan", 50.0, 150.0, 4), (2022, 2, "Feb", 100.0, 150.0, 8),
        (2023, 2, "Feb", 300.0, 300.0, 25)]
    assert values(answers.revenue_trend_insight(frame)) == [(2022, 2023, 100.0)]
    assert values(answers.yearly_comparison_insight(frame, 2022, 2023)) == [
        (2023, 2022, 2023, 100.0)]
    assert answers.yearly_comparison_insight(frame, 2022, 2030).first().change_pct is None


def test_ties_pick_the_smallest_key(prepared):
    frame = prepared({"region": "B"}, {"region": "A"}, {"region": "C", "sales": 1.0})
    assert values(answers.revenue_by_region_insight(frame)) == [("A", 100.0, "C", 1.0, 99.0)]


def test_bottom_products_flag_losses(prepared):
    frame = prepared({"product_name": "x", "profit": -1.0}, {"product_name": "y"})
    assert [(r.product_name, r.flag) for r in answers.bottom_products(frame).collect()] == [
        ("x", "[LOSS]"), ("y", "")]


def test_summary_matches_separate_reports(prepared):
    frame = prepared(
        on("2022-11-01", customer_id="1", category="Electronics", sales=300.0, profit_margin=10.0),
        on("2023-01-01", customer_id="2", region="West", discount=0.35, profit_margin=5.0),
        on("2023-02-01", customer_id=None, customer_name="Bob", product_name="Pen", sales=50.0))
    row = answers.summary(frame, top=1).first()
    assert (row.total_revenue, row.total_orders, row.unique_customers, row.products) == (450.0, 3, 2, 2)
    assert (row.best_region, row.best_category, row.best_year, row.top_customer) == (
        "North", "Electronics", 2022, "Ann")
    assert row.category_share == pytest.approx(300 / 450 * 100)
    assert (row.category_margin, row.region_margin, row.steep_discount_margin) == (10.0, 5.0, 5.0)
    assert row.no_discount_margin == 15.0
    assert row.q4_share == pytest.approx(300 / 450 * 100)
    assert row.top_customers_share == pytest.approx(400 / 450 * 100)


def test_summary_of_unknown_names(prepared):
    row = answers.summary(prepared({}), category="none", region="none").first()
    assert (row.category_share, row.category_margin, row.region_margin) == (0.0, None, None)


def test_discount_insight(prepared):
    frame = prepared({"discount": 0.0, "profit_margin": 40.0}, {"discount": 0.4, "profit_margin": 14.0})
    assert values(answers.discount_impact_insight(frame)) == [(40.0, 14.0, 26.0)]
    assert [r.discount_band for r in answers.discount_impact(frame).collect()] == [
        "No Discount", "Very High (>30%)"]


def test_shipping(prepared):
    frame = prepared({"ship_mode": "slow"}, {"ship_mode": "slow"},
                     {"ship_mode": "fast", "ship_date": dt.date(2022, 1, 2)})
    assert values(answers.shipping(frame)) == [("slow", 2, 3.0, 200.0, 66.7),
                                               ("fast", 1, 1.0, 100.0, 33.3)]
    assert values(answers.shipping_insight(frame)) == [("slow", 66.7, "fast")]


@pytest.mark.parametrize("question, columns", [
    ("Which region has the highest revenue?", "region"),
    ("Show the top 5 customers by revenue", "customer_name"),
    ("Compare 2022 and 2023 revenue", "change_pct"),
    ("Most profitable products", "avg_margin"),
    ("Total profit for 2023", "best_year"),
    ("no idea at all", "keywords"),
    ("how to use this, help", "keywords"),
])
def test_ask(prepared, question, columns):
    frame = prepared(*[on(f"202{2 + i % 2}-01-01", customer_name=f"n{i}") for i in range(7)])
    got = answers.ask(frame, question)
    assert columns in got.columns
    if "top 5" in question:
        assert got.count() == 5


def test_every_topic_has_a_report(prepared):
    frame = prepared(*[on(f"202{y}-01-01") for y in (2, 4)])
    for topic in answers.REPORTS:
        assert answers.report(topic, frame).count() >= 1, topic


def test_grids_hold_every_year_and_category(prepared):
    frame = prepared({"order_date": dt.date(1971, 1, 5), "category": "Odd, new"}, {"category": None}, {})
    grid = exploratory.quarter_year_grid(frame)
    assert grid.columns == ["order_quarter", "1971", "2022"]
    cells = exploratory.grid_cells(exploratory.year_category_grid(frame), "category", "sales")
    assert sorted(values(cells)) == [(1971, "Odd, new", 100.0), (2022, "Books", 100.0)]
    assert exploratory.grid_cells(exploratory.quarter_year_grid(frame.where("false")), "order_year", "sales").count() == 0


@pytest.mark.parametrize("count", ["9999999999", "99999999999999999999999"])
def test_ask_for_very_many(prepared, count):
    frame = prepared({}, {"product_name": "Other"})
    assert answers.ask(frame, f"top {count} best product").count() == 2
