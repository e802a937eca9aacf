from __future__ import annotations

import datetime as dt
import math

import pytest
from conftest import values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillsight.functions import bands, labels
from tillsight.functions.exact import amount, mean, ratio, sum_units
from tillsight.operators import features, pricing


def column(spark, data, kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")


def apply(spark, data, expression):
    return [r[0] for r in column(spark, data).orderBy("i").select(expression).collect()]


NONE, LOW, MED, HIGH, VERY = bands.DISCOUNT_LABELS
DISCOUNTS = [None, math.nan, -0.01, -0.005, 0.0, 0.05, 0.10, 0.1000001, 0.20, 0.30, 0.31, 1.0, 1.01]


def test_discount_band_edges(spark):
    assert apply(spark, DISCOUNTS, bands.discount_band("v")) == [
        None, None, None, NONE, NONE, LOW, LOW, MED, MED, HIGH, VERY, VERY, None]


def test_case_band_catches_everything(spark):
    assert apply(spark, DISCOUNTS, bands.discount_band_case("v")) == [
        VERY, VERY, LOW, LOW, NONE, LOW, LOW, MED, MED, HIGH, VERY, VERY, VERY]


def test_sales_band_edges(spark):
    data = [None, math.nan, -1.0, 0.0, 2000.0, 2000.01, 10000.0, 30000.0, 100000.0, 100000.01]
    assert apply(spark, data, bands.sales_band("v")) == [
        None, None, None, None, "< 2K", "2K-10K", "2K-10K", "10K-30K", "30K-1L", "> 1L"]


def test_tier_edges_and_own_limits(spark):
    data = [0.0, 50000.0, 50000.01, 150000.0, 300000.0, 300000.01]
    assert apply(spark, data, bands.customer_tier("v")) == [
        None, "Bronze", "Silver", "Silver", "Gold", "Platinum"]
    assert apply(spark, [5.0, 15.0], bands.customer_tier("v", (0, 10, 20, 30, None))) == [
        "Bronze", "Silver"]


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.sampled_from([-0.01, 0.0, 0.1, 0.2, 0.3, 1.0]),
                          st.floats(-0.5, 1.5)), min_size=1, max_size=40))
def test_bands_are_right_closed_intervals(spark, data):
    def expected(v):
        for low, high, label in zip(bands.DISCOUNT_LIMITS, bands.DISCOUNT_LIMITS[1:],
                                    bands.DISCOUNT_LABELS):
            if low < v <= high:
                return label
        return None
    assert apply(spark, data, bands.discount_band("v")) == [expected(v) for v in data]


def test_band_position(spark):
    got = column(spark, ["High (21-30%)", "No Discount", "other", None], "string") \
        .orderBy("i").select(bands.position("v", bands.DISCOUNT_LABELS)).collect()
    assert [r[0] for r in got] == [4, 1, None, None]


def test_amount_labels(spark):
    data = [-5.0, 0.0, 999.0, 1e3, 99_949.0, 1e5, 1e7, 64_810_200.0, -250_000.0]
    assert apply(spark, data, labels.amount_label("v")) == [
        "Rs.-5", "Rs.0", "Rs.999", "Rs.1.0K", "Rs.99.9K", "Rs.1.0 L", "Rs.1.00 Cr",
        "Rs.6.48 Cr", "Rs.-250000"]


def test_percent_labels(spark):
    assert apply(spark, [12.34, -0.5, 100.0], labels.percent_label("v")) == [
        "12.3%", "-0.5%", "100.0%"]
    assert apply(spark, [0.2151], labels.fraction_label("v")) == ["21.5%"]


def test_profit_flag_and_status(prepared):
    frame = prepared({"profit": 1.0}, {"profit": 0.0}, {"profit": -1.0}, {"profit": None},
                     {"profit": math.nan})
    assert [r.is_profitable for r in frame.orderBy("order_id").collect()] == [
        True, False, False, False, False]
    status = frame.where("profit is null or not isnan(profit)") \
        .orderBy("order_id").select(labels.profit_status())
    assert [r[0] for r in status.collect()] == ["Profitable", "Loss", "Loss", "Loss"]


def test_date_parts(prepared):
    row = prepared({"order_date": dt.date(2024, 2, 29), "ship_date": dt.date(2024, 3, 2)}).first()
    assert (row.order_year, row.order_month, row.order_quarter, row.order_month_name,
            row.order_year_month, row.days_to_ship) == (2024, 2, 1, "Feb", "2024-02", 2)


def test_missing_ship_date_gives_no_days(prepared):
    assert prepared({"ship_date": None}).first().days_to_ship is None


@pytest.mark.parametrize("heavy", [1, 10_000])
@pytest.mark.parametrize("limit", ["-1", "10485760"])
def test_customer_value_with_hot_and_missing_customers(spark, orders, heavy, limit):
    """A third of the rows on one customer, some without any, on both join plans."""
    from tillsight.operators.lookup import attach
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        frame = orders(*([{"customer_id": "hot", "sales": 1.1}] * 40
                         + [{"customer_id": f"c{i % 20}", "sales": 2.0} for i in range(60)]
                         + [{"customer_id": None, "sales": 9.0}] * 5))
        valued = attach(frame, features.customer_value(frame), "customer_id", "customer_ltv",
                        "customer_rows", F.col("order_id"), heavy_keys=heavy)
        got = valued.groupBy("customer_id").agg(
            F.count("*"), F.min("customer_ltv"), F.max("customer_ltv"))
        result = {r[0]: tuple(r)[1:] for r in got.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert result.pop("hot") == (40, 44.0, 44.0)
    assert result.pop(None) == (5, None, None)
    assert result == {f"c{i}": (3, 6.0, 6.0) for i in range(20)}


def test_full_table_has_28_columns(orders):
    full = features.with_features(orders({"sales": 60000.0}, {"sales": 50.0, "customer_id": "C-2"}))
    assert len(full.columns) == 28
    assert {r.customer_id: r.customer_tier for r in full.collect()} == {"C-1": "Silver",
                                                                        "C-2": "Bronze"}


def test_pricing(orders):
    frame = orders({"unit_price": 99.99, "quantity": 3, "discount": 0.15, "region": "West"},
                   {"unit_price": 0.0, "region": "West"}, {"region": "Nowhere"})
    priced = pricing.price_lines(frame, F.lit(0.4)).orderBy("order_id").collect()
    # 99.99*3*0.85 = 254.9745; *0.4*(1-0.27) = 74.4524; *1.1 = 81.895
    assert (priced[0].sales, priced[0].profit, priced[0].profit_margin) == (254.97, 81.90, 32.12)
    assert (priced[1].sales, priced[1].profit, priced[1].profit_margin) == (0.0, 0.0, 0.0)
    assert priced[2].profit is None


def test_exact_totals_and_rounding(spark):
    frame = column(spark, [0.1, 0.2, 0.2, None, -0.35, 0.35])
    row = frame.agg(sum_units("v").alias("u"), F.count("v").alias("n")).select(
        amount("u"), amount("u", 0), mean("u", "n", 2), ratio("u", F.lit(0)),
        ratio(F.lit(25), F.lit(1000), 2), ratio(F.lit(-25), F.lit(1000), 2)).first()
    assert tuple(row) == (0.5, 1.0, 0.1, None, 0.03, -0.03)
    assert column(spark, [None]).agg(sum_units("v")).first()[0] is None
