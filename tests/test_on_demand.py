"""A star and cells whose tables are made when a report asks for them."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from tillsight.operators import features, quality
from tillsight.plans import cells, dashboard, measures, periods, star
from tillsight.sources import workspace

SLICE = {"year": 2022, "region": "West", "category": "K1"}


@pytest.fixture(scope="module")
def full(orders):
    """Orders of one line, of several lines in one cell, and across cells; some without an id."""
    draw = random.Random(11)
    rows = []
    for k in range(600):
        day = dt.date(draw.choice([2022, 2023]), draw.randint(1, 12), draw.randint(1, 28))
        rows.append({
            "order_id": None if k % 71 == 0 else f"O{k if k % 3 else draw.randint(1, 90)}", "order_date": day, "ship_date": day,
            "customer_id": None if k % 89 == 0 else f"C{k % 40}", "customer_name": f"N{k % 30}", "segment": f"S{k % 40 % 3}",
            "region": draw.choice(["East", "West"]), "city": f"T{k % 5}", "category": f"K{k % 9 % 3}", "product_name": f"P{k % 9}",
            "discount": draw.choice([0.0, 0.15, 0.25]), "sales": draw.randint(1, 99999) / 100, "profit": draw.randint(-999, 999) / 100})
    # One order of three lines in one cell, two of them with a high discount.
    rows += [{"order_id": "whole", "order_date": dt.date(2022, 5, 5), "ship_date": dt.date(2022, 5, 5), "region": "West",
              "city": "T1", "category": "K1", "product_name": "P1", "discount": d} for d in (0.25, 0.35, 0.0)]
    return features.with_features(orders(*rows), (0, 3000, 6000, 9000, None))


@pytest.fixture(scope="module")
def written_star(spark, full):
    return star.write_star(full, workspace.new_path(spark, "star"))


@pytest.fixture
def lazy(written_star):
    """(star on demand, the names asked for)"""
    asked = []

    def table(name):
        asked.append(name)
        return getattr(written_star, name)

    return star.StarOnDemand(table), asked


def test_only_the_tables_that_a_report_names_are_made(lazy):
    own, asked = lazy
    dashboard.kpis(own).collect()
    assert set(asked) == {"fact_sales"}
    dashboard.region_donut(own).collect()
    assert set(asked) == {"fact_sales", "dim_geography"}
    periods.period_measures(own, {"year": 2022, "week": 9}, ["region"]).collect()
    assert "dim_customer" not in asked and "dim_product" not in asked


def test_a_page_makes_one_level_and_gives_the_figures_of_the_facts(spark, written_star, lazy):
    own, _ = lazy
    paths = {}

    def make(level):
        if level not in paths:
            paths[level] = workspace.new_path(spark, level)
            cells.write_level(own, level, paths[level])
        return paths[level]

    prepared = cells.with_cells(own, cells.on_demand(make))
    wanted = [("kpis", "by_band"), ("region_donut", "by_band"), ("city_map", "by_city"), ("trend", "by_month"),
              ("segment_donut", "by_segment"), ("product_table", "by_product"), ("tier_matrix", "by_customer"),
              ("discount_combo", "by_band"), ("region_aov", "by_band")]
    for name, level in wanted:
        for where in (SLICE, {"year": 2022}, {}):
            visual = getattr(dashboard, name)
            assert values(visual(prepared, where=where)) == values(visual(written_star, where=where)), (name, where)
        assert level in paths, name
    assert set(paths) == {level for _, level in wanted}
    every = list(measures.MEASURES)
    assert str(measures.evaluate(prepared, every, ["customer_tier"], SLICE).orderBy("customer_tier").collect()) == str(
        measures.evaluate(written_star, every, ["customer_tier"], SLICE).orderBy("customer_tier").collect())


def test_orders_of_one_line_are_counted_where_they_lie_and_others_once(written_star):
    repeated = cells.repeated_lines(written_star)
    counted, crossing = cells._cells(written_star, "by_band", repeated)
    lines = written_star.fact_sales.where("order_id IS NOT NULL").groupBy("order_id").agg(F.count("*").alias("n"))
    many = lines.where("n > 1").agg(F.sum("n").alias("n")).first().n
    assert repeated.count() == many
    total = counted.agg(F.sum(cells._ORDERS).alias("n")).first().n + crossing.select("order_id").distinct().count()
    assert total == lines.count()
    assert counted.where(F.col(cells._ORDERS) < 0).isEmpty() and counted.where(F.col(cells._HIGH) < 0).isEmpty()


def test_a_report_looks_up_only_the_keys_it_names(full, written_star):
    """Facts that are read once are planned with the keys of the report; the table of facts is not made."""
    asked, planned = [], []

    def table(name):
        asked.append(name)
        return getattr(written_star, name)

    def lines(keys, columns):
        planned.append(set(keys))
        return star.with_order_year(star.fact_sales(
            full, table("dim_product") if "product_id" in keys else None, table("dim_geography") if "geo_id" in keys else None))

    own = star.StarOnDemand(table, lines=lines)
    for visual, where, dims in ((dashboard.kpis, {}, set()), (dashboard.trend, {"year": 2022}, {"dim_date"}),
                                (dashboard.category_margin, {}, {"dim_product"}), (dashboard.region_aov, {}, {"dim_geography"}),
                                (dashboard.segment_donut, SLICE, {"dim_customer", "dim_product", "dim_geography", "dim_date"})):
        asked.clear()
        assert values(visual(own, where=where)) == values(visual(written_star, where=where)), visual
        assert set(asked) == dims
    for period in ({"year": 2022, "week": 9}, {"year": 2022}):
        assert values(periods.period_measures(own, period, ["region"])) == values(
            periods.period_measures(written_star, period, ["region"]))
    assert set() in planned and {"product_id"} in planned and {"geo_id"} in planned and "fact_sales" not in asked

    def joins(frame):
        return frame._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter")

    # The product's number and its category are looked up, no place.
    assert joins(measures.evaluate(own, ["total_revenue"], ["category"])) == joins(full) + 2


def test_a_page_without_counts_makes_sums_only(spark, written_star, lazy):
    own, _ = lazy
    made = {"all": [], "sums": []}

    def maker(kind, write):
        def make(level):
            path = workspace.new_path(spark, level)
            made[kind].append(level)
            write(own, level, path)
            return path
        return make

    prepared = cells.with_cells(own, cells.on_demand(maker("all", cells.write_level), maker("sums", cells.write_sums)))
    for name in ("segment_donut", "region_donut", "trend", "city_map", "product_table", "top_customers", "category_margin"):
        for where in (SLICE, {}):
            assert values(getattr(dashboard, name)(prepared, where=where)) == values(
                getattr(dashboard, name)(written_star, where=where)), (name, where)
    assert not made["all"]
    sums = len(made["sums"])
    for name in ("kpis", "region_aov", "tier_matrix"):
        assert values(getattr(dashboard, name)(prepared, where=SLICE)) == values(getattr(dashboard, name)(written_star, where=SLICE))
    assert len(made["sums"]) == sums and made["all"]


def test_facts_do_not_move_for_their_layout(spark, full, written_star, tmp_path):
    """The only shuffle a fact row may see is that of a lookup: the layout by year is made in its task."""
    rows = star.fact_sales(full, written_star.dim_product, written_star.dim_geography)
    back = star.write_table("fact_sales", rows.coalesce(1), str(tmp_path / "facts"))
    files = {f.rsplit("/", 2)[-2] for f in back.inputFiles()}
    assert files == {"order_year=2022", "order_year=2023"} and len(back.inputFiles()) == 2
    assert back.count() == full.count()


def test_repeated_rows_are_dropped_in_one_exchange_and_nothing_is_written(spark, tmp_path):
    frame = spark.createDataFrame([(k % 50, f"t{k % 3}", None) for k in range(400)], "a int, b string, c double")
    frame.write.parquet(str(tmp_path / "rows"))
    before = workspace.run_folder(spark)
    names = set(os.listdir(before)) if os.path.isdir(before) else set()
    found = quality.drop_duplicates(spark.read.parquet(str(tmp_path / "rows")))
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert found.count() == frame.distinct().count() == 150
    assert (set(os.listdir(before)) if os.path.isdir(before) else set()) == names
