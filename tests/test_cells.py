"""Pages from cells against pages from the facts, sketches, and what a filter reads."""

from __future__ import annotations

import datetime as dt
import itertools
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tillsight.operators import features
from tillsight.plans import cells, dashboard, measures, star
from tillsight.sources import workspace

VISUALS = ["kpis", "trend", "category_bar", "category_treemap", "region_donut", "city_map", "region_compare", "region_matrix",
           "region_aov", "top_products", "category_margin", "product_table", "segment_donut", "top_customers",
           "discount_combo", "tier_matrix"]


@pytest.fixture(scope="module")
def model(spark, orders):
    """Orders that cross places, products, days and customers; some without an id, a customer or a place."""
    draw = random.Random(5)
    rows = []
    for k in range(900):
        day = dt.date(draw.choice([2022, 2023]), draw.randint(1, 12), draw.randint(1, 28))
        rows.append({
            "order_id": None if k % 97 == 0 else f"O{draw.randint(1, 500)}", "order_date": day, "ship_date": day,
            "customer_id": None if k % 89 == 0 else f"C{k % 60 if k % 3 else 0}", "customer_name": f"N{k % 50}",
            "segment": f"S{k % 60 % 3}", "region": draw.choice(["East", "West"]), "city": None if k % 83 == 0 else f"T{k % 7}",
            "category": f"K{k % 11 % 4}", "product_name": f"P{k % 11}", "discount": draw.choice([0.0, 0.05, 0.15, 0.25, 0.35]),
            "sales": draw.randint(1, 99999) / 100, "profit": draw.randint(-9999, 9999) / 100})
    full = features.with_features(orders(*rows), (0, 3000, 6000, 9000, None))
    folder = workspace.new_path(spark, "star")
    own = star.write_star(full, folder)
    return own, cells.with_cells(own, cells.write_cells(own, f"{folder}/cells"))


def filters():
    chosen = {"year": 2022, "region": "West", "category": "K1"}
    for n in (0, 1, 3):
        for names in itertools.combinations(chosen, n):
            yield {k: chosen[k] for k in names}


def unreadable(own):
    """The star with facts that stop whatever reads them."""
    return replace(own, fact_sales=own.fact_sales.select(*[
        F.raise_error(F.lit("the facts were read")).cast(f.dataType).alias(f.name) for f in own.fact_sales.schema.fields]))


@pytest.mark.parametrize("where", list(filters()), ids=lambda w: "-".join(w) or "none")
def test_every_visual_under_every_filter_is_the_same_and_reads_no_facts(model, where):
    plain, prepared = model
    blind = unreadable(prepared)
    for name in VISUALS:
        visual = getattr(dashboard, name)
        assert [tuple(r) for r in visual(blind, where=where).collect()] == [
            tuple(r) for r in visual(plain, where=where).collect()], name
    with pytest.raises(Exception, match="the facts were read"):
        measures.evaluate(blind, ["total_revenue"], ["ship_mode"], where).collect()


def test_more_measures_and_lists_of_values(model):
    plain, prepared = model
    every = list(measures.MEASURES)
    for by, where in (((), {"category": ["K1", "K2", "none"]}), (("segment",), {"year": [2022, 2023]}),
                      (("year", "region"), {"customer_tier": "Gold"}), ((), {"year": 1900})):
        def of(own):
            return sorted(map(str, measures.evaluate(own, every, by, where).collect()))

        assert of(prepared) == of(plain)


def test_the_smallest_level_that_covers_is_used_and_else_the_facts(model):
    plain, prepared = model
    own = prepared.cells
    assert own.covering(["year", "segment"], ["orders"], False) == "by_segment"
    assert own.covering(["segment"], ["customers"], False) == "by_customer"
    assert own.covering(["segment"], ["customers"], True) == "by_segment"
    assert own.covering(["ship_mode"], [], False) is None
    got = measures.evaluate(prepared, ["total_revenue"], ["ship_mode"])
    assert got.collect() == measures.evaluate(plain, ["total_revenue"], ["ship_mode"]).collect()


def test_sketches_are_close_merge_over_any_slice_and_are_asked_for(model):
    plain, prepared = model
    rough = cells.with_cells(plain, prepared.cells, approximate=True)
    for where in filters():
        exact = measures.evaluate(plain, ["total_orders", "total_customers"], ["region"], where).collect()
        near = {r.region: r for r in measures.evaluate(rough, ["total_orders", "total_customers"], ["region"], where).collect()}
        states = {r.region: r for r in cells.approximate_counts(plain, cells.distinct_by_day(plain), ["region"], {
            k: v for k, v in where.items() if k != "category"}).collect()}
        assert near.keys() == {r.region for r in exact} and near.keys() <= states.keys()
        for r in exact:
            for c in ("total_orders", "total_customers"):
                assert abs(near[r.region][c] - r[c]) <= max(1, 5 * cells.ERROR * r[c])
                if "category" not in where:
                    assert abs(states[r.region][c] - r[c]) <= max(1, 5 * cells.ERROR * r[c])
    with pytest.raises(ValueError):
        cells.approximate_counts(plain, cells.distinct_by_day(plain), ["segment"])
    with pytest.raises(ValueError):
        cells.approximate_counts(plain, cells.distinct_by_day(plain), ["ship_mode"])


def test_states_are_as_many_as_days_and_places(spark, model):
    plain, _ = model
    twice = replace(plain, fact_sales=plain.fact_sales.unionByName(plain.fact_sales))
    assert cells.distinct_by_day(twice).count() == cells.distinct_by_day(plain).count() <= 900


def test_no_orders_at_all(spark, orders):
    empty = star.write_star(features.with_features(orders().limit(0)), workspace.new_path(spark, "star"))
    prepared = cells.with_cells(empty, cells.write_cells(empty, workspace.new_path(spark, "cells")))
    assert dashboard.kpis(prepared).collect() == dashboard.kpis(empty).collect()
    assert dashboard.city_map(prepared).collect() == []


def test_a_filter_on_dates_reads_the_folders_of_its_years(model):
    plain, _ = model
    plan = measures.evaluate(plain, ["total_revenue"], ["region"], {"year_month": "2022-03"})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text and "order_year" in text


def files_read(frame):
    """Files of the facts that the finished plan read."""
    frame.collect()
    plan, found = frame._jdf.queryExecution().executedPlan(), []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "FileSourceScanExec" and "order_year" in node.toString():
            found.append(node.metrics().apply("numFiles").value())
        for k in range(node.children().size()):
            walk(node.children().apply(k))
        return None

    walk(plan)
    return max(found)


def test_fewer_files_are_read_for_a_month_than_for_all(model):
    plain, _ = model
    every = files_read(measures.evaluate(plain, ["total_revenue"], ["region"]))
    assert files_read(measures.evaluate(plain, ["total_revenue"], ["region"], {"year": 2022})) < every
    assert files_read(measures.evaluate(plain, ["total_revenue"], ["region"], {"year_month": "2022-03"})) < every
