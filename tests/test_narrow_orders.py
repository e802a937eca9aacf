"""Reports over the star write and move only what they are made of."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from conftest import values

from tillsight import registry
from tillsight.operators import features
from tillsight.plans import cells, dashboard, measures, star
from tillsight.sources import workspace

LIMITS = (0, 300, 600, 900, None)


@pytest.fixture(scope="module")
def rows(orders):
    """Customers with several names and places, some missing; orders across cells, with repeated and missing ids."""
    draw = random.Random(3)
    made = []
    for k in range(200):
        day = dt.date(2022, draw.randint(1, 12), draw.randint(1, 28))
        made.append({
            "order_id": None if k % 41 == 0 else f"O{draw.randint(1, 90)}", "order_date": None if k % 37 == 0 else day, "ship_date": day,
            "customer_id": None if k % 19 == 0 else f"C{k % 12}", "customer_name": None if k % 23 == 0 else f"N{k % 5}",
            "segment": f"S{k % 3}", "region": None if k % 29 == 0 else draw.choice(["East", "West"]), "city": f"T{k % 4}",
            "category": f"K{k % 7 % 3}", "product_name": f"P{k % 7}", "discount": draw.choice([0.0, 0.25]),
            "sales": None if k % 31 == 0 else draw.randint(1, 9999) / 100})
    return orders(*made)


def test_customers_are_the_same_without_a_value_on_every_order(rows):
    found, plain = star.dim_customer_of_orders(rows, LIMITS), star.dim_customer(features.with_features(rows, LIMITS))
    assert found.columns == plain.columns and [t for _, t in found.dtypes] == [t for _, t in plain.dtypes]
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
    # No order is joined to its customer's value.
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def own(spark, rows, monkeypatch):
    """The registry over these orders, in a folder of its own."""
    monkeypatch.setattr(registry, "raw", lambda *_: rows)
    monkeypatch.setattr(registry, "_paths", {})
    monkeypatch.setattr(registry, "_stamp", lambda spark, folder: ("orders", folder))
    return workspace.new_path(spark, "none")


def held(name):
    return set(name.split("-")[1:])


def test_a_report_writes_the_columns_it_is_made_of(spark, own):
    dashboard.kpis(registry.star(spark, own)).collect()
    assert not registry._paths  # read once, so not written
    found = values(dashboard.region_aov(registry.star(spark, own)))
    names = [k[-1] for k in registry._paths if k[-1].startswith("orders-")]
    assert len(names) == 1 and held(names[0]) == {"order_id", "sales", "region", "city"}
    assert "raw" not in [k[-1] for k in registry._paths]
    # A report that needs no more reads the same file; whole orders, where there are some, serve all.
    measures.evaluate(registry.star(spark, own), ["total_revenue"], ["region"]).collect()
    assert [k[-1] for k in registry._paths if k[-1].startswith("orders-")] == names
    registry.kept_raw(spark, own)
    whole = {k[-1] for k in registry._paths}
    dashboard.top_customers(registry.star(spark, own)).collect()
    assert {k[-1] for k in registry._paths} - whole == {"dim_customer"}
    facts = star.write_star(features.with_features(registry.kept_raw(spark, own), registry.TIERS), workspace.new_path(spark, "star"))
    assert values(dashboard.region_aov(facts)) == found


def test_exact_pages_make_no_sketches_and_look_a_product_up_once(spark, own):
    page = registry.prepared(spark, own)
    facts = star.write_star(features.with_features(registry.raw(), registry.TIERS), workspace.new_path(spark, "star"))
    where = {"category": "K1"}
    assert values(dashboard.tier_matrix(page, where=where)) == values(dashboard.tier_matrix(facts, where=where))
    path = next(p for k, p in registry._paths.items() if k[-1] == "by_customer-exact")
    level = spark.read.parquet(f"{path}/by_customer")
    assert level.count() and not [c for c in level.columns if c.endswith("_sketch")]
    rough = cells.with_cells(facts, registry.prepared(spark, own).cells, approximate=True)
    assert measures.evaluate(rough, ["total_orders"], ["category"]).count() == 3
    assert any(k[-1] == "by_band" for k in registry._paths) and os.path.isdir(path)

    lines = registry.prepared(spark, own).facts(["product_id"], ["sales", "category"])
    assert {"category", "product_id", "sales"} == set(lines.columns)
    attributed = measures._attributed(page, lines, ["category"], {})
    assert attributed._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 1
