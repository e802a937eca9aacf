"""Lines of the star on demand give the attributes of products, places and days themselves."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from tillsight import registry
from tillsight.operators import features
from tillsight.plans import cells, dashboard, measures, periods, star
from tillsight.sources import workspace


def made(orders, mixed):
    """Orders with missing names, places, days and categories; P1 to P3 are sold in several categories, if ``mixed``."""
    draw = random.Random(5)
    rows = []
    for k in range(260):
        p, day = k % 9, dt.date(2022 + k % 2, draw.randint(1, 12), draw.randint(1, 28))
        category = None if p == 4 else f"K{p % 3}"
        if mixed and p in (1, 2, 3):
            category = draw.choice([None, "K0", "K1", "K2"])
        rows.append({
            "order_id": None if k % 41 == 0 else f"O{draw.randint(1, 120)}", "order_date": None if k % 17 == 0 else day, "ship_date": day,
            "customer_id": f"C{k % 12}", "customer_name": f"N{k % 5}", "segment": f"S{k % 3}",
            "region": None if k % 13 == 0 else draw.choice(["East", "West"]), "city": None if k % 19 == 0 else f"T{k % 4}",
            "category": category, "product_name": None if k % 23 == 0 else f"P{p}",
            "discount": draw.choice([0.0, 0.15, 0.25]), "sales": draw.randint(1, 9999) / 100, "profit": draw.randint(-99, 99) / 100})
    return orders(*rows)


@pytest.fixture(params=[False, True], ids=["plain", "mixed"])
def own(spark, orders, request, monkeypatch):
    """(the registry's folder, the written star of the same orders, whether products are mixed)"""
    rows = made(orders, request.param)
    monkeypatch.setattr(registry, "raw", lambda *_: rows)
    monkeypatch.setattr(registry, "_paths", {})
    monkeypatch.setattr(registry, "_stamp", lambda spark, folder: ("orders", folder))
    facts = star.write_star(features.with_features(rows, registry.TIERS), workspace.new_path(spark, "star"))
    return workspace.new_path(spark, "none"), facts, request.param


def joins(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString().count("Join")


def names():
    return {k[-1].split("-")[0] for k in registry._paths}


def ordered(frame):
    return sorted(map(str, frame.collect()))


def test_lines_hold_what_the_tables_say(spark, own):
    folder, facts, mixed = own
    page = registry.star(spark, folder)
    for d in ("dim_product", "dim_geography", "dim_date"):
        by = measures.DIMENSIONS[d][1]
        m = ["total_orders", "profit_margin"] if d != "dim_date" else ["total_orders", "total_customers"]
        found, plain = measures.evaluate(page, m, by), measures.evaluate(facts, m, by)
        assert found.dtypes == plain.dtypes and ordered(found) == ordered(plain), by
    where = {"year": 2022, "category": "K1"}
    assert values(dashboard.region_donut(page, where=where)) == values(dashboard.region_donut(facts, where=where))
    assert str(values(periods.rolling_by_day(page, {"year": 2022, "category": "K1"}, ["region"]))) == str(
        values(periods.rolling_by_day(facts, {"year": 2022, "category": "K1"}, ["region"])))
    assert not names() & {"dim_product", "dim_geography", "facts"}


def test_only_mixed_products_are_looked_up(spark, own):
    folder, _, mixed = own
    page = registry.star(spark, folder)
    assert joins(measures.evaluate(page, ["profit_margin_label"], ["product_name"])) == 0
    assert joins(measures.evaluate(page, ["total_revenue"], ["region"], {"category": "K1"})) == int(mixed)
    kept = [k[-1] for k in registry._paths if k[-1].startswith("orders-")]
    assert kept and not any("unit_price" in k for k in kept)
    known = star.mixed_products(registry.raw())
    assert known.isEmpty() != mixed
    if mixed:
        table = star.dim_product(registry.raw()).select(F.col("product_name").alias("_mixed"), F.col("category").alias("_category"))
        assert set(known.collect()) <= set(table.collect())


def test_pages_read_the_written_orders(spark, own, monkeypatch):
    folder, facts, mixed = own
    kept = []
    monkeypatch.setattr(cells, "written", lambda rows, name, *a: kept.append(name) or workspace.written(rows, name, *a))
    page = registry.prepared(spark, folder)
    where = {"year": 2022, "category": "K1"}
    for visual in (dashboard.category_margin, dashboard.top_products, dashboard.city_map, dashboard.discount_combo):
        assert values(visual(page, where=where)) == values(visual(facts, where=where)), visual
    assert not names() & {"dim_product", "dim_geography", "dim_date", "facts"}
    assert ("lines-of-cells" in kept) == mixed
    path = next(p for k, p in registry._paths.items() if k[-1] == "by_band-exact")
    assert os.path.isdir(path.removeprefix("file:"))
