"""Queries that write the clean table, the star, or CSV move and write no more than they need."""

from __future__ import annotations

import datetime as dt
import glob
import random

import pytest
from pyspark.sql import functions as F

from tillsight import registry
from tillsight.operators import features, quality
from tillsight.plans import star
from tillsight.sources import files, tables, workspace
from tillsight.sources.schema import CLEAN


@pytest.fixture(scope="module")
def rows(orders):
    """Orders of several years, customers and products; some repeat, some lack a key."""
    draw = random.Random(7)
    made = []
    for k in range(120):
        day = dt.date(2020 + k % 4, draw.randint(1, 12), draw.randint(1, 28))
        made.append({
            "order_id": f"O{k // 3}-{k % 3}", "order_date": day, "ship_date": day + dt.timedelta(days=k % 9), "quantity": k % 30 + 1,
            "customer_id": None if k % 19 == 0 else f"C{k % 12}", "product_name": None if k % 23 == 0 else f'P "{k % 7}", x',
            "category": f"K{k % 3}", "region": "East" if k % 2 else "West", "city": None if k % 29 == 0 else f"T{k % 4}",
            "unit_price": draw.randint(1, 999) / 7, "sales": draw.randint(1, 9999) / 100})
    return orders(*made, *made[:10])


@pytest.fixture
def own(spark, rows, monkeypatch):
    """The registry over these orders, in a folder of its own."""
    monkeypatch.setattr(registry, "raw", lambda *_: rows)
    monkeypatch.setattr(registry, "_paths", {})
    monkeypatch.setattr(registry, "_stamp", lambda spark, folder: ("moved", folder))
    return workspace.new_path(spark, "none")


def made():
    return {k[-1] for k in registry._paths}


def same(left, right):
    left, right = files.with_iso_dates(left), files.with_iso_dates(right.select(*left.columns))
    return sorted(map(str, left.collect())) == sorted(map(str, right.collect()))


def test_orders_move_to_their_customers_without_derived_columns(rows, monkeypatch):
    seen = []
    attach = features.attach
    monkeypatch.setattr(features, "attach", lambda given, *more, **named: seen.append(given.columns) or attach(given, *more, **named))
    full = features.with_features(rows, registry.TIERS)
    assert seen == [rows.columns] and full.columns == CLEAN.fieldNames()
    # Some of the orders are worth what their customers spent in all of them.
    some = features.with_features(rows.where("quantity < 9"), registry.TIERS, rows)
    assert some.count() and same(some, full.where("quantity < 9"))


def test_the_clean_table_stays_in_its_tasks(spark, own, rows, monkeypatch):
    dealt = []
    write = files.write_clean
    monkeypatch.setattr(files, "write_clean", lambda *given, **named: dealt.append(named.get("dealt", True)) or write(*given, **named))
    found = registry.QUERIES["flat_sales"](spark, own)
    assert dealt == [False] and same(found, features.with_features(rows, registry.TIERS))
    plan = found.where("order_year = 2021")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_year" in plan


def test_lines_meet_their_parts_before_their_orders(spark):
    plan = tables.sales_raw(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("(l_orderkey") < plan.index("(l_partkey")  # the inner join is printed last
    assert "l_discount" not in plan[:plan.index("(l_partkey")]  # what they move with is made of it


def test_the_published_table_is_written_once(spark, own, rows):
    found = registry.QUERIES["snk_sales_table"](spark, own)
    assert made() == {"raw"} and same(found, features.with_features(rows, registry.TIERS))
    assert all(f.endswith(".zstd.parquet") for f in found.inputFiles())


def test_the_flat_copy_is_written_without_the_clean_table(spark, own, rows):
    lines = registry.QUERIES["snk_star"](spark, own).collect()
    assert made() == {"raw", "flat_sales", *star.TABLES}
    full = features.with_features(rows, registry.TIERS)
    tables_ = star.write_star(full, workspace.new_path(spark, "star"))
    for name in ("fact_sales", "dim_customer", "dim_product"):
        expected = quality.column_profile(getattr(tables_, name)).where("column_name <> 'order_year'")
        assert sorted(map(str, expected.collect())) == sorted(str(r) for r in spark.createDataFrame(
            [r for r in lines if r.table_name == name]).drop("table_name").select(*expected.columns).collect())
    assert {r.column_name for r in lines if r.table_name == "flat_sales"} == set(CLEAN.fieldNames())


def test_facts_for_csv_are_not_written_before(spark, own, rows):
    found = registry.QUERIES["snk_star_csv"](spark, own)
    assert made() == {"raw", *star.TABLES} - {"fact_sales", "dim_date"} | (made() & {"dim_date"})
    assert all(f.endswith(".csv.gz") for f in found.inputFiles())
    tables_ = star.write_star(features.with_features(rows, registry.TIERS), workspace.new_path(spark, "star"))
    assert same(found, tables_.fact_sales)


def test_csv_that_is_read_back_is_compressed(spark, own, rows):
    found = registry.QUERIES["src_clean_text_dates"](spark, own)
    assert made() == {"raw"} and all(f.endswith(".csv.gz") for f in found.inputFiles())
    full = features.with_features(rows, registry.TIERS)
    assert same(found, full.withColumns({c: F.col(c).cast("string") for c in ("order_date", "ship_date")}))


def test_spoilt_orders_are_not_written_before_their_csv(spark, own, rows):
    good = registry.QUERIES["clean_accepted_dates"](spark, own)
    bad = registry.QUERIES["clean_rejected_dates"](spark, own)
    assert not made() and good.count() + bad.count() == rows.count() and bad.count()
    assert all(".zstd." in f for f in bad.inputFiles())
    assert glob.glob(f"{workspace.run_folder(spark)}/spoilt_csv-*/*.csv.gz".removeprefix("file:"))
