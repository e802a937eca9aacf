from __future__ import annotations

import datetime as dt

import pytest
from conftest import values

from tillsight.plans import answers, business, dashboard, measures
from tillsight.plans.build import build, load
from tillsight.sources import files, workspace


def on(day, **more):
    return {"order_date": dt.date.fromisoformat(day), "ship_date": dt.date.fromisoformat(day), **more}


@pytest.fixture(scope="module")
def built(spark, orders):
    """CSV to clean table to star, with one order loaded twice."""
    twice = on("2022-03-05", order_id="same", sales=250.0, profit=50.0)
    raw = orders(twice, twice, on("2023-03-05", sales=400.0, region="West", city="Pune"),
                 on("2023-04-01", customer_id="C-2", customer_name="Bob", product_name='Disk 13"'))
    path = workspace.new_path(spark, "raw")
    files.write_csv(raw, path)
    folder = workspace.new_path(spark, "built")
    build(files.read_raw_csv_text_dates(spark, path), folder)
    return load(spark, folder)


def test_duplicates_are_gone_and_names_survive(built):
    assert built.sales.count() == 3
    assert built.star.fact_sales.count() == 3
    assert {r.product_name for r in built.star.dim_product.collect()} == {"Atlas", 'Disk 13"'}


def test_reports_and_star_agree(built):
    assert answers.total_revenue(built.sales).first().total_revenue == 750.0
    assert dashboard.kpis(built.star).first().total_revenue == 750.0
    assert values(business.year_over_year(built.sales)) == [(2023, "Books", 500.0, 250.0, 100.0)]
    assert values(answers.top_customers(built.sales, 1))[0][0] == "Ann"


def test_time_measures_under_a_filter(built):
    got = {r.year_month: r for r in
           measures.time_measures(built.star, {"region": "West"}).collect()}
    assert len(got) == 14
    assert got["2023-03"].total_revenue == 400.0 and got["2023-03"].revenue_prev_year is None
    assert got["2023-04"].revenue_prev_month == 400.0 and got["2023-04"].revenue_mom == -1.0
    assert got["2023-04"].revenue_ytd == 400.0


@pytest.mark.parametrize("text, rows", [
    ("WITH m AS (SELECT order_year y, SUM(sales) s FROM sales GROUP BY order_year) "
     "SELECT y, s - LAG(s) OVER (ORDER BY y) AS d FROM m ORDER BY y", [(2022, None), (2023, 250.0)]),
    ("SELECT customer_id FROM sales WHERE order_year = 2022 INTERSECT "
     "SELECT customer_id FROM sales WHERE order_year = 2023", [("C-1",)]),
    ("SELECT category FROM sales GROUP BY category HAVING AVG(sales) >= "
     "(SELECT AVG(sales) FROM sales)", [("Books",)]),
    ("SELECT DISTINCT customer_name, FIRST_VALUE(sales) OVER (PARTITION BY customer_id ORDER BY "
     "order_date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS f FROM sales "
     "ORDER BY 1", [("Ann", 250.0), ("Bob", 100.0)]),
])
def test_sql_over_the_clean_table(built, text, rows):
    assert values(files.run_sql(built.sales, text)) == rows
