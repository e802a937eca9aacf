"""SQL of the pages under filters, which scans the orders, and of the written star."""

from __future__ import annotations

from . import registry as R
from .oracle import CASE_BAND, P, S, VALUED, _with, amt, frac
from .sources.tables import PARENTS

_ORDERS = "COUNT(DISTINCT order_id)"
_REVENUE, _PROFIT = f"{amt(S)} AS total_revenue", f"{amt(P)} AS total_profit"
_MARGIN, _AOV = f"{frac(P, S)} AS profit_margin", f"{frac(amt(S), _ORDERS)} AS avg_order_value"
_SLICE = f"WHERE order_year = {R.YEAR} AND region = '{R.REGION}' AND category = '{R.CATEGORY}'"


def _by(keys: str, columns: str) -> str:
    return _with(f"SELECT {keys}, {columns} FROM sales {_SLICE} GROUP BY ALL")


def _top(key: str, n: int) -> str:
    return _with(f"SELECT {key}, {amt('s')} AS total_revenue FROM (SELECT {key}, {S} AS s, rank() OVER (ORDER BY {S} DESC) "
                 f"AS place FROM sales {_SLICE} GROUP BY {key}) WHERE place <= {n}")


def _pages() -> dict[str, str]:
    products = _with(
        f"SELECT product_name, category, {amt('s')} AS total_revenue, {amt('p')} AS total_profit, {frac('p', 's')} AS "
        "profit_margin, dense_rank() OVER (ORDER BY s DESC) AS product_rank FROM "
        f"(SELECT product_name, category, {S} AS s, {P} AS p FROM sales {_SLICE} GROUP BY ALL)")
    return {
        "kpis": _with(f"SELECT {_REVENUE}, {_PROFIT}, {_MARGIN}, {_ORDERS} AS total_orders FROM sales {_SLICE}"),
        "trend": _by("order_year_month AS year_month", _REVENUE),
        "category_bar": _by("category", _REVENUE), "category_treemap": _by("category", _REVENUE),
        "region_donut": _by("region", _REVENUE), "city_map": _by("region, city", _REVENUE),
        "region_compare": _by("region", f"{_REVENUE}, {_PROFIT}"),
        "region_matrix": _by("region", f"{_REVENUE}, {_PROFIT}, {_MARGIN}, {_AOV}, CAST(dense_rank() OVER (ORDER BY {S} DESC) "
                                       "AS INTEGER) AS region_rank"),
        "region_aov": _by("region", _AOV), "top_products": _top("product_name", 10),
        "category_margin": _by("category", _MARGIN), "product_table": products,
        "segment_donut": _by("segment", _REVENUE), "top_customers": _top("customer_name", 15),
        "discount_combo": _by(f"{CASE_BAND} AS discount_band", f"{_ORDERS} AS total_orders, {_MARGIN}"),
        "tier_matrix": _with(
            f"SELECT customer_tier, COUNT(DISTINCT customer_id) AS total_customers, {_REVENUE}, {_AOV} "
            f"FROM valued {_SLICE} GROUP BY customer_tier", VALUED),
        "drill_category": products,
    }


def _close(where: str = "") -> str:
    """Exact counts; sketches are expected to be close to them."""
    return _with(f"SELECT region, {_ORDERS} AS total_orders, COUNT(DISTINCT customer_id) AS total_customers, "
                 f"true AS total_orders_close, true AS total_customers_close FROM sales {where} GROUP BY region")


# What is no text in the six tables.
_NUMBERS = set("""quantity unit_price discount sales profit profit_margin order_year order_month order_quarter days_to_ship
 customer_ltv total_orders avg_unit_price order_count date_key year quarter month week day""".split())
_COLUMNS = {
    "dim_customer": "customer_id customer_name segment customer_tier customer_ltv home_region home_city total_orders",
    "dim_product": "product_id product_name category avg_unit_price",
    "dim_geography": "geo_id region city order_count",
    "dim_date": "date date_key year quarter quarter_name month month_name month_short year_month week day day_name "
                "is_weekend is_festive_q",
    "fact_sales": "order_id date_key customer_id product_id geo_id ship_mode quantity unit_price discount sales profit "
                  "profit_margin days_to_ship",
    "flat_sales": "order_id order_date ship_date ship_mode customer_id customer_name segment region city category "
                  "product_name quantity unit_price discount sales profit profit_margin order_year order_month order_quarter "
                  "order_month_name order_year_month days_to_ship discount_band sales_band is_profitable customer_ltv "
                  "customer_tier",
}


def _profile(table: str, rows: str) -> str:
    def line(c: str) -> str:
        value = f"CAST(floor(CAST({c} AS DOUBLE) * 10000 + 0.5) AS BIGINT)" if c in _NUMBERS else f"CAST({c} AS VARCHAR)"
        total = f"CAST(SUM({value}) AS VARCHAR)" if c in _NUMBERS else "CAST(NULL AS VARCHAR)"
        return (f"{{'column_name': '{c}', 'present': COUNT({c}), 'lowest': CAST(MIN({value}) AS VARCHAR), "
                f"'highest': CAST(MAX({value}) AS VARCHAR), 'total': {total}}}")

    lines = ", ".join(map(line, _COLUMNS[table].split()))
    return f"SELECT '{table}' AS table_name, unnest(l, recursive := true) FROM (SELECT [{lines}] AS l FROM ({rows}))"


_SPOILT = """CASE WHEN quantity % 11 = 0 THEN 'on ' || CAST(order_date AS VARCHAR) WHEN quantity % 13 = 0 THEN
 strftime(order_date, '%Y') || '-02-30' ELSE CAST(order_date AS VARCHAR) END AS order_date,
 CASE WHEN quantity % 22 <> 0 THEN CAST(ship_date AS VARCHAR) END AS ship_date, quantity, sales"""
_REASONS = """concat_ws(', ', CASE WHEN quantity % 11 = 0 THEN 'order_date: no date' WHEN quantity % 13 = 0 THEN
 'order_date: no such day' END, CASE WHEN quantity % 22 = 0 THEN 'ship_date: missing' END) AS reasons"""


# Topic: the report that answers it.
_REPORT_OF = {
    "revenue_by_region": "rpt_revenue_by_region", "revenue_by_category": "rpt_revenue_by_category",
    "revenue_trend": "rpt_revenue_trend", "total_revenue": "rpt_total_revenue", "profit_by_category": "rpt_profit_by_category",
    "profit_by_region": "rpt_profit_by_region", "profit_overall": "rpt_total_profit",
    "customer_segments": "rpt_customer_segments", "bottom_products": "rpt_bottom_products",
    "discount_impact": "rpt_discount_impact", "quarterly": "rpt_quarterly", "city_analysis": "rpt_city",
    "region_scorecard": "rpt_region_scorecard", "shipping": "rpt_shipping", "summary": "rpt_summary",
}


def _answered(own: dict[str, str]) -> str:
    lines = " ".join(f"WHEN '{t}' THEN (SELECT COUNT(*) FROM ({own[r]}))" for t, r in _REPORT_OF.items())
    topics = ", ".join(f"'{t}'" for t in _REPORT_OF)
    return (f"SELECT intent, id, CASE intent {lines} END AS lines FROM (SELECT intent, MIN(id) AS id FROM ({own['intent_tag']}) "
            f"WHERE intent IN ({topics}) GROUP BY intent)")


def statements(own: dict[str, str]) -> dict[str, str]:
    return {
        "dq_orphans": " UNION ALL ".join(
            f"SELECT '{child}' AS child, '{parent}' AS parent, COUNT(*) FILTER (WHERE {key} IS NULL OR {key} NOT IN "
            f"(SELECT {own_key} FROM {parent})) AS missing FROM {child}" for child, key, parent, own_key in PARENTS),
        "intent_dispatch_asked": _answered(own),
        **{f"dash_{name}_slice": sql for name, sql in _pages().items()},
        "m_distinct_sketches": _close(),
        "m_distinct_sketches_year": _close(f"WHERE order_year = {R.YEAR}"),
        "clean_accepted_dates": _with(f"SELECT order_id, product_name, {_SPOILT} FROM sales WHERE quantity % 11 <> 0 "
                                      "AND quantity % 13 <> 0"),
        "clean_rejected_dates": _with(f"SELECT order_id, product_name, {_SPOILT}, {_REASONS} FROM sales WHERE "
                                      "quantity % 11 = 0 OR quantity % 13 = 0"),
        "feat_bands_from_table": _with("SELECT order_id, product_name, discount, sales, discount_band, sales_band FROM sales"),
        "intent_scores_by_table": own["intent_scores"],
        "intent_tag_by_table": own["intent_tag"],
        "snk_star": " UNION ALL ".join(_profile(t, own[t]) for t in _COLUMNS),
        "snk_star_csv": own["fact_sales"],
    }
