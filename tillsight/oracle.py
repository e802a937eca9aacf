"""For each query, SQL that DuckDB runs on the same tables.

Written apart from the Spark plans: amounts are whole hundredths derived with
DECIMAL, rounding is integer arithmetic on HUGEINT, and the star queries are
answered from the flat orders.
"""

from __future__ import annotations

from . import registry as R
from .functions import bands
from .functions.questions import DEFAULT_TOP, TOP_PATTERN, TOPICS, UNKNOWN, YEAR_PATTERN
from .sources.tables import BASE_MARGIN, WORDS

# ---- the orders ------------------------------------------------------------

_MARGIN = " ".join(f"WHEN '{k}' THEN {v / 100:.2f}" for k, v in BASE_MARGIN.items())

ORDERS = f"""
joined AS (
  SELECT *, CAST(CAST(l_discount AS DECIMAL(4,2)) * 4 AS DECIMAL(4,2)) AS disc,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS list_price,
         CAST(CASE p_type {_MARGIN} END AS DECIMAL(4,2)) AS base
  FROM lineitem
  JOIN orders ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey
  JOIN part ON p_partkey = l_partkey),
sold AS (
  SELECT *, CAST(round(list_price * (1 - disc), 2) AS DECIMAL(18,2)) AS sales_d FROM joined),
earned AS (
  SELECT *, CAST(round(sales_d * base * (1 - CAST(1.8 AS DECIMAL(2,1)) * disc)
                       - list_price * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS profit_d
  FROM sold),
counted AS (
  SELECT *, CAST(disc * 100 AS BIGINT) AS discount_c, CAST(sales_d * 100 AS BIGINT) AS sales_c,
         CAST(profit_d * 100 AS BIGINT) AS profit_c, CAST(list_price * 100 AS BIGINT) AS list_c
  FROM earned),
sales AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_id,
         CAST(o_orderdate AS DATE) AS order_date,
         CAST(CAST(o_orderdate AS DATE) + l_linenumber AS DATE) AS ship_date,
         o_orderpriority AS ship_mode,
         CAST(c_custkey AS VARCHAR) AS customer_id,
         'Customer#' || CAST(c_custkey - CASE WHEN c_custkey % 7 = 0 AND c_custkey > 0
                                              THEN 1 ELSE 0 END AS VARCHAR) AS customer_name,
         c_mktsegment AS segment, r_name AS region, n_name AS city, p_type AS category,
         p_name || ' #' || CAST(p_partkey AS VARCHAR) AS product_name,
         CAST(l_quantity AS INTEGER) AS quantity,
         l_extendedprice / l_quantity AS unit_price,
         discount_c / 100 AS discount, sales_c / 100 AS sales, profit_c / 100 AS profit,
         CASE WHEN sales_c > 0 THEN sign(profit_c)
              * ((2 * abs(profit_c) * 10000 + sales_c) // (2 * sales_c)) ELSE 0 END AS margin_c,
         discount_c, sales_c, profit_c, list_c,
         CAST(year(o_orderdate) AS INTEGER) AS order_year,
         CAST(month(o_orderdate) AS INTEGER) AS order_month,
         CAST(quarter(o_orderdate) AS INTEGER) AS order_quarter,
         strftime(o_orderdate, '%b') AS order_month_name,
         strftime(o_orderdate, '%Y-%m') AS order_year_month,
         CAST(l_linenumber AS INTEGER) AS days_to_ship,
         CASE WHEN disc > 1 OR disc <= -0.01 THEN NULL WHEN disc <= 0 THEN 'No Discount'
              WHEN disc <= 0.10 THEN 'Low (1-10%)' WHEN disc <= 0.20 THEN 'Medium (11-20%)'
              WHEN disc <= 0.30 THEN 'High (21-30%)'
              ELSE 'Very High (>30%)' END AS discount_band,
         CASE WHEN sales_d <= 0 THEN NULL WHEN sales_d <= 2000 THEN '< 2K'
              WHEN sales_d <= 10000 THEN '2K-10K' WHEN sales_d <= 30000 THEN '10K-30K'
              WHEN sales_d <= 100000 THEN '30K-1L' ELSE '> 1L' END AS sales_band,
         profit_d > 0 AS is_profitable
  FROM counted)"""

_T = R.TIERS
VALUED = f"""
worth AS (SELECT customer_id, SUM(sales_c) AS ltv_c FROM sales GROUP BY customer_id),
valued AS (
  SELECT sales.*, CAST(ltv_c AS DOUBLE) / 100 AS customer_ltv,
         CASE WHEN ltv_c <= 0 THEN NULL WHEN ltv_c <= {_T[1]}00 THEN 'Bronze'
              WHEN ltv_c <= {_T[2]}00 THEN 'Silver' WHEN ltv_c <= {_T[3]}00 THEN 'Gold'
              ELSE 'Platinum' END AS customer_tier
  FROM sales JOIN worth USING (customer_id))"""


def _with(body: str, *more: str) -> str:
    return "WITH " + ",".join([ORDERS, *more]) + "\n" + body


# ---- arithmetic ------------------------------------------------------------

def hu(num: str, den: str | int, places: int) -> str:
    """num / den rounded half away from zero, as DOUBLE; NULL for den = 0."""
    n, d, p = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)", 10 ** places
    return (f"(CASE WHEN {d} = 0 THEN NULL ELSE CAST(sign({n}) * sign({d}) * "
            f"((2 * abs({n}) * {p} + abs({d})) // (2 * abs({d}))) AS DOUBLE) / {p} END)")


def amt(c: str) -> str:
    return f"(CAST({c} AS DOUBLE) / 100)"


def amt0(c: str) -> str:
    return hu(c, 100, 0)


def pct1(part: str, whole: str) -> str:
    return hu(f"({part}) * 100", whole, 1)


def pct(part: str, whole: str) -> str:
    return f"(CAST({part} AS DOUBLE) * 100.0 / NULLIF(CAST({whole} AS DOUBLE), 0))"


def frac(part: str, whole: str) -> str:
    return f"COALESCE(CAST({part} AS DOUBLE) / NULLIF(CAST({whole} AS DOUBLE), 0), 0)"


def mean(c: str, n: str) -> str:
    return f"({amt(c)} / NULLIF(CAST({n} AS DOUBLE), 0))"


def mean_r(c: str, n: str, places: int) -> str:
    return hu(c, f"({n}) * 100", places)


def grow1(now: str, before: str) -> str:
    return pct1(f"{now} - {before}", before)


S, P, M, N = "SUM(sales_c)", "SUM(profit_c)", "SUM(margin_c)", "COUNT(*)"
RAW_COLUMNS = """order_id, CAST(order_date AS VARCHAR) AS order_date,
 CAST(ship_date AS VARCHAR) AS ship_date, ship_mode, customer_id, customer_name, segment, region,
 city, category, product_name, quantity, unit_price, discount, sales, profit,
 margin_c / 100 AS profit_margin"""
CLEAN_COLUMNS = RAW_COLUMNS + """, order_year, order_month, order_quarter, order_month_name,
 order_year_month, days_to_ship, discount_band, sales_band, is_profitable, customer_ltv,
 customer_tier"""
CUSTOMER = "customer_id, customer_name, region, segment"
_ROW = "order_id, product_name"


def _row(columns: str) -> str:
    return _with(f"SELECT {_ROW}, {columns} FROM sales")


_DATE = "CAST(order_date AS VARCHAR) AS order_date"
CASE_BAND = """CASE WHEN discount_c = 0 THEN 'No Discount' WHEN discount_c <= 10 THEN 'Low (1-10%)'
 WHEN discount_c <= 20 THEN 'Medium (11-20%)' WHEN discount_c <= 30 THEN 'High (21-30%)'
 ELSE 'Very High (>30%)' END"""


# ---- sources, quality, features -------------------------------------------

def _foundation() -> dict[str, str]:
    raw = _with(f"SELECT {RAW_COLUMNS} FROM sales")
    clean = _with(f"SELECT {CLEAN_COLUMNS} FROM valued", VALUED)
    names = ["order_id", "order_date", "ship_date", "ship_mode", "customer_id", "customer_name",
             "segment", "region", "city", "category", "product_name", "quantity", "unit_price",
             "discount", "sales", "profit", "profit_margin"]
    typed = ", ".join(f"typeof(any_value({n if n != 'profit_margin' else 'margin_c / 100'})) "
                      f"AS {n}" for n in names)
    kinds = ("CASE {0} WHEN 'VARCHAR' THEN 'string' WHEN 'DATE' THEN 'date' "
             "WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' END")
    priced = f"""
    lines AS (SELECT order_id, product_name, region, category, quantity, discount, discount_c,
        CAST({hu('list_c', 'quantity', 0)} AS BIGINT) AS price_c FROM sales),
    step1 AS (SELECT *, CAST({hu('price_c * quantity * (100 - discount_c)', 100, 0)} AS BIGINT)
        AS new_sales FROM lines),
    step2 AS (SELECT *, CAST({hu('CAST(new_sales AS HUGEINT) * CASE category '
        + ' '.join(f"WHEN '{k}' THEN {v}" for k, v in BASE_MARGIN.items())
        + ' END * (1000 - 18 * discount_c)', 100000, 0)} AS BIGINT) AS kept FROM step1),
    step3 AS (SELECT *, CAST({hu('kept * CASE region '
        + ' '.join(f"WHEN '{k}' THEN {round(v * 100)}" for k, v in R.REGION_FACTORS.items())
        + ' END', 100, 0)} AS BIGINT) AS gain FROM step2)"""
    label = f"""CASE WHEN c >= 1000000000 THEN 'Rs.' || printf('%.2f', {hu('c', 10**9, 2)}) || ' Cr'
     WHEN c >= 10000000 THEN 'Rs.' || printf('%.1f', {hu('c', 10**7, 1)}) || ' L'
     WHEN c >= 100000 THEN 'Rs.' || printf('%.1f', {hu('c', 10**5, 1)}) || 'K'
     ELSE 'Rs.' || printf('%.0f', {hu('c', 100, 0)}) END"""
    six = f"{hu('p * 100', 's', 6)} * 1000000"
    copies = f"c AS (SELECT {RAW_COLUMNS} FROM sales UNION ALL SELECT {RAW_COLUMNS} FROM sales WHERE " \
             "quantity % 7 = 0)"
    return {
        "src_raw_csv": raw, "src_clean_csv": clean, "src_clean_text_dates": clean,
        "snk_clean": clean, "snk_sales_table": clean, "flat_sales": clean,
        "sql_surface": _with(
            f"SELECT region, segment, COUNT(*) AS orders, COUNT(DISTINCT customer_id) AS customers,"
            f" {amt0(S)} AS revenue FROM sales WHERE order_quarter IN (1, 4) AND discount_band IS "
            "NOT NULL GROUP BY region, segment HAVING COUNT(*) > 1"),
        "dq_shape": _with("SELECT COUNT(*) AS rows, 17 AS columns FROM sales"),
        "dq_sample_rows": _with(
            f"SELECT {_DATE}, order_id, product_name, sales FROM sales "
            "ORDER BY sales.order_date, order_id, product_name, sales LIMIT 5"),
        "dq_null_counts": _with(" UNION ALL ".join(
            f"SELECT '{n}' AS \"column\", COUNT(*) - COUNT({n if n != 'profit_margin' else 'margin_c'}) "
            "AS nulls FROM sales" for n in names)),
        "dq_duplicate_count": _with(
            "SELECT COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM c)) AS duplicate_rows FROM c",
            copies),
        "clean_dedup": _with("SELECT DISTINCT * FROM c", copies),
        "dq_dtypes": _with(" UNION ALL ".join(
            f"SELECT '{n}' AS \"column\", {kinds.format(n)} AS type, "
            f"(SELECT COUNT({n if n != 'profit_margin' else 'margin_c'}) FROM sales) AS present FROM t"
            for n in names),
            f"t AS (SELECT {typed} FROM sales)"),
        "clean_cast_dates": _with(
            f"SELECT order_id, {_DATE}, CAST(ship_date AS VARCHAR) AS ship_date, "
            "CAST(date_diff('day', sales.order_date, sales.ship_date) AS INTEGER) AS days FROM sales"),
        "dq_summary": _with(
            "SELECT COUNT(*) AS total_rows, 17 AS total_columns, CAST(min(order_date) AS VARCHAR) AS "
            "first_date, CAST(max(order_date) AS VARCHAR) AS last_date, "
            f"{amt0(S)} AS total_sales, {amt0(P)} AS total_profit, COUNT(DISTINCT customer_id) AS "
            "customers, COUNT(DISTINCT product_name) AS products FROM sales"),
        "dq_category_totals": _with(
            f"SELECT category, {amt(S)} AS sales, {amt(P)} AS profit FROM sales GROUP BY category"),
        "feat_date_parts": _row(f"{_DATE}, order_year, order_month, order_quarter"),
        "feat_date_labels": _row(f"{_DATE}, order_month_name, order_year_month"),
        "feat_days_to_ship": _row(
            f"{_DATE}, CAST(ship_date AS VARCHAR) AS ship_date, CAST(date_diff('day', "
            "sales.order_date, sales.ship_date) AS INTEGER) AS days_to_ship"),
        "feat_discount_band": _row("discount, discount_band"),
        "feat_sales_band": _row("sales, sales_band"),
        "feat_is_profitable": _row("profit, is_profitable"),
        "feat_customer_ltv": _with(f"SELECT {_ROW}, customer_id, customer_ltv FROM valued", VALUED),
        "feat_customer_tier": _with(
            f"SELECT {_ROW}, customer_ltv, customer_tier FROM valued", VALUED),
        "feat_band_case": _row(f"discount, {CASE_BAND} AS band"),
        "feat_profit_status": _row(
            "profit, CASE WHEN profit_c > 0 THEN 'Profitable' ELSE 'Loss' END AS status"),
        "price_order_line": _with(
            "SELECT order_id, product_name, region, category, price_c / 100 AS unit_price, quantity,"
            " discount, new_sales / 100 AS sales, gain / 100 AS profit, "
            f"COALESCE({hu('gain * 100', 'new_sales', 2)}, 0) AS profit_margin FROM step3", priced),
        "fmt_inr": _with(
            f"SELECT customer_id, {amt('c')} AS sales, {label} AS label FROM "
            "(SELECT customer_id, SUM(sales_c) AS c FROM sales GROUP BY customer_id)"),
        "fmt_pct": _with(
            f"SELECT product_name, printf('%.1f', {hu(six, 1000000, 1)}) || '%' AS label FROM "
            f"(SELECT product_name, {S} AS s, {P} AS p FROM sales "
            "GROUP BY product_name)"),
    }


# ---- business reports ------------------------------------------------------

def _business() -> dict[str, str]:
    month = f"m AS (SELECT order_year, order_month, {amt0(S)} AS revenue FROM sales " \
            "GROUP BY order_year, order_month)"
    lagged = "l AS (SELECT *, lag(revenue) OVER (ORDER BY order_year, order_month) AS prev FROM m)"
    margin_products = (
        f"SELECT product_name, category, COUNT(*) AS orders, {amt0(S)} AS total_sales, "
        f"{mean_r(M, N, 1)} AS avg_margin_pct FROM sales GROUP BY product_name, category "
        "HAVING SUM(margin_c) / COUNT(*) > (SELECT SUM(margin_c) / COUNT(*) FROM sales)")
    ranked = (
        f"t AS (SELECT customer_id, customer_name, region, {amt0(S)} AS total_sales, COUNT(*) AS "
        "orders FROM sales GROUP BY customer_id, customer_name, region), "
        "r AS (SELECT *, CAST(dense_rank() OVER (PARTITION BY region ORDER BY total_sales DESC) AS "
        "INTEGER) AS region_rank FROM t)")
    best = (
        f"t AS (SELECT category, product_name, {amt0(S)} AS total_sales, COUNT(*) AS orders, "
        f"{amt0(P)} AS total_profit FROM sales GROUP BY category, product_name), "
        "r AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY total_sales DESC, "
        "product_name) AS place FROM t)")
    quarters = {q: f"SUM(CASE WHEN order_quarter = {q} THEN sales_c ELSE 0 END)" for q in range(1, 5)}
    q_columns = ", ".join(f"{amt0(e)} AS Q{q}" for q, e in quarters.items())
    high = f"{CUSTOMER}, {S} AS s, {P} AS p, COUNT(*) AS n FROM sales GROUP BY {CUSTOMER} " \
           f"HAVING {S} > {R.MIN_LTV}00"
    y1, y2 = R.RETAINED
    retained = (
        f"SELECT {CUSTOMER} FROM sales WHERE order_year = {y1} AND customer_id IN "
        f"(SELECT customer_id FROM sales WHERE order_year = {y1} INTERSECT "
        f"SELECT customer_id FROM sales WHERE order_year = {y2}) GROUP BY {CUSTOMER} "
        "ORDER BY customer_name, customer_id, region, segment")
    ends = """SELECT DISTINCT customer_name, region,
      first_value(sales_c) OVER (PARTITION BY customer_id ORDER BY order_date, order_id, sales_c
        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS a,
      first_value(sales_c) OVER (PARTITION BY customer_id
        ORDER BY order_date DESC, order_id DESC, sales_c DESC
        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS b FROM sales"""
    return {
        "q01_category_summary": _with(
            f"SELECT category, COUNT(*) AS total_orders, {amt0(S)} AS total_revenue, {amt0(P)} AS "
            f"total_profit, {pct1(P, S)} AS profit_margin_pct, {mean_r(S, N, 0)} AS avg_order_value "
            "FROM sales GROUP BY category"),
        "q02_high_value_customers": _with(
            f"SELECT customer_name, region, segment, n AS total_orders, {amt0('s')} AS "
            f"lifetime_value, {mean_r('s', 'n', 0)} AS avg_order_value, {amt0('p')} AS total_profit "
            f"FROM (SELECT {high})"),
        "q03_monthly_trend": _with(
            f"SELECT order_year AS year, order_month AS month, COUNT(*) AS orders, {amt0(S)} AS "
            f"monthly_revenue, {mean_r(S, N, 0)} AS avg_order_value, {pct1(P, S)} AS margin_pct "
            "FROM sales GROUP BY order_year, order_month"),
        "q04_above_avg_margin": _with(margin_products),
        "q05_top_customers_region": _with(
            "SELECT customer_name, region, total_sales, orders, region_rank FROM r "
            "WHERE region_rank <= 3", ranked),
        "q06_mom_growth": _with(
            f"SELECT order_year, order_month, revenue, prev AS prev_revenue, "
            f"{grow1('revenue', 'prev')} AS mom_growth_pct FROM l WHERE prev IS NOT NULL",
            month, lagged),
        "q07_best_product_category": _with(
            "SELECT category, product_name, total_sales, orders, total_profit FROM r "
            "WHERE place = 1", best),
        "q08_discount_impact": _with(
            f"SELECT {CASE_BAND} AS discount_band, COUNT(*) AS orders, {amt0(S)} AS total_revenue, "
            f"{mean_r(M, N, 1)} AS avg_margin_pct, {mean_r(P, N, 0)} AS avg_profit_per_order, "
            f"{pct1(P, S)} AS effective_margin FROM sales GROUP BY ALL"),
        "q09_above_segment_avg": _with(
            f"SELECT customer_name, segment, region, {amt0('s')} AS customer_revenue, "
            f"{mean_r('seg_s', 'seg_n', 0)} AS segment_avg_order_value FROM c JOIN g USING (segment)"
            f" WHERE CAST(s AS DOUBLE) > {float(R.SEGMENT_MULTIPLE)} * seg_s / seg_n "
            "ORDER BY customer_revenue DESC, customer_name, customer_id LIMIT 15",
            f"c AS (SELECT {CUSTOMER}, {S} AS s FROM sales GROUP BY {CUSTOMER})",
            f"g AS (SELECT segment, {S} AS seg_s, {N} AS seg_n FROM sales GROUP BY segment)"),
        "q10_running_total": _with(
            "SELECT order_year, order_month, revenue AS monthly_revenue, SUM(revenue) OVER "
            "(PARTITION BY order_year ORDER BY order_month ROWS UNBOUNDED PRECEDING) AS "
            "cumulative_revenue_ytd FROM m", month),
        "q11_regional_scorecard": _with(
            "SELECT region, unique_customers, total_orders, total_revenue, total_profit, margin_pct,"
            " avg_order_value, revenue_per_customer, CAST(rank() OVER (ORDER BY total_revenue DESC) "
            "AS INTEGER) AS revenue_rank, CAST(rank() OVER (ORDER BY margin_pct DESC) AS INTEGER) AS "
            "margin_rank FROM w",
            f"g AS (SELECT region, COUNT(DISTINCT customer_id) AS unique_customers, COUNT(*) AS "
            f"total_orders, {amt0(S)} AS total_revenue, {amt0(P)} AS total_profit, "
            f"{mean_r(S, N, 0)} AS avg_order_value FROM sales GROUP BY region)",
            f"w AS (SELECT *, {pct1('total_profit', 'total_revenue')} AS margin_pct, "
            f"{hu('total_revenue', 'unique_customers', 0)} AS revenue_per_customer FROM g)"),
        "q12_yoy_growth": _with(
            f"SELECT order_year, category, revenue, prev AS prev_year_revenue, "
            f"{grow1('revenue', 'prev')} AS yoy_growth_pct FROM (SELECT *, lag(revenue) OVER "
            "(PARTITION BY category ORDER BY order_year) AS prev FROM y) WHERE prev IS NOT NULL",
            f"y AS (SELECT order_year, category, {amt0(S)} AS revenue FROM sales "
            "GROUP BY order_year, category)"),
        "q13_retained_customers": _with(
            f"SELECT customer_name, region, segment FROM ({retained} LIMIT 15)"),
        "rpt_retention": _with(f"SELECT customer_name, region, segment FROM ({retained})"),
        "q14_first_vs_latest": _with(
            f"SELECT DISTINCT customer_name, region, {amt0('a')} AS first_order_value, {amt0('b')} AS "
            f"latest_order_value, {amt0('(b - a)')} AS value_change FROM ({ends}) ORDER BY "
            "value_change DESC, customer_name, region, first_order_value, latest_order_value "
            "LIMIT 15"),
        "q15_quarterly_pivot": _with(
            f"SELECT order_year, category, {q_columns}, {amt0(S)} AS annual_total, "
            f"{grow1(quarters[4], quarters[1])} AS q4_vs_q1_growth_pct FROM sales "
            "GROUP BY order_year, category"),
        "v01_category_summary": _with(
            f"SELECT category, COUNT(*) AS total_orders, {amt0(S)} AS total_revenue, {amt0(P)} AS "
            f"total_profit, {pct1(P, S)} AS margin_pct FROM sales GROUP BY category"),
        "v02_high_value_top10": _with(
            f"SELECT customer_name, region, segment, n AS orders, {amt0('s')} AS lifetime_value FROM "
            f"(SELECT {high}) ORDER BY lifetime_value DESC, customer_name, customer_id LIMIT 10"),
        "v03_first_12_months": _with(
            f"SELECT order_year, order_month, COUNT(*) AS orders, {amt0(S)} AS monthly_revenue "
            "FROM sales GROUP BY order_year, order_month ORDER BY order_year, order_month LIMIT 12"),
        "v04_above_avg_margin_top10": _with(
            f"SELECT product_name, category, avg_margin_pct AS avg_margin FROM ({margin_products}) "
            "ORDER BY avg_margin DESC, product_name, category LIMIT 10"),
        "v05_top3_region": _with(
            "SELECT customer_name, region, total_sales, region_rank FROM r WHERE region_rank <= 3",
            ranked),
        "v06_mom_with_first": _with(
            f"SELECT order_year, order_month, revenue, prev AS prev_revenue, "
            f"{grow1('revenue', 'prev')} AS growth_pct FROM l ORDER BY order_year, order_month "
            "LIMIT 12", month, lagged),
        "v07_best_product": _with(
            "SELECT category, product_name, total_sales FROM r WHERE place = 1", best),
        "v08_discount_impact": _with(
            f"SELECT {CASE_BAND} AS discount_band, COUNT(*) AS orders, {mean_r(M, N, 1)} AS "
            "avg_margin FROM sales GROUP BY ALL"),
        "v09_running_total": _with(
            "SELECT order_year, order_month, revenue, SUM(revenue) OVER (PARTITION BY order_year "
            "ORDER BY order_month) AS running_total FROM m ORDER BY order_year, order_month LIMIT 12",
            month),
        "v10_quarterly_pivot": _with(
            f"SELECT order_year, category, {q_columns} FROM sales GROUP BY order_year, category "
            "ORDER BY order_year, category LIMIT 10"),
    }


# ---- exploratory data sets -------------------------------------------------

def _exploratory() -> dict[str, str]:
    labels = ", ".join(f"('{x}')" for x in bands.DISCOUNT_LABELS)
    numeric = {"quantity": "quantity", "unit_price": "unit_price", "discount": "discount",
               "sales": "sales", "profit": "profit", "profit_margin": "margin_c / 100",
               "days_to_ship": "days_to_ship", "customer_ltv": "customer_ltv"}
    cells = " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(covar_pop(x_{a}, x_{b}) / "
        f"NULLIF(stddev_pop(x_{a}) * stddev_pop(x_{b}), 0), 6) AS r FROM x"
        for a in numeric for b in numeric)
    values = ", ".join(f"CAST({e} AS DOUBLE) AS x_{n}" for n, e in numeric.items())

    def total(keys: str, tail: str = "") -> str:
        return _with(f"SELECT {keys}, {amt(S)} AS sales FROM sales GROUP BY {keys} {tail}")

    return {
        "eda01_monthly_revenue": total("order_year_month"),
        "eda02_category_sales_profit": _with(
            f"SELECT category, {amt(S)} AS sales, {amt(P)} AS profit FROM sales GROUP BY category"),
        "eda03_region_share": _with(
            f"SELECT region, {amt('s')} AS sales, {pct1('s', '(SUM(s) OVER ())')} AS share_pct FROM "
            f"(SELECT region, {S} AS s FROM sales GROUP BY region)"),
        "eda04_margin_by_band": _with(
            f"SELECT label AS discount_band, {mean('m', 'k')} AS profit_margin, "
            f"{mean_r('m', 'k', 1)} AS profit_margin_1dp FROM (VALUES {labels}) b(label) LEFT JOIN "
            f"(SELECT discount_band, {M} AS m, {N} AS k FROM sales GROUP BY discount_band) "
            "ON discount_band = label"),
        "eda05_top_customers": total("customer_name", "ORDER BY sales DESC, customer_name LIMIT 10"),
        "eda06_top_products_profit": _with(
            f"SELECT product_name, {amt(P)} AS profit FROM sales GROUP BY product_name "
            "ORDER BY profit DESC, product_name LIMIT 10"),
        "eda07_ship_mode_counts": _with(
            "SELECT ship_mode, COUNT(*) AS orders FROM sales GROUP BY ship_mode"),
        "eda08_segment_revenue": total("segment"),
        "eda09_quarter_year_heatmap": _with(
            f"SELECT order_quarter, CAST(order_year AS VARCHAR) AS order_year, {amt(S)} AS sales "
            "FROM sales GROUP BY order_quarter, sales.order_year"),
        "eda10_year_category": _with(
            f"SELECT order_year, category, {amt(S)} AS sales FROM sales GROUP BY order_year, category"),
        "eda11_correlation_matrix": _with(cells, VALUED, f"x AS (SELECT {values} FROM valued)"),
        "eda12_overall_kpis": _with(
            f"SELECT {amt0(S)} AS total_revenue, {amt0(P)} AS total_profit, {pct1(P, S)} AS "
            "profit_margin FROM sales"),
        "eda13_category_margin": _with(
            f"SELECT category, {amt(S)} AS revenue, {amt(P)} AS profit, {pct1(P, S)} AS margin "
            "FROM sales GROUP BY category"),
        "eda14_q4_share": _with(
            f"SELECT {pct1('SUM(sales_c) FILTER (order_quarter = 4)', S)} AS q4_share_pct "
            "FROM sales"),
    }


# ---- answers ---------------------------------------------------------------

def _answers() -> dict[str, str]:
    region = f"g AS (SELECT region, {S} AS s, {P} AS p, {N} AS n, COUNT(DISTINCT customer_id) AS c " \
             "FROM sales GROUP BY region)"
    category = f"g AS (SELECT category, {S} AS s, {P} AS p, {N} AS n FROM sales GROUP BY category)"
    category_lines = (category, f"h AS (SELECT *, {pct1('p', 's')} AS margin, "
                                f"{pct1('s', '(SUM(s) OVER ())')} AS share FROM g)")
    by_region = _with(
        f"SELECT region, {amt('s')} AS total_revenue, n AS total_orders, {mean('s', 'n')} AS "
        "avg_order_value, CAST((s * 20) // (MAX(s) OVER ()) AS INTEGER) AS bar_length FROM g", region)
    band = f"g AS (SELECT discount_band, {N} AS n, {mean(M, N)} AS avg_margin, {mean(P, N)} AS " \
           f"avg_profit, {amt(S)} AS total_revenue FROM sales GROUP BY discount_band)"
    years = f"y AS (SELECT order_year, {S} AS s, {P} AS p, {N} AS n FROM sales GROUP BY order_year)"
    cells = f"q AS (SELECT order_year, order_quarter, {S} AS s FROM sales " \
            "GROUP BY order_year, order_quarter)"
    grid = "w AS (SELECT order_year, " + ", ".join(
        f"COALESCE(SUM(s) FILTER (order_quarter = {q}), 0) AS q{q}" for q in range(1, 5)) + \
        " FROM q GROUP BY order_year)"
    products = f"SELECT product_name, category, {amt(S)} AS total_sales, {amt(P)} AS total_profit, " \
               f"{N} AS orders, {mean(M, N)} AS avg_margin FROM sales GROUP BY product_name, category"
    modes = f"g AS (SELECT ship_mode, {N} AS n, AVG(days_to_ship) AS d, {S} AS s FROM sales " \
            "GROUP BY ship_mode)", f"h AS (SELECT *, {pct1('n', '(SUM(n) OVER ())')} AS share FROM g)"
    a, b = R.COMPARED

    def profit_by(key: str) -> str:
        return _with(f"SELECT {key}, {amt(P)} AS total_profit, {amt(S)} AS total_revenue, "
                     f"{pct1(P, S)} AS margin FROM sales GROUP BY {key}")

    def best(key: str) -> str:
        return f"(SELECT {key} FROM sales GROUP BY {key} ORDER BY {S} DESC, {key} LIMIT 1)"

    def average_rank(value: str) -> str:
        return (f"CAST(floor(rank() OVER (ORDER BY {value} DESC) + "
                f"(COUNT(*) OVER (PARTITION BY {value}) - 1) / 2) AS INTEGER)")

    def margin_where(test: str) -> str:
        return mean(f"SUM(margin_c) FILTER ({test})", f"COUNT(*) FILTER ({test})")

    return {
        "rpt_revenue_by_region": by_region,
        "intent_dispatch": by_region,
        "rpt_revenue_by_region_insight": _with(
            f"SELECT (SELECT region FROM g ORDER BY s DESC, region LIMIT 1) AS leader, "
            f"{amt('MAX(s)')} AS leader_revenue, (SELECT region FROM g ORDER BY s, region LIMIT 1) AS "
            f"laggard, {amt('MIN(s)')} AS laggard_revenue, {amt('(MAX(s) - MIN(s))')} AS gap FROM g",
            region),
        "rpt_revenue_by_category": _with(
            f"SELECT category, {amt('s')} AS total_revenue, {amt('p')} AS total_profit, n AS orders, "
            "margin, share FROM h", *category_lines),
        "rpt_revenue_by_category_insight": _with(
            "SELECT (SELECT category FROM h ORDER BY s DESC, category LIMIT 1) AS top_category, "
            "MAX(share) AS top_share, (SELECT category FROM h ORDER BY margin, category LIMIT 1) AS "
            "lowest_margin_category, MIN(margin) AS lowest_margin FROM h", *category_lines),
        "rpt_total_revenue": _with(
            f"SELECT {amt(S)} AS total_revenue, {amt(P)} AS total_profit, {pct(P, S)} AS "
            f"profit_margin, COUNT(*) AS total_orders, COUNT(DISTINCT customer_id) AS "
            f"unique_customers, {mean(S, N)} AS avg_order_value, CAST(MIN(order_date) AS VARCHAR) AS "
            "first_date, CAST(MAX(order_date) AS VARCHAR) AS last_date FROM sales"),
        "rpt_profit_by_category": profit_by("category"),
        "rpt_profit_by_region": profit_by("region"),
        "rpt_total_profit": _with(
            f"SELECT {amt('SUM(p)')} AS total_profit, {pct('SUM(p)', 'SUM(s)')} AS profit_margin, "
            "(SELECT order_year FROM y ORDER BY p DESC, order_year LIMIT 1) AS best_year FROM y",
            years),
        "rpt_top_customers": _with(
            f"SELECT customer_name, region, segment, {amt(S)} AS total_revenue, {amt(P)} AS "
            f"total_profit, {N} AS orders FROM sales GROUP BY customer_name, region, segment "
            "ORDER BY total_revenue DESC, customer_name, region, segment LIMIT 5"),
        "rpt_customer_segments": _with(
            f"SELECT segment, {amt(S)} AS revenue, {amt(P)} AS profit, {N} AS orders, "
            f"COUNT(DISTINCT customer_id) AS customers, {pct1(P, S)} AS margin, {mean_r(S, N, 0)} AS "
            f"aov, {hu(N, 'COUNT(DISTINCT customer_id)', 1)} AS orders_per_customer "
            "FROM sales GROUP BY segment"),
        "rpt_top_products": _with(
            f"{products} ORDER BY total_sales DESC, product_name, category LIMIT 10"),
        "rpt_bottom_products": _with(
            f"SELECT product_name, category, {amt(P)} AS total_profit, {amt(S)} AS total_sales, "
            f"{N} AS orders, CASE WHEN {P} < 0 THEN '[LOSS]' ELSE '' END AS flag FROM sales "
            "GROUP BY product_name, category ORDER BY total_profit, product_name, category LIMIT 10"),
        "rpt_product_margin": _with(
            f"{products} ORDER BY avg_margin DESC, product_name, category LIMIT 10"),
        "rpt_discount_impact": _with(
            "SELECT discount_band, n AS orders, avg_margin, avg_profit, total_revenue FROM g", band),
        "rpt_discount_impact_insight": _with(
            "SELECT *, no_discount_margin - very_high_margin AS margin_drop FROM (SELECT "
            "MAX(avg_margin) FILTER (discount_band = 'No Discount') AS no_discount_margin, "
            "MAX(avg_margin) FILTER (discount_band = 'Very High (>30%)') AS very_high_margin FROM g)",
            band),
        "rpt_revenue_trend": _with(
            "SELECT order_year, order_month, month_name, "
            f"{amt('s')} AS revenue, {amt('SUM(s) OVER (PARTITION BY order_year)')} AS year_total, "
            "CAST((s * 25) // (MAX(s) OVER ()) AS INTEGER) AS bar_length FROM (SELECT order_year, "
            f"order_month, MIN(order_month_name) AS month_name, {S} AS s FROM sales "
            "GROUP BY order_year, order_month)"),
        "rpt_revenue_trend_insight": _with(
            f"SELECT prev_year AS from_year, order_year AS to_year, {pct('(s - prev)', 'prev')} AS "
            "growth_pct FROM (SELECT *, lag(order_year) OVER w AS prev_year, lag(s) OVER w AS prev "
            "FROM y WINDOW w AS (ORDER BY order_year)) WHERE prev_year IS NOT NULL", years),
        "rpt_yearly_comparison": _with(
            f"SELECT order_year, {amt('s')} AS revenue, {amt('p')} AS profit, n AS orders, "
            f"{pct1('p', 's')} AS margin FROM y", years),
        "rpt_yearly_comparison_insight": _with(
            f"SELECT (SELECT order_year FROM y ORDER BY s DESC, order_year LIMIT 1) AS best_year, "
            f"{a} AS year_1, {b} AS year_2, {pct('(v.s - u.s)', 'u.s')} AS change_pct "
            f"FROM y u, y v WHERE u.order_year = {a} AND v.order_year = {b}", years),
        "rpt_quarterly": _with(
            "SELECT order_year, " + ", ".join(f"{amt(f'q{q}')} AS Q{q}" for q in range(1, 5))
            + f", CASE WHEN q1 > 0 THEN {pct('(q4 - q1)', 'q1')} END AS q4_vs_q1_pct FROM w",
            cells, grid),
        "rpt_quarterly_insight": _with(
            "SELECT *, (q4_avg - q1_avg) * 100.0 / q1_avg AS higher_pct FROM (SELECT "
            f"{mean('SUM(s) FILTER (order_quarter = 4)', 'COUNT(*) FILTER (order_quarter = 4)')} AS "
            f"q4_avg, {mean('SUM(s) FILTER (order_quarter = 1)', 'COUNT(*) FILTER (order_quarter = 1)')}"
            " AS q1_avg FROM q)", cells),
        "rpt_city": _with(
            f"SELECT city, region, {amt(S)} AS revenue, {N} AS orders, COUNT(DISTINCT customer_id) AS "
            "customers FROM sales GROUP BY city, region ORDER BY revenue DESC, city, region LIMIT 15"),
        "rpt_region_scorecard": _with(
            f"SELECT *, {average_rank('revenue')} AS rev_rank, {average_rank('margin')} AS mgn_rank "
            f"FROM (SELECT region, {amt('s')} AS revenue, {amt('p')} AS profit, n AS orders, "
            f"c AS customers, {mean('s', 'n')} AS aov, {pct1('p', 's')} AS margin FROM g)", region),
        "rpt_shipping": _with(
            f"SELECT ship_mode, n AS orders, d AS avg_days, {amt('s')} AS revenue, share FROM h",
            *modes),
        "rpt_shipping_insight": _with(
            "SELECT (SELECT ship_mode FROM h ORDER BY n DESC, ship_mode LIMIT 1) AS most_used, "
            "MAX(share) AS most_used_share, (SELECT ship_mode FROM h ORDER BY d, ship_mode LIMIT 1) "
            "AS fastest FROM h", *modes),
        "rpt_summary": _with(
            f"SELECT {amt(S)} AS total_revenue, {amt(P)} AS total_profit, {pct(P, S)} AS "
            "overall_margin, COUNT(*) AS total_orders, COUNT(DISTINCT customer_id) AS "
            "unique_customers, COUNT(DISTINCT product_name) AS products, "
            f"{best('region')} AS best_region, {best('category')} AS best_category, "
            f"{best('order_year')} AS best_year, {best('customer_name')} AS top_customer, "
            f"{pct(f'''SUM(sales_c) FILTER (category = '{R.CATEGORY}')''', S)} AS category_share, "
            f"{margin_where(f'''category = '{R.CATEGORY}' ''')} AS category_margin, "
            f"{pct('SUM(sales_c) FILTER (order_quarter = 4)', S)} AS q4_share, "
            f"{margin_where('discount_c = 0')} AS no_discount_margin, "
            f"{margin_where('discount_c > 30')} AS steep_discount_margin, "
            f"{margin_where(f'''region = '{R.REGION}' ''')} AS region_margin, "
            f"{pct(f'(SELECT SUM(s) FROM (SELECT {S} AS s FROM sales GROUP BY customer_name ORDER BY s DESC LIMIT 20))', S)}"
            " AS top_customers_share FROM sales"),
    }


# ---- question texts --------------------------------------------------------

def _questions() -> dict[str, str]:
    texts = ("WITH t AS (SELECT 'd' || CAST(doc_id AS VARCHAR) AS id, text FROM documents UNION ALL "
             "SELECT 'c' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS id, text "
             "FROM conversations)")
    words = "[" + ", ".join(f"'{w}'" for w in WORDS) + "]"

    def word(step: int) -> str:
        return f"{words}[1 + CAST(c_custkey * {step} % {len(WORDS)} AS INTEGER)]"

    def capitals(c: str) -> str:
        return f"array_to_string([upper(w[1]) || lower(w[2:]) FOR w IN string_split({c}, ' ')], ' ')"

    number = "CAST(c_custkey AS VARCHAR)"
    asked = texts[:-1] + (
        f" UNION ALL SELECT 'q' || {number} AS id, CASE c_custkey % 3 WHEN 0 THEN 'Top ' || {number} "
        "|| ' customers of ' || c_mktsegment || ' by profit in ' || CAST(2000 + c_nationkey AS VARCHAR) "
        f"|| ' and 2024' WHEN 1 THEN 'Show me ' || {word(1)} || ' of ' || c_mktsegment ELSE "
        f"{capitals(word(1))} || ' or ' || {word(7)} || ', top ' || {number} END AS text FROM customer)")
    points = ", ".join(
        "(" + " + ".join(f"CAST(contains(lower(text), '{w}') AS INTEGER)" for w in words)
        + f") AS s{i}" for i, words in enumerate(TOPICS.values()))
    scored = f", s AS (SELECT id, {points} FROM t)"
    top = "greatest(" + ", ".join(f"s{i}" for i in range(len(TOPICS))) + ")"
    named = " ".join(f"WHEN s{i} = top THEN '{t}'" for i, t in enumerate(TOPICS))
    tagged = f"SELECT id, CASE WHEN top = 0 THEN '{UNKNOWN}' {named} END AS intent " \
             f"FROM (SELECT *, {top} AS top FROM s)"
    points_table = " UNION ALL ".join(
        f"SELECT id, '{t}' AS intent, s{i} AS score FROM s WHERE s{i} > 0"
        for i, t in enumerate(TOPICS))
    found = f"regexp_extract_all(text, '{YEAR_PATTERN}')"
    return {
        "intent_tag": f"{asked}{scored} {tagged}",
        "intent_tag_texts": f"{texts}{scored} {tagged}",
        "intent_scores": f"{asked}{scored} {points_table}",
        "intent_scores_texts": f"{texts}{scored} {points_table}",
        "intent_volume": f"{asked}{scored} SELECT intent, COUNT(*) AS questions FROM ({tagged}) "
                         "GROUP BY intent",
        "extract_top_n": f"{asked} SELECT id, CAST(COALESCE(NULLIF(regexp_extract(lower(text), "
                         f"'{TOP_PATTERN}', 1), ''), '{DEFAULT_TOP}') AS BIGINT) AS n FROM t",
        "extract_years": f"{asked} SELECT id, COALESCE(array_to_string({found}, ','), '') AS years, "
                         f"CAST(COALESCE({found}[1], '0') AS INTEGER) AS year_1, "
                         f"CAST(COALESCE({found}[2], '0') AS INTEGER) AS year_2 FROM t",
    }


# ---- star, measures, dashboard --------------------------------------------

def _star() -> dict[str, str]:
    numbered_products = (
        "p AS (SELECT printf('PROD-%03d', row_number() OVER (ORDER BY product_name)) AS product_id, * "
        "FROM (SELECT product_name, MIN(category) AS category, round(AVG(unit_price), 2) AS "
        "avg_unit_price FROM sales GROUP BY product_name))")
    numbered_places = (
        "g AS (SELECT printf('GEO-%03d', row_number() OVER (ORDER BY region, city)) AS geo_id, * FROM "
        "(SELECT region, city, COUNT(*) AS order_count FROM sales GROUP BY region, city))")
    key = "CAST(strftime({0}, '%Y%m%d') AS INTEGER)"
    days = "d AS (SELECT CAST(unnest(generate_series(MIN(order_date), MAX(order_date), " \
           "INTERVAL 1 DAY)) AS DATE) AS date FROM sales)"
    orders = "COUNT(DISTINCT order_id)"
    high = "COUNT(DISTINCT CASE WHEN discount_c > 20 THEN order_id END)"
    months = f"""m AS (SELECT DISTINCT year(date) AS y, month(date) AS m,
        strftime(date, '%Y-%m') AS year_month FROM d),
      r AS (SELECT m.*, s, CAST(s AS DOUBLE) / 100 AS rev FROM m LEFT JOIN
        (SELECT order_year, order_month, {S} AS s FROM sales GROUP BY order_year, order_month)
        ON order_year = y AND order_month = m),
      b AS (SELECT r.*, py.rev AS prev_year, pm.rev AS prev_month FROM r
        LEFT JOIN r py ON py.y = r.y - 1 AND py.m = r.m
        LEFT JOIN r pm ON pm.y * 12 + pm.m = r.y * 12 + r.m - 1)"""

    def change(before: str) -> str:
        return f"COALESCE((COALESCE(rev, 0) - COALESCE({before}, 0)) / NULLIF({before}, 0), 0)"

    def line(expression: str, name: str) -> str:
        return _with(f"SELECT year_month, rev AS total_revenue, {expression} AS {name} FROM b",
                     days, months)

    looks = f"""total_revenue, {amt("SUM(s) OVER (PARTITION BY region, y ORDER BY m)")} AS revenue_ytd,
        prev_year AS revenue_prev_year, prev_month AS revenue_prev_month,
        {amt("SUM(s) OVER (PARTITION BY region ORDER BY y * 12 + m RANGE BETWEEN 2 PRECEDING AND CURRENT ROW)")}
        AS rolling_3m, {change("prev_year")} AS revenue_yoy, {change("prev_month")} AS revenue_mom"""
    line_columns = "CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month, year_month"

    def regional(where: str) -> str:
        """The month lines of each region, as ``months`` has them of all orders."""
        return f"""gm AS (SELECT region, m.* FROM (SELECT DISTINCT region FROM sales {where}) CROSS JOIN m),
      gr AS (SELECT gm.*, s, CAST(s AS DOUBLE) / 100 AS rev FROM gm LEFT JOIN
        (SELECT region, order_year, order_month, {S} AS s FROM sales {where} GROUP BY ALL) f
        ON f.region = gm.region AND order_year = y AND order_month = m),
      gb AS (SELECT gr.*, py.rev AS prev_year, pm.rev AS prev_month FROM gr
        LEFT JOIN gr py ON py.region = gr.region AND py.y = gr.y - 1 AND py.m = gr.m
        LEFT JOIN gr pm ON pm.region = gr.region AND pm.y * 12 + pm.m = gr.y * 12 + gr.m - 1)"""

    def time_lines(where: str) -> str:
        return _with(f"SELECT year, month, year_month, {looks_names} FROM (SELECT {line_columns}, {looks} FROM "
                     f"(SELECT *, rev AS total_revenue, 0 AS region FROM b)) {where}", days, months)

    looks_names = ("total_revenue, revenue_ytd, revenue_prev_year, revenue_prev_month, rolling_3m, "
                   "revenue_yoy, revenue_mom")
    sliced = f"WHERE order_year = {R.YEAR} AND region = '{R.REGION}' AND category = '{R.CATEGORY}'"
    paged = f"WHERE order_year = {R.YEAR} AND category = '{R.CATEGORY}'"

    def by(keys: str, columns: str, tail: str = "", where: str = "") -> str:
        return _with(f"SELECT {keys}, {columns} FROM sales {where} GROUP BY {keys} {tail}")

    def ranked(key: str, name: str, where: str = "") -> str:
        return _with(
            f"SELECT {key}, {amt('s')} AS total_revenue, CAST(dense_rank() OVER (ORDER BY s DESC) AS "
            f"{'INTEGER' if name == 'region_rank' else 'BIGINT'}) AS {name} FROM "
            f"(SELECT {key}, {S} AS s FROM sales {where} GROUP BY {key})")

    def top(key: str, n: int) -> str:
        return _with(
            f"SELECT {key}, {amt('s')} AS total_revenue FROM (SELECT {key}, {S} AS s, "
            f"rank() OVER (ORDER BY {S} DESC) AS place FROM sales GROUP BY {key}) WHERE place <= {n}")

    def product_table(where: str = "") -> str:
        return _with(
            f"SELECT product_name, category, {amt('s')} AS total_revenue, {amt('p')} AS total_profit, "
            f"{frac('p', 's')} AS profit_margin, dense_rank() OVER (ORDER BY s DESC) AS product_rank "
            f"FROM (SELECT product_name, category, {S} AS s, {P} AS p FROM sales {where} "
            "GROUP BY product_name, category)")

    revenue, profit = f"{amt(S)} AS total_revenue", f"{amt(P)} AS total_profit"
    margin, aov = f"{frac(P, S)} AS profit_margin", f"{frac(amt(S), orders)} AS avg_order_value"
    kpis = f"SELECT {revenue}, {profit}, {margin}, {orders} AS total_orders FROM sales"
    return {
        "dim_customer": _with(
            "SELECT customer_id, MIN(customer_name) AS customer_name, MIN(segment) AS segment, "
            "MIN(customer_tier) AS customer_tier, MIN(customer_ltv) AS customer_ltv, MIN(region) AS "
            "home_region, MIN(city) AS home_city, COUNT(*) AS total_orders FROM valued "
            "GROUP BY customer_id", VALUED),
        "dim_product": _with("SELECT * FROM p", numbered_products),
        "dim_geography": _with("SELECT * FROM g", numbered_places),
        "dim_date": _with(
            f"SELECT CAST(date AS VARCHAR) AS date, {key.format('date')} AS date_key, "
            "CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter, "
            "'Q' || CAST(quarter(date) AS VARCHAR) AS quarter_name, CAST(month(date) AS INTEGER) AS "
            "month, strftime(date, '%B') AS month_name, strftime(date, '%b') AS month_short, "
            "strftime(date, '%Y-%m') AS year_month, CAST(week(date) AS INTEGER) AS week, "
            "CAST(day(date) AS INTEGER) AS day, strftime(date, '%A') AS day_name, "
            "isodow(date) >= 6 AS is_weekend, quarter(date) = 4 AS is_festive_q FROM d", days),
        "fact_sales": _with(
            f"SELECT order_id, {key.format('order_date')} AS date_key, customer_id, product_id, geo_id,"
            " ship_mode, quantity, unit_price, discount, sales, profit, margin_c / 100 AS "
            "profit_margin, days_to_ship FROM sales JOIN p USING (product_name) "
            "JOIN g USING (region, city)", numbered_products, numbered_places),
        "m_total_revenue": by("region", revenue),
        "m_total_profit": by("category", profit),
        "m_total_orders": by("region", f"{orders} AS total_orders"),
        "m_total_quantity": by("ship_mode", "CAST(SUM(quantity) AS BIGINT) AS total_quantity"),
        "m_total_customers": _with(
            "SELECT order_year AS year, COUNT(DISTINCT customer_id) AS total_customers FROM sales "
            "GROUP BY order_year"),
        "m_avg_order_value": by("category", aov),
        "m_profit_margin": by("segment", margin),
        "m_avg_discount": by("category", f"{mean('SUM(discount_c)', N)} AS avg_discount"),
        "m_revenue_ytd": line(amt("SUM(s) OVER (PARTITION BY y ORDER BY m)"), "revenue_ytd"),
        "m_revenue_prev_year": line("prev_year", "revenue_prev_year"),
        "m_revenue_yoy": line(change("prev_year"), "revenue_yoy"),
        "m_revenue_prev_month": line("prev_month", "revenue_prev_month"),
        "m_revenue_mom": line(change("prev_month"), "revenue_mom"),
        "m_rolling_3m": line(
            amt("SUM(s) OVER (ORDER BY y * 12 + m RANGE BETWEEN 2 PRECEDING AND CURRENT ROW)"),
            "rolling_3m"),
        "m_customer_rank": ranked("customer_name", "customer_rank"),
        "m_product_rank": ranked("product_name", "product_rank"),
        "m_region_rank": ranked("region", "region_rank"),
        "m_time_year": time_lines(f"WHERE year = {R.YEAR}"),
        "m_time_month": time_lines(f"WHERE month = {R.MONTH}"),
        "m_time_by_region": _with(
            f"SELECT region, {line_columns}, {looks} FROM (SELECT *, rev AS total_revenue FROM gb)",
            days, months, regional(f"WHERE category = '{R.CATEGORY}'")),
        "m_customer_rank_slice": ranked("customer_name", "customer_rank", sliced),
        "m_product_rank_slice": ranked("product_name", "product_rank", sliced),
        "m_region_rank_slice": ranked("region", "region_rank", paged),
        "m_top20_slice": _with(
            f"SELECT {amt('SUM(s) FILTER (place <= 20)')} AS top20_revenue, "
            f"{amt('SUM(s) FILTER (place <= 20)')} / {amt('SUM(s)')} AS top20_contribution FROM "
            f"(SELECT customer_name, {S} AS s, rank() OVER (ORDER BY {S} DESC) AS place FROM sales "
            f"{sliced} GROUP BY customer_name)"),
        "m_segment_revenue_slice": by("region", ", ".join(
            f"{amt(f'''SUM(sales_c) FILTER (segment = '{s}')''')} AS {n}"
            for n, s in R.SEGMENTS.items()), where=paged),
        "m_revenue_cr": by("region", f"{amt(S)} / 10000000 AS revenue_cr"),
        "m_profit_l": by("region", f"{amt(P)} / 100000 AS profit_l"),
        "m_profit_margin_label": by(
            "product_name", f"printf('%.1f', {hu(f'{P} * 100', S, 1)}) || '%' AS profit_margin_label"),
        "m_high_discount_orders": by("segment", f"{high} AS high_discount_orders"),
        "m_high_discount_pct": _with(
            f"SELECT order_year AS year, {frac(high, orders)} AS high_discount_pct FROM sales "
            "GROUP BY order_year"),
        **{f"m_rev_{n}": by("category", revenue, where=f"WHERE segment = '{s}'") for n, s in
           zip(("consumer", "corporate", "home_office"), R.SEGMENTS.values())},
        "m_top20_revenue": _with(
            f"SELECT {amt('SUM(s)')} AS top20_revenue FROM (SELECT {S} AS s, rank() OVER "
            f"(ORDER BY {S} DESC) AS place FROM sales GROUP BY customer_name) WHERE place <= 20"),
        "m_segment_revenue": by("region", ", ".join(
            f"{amt(f'''SUM(sales_c) FILTER (segment = '{s}')''')} AS {n}"
            for n, s in R.SEGMENTS.items())),
        "m_top20_contribution": _with(
            f"SELECT {amt('SUM(s) FILTER (place <= 20)')} AS top20_revenue, "
            f"{amt('SUM(s) FILTER (place <= 20)')} / {amt('SUM(s)')} AS top20_contribution FROM "
            f"(SELECT customer_name, {S} AS s, rank() OVER (ORDER BY {S} DESC) AS place FROM sales "
            "GROUP BY customer_name)"),
        "dash_kpis": _with(kpis),
        "dash_kpis_year": _with(f"{kpis} WHERE order_year = {R.YEAR}"),
        "dash_trend": _with(
            f"SELECT order_year_month AS year_month, {revenue} FROM sales GROUP BY order_year_month"),
        "dash_category_bar": by("category", revenue),
        "dash_category_treemap": by("category", revenue),
        "dash_region_donut": by("region", revenue),
        "dash_city_map": by("region, city", revenue),
        "dash_region_compare": by("region", f"{revenue}, {profit}"),
        "dash_region_matrix": by("region", f"{revenue}, {profit}, {margin}, {aov}, CAST(dense_rank() "
                                           f"OVER (ORDER BY {S} DESC) AS INTEGER) AS region_rank"),
        "dash_region_aov": by("region", aov),
        "dash_top_products": top("product_name", 10),
        "dash_category_margin": by("category", margin),
        "dash_product_table": product_table(),
        "dash_segment_donut": by("segment", revenue),
        "dash_top_customers": top("customer_name", 15),
        "dash_discount_combo": _with(
            f"SELECT {CASE_BAND} AS discount_band, {orders} AS total_orders, {margin} FROM sales "
            "GROUP BY ALL"),
        "dash_tier_matrix": _with(
            f"SELECT customer_tier, COUNT(DISTINCT customer_id) AS total_customers, {revenue}, {aov} "
            "FROM valued GROUP BY customer_tier", VALUED),
        "dash_slice": by("segment", revenue, where=f"WHERE order_year = {R.YEAR} AND region = "
                                                   f"'{R.REGION}' AND category = '{R.CATEGORY}'"),
        "dash_drill_category": product_table(f"WHERE category = '{R.CATEGORY}'"),
    }


def statements() -> dict[str, str]:
    from . import oracle_cells, oracle_periods  # they build on this module

    own = {**_foundation(), **_business(), **_exploratory(), **_answers(), **_questions(), **_star()}
    return {**own, **oracle_periods.statements(), **oracle_cells.statements(own)}
