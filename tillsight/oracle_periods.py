"""SQL of the measures over days: every line joined to the orders of its days."""

from __future__ import annotations

from . import registry as R
from .oracle import _with, amt


def _calendar(where: str = "") -> str:
    """The days that ``where`` chooses, with the attributes lines are made of."""
    return f"""d AS (SELECT CAST(unnest(generate_series(min(order_date), max(order_date),
        INTERVAL 1 DAY)) AS DATE) AS date FROM sales),
      chosen AS (SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(weekofyear(date) AS INTEGER) AS week,
        dayname(date) AS day_name, strftime(date, '%Y-%m') AS year_month FROM d {where})"""


def _lines(by: str, others: str, where: str, orders: str = "") -> str:
    """Lines of the chosen days by date attributes ``by``; the orders by ``others``."""
    keys = ", ".join(c for c in (by, others) if c)
    of_line = f"GROUP BY {by}" if by else ""
    ends = f"ends AS (SELECT {by + ',' if by else ''} min(date) AS f, max(date) AS l FROM chosen {of_line})"
    same = "".join(f" AND c.{k.strip()} = e.{k.strip()}" for k in by.split(",") if k)
    own = "".join(f"e.{k.strip()}, " for k in by.split(",") if k)
    kinds = {
        "total_revenue": f"o.order_date IN (SELECT c.date FROM chosen c WHERE true{same})",
        "revenue_ytd": "o.order_date BETWEEN make_date(year(e.l), 1, 1) AND e.l",
        "revenue_prev_year": f"o.order_date IN (SELECT CAST(c.date - INTERVAL 1 YEAR AS DATE) FROM chosen c WHERE true{same})",
        "revenue_prev_month": "strftime(o.order_date, '%Y-%m') = strftime(e.f - INTERVAL 1 MONTH, '%Y-%m')",
        "rolling_3m": "o.order_date > CAST(e.l - INTERVAL 3 MONTH AS DATE) AND o.order_date <= e.l",
    }
    sums = ", ".join(f"SUM(s) FILTER ({test}) AS {name}" for name, test in kinds.items())
    some = " OR ".join(f"{name} IS NOT NULL" for name in kinds) if keys else "true"
    group = f"GROUP BY {keys}" if keys else ""

    def change(before: str) -> str:
        return f"COALESCE((COALESCE(total_revenue, 0) - COALESCE({before}, 0)) / NULLIF({before}, 0), 0)"

    return _with(
        f"SELECT {keys + ',' if keys else ''} {', '.join(f'{amt(k)} AS {k}' for k in kinds)}, "
        f"{change('revenue_prev_year')} AS revenue_yoy, {change('revenue_prev_month')} AS revenue_mom "
        f"FROM totals WHERE {some}",
        _calendar(where), ends,
        f"o AS (SELECT order_date, {others + ',' if others else ''} SUM(sales_c) AS s FROM sales {orders} GROUP BY ALL)",
        f"totals AS (SELECT {own}{others + ',' if others else ''} {sums} FROM ends e CROSS JOIN o {group})"
        .replace("GROUP BY " + keys, "GROUP BY ALL") if keys else
        f"totals AS (SELECT {sums} FROM ends e CROSS JOIN o)")


def _rolling(by: str = "", orders: str = "", where: str = "") -> str:
    """Every day and group beside the orders of the three months that end with it."""
    keys = f"{by}," if by else ""
    months = f"m AS (SELECT DISTINCT {keys} date_trunc('month', o.order_date) + to_months(k.k) AS month " \
             "FROM o CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS k) k)"
    lines = f"l AS (SELECT {'m.' + by + ',' if by else ''} d.date FROM m JOIN d ON date_trunc('month', d.date) = m.month)"
    same = f"AND o.{by} = l.{by}" if by else ""
    return _with(
        f"SELECT {'l.' + by + ',' if by else ''} CAST(l.date AS VARCHAR) AS date, "
        f"{amt('SUM(s) FILTER (o.order_date = l.date)')} AS total_revenue, {amt('SUM(s)')} AS rolling_3m "
        f"FROM l LEFT JOIN o ON o.order_date <= l.date AND o.order_date > CAST(l.date - INTERVAL 3 MONTH AS DATE) {same} "
        f"{where} GROUP BY ALL",
        _calendar(), f"o AS (SELECT {keys} order_date, SUM(sales_c) AS s FROM sales {orders} GROUP BY ALL)", months, lines)


def statements() -> dict[str, str]:
    week = f"WHERE year(date) = {R.YEAR} AND weekofyear(date) = {R.WEEK}"
    return {
        "m_rolling_3m_day": _rolling(),
        "m_rolling_3m_day_by_region": _rolling("region"),
        "m_rolling_3m_day_slice": _rolling("region", f"WHERE category = '{R.CATEGORY}'", f"WHERE year(l.date) = {R.YEAR}"),
        "m_period_week": _lines("", "", week),
        "m_period_week_by_region": _lines("", "region", week),
        "m_period_leap_day": _lines("", "segment", f"WHERE date = DATE '{R.LEAP_DAY}'"),
        "m_period_after_leap_year": _lines("", "", f"WHERE date = DATE '{R.AFTER_LEAP_YEAR}'"),
        "m_period_by_week": _lines("year, week", "", f"WHERE year(date) = {R.YEAR}"),
        "m_period_weekdays": _lines("day_name", "region", f"WHERE year(date) = {R.YEAR}", f"WHERE category = '{R.CATEGORY}'"),
    }
