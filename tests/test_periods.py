"""Measures over days against plain date arithmetic."""

from __future__ import annotations

import calendar
import datetime as dt
import random

import pytest
from conftest import values

from tillsight.operators import features
from tillsight.plans import periods, star
from tillsight.sources import workspace

DAYS = ["2023-11-29", "2023-11-30", "2023-12-01", "2023-12-31", "2024-01-30", "2024-01-31", "2024-02-28", "2024-02-29",
        "2024-03-01", "2024-03-31", "2024-04-29", "2024-04-30", "2024-05-29", "2024-05-30", "2024-05-31", "2024-06-01",
        "2025-02-27", "2025-02-28", "2025-03-01"]


def shifted(day, months):
    """The same day so many months on, or the last one that month has."""
    index = day.year * 12 + day.month - 1 + months
    year, month = index // 12, index % 12 + 1
    return dt.date(year, month, min(day.day, calendar.monthrange(year, month)[1]))


@pytest.fixture(scope="module")
def sold():
    draw = random.Random(7)
    return [(dt.date.fromisoformat(d), draw.choice(["North", "West"]), draw.choice(["A", "B"]), float(draw.randint(1, 99)))
            for d in DAYS for _ in range(3)]


@pytest.fixture(scope="module")
def small(spark, orders, sold):
    rows = orders(*[{"order_date": d, "ship_date": d, "region": r, "category": c, "product_name": c, "sales": s}
                    for d, r, c, s in sold])
    return star.write_star(features.with_features(rows), workspace.new_path(spark, "star"))


def total(sold, test):
    found = [s for d, r, c, s in sold if test(d, r, c)]
    return sum(found) if found else None


@pytest.mark.parametrize("by", [(), ("region",)])
def test_rolling_days_at_month_ends_and_leap_days(small, sold, by):
    got = {(r.date, r.region if by else None): (r.total_revenue, r.rolling_3m)
           for r in periods.rolling_by_day(small, by=by).collect()}
    day, last = min(d for d, *_ in sold), max(d for d, *_ in sold)
    while day <= last:
        for region in ("North", "West") if by else (None,):
            low = shifted(day, -3)
            expected = (total(sold, lambda d, r, c: d == day and region in (None, r)),
                        total(sold, lambda d, r, c: low < d <= day and region in (None, r)))
            assert got.pop((day, region), (None, None)) == expected, (day, region)
        day += dt.timedelta(1)
    assert not got


def test_conditions_on_days_pick_lines_and_others_orders(small, sold):
    got = periods.rolling_by_day(small, {"year_month": "2024-03", "category": "A"}).collect()
    assert {r.date.month for r in got} == {3} and len(got) == 31
    end = next(r for r in got if r.date == dt.date(2024, 3, 31))
    assert end.rolling_3m == total(sold, lambda d, r, c: c == "A" and dt.date(2023, 12, 31) < d <= dt.date(2024, 3, 31))
    with pytest.raises(ValueError):
        periods.rolling_by_day(small, by=("week",))


def of_days(sold, days, region=None):
    """What a line of the days shows."""
    def add(test):
        return total(sold, lambda d, r, c: test(d) and region in (None, r))

    first, last = min(days), max(days)
    before = shifted(first.replace(day=1), -1)
    now, year, month = add(days.__contains__), add({shifted(d, -12) for d in days}.__contains__), add(
        lambda d: (d.year, d.month) == (before.year, before.month))

    def growth(base):
        return ((now or 0) - base) / base if base else 0.0

    return (now, add(lambda d: d.year == last.year and d <= last), year, month,
            add(lambda d: shifted(last, -3) < d <= last), pytest.approx(growth(year)), pytest.approx(growth(month)))


@pytest.mark.parametrize("where, chosen", [
    ({"date": dt.date(2025, 2, 28)}, lambda d: d == dt.date(2025, 2, 28)),
    ({"date": dt.date(2024, 2, 29)}, lambda d: d == dt.date(2024, 2, 29)),
    ({"year": 2024, "week": 9}, lambda d: d.year == 2024 and d.isocalendar()[1] == 9),
    ({"year_month": ["2024-02", "2024-05"]}, lambda d: (d.year, d.month) in {(2024, 2), (2024, 5)}),
    ({"is_weekend": True}, lambda d: d.weekday() >= 5),
])
def test_any_choice_of_days(small, sold, where, chosen):
    first, last = min(d for d, *_ in sold), max(d for d, *_ in sold)
    days = {d for k in range((last - first).days + 1) if chosen(d := first + dt.timedelta(k))}
    assert values(periods.period_measures(small, where)) == [of_days(sold, days)]
    by_region = {r.region: tuple(r)[1:] for r in periods.period_measures(small, where, ("region",)).collect()}
    for region in ("North", "West"):
        expected = of_days(sold, days, region)
        assert by_region.get(region, (None,) * 5 + (0.0, 0.0)) == expected


def test_lines_of_single_days_look_back_each_on_their_own(small, sold):
    got = {r.date: tuple(r)[1:] for r in periods.period_measures(small, {"year": 2024}, ("date",)).collect()}
    day = dt.date(2024, 1, 1)
    while day.year == 2024:
        assert got.get(day, (None,) * 5 + (0.0, 0.0)) == of_days(sold, {day}), day
        day += dt.timedelta(1)


def test_no_day_chosen_gives_one_empty_line(small):
    assert values(periods.period_measures(small, {"year": 1900})) == [(None,) * 5 + (0.0, 0.0)]
    assert values(periods.period_measures(small, {"year": 1900}, ("region",))) == []


def test_no_task_holds_all_days_of_a_group(small):
    plan = periods.rolling_by_day(small, by=("region",))._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "_block" in plan.split("Window", 1)[1].split("\n")[0]
