"""Exploration operators on a two-week series whose results are worked out by hand."""

import datetime as dt

import pytest

from tripkit.plans import dashboard as DB

SCHEMA = ("pickup_date date, total_trips bigint, total_revenue double, avg_distance double, "
          "avg_fare double, avg_tip_pct double")
MONDAY = dt.date(2024, 1, 1)
# trips of 14 days from a Monday on; the second Sunday is far under 30 % of the median
TRIPS = [10, 20, 30, 40, 50, 60, 70, 20, 30, 40, 50, 60, 70, 5]
# every metric is a multiple of the trips, so its results are too
FACTOR = {"total_trips": 1.0, "total_revenue": 10.0, "avg_distance": 0.5, "avg_fare": 2.0, "avg_tip_pct": 0.25}


def day(k):
    return MONDAY + dt.timedelta(days=k)


@pytest.fixture(scope="module")
def daily(spark):
    rows = [(day(k), n, *[n * FACTOR[c] for c in ("total_revenue", "avg_distance", "avg_fare", "avg_tip_pct")]) for k, n in enumerate(TRIPS)]
    late = [(dt.date(2025, 11, 1), 10_000, 1.0, 1.0, 1.0, 1.0)]  # after the last day of the dashboards
    return spark.createDataFrame(rows + late, SCHEMA)


def test_complete_days(daily):
    # median of the 14 counts: 40, so days under 12 go: the first Monday (10) and the last Sunday (5)
    kept = sorted(r.pickup_date for r in DB.complete_days(daily).collect())
    assert kept == [day(k) for k in range(1, 13)]


@pytest.mark.parametrize("metric", list(DB.METRICS))
def test_weekly_profile(daily, metric):
    f = FACTOR[metric]
    got = DB.weekly_profile(DB.complete_days(daily), metric).collect()
    # Monday 20; Tuesday (20 + 30) / 2; ... Saturday (60 + 70) / 2; Sunday 70; their mean 320 / 7
    assert [r.value / f for r in got] == [20, 25, 35, 45, 55, 65, 70]
    assert all(abs(r.mean_value / f - 315 / 7) < 1e-9 for r in got)
    assert [r.above_mean for r in got] == [False, False, False, True, True, True, True]
    assert [r.delta_pct for r in got] == [-55.6, -44.4, -22.2, 0.0, 22.2, 44.4, 55.6]
    assert [r.day_name for r in got][::6] == ["Monday", "Sunday"]


@pytest.mark.parametrize("metric", list(DB.METRICS))
def test_moving_mean_top_and_bottom(daily, metric):
    f = FACTOR[metric]
    days = DB.complete_days(daily)
    got = DB.daily_evolution(days, metric).collect()
    # 20 30 40 50 60 70 20 30 40 50 60 70: four values at the ends, seven within
    assert got[0].ma7 / f == 35 and got[1].ma7 / f == 40 and got[-1].ma7 / f == 55
    assert abs(got[3].ma7 / f - 290 / 7) < 1e-9 and abs(got[6].ma7 / f - 320 / 7) < 1e-9
    # three largest: 70, 70 and, of two days with 60, the earlier; shown from the smallest up
    assert [(r.pickup_date, r.value / f) for r in DB.top_days(days, metric, 3).collect()] == [(day(5), 60), (day(6), 70), (day(12), 70)]
    # three smallest: 20, 20 and the earlier day with 30; shown from the largest down
    assert [(r.pickup_date, r.value / f) for r in DB.bottom_days(days, metric, 3).collect()] == [(day(2), 30), (day(1), 20), (day(7), 20)]
    best = DB.period_extremes(days, metric, "Tout", 0).first()
    assert (best.best_date, best.worst_date) == (day(6), day(1)) and (best.best_value / f, best.worst_value / f) == (70, 20)


def test_period_windows(spark):
    ends = [(dt.date(2024, 1, 31), 1), (dt.date(2025, 3, 31), 2)]
    days = spark.createDataFrame(ends, "pickup_date date, total_trips bigint")
    expected = {("1M", 0): ("2025-02-28", "2025-03-31", True, False), ("1M", 1): ("2025-01-28", "2025-02-28", True, True),
                ("3M", 1): ("2024-09-30", "2024-12-31", True, True), ("6M", 2): ("2024-01-31", "2024-03-31", False, True),
                ("1A", 0): ("2024-03-31", "2025-03-31", True, False), ("Tout", 0): ("2024-01-31", "2025-03-31", False, False)}
    for (period, page), (low, high, back, forward) in expected.items():
        r = DB.period_window(days, period, page).first()
        assert (str(r.x_min), str(r.x_max), r.has_prev, r.has_next) == (low, high, back, forward), (period, page)
