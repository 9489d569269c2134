"""Report results on hand-made marts: ties and edge cases."""

import datetime as dt

from tripkit.plans import notebook as NB


def d(s):
    return dt.date.fromisoformat(s)


def test_kpis_ties_pick_first(spark):
    daily = spark.createDataFrame(
        [(d("2024-01-31"), 5, 10.0, 2.0, 1.0), (d("2024-02-01"), 3, 6.0, 4.0, 1.0),
         (d("2024-02-02"), 2, 4.0, 3.0, 1.0)],
        "pickup_date date, total_trips bigint, total_revenue double, avg_distance double, avg_tip_percentage double")
    hourly = spark.createDataFrame([(7, 10), (3, 10), (9, 4)], "pickup_hour int, total_trips bigint")
    zones = spark.createDataFrame([(12, 8, 5.0), (4, 8, 7.0), (30, 2, 7.0)],
                                  "pickup_zone bigint, total_trips bigint, total_revenue double")
    k = NB.nb_kpis(daily, hourly, zones).first()
    assert (k.total_trips, k.total_revenue, k.top_zone, k.peak_hour) == (10, 20.0, 4, 3)
    assert k.avg_trip_revenue == 2.0 and k.avg_distance == 3.0
    # Jan and Feb both have 5 trips: the earliest month wins
    assert NB.busiest_month(daily).first().month == "2024-01"
    # zones 4 and 30 tie on revenue: 4 comes first in the top-k order (more trips)
    assert NB.best_revenue_zone(zones).first().pickup_zone == 4


def test_long_trip_share_and_category_share(spark):
    cats = spark.createDataFrame(
        [("Longs trajets", "Weekend", 2, 10.0), ("Très longs trajets", "Jours de semaine", 3, 20.0),
         ("Courts trajets", "Weekend", 5, 4.0)],
        "distance_category string, day_type string, total_trips bigint, avg_revenue double")
    r = NB.long_trip_share(cats).first()
    assert (r.long_trips, r.total_trips, r.long_trip_pct) == (5, 10, 50.0)
    w = NB.weekend_vs_weekday(cats).first()
    assert (w.weekend_avg, w.weekday_avg, w.diff_pct) == (7.0, 20.0, -65.0)
    share = {x.distance_category: x.total_trips for x in NB.nb_category_share(cats).collect()}
    assert share == {"Longs trajets": 2, "Très longs trajets": 3, "Courts trajets": 5}


def test_date_options_and_evolution_default_range(spark):
    days = [(d("2024-01-01") + dt.timedelta(days=i), i, 0.0, 0.0, 0.0) for i in range(65)]
    daily = spark.createDataFrame(
        days, "pickup_date date, total_trips bigint, total_revenue double, avg_distance double, avg_tip_percentage double")
    opts = [r.pickup_date for r in NB.date_options(daily).orderBy("pickup_date").collect()]
    assert opts == [d("2024-01-01"), d("2024-01-31"), d("2024-03-01")]
    ev = NB.nb_evolution(daily, "total_trips").collect()
    # default range ends at the last option, not at the last day
    assert ev[0].pickup_date == d("2024-01-01") and ev[-1].pickup_date == d("2024-03-01") and len(ev) == 61
    ev2 = NB.nb_evolution(daily, "total_revenue", "2024-01-05", "2024-01-07").collect()
    assert [r.pickup_date.day for r in ev2] == [5, 6, 7]


def test_head_n_bounds(spark):
    import pytest
    z = spark.createDataFrame([(i, 100 - i) for i in range(1, 25)], "pickup_zone bigint, total_trips bigint")
    assert [r.pickup_zone for r in NB.head_n(z, 5).collect()] == [1, 2, 3, 4, 5]
    with pytest.raises(ValueError):
        NB.head_n(z, 21)
