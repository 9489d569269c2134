"""Exploration steps on hand-made daily series and zones."""

import datetime as dt

from pyspark.sql import functions as F

from tripkit.plans import dashboard as DB
from tripkit.plans import notebook as NB

SCHEMA = ("pickup_date date, total_trips bigint, total_revenue double, avg_distance double, "
          "avg_fare double, avg_tip_pct double")


def days(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def d(s):
    return dt.date.fromisoformat(s)


def test_complete_days_median_after_cutoff(spark):
    rows = [(d("2025-10-27"), 100, 1.0, 1.0, 1.0, 1.0), (d("2025-10-28"), 10, 1.0, 1.0, 1.0, 1.0),
            (d("2025-10-29"), 40, 1.0, 1.0, 1.0, None), (d("2025-10-31"), 30, 1.0, 1.0, 1.0, 1.0),
            (d("2025-11-01"), 1000, 1.0, 1.0, 1.0, 1.0)]
    kept = DB.complete_days(days(spark, rows))
    # after the cut-off: 100, 10, 40, 30 -> median 35 -> keep >= 10.5
    assert sorted(r.total_trips for r in kept.collect()) == [30, 40, 100]


def test_weekly_profile_missing_weekday(spark):
    # Mon 2024-01-01 .. Sat 2024-01-06 only (no Sunday), Monday twice
    rows = [(d("2024-01-01"), 10, 0.0, 0.0, 0.0, 0.0), (d("2024-01-08"), 30, 0.0, 0.0, 0.0, 0.0)] + \
           [(d(f"2024-01-0{i}"), 10 * i, 0.0, 0.0, 0.0, 0.0) for i in range(2, 7)]
    w = DB.weekly_profile(days(spark, rows)).collect()
    assert [r.day_name for r in w] == ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday",
                                       "Saturday", "Sunday"]
    assert w[0].value == 20.0 and w[6].value is None and w[6].above_mean is False
    mean = (20 + 20 + 30 + 40 + 50 + 60) / 6
    assert abs(w[0].mean_value - mean) < 1e-9
    assert w[5].delta_pct == round((60 - mean) / mean * 100, 1)


def test_period_window_and_extremes(spark):
    rows = [(d("2024-01-01") + dt.timedelta(days=i), 5 + (i % 4), 0.0, 0.0, 0.0, 0.0) for i in range(400)]
    df = days(spark, rows)
    pw = DB.period_window(df, "6M", 0).first()
    assert pw.x_max == d("2025-02-03") and pw.x_min == d("2024-08-03") and pw.has_prev and not pw.has_next
    pw2 = DB.period_window(df, "6M", 3).first()
    assert pw2.x_min == d("2024-01-01") and not pw2.has_prev and pw2.has_next
    allw = DB.period_window(df, "Tout", 0).first()
    assert allw.x_min == d("2024-01-01") and not allw.has_prev
    ex = DB.period_extremes(df, "total_trips", "6M", 0).first()
    assert ex.best_value == 8.0 and ex.worst_value == 5.0
    # ties: the earliest date inside the window wins
    assert ex.best_date == d("2024-08-03") and ex.worst_date == d("2024-08-04")


def test_top_bottom_ties_keep_earliest(spark):
    rows = [(d("2024-01-01") + dt.timedelta(days=i), v, 0.0, 0.0, 0.0, 0.0)
            for i, v in enumerate([5, 9, 9, 1, 1, 7, 3, 9, 2, 2, 8, 4])]
    top = DB.top_days(days(spark, rows), "total_trips", 3).collect()
    assert [r.pickup_date.day for r in top] == [2, 3, 8]
    bot = DB.bottom_days(days(spark, rows), "total_trips", 3).collect()
    assert [r.pickup_date.day for r in bot] == [9, 4, 5]


def test_short_series_moving_average(spark):
    rows = [(d("2024-01-0%d" % i), i, 0.0, 0.0, 0.0, 0.0) for i in range(1, 5)]
    ev = DB.daily_evolution(days(spark, rows)).collect()
    assert [r.ma7 for r in ev] == [2.5, 2.5, 2.5, 2.5]


def test_zone_treemap_shared_names_null_and_unknown(spark):
    zones = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B")], "location_id bigint, zone_name string")
    top = spark.createDataFrame([(1, 10, 2.0), (2, 30, 4.0), (3, 5, 1.0), (999, 1, 9.0), (None, 4, 1.0)],
                                "zone_id bigint, total_trips bigint, avg_fare double")
    tm = {(r.node, r.is_total): r for r in DB.zone_treemap(top, zones).collect()}
    assert tm[("A", False)].total_trips == 40 and tm[("A", False)].avg_fare == 3.5
    assert tm[("999", False)].total_trips == 1
    assert tm[(None, False)].total_trips == 4
    assert tm[("NYC", True)].total_trips == 50 and tm[("NYC", True)].parent is None


def test_payment_split_and_portrait(spark):
    prof = spark.createDataFrame([(80.0, 2.0, 1.0)], "pct_carte double, pct_aeroport_jfk double, pct_aeroport_lga double")
    ps = DB.payment_split(prof).collect()
    assert [(r.mode, r.share) for r in ps] == [("Carte bancaire", 80.0), ("Espèces", 17.0), ("Autre", 3.0)]
    tp = DB.trip_portrait(prof).first()
    assert tp.pct_intra_ville == 97.0 and tp.pct_hors_carte == 20.0


def test_weekend_vs_weekday_absent_side(spark):
    cats = spark.createDataFrame([("Courts trajets", "Weekend", 3, 10.0)],
                                 "distance_category string, day_type string, total_trips bigint, avg_revenue double")
    assert NB.weekend_vs_weekday(cats).count() == 0


def test_metric_allow_list(spark):
    import pytest
    with pytest.raises(ValueError):
        DB.weekly_profile(days(spark, []), "fare_amount; drop table")


def test_upper_columns(spark):
    df = spark.createDataFrame([(1,)], "total_trips int")
    assert DB.upper_columns(df).columns == ["TOTAL_TRIPS"]
    assert df.select(F.col("TOTAL_TRIPS")).count() == 1


def test_payment_split_exact_sums_to_100(spark):
    from tripkit.sources.fixture import trips_view
    from conftest import SF001
    rows = DB.payment_split_exact(trips_view(spark, SF001)).collect()
    assert [r.mode for r in rows] == ["Carte bancaire", "Espèces", "Autre"]
    assert abs(sum(r.share for r in rows) - 100.0) < 1e-9
    card = DB.dash_profile(trips_view(spark, SF001)).first().pct_carte
    assert abs(rows[0].share - card) < 1e-12


def _settled(df):
    cols = sorted(df.columns)
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r)
                   for r in df.select(*cols).collect()), key=repr)


def test_dashboard_load_one_scan_equals_four_queries(spark, capsys):
    """The four dashboard queries from one GROUPING SETS scan equal the
    one-query forms (up to float rounding), on the whole window and on an
    empty one, and the plan scans the trips once."""
    import re

    from conftest import SF01
    from tripkit.session import materialize
    from tripkit.sources.raw import raw_trips

    t = raw_trips(spark, SF01)
    single = {"dash_daily": DB.dash_daily, "dash_hourly": DB.dash_hourly,
              "dash_zones": DB.dash_zones, "dash_profile": DB.dash_profile}
    for window in [(), ("2026-01-01", "2026-07-01"), ("1990-01-01", "1990-02-01")]:
        one = DB.dashboard_load(t, *window, materialize=materialize)
        for name, fn in single.items():
            sep = fn(t, *window)
            assert one[name].columns == sep.columns, name
            assert [f.dataType for f in one[name].schema] == [f.dataType for f in sep.schema], name
            assert _settled(one[name]) == _settled(sep), (name, window)
    empty = DB.dashboard_load(t, "1990-01-01", "1990-02-01")["dash_profile"].collect()
    assert len(empty) == 1 and empty[0].total_trips == 0 and empty[0].avg_fare is None
    capsys.readouterr()
    DB.dashboard_load(t)["dash_profile"].explain(mode="formatted")
    out = capsys.readouterr().out
    assert len(re.findall(r"^\(\d+\) Scan parquet", out, re.M)) == 1 and "Expand" in out
