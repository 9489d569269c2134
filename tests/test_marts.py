"""Staging and marts on the sf0.01 fixture: published expected values and invariants."""

import pytest
from pyspark.sql import functions as F

from tripkit.plans import dashboard as DB
from tripkit.plans import marts
from tripkit.plans.staging import clean_trips
from tripkit.sources.fixture import trips_view

from conftest import SF01


@pytest.fixture(scope="module")
def built(spark):
    t = trips_view(spark, SF01)
    c = clean_trips(t).cache()
    yield t, c
    c.unpersist()


def test_clean_trips_expected_values(built):
    _, c = built
    r = c.agg(F.count(F.lit(1)).alias("n"), F.sum("trip_duration_minutes").alias("dur"),
              F.count_if(F.col("trip_duration_minutes") == 0).alias("zero"),
              F.sum("pickup_hour").alias("h"), F.sum("pickup_day_of_week").alias("dow"),
              F.sum("avg_speed_mph").alias("speed"), F.sum("tip_percentage").alias("tip")).first()
    assert r.n == 54991 and r.dur == 2452300 and r.zero == 276
    assert r.h == 632074 and r.dow == 165968
    assert round(r.speed, 4) == 2366408.5074
    assert round(r.tip, 2) == 600962.77
    assert len(c.columns) == 27


def test_zone_ranks(built):
    _, c = built
    z = marts.zone_analysis(c)
    r = z.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("popularity_rank").alias("d"),
              F.max("popularity_rank").alias("mx"), F.min("popularity_rank").alias("mn")).first()
    assert (r.n, r.d, r.mx, r.mn) == (263, 68, 263, 1)


def test_category_counts(built):
    _, c = built
    got = {(r.distance_category, r.day_type): r.total_trips for r in marts.trip_categories(c).collect()}
    assert got[("Courts trajets", "Jours de semaine")] == 1431
    assert got[("Courts trajets", "Weekend")] == 581
    assert got[("Trajets moyens", "Jours de semaine")] == 6202
    assert got[("Trajets moyens", "Weekend")] == 2616
    assert got[("Longs trajets", "Jours de semaine")] == 7988
    assert got[("Longs trajets", "Weekend")] == 3101
    assert got[("Très longs trajets", "Jours de semaine")] == 23605
    assert got[("Très longs trajets", "Weekend")] == 9467


def test_mart_totals_agree(built):
    _, c = built
    n = c.count()
    for name, fn in marts.MARTS.items():
        assert fn(c).agg(F.sum("total_trips")).first()[0] == n, name


def test_dash_daily_and_complete_days(built):
    t, _ = built
    daily = DB.dash_daily(t)
    r = daily.agg(F.count(F.lit(1)).alias("days"), F.sum("total_trips").alias("trips"),
                  F.median("total_trips").alias("med")).first()
    assert (r.days, r.trips, r.med) == (1034, 25055, 24.0)
    kept = DB.complete_days(daily)
    assert r.days - kept.count() == 28


def test_treemap_total_is_sum_of_names(spark, built):
    from tripkit.sources.zones import zones_fixture
    t, _ = built
    tm = DB.zone_treemap(DB.dash_zones(t), zones_fixture(spark, SF01))
    total = tm.filter("is_total").first().total_trips
    assert total == tm.filter(~F.col("is_total")).agg(F.sum("total_trips")).first()[0]
    assert total == DB.dash_zones(t).agg(F.sum("total_trips")).first()[0]
