"""Boundary rows for every derived column (hand-made inputs)."""

import datetime as dt

from pyspark.sql import functions as F

from tripkit.functions import derive as D
from tripkit.functions.dates import (clamp_dates, date_label, day_name, epoch_repair, iso_weekday, month_period,
                                    shift_months, to_epoch)


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_minute_difference_counts_boundaries(spark):
    df = spark.createDataFrame(
        [(ts("2024-01-01 10:00:59"), ts("2024-01-01 10:01:01")),
         (ts("2024-01-01 10:00:00"), ts("2024-01-01 10:00:59")),
         (ts("2024-01-01 23:59:59"), ts("2024-01-02 00:00:00")),
         (ts("1969-12-31 23:59:30"), ts("1970-01-01 00:00:30")),
         (ts("2024-01-01 10:05:00"), ts("2024-01-01 10:00:00"))],
        "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz")
    got = [r[0] for r in df.select(D.trip_duration_minutes()).collect()]
    assert got == [1, 0, 1, 1, -5]


def test_distance_category_edges(spark):
    vals = [0.1, 1.0, 1.005, 1.01, 5.0, 5.005, 5.01, 10.0, 10.01, 100.0, 100.01]
    df = spark.createDataFrame([(v,) for v in vals], "trip_distance double")
    got = [r[0] for r in df.select(D.distance_category()).collect()]
    assert got == ["Courts trajets", "Courts trajets", "Non défini", "Trajets moyens", "Trajets moyens",
                   "Non défini", "Longs trajets", "Longs trajets", "Très longs trajets",
                   "Très longs trajets", "Très longs trajets"]


def test_hour_buckets(spark):
    df = spark.createDataFrame([(h,) for h in range(24)], "pickup_hour int")
    rows = df.select("pickup_hour", D.time_period().alias("p"), D.tranche().alias("t")).collect()
    p = {r[0]: r[1] for r in rows}
    t = {r[0]: r[2] for r in rows}
    assert [p[h] for h in (5, 6, 9, 10, 15, 16, 19, 20, 23, 0)] == [
        "Nuit", "Rush Matinal", "Rush Matinal", "Journée", "Journée", "Rush Soir", "Rush Soir",
        "Soirée", "Soirée", "Nuit"]
    assert [t[h] for h in (0, 5, 6, 9, 10, 16, 17, 20, 21, 23)] == [
        "Nuit (0h-6h)", "Nuit (0h-6h)", "Matin (6h-10h)", "Matin (6h-10h)", "Journée (10h-17h)",
        "Journée (10h-17h)", "Soir (17h-21h)", "Soir (17h-21h)", "Soirée (21h-0h)", "Soirée (21h-0h)"]


def test_tip_measures(spark):
    df = spark.createDataFrame(
        [(1.0, 0.0), (1.0, -4.0), (None, 10.0), (1.0, None), (2.675, 100.0), (1.0, 3.0)],
        "tip_amount double, fare_amount double")
    rows = df.select(D.tip_percentage().alias("a"), D.tip_pct_nullif().alias("b")).collect()
    assert [r.a for r in rows] == [0.0, 0.0, None, 0.0, 2.68, 33.33]
    assert rows[0].b is None and rows[1].b == -25.0 and rows[2].b is None


def test_weekday_and_day_type(spark):
    # 2024-01-07 is a Sunday, 2024-01-06 a Saturday, 2024-01-08 a Monday
    df = spark.createDataFrame([(ts("2024-01-07 12:00:00"),), (ts("2024-01-06 12:00:00"),),
                                (ts("2024-01-08 12:00:00"),)], "tpep_pickup_datetime timestamp_ntz")
    rows = df.select(D.pickup_day_of_week().alias("dow"),
                     D.day_type(D.pickup_day_of_week()).alias("dt"),
                     iso_weekday(D.pickup_date()).alias("iso"),
                     day_name(D.pickup_date()).alias("name")).collect()
    assert [(r.dow, r.dt, r.iso, r.name) for r in rows] == [
        (0, "Weekend", 7, "Sunday"), (6, "Weekend", 6, "Saturday"), (1, "Jours de semaine", 1, "Monday")]


def test_speed_and_dates(spark):
    df = spark.createDataFrame([(7.3, 7), (3.0, 0), (3.0, -2)], "trip_distance double, m bigint")
    got = [r[0] for r in df.select(D.avg_speed_mph(minutes="m")).collect()]
    assert abs(got[0] - 62.5714285714) < 1e-9 and got[1] == 0.0 and got[2] == 0.0
    d = spark.createDataFrame([(dt.date(2024, 3, 31),)], "d date")
    r = d.select(shift_months("d", 1).alias("s"), month_period("d").alias("m"),
                 date_label("d").alias("l"), date_label("d", "MMM yyyy").alias("l2")).first()
    assert r.s == dt.date(2024, 2, 29) and r.m == "2024-03" and r.l == "31 Mar 2024" and r.l2 == "Mar 2024"


def test_clamp_dates(spark):
    lo, hi = dt.date(2024, 1, 10), dt.date(2024, 6, 30)
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 3, 15),), (dt.date(2025, 1, 1),), (None,)], "d date")
    got = [r.c for r in df.select(clamp_dates("d", F.lit(lo), F.lit(hi)).alias("c")).collect()]
    assert got == [lo, dt.date(2024, 3, 15), hi, None]


def test_epoch_repair_out_of_range_is_null(spark):
    df = spark.createDataFrame([(9_000_000_000_000_000_000,), (300_000_000_000,), (-1,), (None,)], "v bigint")
    rows = df.select(epoch_repair("v", "s").alias("s"), epoch_repair("v").alias("us")).collect()
    assert [r.s for r in rows] == [None, None, dt.datetime(1969, 12, 31, 23, 59, 59), None]
    assert rows[1].us == dt.datetime(1970, 1, 4, 11, 20) and rows[0].us is None


def test_epoch_repair_units(spark):
    df = spark.createDataFrame([(1704067200123456, 1704067200, 1704067200123)], "us bigint, s bigint, ms bigint")
    r = df.select(epoch_repair("us").alias("a"), epoch_repair("s", "s").alias("b"),
                  epoch_repair("ms", "ms").alias("c")).first()
    assert r.a == dt.datetime(2024, 1, 1, 0, 0, 0, 123456)
    assert r.b == dt.datetime(2024, 1, 1) and r.c == dt.datetime(2024, 1, 1, 0, 0, 0, 123000)
    back = df.select(to_epoch(epoch_repair("us")).alias("x")).first().x
    assert back == 1704067200123456


def test_zone_label_and_coalesce(spark):
    df = spark.createDataFrame([(5, None), (None, None), (7, "Astoria")], "z bigint, n string")
    rows = df.select(D.zone_label("z").alias("l"), D.coalesce_name("n", "z").alias("c")).collect()
    assert [(r.l, r.c) for r in rows] == [("Zone 5", "5"), (None, None), ("Zone 7", "Astoria")]
