"""Report and notebook results computed from the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import month_period
from ..functions.derive import LONG_CATEGORIES, WEEKDAYS, WEEKEND, zone_label
from ..functions.numeric import share_pct
from ..operators.aggregates import arg_max_first
from ..operators.filters import filter_selected_range
from ..operators.topk import top_k
from ..operators.windows import every_nth_row

NB_METRICS = ("total_trips", "total_revenue", "avg_distance", "avg_tip_percentage")


def report_top5_zones(zone_mart: DataFrame, k: int = 5) -> DataFrame:
    top = top_k(zone_mart.select("pickup_zone", "total_trips"), "total_trips", k, "pickup_zone")
    return top.withColumn("zone_label", zone_label("pickup_zone"))


def report_hourly(hourly_mart: DataFrame) -> DataFrame:
    return hourly_mart.select("pickup_hour", "total_trips").orderBy("pickup_hour")


def nb_daily(daily_mart: DataFrame) -> DataFrame:
    return daily_mart.select("pickup_date", "total_trips", "total_revenue", "avg_distance",
                             "avg_tip_percentage").orderBy("pickup_date")


def nb_hourly(hourly_mart: DataFrame) -> DataFrame:
    return hourly_mart.select("pickup_hour", "total_trips", "avg_revenue", "avg_speed",
                              "time_period").orderBy("pickup_hour")


def nb_zones20(zone_mart: DataFrame, k: int = 20) -> DataFrame:
    cols = ["pickup_zone", "total_trips", "total_revenue", "avg_distance", "popularity_rank"]
    return top_k(zone_mart.select(*cols), "total_trips", k, "pickup_zone")


def nb_categories(cat_mart: DataFrame) -> DataFrame:
    return cat_mart.select("distance_category", "day_type", "total_trips", "avg_revenue",
                           "avg_duration", "avg_speed") \
        .orderBy(F.col("total_trips").desc(), "distance_category", "day_type")


def date_options(daily: DataFrame, n: int = 30) -> DataFrame:
    """Every n-th date of the daily series (range-slider options)."""
    return every_nth_row(daily.select("pickup_date"), n, "pickup_date")


def nb_evolution(daily: DataFrame, metric: str = "total_trips", start=None, end=None,
                 n: int = 30) -> DataFrame:
    """Chosen metric of the daily series between start and end (inclusive).

    Defaults reproduce the slider's initial range: first to last option
    (the last option is the last n-th date, not necessarily the last day).
    """
    if metric not in NB_METRICS:
        raise ValueError(f"metric must be one of {NB_METRICS}")
    if start is None or end is None:
        # First option = first date; last option = the date at row
        # 1 + n*floor((rows-1)/n). Whole-series windows over the daily rows
        # (bounded by the calendar) keep this in the same plan as the series;
        # a scalar subquery would run the mart's aggregation a second time.
        whole = Window.partitionBy()
        rn = F.row_number().over(Window.orderBy("pickup_date"))
        daily = daily.withColumn("_rn", rn).withColumn("_rows", F.count(F.lit(1)).over(whole))
        last_rn = F.lit(1) + F.floor((F.col("_rows") - 1) / n) * n
        daily = daily.withColumn("_lo", F.min("pickup_date").over(whole)) \
            .withColumn("_hi", F.max(F.when(F.col("_rn") == last_rn, F.col("pickup_date"))).over(whole))
        start = F.col("_lo") if start is None else start
        end = F.col("_hi") if end is None else end
    sel = filter_selected_range(daily, start, end)
    return sel.select("pickup_date", F.col(metric).cast("double").alias("value")).orderBy("pickup_date")


def head_n(zones20: DataFrame, n: int = 10) -> DataFrame:
    if not 5 <= n <= 20:
        raise ValueError("n must be between 5 and 20")
    return top_k(zones20, "total_trips", n, "pickup_zone").withColumn("zone_label", zone_label("pickup_zone"))


def nb_category_share(cat_mart: DataFrame) -> DataFrame:
    return cat_mart.groupBy("distance_category").agg(F.sum("total_trips").cast("bigint").alias("total_trips"))


def nb_kpis(daily: DataFrame, hourly: DataFrame, zones20: DataFrame) -> DataFrame:
    trips, rev = F.sum("total_trips"), F.sum("total_revenue")
    top_zone = zones20.select(arg_max_first("pickup_zone", "total_trips", "pickup_zone")).scalar()
    peak_hour = hourly.select(arg_max_first("pickup_hour", "total_trips", "pickup_hour")).scalar()
    return daily.agg(
        trips.cast("bigint").alias("total_trips"),
        rev.alias("total_revenue"),
        (rev / F.nullif(trips.cast("double"), F.lit(0.0))).alias("avg_trip_revenue"),
        F.avg("avg_distance").alias("avg_distance"),
    ).select("*", top_zone.alias("top_zone"), peak_hour.alias("peak_hour"))


def busiest_month(daily: DataFrame) -> DataFrame:
    monthly = daily.groupBy(month_period("pickup_date").alias("month")) \
        .agg(F.sum("total_trips").cast("bigint").alias("total_trips"))
    return monthly.agg(arg_max_first("month", "total_trips", "month").alias("month"),
                       F.max("total_trips").alias("total_trips"))


def best_revenue_zone(zones20: DataFrame) -> DataFrame:
    """Highest total_revenue among the top-20 zones by trips (ties: top-20 order)."""
    w = zones20.select("pickup_zone", "total_revenue", "total_trips")
    best = F.max_by(F.col("pickup_zone"),
                    F.when(F.col("total_revenue").isNotNull(),
                           F.struct("total_revenue", "total_trips", -F.col("pickup_zone"))))
    return w.agg(best.alias("pickup_zone"), F.max("total_revenue").alias("total_revenue"))


def long_trip_share(cat_mart: DataFrame, long_categories=LONG_CATEGORIES) -> DataFrame:
    is_long = F.col("distance_category").isin(list(long_categories))
    long_n = F.sum(F.when(is_long, F.col("total_trips")).otherwise(F.lit(0))).cast("bigint")
    all_n = F.sum("total_trips").cast("bigint")
    return cat_mart.agg(long_n.alias("long_trips"), all_n.alias("total_trips"),
                        share_pct(long_n, all_n).alias("long_trip_pct"))


def weekend_vs_weekday(cat_mart: DataFrame) -> DataFrame:
    """Unweighted mean over categories of avg_revenue, weekend vs weekdays;
    no row when either side has no category."""
    we = F.avg(F.when(F.col("day_type") == WEEKEND, F.col("avg_revenue")))
    wd = F.avg(F.when(F.col("day_type") == WEEKDAYS, F.col("avg_revenue")))
    n_we = F.count_if(F.col("day_type") == WEEKEND)
    n_wd = F.count_if(F.col("day_type") == WEEKDAYS)
    out = cat_mart.agg(we.alias("weekend_avg"), wd.alias("weekday_avg"),
                       n_we.alias("_nwe"), n_wd.alias("_nwd"))
    return out.filter((F.col("_nwe") > 0) & (F.col("_nwd") > 0)).select(
        "weekend_avg", "weekday_avg",
        ((F.col("weekend_avg") - F.col("weekday_avg")) / F.col("weekday_avg") * 100).alias("diff_pct"))
