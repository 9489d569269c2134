"""Registered result tables: name -> fn(spark, sf_dir) -> DataFrame.

Every entry reads the driver tables through the ``trips`` fixture (or a
table Spark derives from them), so its work grows with the data. The marts'
and the dashboard's base tables have exact sums and are returned as they are.
What is computed from their means is settled to 4 decimals (half-up through
DECIMAL(38,9)), because those few sums depend on addition order.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import derive as D
from ..functions.dates import date_label, day_name, month_period, shift_months
from ..functions.numeric import dec_round
from ..operators import filters as FL
from ..operators.medians import grouped_median
from ..operators.series import every_nth, moving_mean, value_rank
from ..operators.expect import row_check_aggregates, run_tests
from ..session import materialize
from ..sources.months import month_manifest, month_range, skip_loaded_months
from ..sources.parquet import copy_by_name, infer_glob_schema, infer_schema, scan_parquet_glob
from ..sources.fixture import joined_lines, table_path, trip_seconds
from ..sources.raw import build_once, raw_root, raw_trips
from ..sources.schema import TRIPS, TRIPS_NAMES
from ..sources.zonemap import scan_window, zone_map
from ..sources.zones import zones_fixture
from . import dashboard as DB
from . import load_queries as LQ
from . import marts
from . import notebook as NB
from . import quality as Q
from .staging import clean_trips

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def settle(df: DataFrame, scale: int = 4) -> DataFrame:
    """Round every DOUBLE column half-up to ``scale`` decimals."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            cols.append(dec_round(F.col(f.name), scale).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def register(name: str, settled: bool = True):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = fn(spark, sf_dir)
            return settle(out) if settled else out
        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return fn
    return deco


def _clean(spark, sf_dir):
    return clean_trips(_trips(spark, sf_dir))


def _trips(spark, sf_dir):
    """The RAW table for ``sf_dir``: written once by Spark from the fixture,
    then read by every query."""
    return raw_trips(spark, sf_dir)


def _by_day(spark, sf_dir):
    """The RAW table with the pickup day, which date windows prune on."""
    return raw_trips(spark, sf_dir, with_day=True)


@register("daily_summary", settled=False)
def q_daily_summary(spark, sf_dir):
    """Per pickup date: trips, mean distance, revenue sum and mean, mean tip %."""
    return marts.daily_summary(_clean(spark, sf_dir)).orderBy("pickup_date")


# --- marts ---------------------------------------------------------------


@register("clean_trips", settled=False)
def q_clean_trips(spark, sf_dir):
    """Staging table: four filters, eight derived columns."""
    return _clean(spark, sf_dir)


@register("zone_analysis", settled=False)
def q_zone_analysis(spark, sf_dir):
    return marts.zone_analysis(_clean(spark, sf_dir)).orderBy(F.col("total_trips").desc(), "pickup_zone")


@register("hourly_patterns", settled=False)
def q_hourly_patterns(spark, sf_dir):
    return marts.hourly_patterns(_clean(spark, sf_dir)).orderBy("pickup_hour")


@register("trip_categories", settled=False)
def q_trip_categories(spark, sf_dir):
    return marts.trip_categories(_clean(spark, sf_dir)).orderBy(F.col("total_trips").desc())


# --- RAW table, filters and per-trip expressions ---------------------------

@register("trips_raw", settled=False)
def q_trips_raw(spark, sf_dir):
    """The RAW table: the fixture scan conformed by name to the fixed schema."""
    return copy_by_name(_trips(spark, sf_dir))


def _filter_query(name, fn):
    @register(name, settled=False)
    def q(spark, sf_dir):
        return fn(_trips(spark, sf_dir))
    q.__doc__ = fn.__doc__
    return q


for _name, _fn in [
    ("filter_nonneg_amounts", FL.filter_nonneg_amounts),
    ("filter_ordered_times", FL.filter_ordered_times),
    ("filter_distance_range", FL.filter_distance_range),
    ("filter_zones_present", FL.filter_zones_present),
    ("filter_positive_distance", FL.filter_positive_distance),
    ("filter_positive_total", FL.filter_positive_total),
    ("any_null", FL.filter_any_null),
]:
    _filter_query(_name, _fn)


@register("filter_date_window", settled=False)
def q_filter_date_window(spark, sf_dir):
    return FL.filter_date_window(_by_day(spark, sf_dir)).select(*TRIPS_NAMES)


@register("trip_features", settled=False)
def q_trip_features(spark, sf_dir):
    """Every per-trip scalar expression on the whole RAW table."""
    t = _trips(spark, sf_dir)
    dur = D.trip_duration_minutes()
    d = D.pickup_date()
    return t.select(
        D.PICKUP, D.DROPOFF, "pulocationid", "trip_distance", "fare_amount", "tip_amount",
        dur.alias("trip_duration_minutes"),
        D.pickup_hour().alias("pickup_hour"),
        D.pickup_day_of_week().alias("pickup_day_of_week"),
        D.pickup_month().alias("pickup_month"),
        d.alias("pickup_date"),
        D.avg_speed_mph(minutes=dur).alias("avg_speed_mph"),
        D.tip_percentage().alias("tip_percentage"),
        D.tip_pct_nullif().alias("tip_pct_nullif"),
        D.distance_category().alias("distance_category"),
        D.day_type(D.pickup_day_of_week()).alias("day_type"),
        D.time_period(D.pickup_hour()).alias("time_period"),
        D.tranche(D.pickup_hour()).alias("tranche"),
        day_name(d).alias("day_name"),
        month_period(d).alias("month_period"),
        date_label(d, "d MMM yyyy").alias("date_label"),
        shift_months(d, 1).alias("date_minus_1m"),
        D.zone_label("pulocationid").alias("zone_label"),
        D.coalesce_name(F.lit(None).cast("string"), "pulocationid").alias("zone_name"),
    )


@register("epoch_repair", settled=False)
def q_epoch_repair(spark, sf_dir):
    """Trips whose timestamps arrive as BIGINT microseconds (counted here from
    the order's day and the trip's seconds), repaired by the by-name load."""
    day = F.unix_date((F.col("o_orderdate") + F.expr("INTERVAL '28' YEAR")).cast("date")).cast("bigint")
    pickup, length = trip_seconds()
    arrived = joined_lines(spark, sf_dir).select(((day * 86_400 + pickup) * 1_000_000).alias("TPEP_PICKUP_DATETIME"),
                            ((day * 86_400 + pickup + length) * 1_000_000).alias("TPEP_DROPOFF_DATETIME"))
    times = T.StructType([f for f in TRIPS.fields if f.name in (D.PICKUP, D.DROPOFF)])
    raw = arrived.withColumns({"pickup_us": F.col("TPEP_PICKUP_DATETIME"), "dropoff_us": F.col("TPEP_DROPOFF_DATETIME")})
    return copy_by_name(raw, times, keep=("pickup_us", "dropoff_us"))


# --- dashboard -------------------------------------------------------------

# Part of the key of the stored tables: raise it when ``dashboard_load`` changes.
DASH_VERSION = 2


def dash_tables(spark, sf_dir, rebuild=False) -> str:
    """The folder of the dashboard's four base aggregates, from one scan of
    RAW; stored once per input and read by every exploration step."""
    def write(folder):
        for name, df in DB.dashboard_load(_by_day(spark, sf_dir), materialize=materialize).items():
            df.write.parquet(f"{folder}/{name}")

    return build_once(spark, f"{raw_root(spark, sf_dir)}/dashboard{DASH_VERSION}", write, rebuild)


def _dash(spark, sf_dir, which: str):
    """One of the four stored base aggregates."""
    fn = {"daily": DB.dash_daily, "hourly": DB.dash_hourly, "zones": DB.dash_zones,
          "profile": DB.dash_profile}[which]
    folder = dash_tables(spark, sf_dir)
    # the schema is known without opening a file
    return spark.read.schema(fn(_by_day(spark, sf_dir)).schema).parquet(f"{folder}/dash_{which}")


def _days(spark, sf_dir):
    return DB.complete_days(_dash(spark, sf_dir, "daily"))


@register("dash_daily", settled=False)
def q_dash_daily(spark, sf_dir):
    return DB.dash_daily(_by_day(spark, sf_dir)).orderBy("pickup_date")


@register("dash_hourly", settled=False)
def q_dash_hourly(spark, sf_dir):
    return DB.dash_hourly(_by_day(spark, sf_dir)).orderBy("pickup_hour")


@register("dash_zones", settled=False)
def q_dash_zones(spark, sf_dir):
    return DB.dash_zones(_by_day(spark, sf_dir))


@register("dash_profile", settled=False)
def q_dash_profile(spark, sf_dir):
    return DB.dash_profile(_by_day(spark, sf_dir))


@register("complete_days")
def q_complete_days(spark, sf_dir):
    return _days(spark, sf_dir).orderBy("pickup_date")


@register("coverage_caption")
def q_coverage_caption(spark, sf_dir):
    return DB.coverage_caption(_days(spark, sf_dir))


@register("kpis")
def q_kpis(spark, sf_dir):
    return DB.kpis(_days(spark, sf_dir))


@register("weekly_profile")
def q_weekly_profile(spark, sf_dir):
    return DB.weekly_profile(_days(spark, sf_dir), "total_trips")


@register("hourly_metric")
def q_hourly_metric(spark, sf_dir):
    return DB.hourly_metric(_dash(spark, sf_dir, "hourly"), "total_trips")


@register("daily_evolution")
def q_daily_evolution(spark, sf_dir):
    """Daily metric with its centred 7-row moving mean (moving_avg_7)."""
    return DB.daily_evolution(_days(spark, sf_dir), "total_trips")


@register("period_window")
def q_period_window(spark, sf_dir):
    return DB.period_window(_days(spark, sf_dir), "6M", 0)


@register("period_extremes")
def q_period_extremes(spark, sf_dir):
    return DB.period_extremes(_days(spark, sf_dir), "total_trips", "6M", 0)


@register("top10_days")
def q_top10_days(spark, sf_dir):
    return DB.top_days(_days(spark, sf_dir), "total_trips", 10)


@register("bottom10_days")
def q_bottom10_days(spark, sf_dir):
    return DB.bottom_days(_days(spark, sf_dir), "total_trips", 10)


@register("zone_name_lookup")
def q_zone_name_lookup(spark, sf_dir):
    return DB.zones_named(_dash(spark, sf_dir, "zones"), zones_fixture(spark, sf_dir))


@register("zone_treemap")
def q_zone_treemap(spark, sf_dir):
    return DB.zone_treemap(_dash(spark, sf_dir, "zones"), zones_fixture(spark, sf_dir))


@register("trip_portrait")
def q_trip_portrait(spark, sf_dir):
    return DB.trip_portrait(_dash(spark, sf_dir, "profile"))


@register("payment_split")
def q_payment_split(spark, sf_dir):
    return DB.payment_split(_dash(spark, sf_dir, "profile"))


@register("payment_split_exact")
def q_payment_split_exact(spark, sf_dir):
    return DB.payment_split_exact(_by_day(spark, sf_dir))


# --- dashboard, every value of its parameters ---------------------------------

def _each(fn, values):
    return LQ.union(fn(v) for v in values)


@register("weekly_profile_metrics")
def q_weekly_profile_metrics(spark, sf_dir):
    days = _days(spark, sf_dir)
    return _each(lambda m: DB.weekly_profile(days, m), DB.METRICS)


@register("hourly_metric_metrics")
def q_hourly_metric_metrics(spark, sf_dir):
    hours = _dash(spark, sf_dir, "hourly")
    return _each(lambda m: DB.hourly_metric(hours, m).withColumn("metric", F.lit(m)), DB.METRICS)


@register("daily_evolution_metrics")
def q_daily_evolution_metrics(spark, sf_dir):
    days = _days(spark, sf_dir)
    return _each(lambda m: DB.daily_evolution(days, m).withColumn("metric", F.lit(m)), DB.METRICS)


@register("period_window_pages")
def q_period_window_pages(spark, sf_dir):
    days = _days(spark, sf_dir)
    return _each(lambda p: DB.period_window(days, *p), [(p, k) for p in DB.PERIODS for k in range(3)])


@register("period_extremes_metrics")
def q_period_extremes_metrics(spark, sf_dir):
    """Best and worst day of every metric, in the second page of three months."""
    days = _days(spark, sf_dir)
    return _each(lambda m: DB.period_extremes(days, m, "3M", 1).withColumn("metric", F.lit(m)), DB.METRICS)


@register("top_bottom_days_metrics")
def q_top_bottom_days_metrics(spark, sf_dir):
    days = _days(spark, sf_dir)
    return _each(lambda m: DB.top_days(days, m, 10).withColumn("side", F.lit("top"))
                 .unionByName(DB.bottom_days(days, m, 10).withColumn("side", F.lit("bottom"))).withColumn("metric", F.lit(m)), DB.METRICS)


# --- quality -----------------------------------------------------------------

@register("dq_summary")
def q_dq_summary(spark, sf_dir):
    return Q.dq_summary(_trips(spark, sf_dir))


@register("dq_clean_estimate")
def q_dq_clean_estimate(spark, sf_dir):
    return Q.dq_clean_estimate(Q.dq_summary(_trips(spark, sf_dir)))


@register("dq_report")
def q_dq_report(spark, sf_dir):
    return Q.dq_report(Q.dq_summary(_trips(spark, sf_dir)))


@register("dq_overview")
def q_dq_overview(spark, sf_dir):
    return Q.dq_overview(_trips(spark, sf_dir))


# --- report and notebook -----------------------------------------------------

def _marts(spark, sf_dir, clean=None):
    """All four marts from one scan of the staging rows, written once."""
    c = _clean(spark, sf_dir) if clean is None else clean
    return marts.all_marts(c, materialize)


@register("report_top5_zones")
def q_report_top5_zones(spark, sf_dir):
    return NB.report_top5_zones(marts.zone_analysis(_clean(spark, sf_dir)))


@register("report_hourly")
def q_report_hourly(spark, sf_dir):
    return NB.report_hourly(marts.hourly_patterns(_clean(spark, sf_dir)))


@register("nb_daily")
def q_nb_daily(spark, sf_dir):
    return NB.nb_daily(marts.daily_summary(_clean(spark, sf_dir)))


@register("nb_hourly")
def q_nb_hourly(spark, sf_dir):
    return NB.nb_hourly(marts.hourly_patterns(_clean(spark, sf_dir)))


@register("nb_zones20")
def q_nb_zones20(spark, sf_dir):
    return NB.nb_zones20(marts.zone_analysis(_clean(spark, sf_dir)))


@register("nb_categories")
def q_nb_categories(spark, sf_dir):
    return NB.nb_categories(marts.trip_categories(_clean(spark, sf_dir)))


@register("every_nth_row")
def q_every_nth_row(spark, sf_dir):
    """Every 30th date of the daily mart (the date-range options)."""
    return NB.date_options(marts.daily_summary(_clean(spark, sf_dir)), 30)


@register("nb_evolution")
def q_nb_evolution(spark, sf_dir):
    return NB.nb_evolution(NB.nb_daily(marts.daily_summary(_clean(spark, sf_dir))), "total_trips")


@register("head_n")
def q_head_n(spark, sf_dir):
    return NB.head_n(NB.nb_zones20(marts.zone_analysis(_clean(spark, sf_dir))), 10)


@register("nb_category_share")
def q_nb_category_share(spark, sf_dir):
    return NB.nb_category_share(marts.trip_categories(_clean(spark, sf_dir)))


@register("nb_kpis")
def q_nb_kpis(spark, sf_dir):
    m = _marts(spark, sf_dir)
    return NB.nb_kpis(m["daily_summary"], m["hourly_patterns"], NB.nb_zones20(m["zone_analysis"]))


@register("busiest_month")
def q_busiest_month(spark, sf_dir):
    return NB.busiest_month(marts.daily_summary(_clean(spark, sf_dir)))


@register("best_revenue_zone")
def q_best_revenue_zone(spark, sf_dir):
    return NB.best_revenue_zone(NB.nb_zones20(marts.zone_analysis(_clean(spark, sf_dir))))


@register("long_trip_share")
def q_long_trip_share(spark, sf_dir):
    return NB.long_trip_share(marts.trip_categories(_clean(spark, sf_dir)))


@register("weekend_vs_weekday")
def q_weekend_vs_weekday(spark, sf_dir):
    return NB.weekend_vs_weekday(marts.trip_categories(_clean(spark, sf_dir)))


# --- data tests ----------------------------------------------------------------

@register("run_tests")
def q_run_tests(spark, sf_dir):
    """The 13 column tests on the staging table and three marts."""
    c = _clean(spark, sf_dir)
    # the staging row checks ride along in the marts' one pass over staging
    m = marts.all_marts(c, materialize, extra_aggs=row_check_aggregates("clean_trips"))
    counted = {"clean_trips": m.pop("extra")}
    return run_tests(spark, {"clean_trips": c, **m}, counted=counted)


@register("run_tests_raw")
def q_run_tests_raw(spark, sf_dir):
    """The 13 column tests on trips that no staging rule has cleaned: reversed
    times, negative amounts and missing zones make some of them fail."""
    rows = _trips(spark, sf_dir).withColumns(D.staging_columns())
    return run_tests(spark, {"clean_trips": rows, **{n: fn(rows) for n, fn in (
        ("daily_summary", marts.daily_summary), ("zone_analysis", marts.zone_analysis), ("hourly_patterns", marts.hourly_patterns))}})


@register("row_count_check")
def q_row_count_check(spark, sf_dir):
    """Rows in RAW, staging and each mart (one row per table)."""
    t = _trips(spark, sf_dir)
    c = clean_trips(t)
    # RAW and staging from one scan: staging keeps the rows where its filter holds
    both = t.agg(F.count(F.lit(1)).alias("trips_raw"), F.count_if(FL.staging_filter()).alias("clean_trips"))
    first = both.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("table_name"), F.col(n).cast("bigint").alias("row_count"))
        for n in ("trips_raw", "clean_trips")])))
    counted = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
               for n, df in _marts(spark, sf_dir, c).items()]
    return reduce(lambda a, b: a.unionByName(b), [first] + counted)


# --- sources -------------------------------------------------------------------------

@register("infer_schema")
def q_infer_schema(spark, sf_dir):
    """Schema listing of the lineitem file (name, type, nullable, cast, position)."""
    return infer_schema(spark, table_path(sf_dir, "lineitem"))


@register("skip_loaded_months")
def q_skip_loaded_months(spark, sf_dir):
    """The 21 requested months, flagged when the RAW table already holds them."""
    requested = month_range(spark).select("month")
    return skip_loaded_months(requested, month_manifest(_trips(spark, sf_dir)))


@register("append_months", settled=False)
def q_append_months(spark, sf_dir):
    """All rows of the months loaded from files that disagree (one month fails)."""
    rows, _ = LQ.loaded(spark, sf_dir)
    return rows.select(*TRIPS_NAMES, F.col("load_month").cast("string").alias("load_month"))


@register("month_load_report", settled=False)
def q_month_load_report(spark, sf_dir):
    """Each month's outcome, loaded to a table and lazily."""
    _, report = LQ.loaded(spark, sf_dir)
    return report.select("mode", "month", "ok", "rows", "unrepaired", F.col("error").isNotNull().alias("has_error"))


@register("scan_parquet_glob", settled=False)
def q_scan_parquet_glob(spark, sf_dir):
    """The castable month files, of five physical schemas, as one table."""
    return scan_parquet_glob(spark, LQ.good_paths(spark, sf_dir))


@register("skip_after_failed_month")
def q_skip_after_failed_month(spark, sf_dir):
    """The requested months after that load: the failed one is still to do."""
    rows, _ = LQ.loaded(spark, sf_dir)
    return skip_loaded_months(month_range(spark).select("month"), month_manifest(rows))


@register("truncate_reload", settled=False)
def q_truncate_reload(spark, sf_dir):
    """All rows after a load of all months that replaces what three months' load left."""
    return LQ.reloaded(spark, sf_dir).select(*TRIPS_NAMES, "load_month")


@register("changed_months", settled=False)
def q_changed_months(spark, sf_dir):
    """Each month whose files are new, replaced or the same since they were loaded."""
    status, _ = LQ.replaced(spark, sf_dir)
    return status.select("month", "status", (F.col("changed_files") > 0).alias("changed"))


@register("reload_changed_months", settled=False)
def q_reload_changed_months(spark, sf_dir):
    """Rows and first and last pickup by month after the new and replaced months are loaded."""
    _, rows = LQ.replaced(spark, sf_dir)
    return month_manifest(rows)


@register("infer_schema_glob", settled=False)
def q_infer_schema_glob(spark, sf_dir):
    """The merged schema of month files that disagree, from every file's footer."""
    found = infer_glob_schema(spark, list(LQ.month_files(spark, sf_dir).values()))
    return found.select("column_name", "type", "nullable", "expression", "order_id", "in_all_files", F.size("types").alias("n_types"))


@register("zone_map", settled=False)
def q_zone_map(spark, sf_dir):
    """Rows and first and last pickup of every month file, from the footers alone."""
    zones = zone_map(spark, LQ.good_paths(spark, sf_dir))
    time = [F.timestamp_add("MICROSECOND", x, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")) for x in (F.min("low"), F.max("high"))]
    return zones.groupBy(F.regexp_extract("path", "file_month=([0-9-]+)", 1).alias("month")).agg(
        F.sum("rows").alias("rows"), time[0].alias("first_pickup"), time[1].alias("last_pickup"))


@register("zone_map_week", settled=False)
def q_zone_map_week(spark, sf_dir):
    """One week of the month files, of which only those that hold it are opened."""
    return scan_window(spark, LQ.good_paths(spark, sf_dir), "2024-03-28", "2024-04-04")


@register("zone_map_dash_daily", settled=False)
def q_zone_map_dash_daily(spark, sf_dir):
    """The dashboard's daily view of a quarter, on the month files as they arrived."""
    rows = scan_window(spark, LQ.good_paths(spark, sf_dir), "2024-11-16", "2025-02-16")
    return DB.dash_daily(rows.withColumn(FL.DAY, F.to_date(D.PICKUP)))


def _kept(name):
    @register(f"incremental_{name}", settled=False)
    def q(spark, sf_dir):
        return LQ.kept_marts(spark, sf_dir)[name]
    q.__doc__ = f"{name} from month states, after one new and one reloaded month."
    return q


for _name in marts.MARTS:
    _kept(_name)


# --- order operators and medians on the trips themselves --------------------------------------------

@register("trip_rank", settled=False)
def q_trip_rank(spark, sf_dir):
    """Every trip's rank by distance, the longest first."""
    trips = _trips(spark, sf_dir).select("vendorid", "pulocationid", "trip_distance")
    return value_rank(trips, "trip_distance", "distance_rank")


@register("every_nth_trip", settled=False)
def q_every_nth_trip(spark, sf_dir):
    """Every 1000th trip by time."""
    return every_nth(_trips(spark, sf_dir), 1000, [D.PICKUP, D.DROPOFF])


@register("moving_avg_seconds", settled=False)
def q_moving_avg_seconds(spark, sf_dir):
    """Trips by second of pickup and their centred seven-row mean."""
    series = _trips(spark, sf_dir).groupBy(D.PICKUP).agg(F.count("*").alias("trips"))
    return moving_mean(series, "trips", [D.PICKUP])


@register("zone_medians", settled=False)
def q_zone_medians(spark, sf_dir):
    """The exact median amount of each pickup zone's trips."""
    return grouped_median(_trips(spark, sf_dir), ["pulocationid"], "total_amount", "median_amount")
