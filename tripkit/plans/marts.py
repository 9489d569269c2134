"""The four marts built from the staging table.

Grouping keys are low-cardinality (dates, zones, hours, categories), so the
partial aggregation before each shuffle emits at most one row per key and
map task: a key holding a third of all trips costs no more than any other.
Sums and means of doubles are exact (``functions.exact``): the marts are the
same, bit for bit, however the trips are partitioned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.derive import PICKUP, time_period
from ..functions.exact import exact_avg, exact_sum
from ..operators.windows import popularity_rank


def daily_summary(clean: DataFrame) -> DataFrame:
    return (clean.groupBy(F.to_date(PICKUP).alias("pickup_date"))
            .agg(F.count(F.lit(1)).alias("total_trips"),
                 exact_avg("trip_distance").alias("avg_distance"),
                 exact_sum("total_amount").alias("total_revenue"),
                 exact_avg("total_amount").alias("avg_revenue"),
                 exact_avg("tip_percentage").alias("avg_tip_percentage")))


def zone_analysis(clean: DataFrame) -> DataFrame:
    per_zone = (clean.groupBy(F.col("pulocationid").alias("pickup_zone"))
                .agg(F.count(F.lit(1)).alias("total_trips"),
                     exact_avg("total_amount").alias("avg_revenue"),
                     exact_sum("total_amount").alias("total_revenue"),
                     exact_avg("trip_distance").alias("avg_distance")))
    # rank over the aggregated zones only (bounded by the zone domain)
    return popularity_rank(per_zone)


def hourly_patterns(clean: DataFrame) -> DataFrame:
    per_hour = (clean.groupBy("pickup_hour")
                .agg(F.count(F.lit(1)).alias("total_trips"),
                     exact_avg("total_amount").alias("avg_revenue"),
                     exact_avg("avg_speed_mph").alias("avg_speed"),
                     exact_avg("trip_distance").alias("avg_distance")))
    return per_hour.withColumn("time_period", time_period("pickup_hour"))


def trip_categories(clean: DataFrame) -> DataFrame:
    return (clean.groupBy("distance_category", "day_type")
            .agg(F.count(F.lit(1)).alias("total_trips"),
                 exact_avg("trip_distance").alias("avg_distance"),
                 exact_avg("total_amount").alias("avg_revenue"),
                 F.avg("trip_duration_minutes").alias("avg_duration"),
                 exact_avg("avg_speed_mph").alias("avg_speed"),
                 exact_avg("tip_percentage").alias("avg_tip_percentage")))


MARTS = {
    "daily_summary": daily_summary,
    "zone_analysis": zone_analysis,
    "hourly_patterns": hourly_patterns,
    "trip_categories": trip_categories,
}


# --- all four marts from one scan ---------------------------------------------

_KEYS = ("pickup_date", "pickup_zone", "pickup_hour", "distance_category", "day_type")
_SETS = {
    "daily_summary": ("pickup_date",),
    "zone_analysis": ("pickup_zone",),
    "hourly_patterns": ("pickup_hour",),
    "trip_categories": ("distance_category", "day_type"),
}


def _gid(keys) -> int:
    """grouping_id() of a set: bit i (from the left, most significant first)
    is 1 when key i is NOT in the set."""
    n = len(_KEYS)
    return sum(1 << (n - 1 - i) for i, k in enumerate(_KEYS) if k not in keys)


def all_marts(clean: DataFrame, materialize=None, extra_aggs=None) -> dict[str, DataFrame]:
    """The four marts from ONE scan of the staging table and one shuffle.

    ``GROUPING SETS ((date), (zone), (hour), (category, day type))`` expands
    each trip into four keyed rows that the partial aggregation collapses
    before the shuffle; the result (days + zones + hours + categories rows)
    is tiny. ``materialize`` (e.g. ``tripkit.session.materialize``) writes it
    once so the four marts are cheap filters of a stored table; without it
    each mart re-runs the single-pass plan.

    ``extra_aggs`` are more count-like aggregates over the staging rows
    (e.g. the data tests' failure counts) computed in the same pass; they
    may use the measure columns selected below. Each
    grouping set covers every row exactly once, so their totals are the sums
    over one set's groups (the hours); they are returned as a one-row
    DataFrame under ``"extra"``.
    """
    extra_aggs = list(extra_aggs or [])
    keyed = clean.select(
        F.to_date(PICKUP).alias("pickup_date"), F.col("pulocationid").alias("pickup_zone"),
        "pickup_hour", "distance_category", "day_type", "trip_distance", "total_amount",
        "tip_percentage", "avg_speed_mph", "trip_duration_minutes")
    agg = keyed.groupingSets([list(s) for s in _SETS.values()], *_KEYS).agg(
        F.grouping_id().alias("_gid"),
        F.count(F.lit(1)).alias("total_trips"),
        exact_avg("trip_distance").alias("avg_distance"),
        exact_sum("total_amount").alias("total_revenue"),
        exact_avg("total_amount").alias("avg_revenue"),
        exact_avg("tip_percentage").alias("avg_tip_percentage"),
        exact_avg("avg_speed_mph").alias("avg_speed"),
        F.avg("trip_duration_minutes").alias("avg_duration"),
        *extra_aggs,
    )
    if materialize is not None:
        agg = materialize(agg)

    def part(name):
        return agg.filter(F.col("_gid") == _gid(_SETS[name]))

    # coalesce: on empty staging there are no hour groups, and a count is 0
    out = {} if not extra_aggs else {"extra": part("hourly_patterns").agg(*[
        F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in agg.columns[-len(extra_aggs):]])}
    return out | {
        "daily_summary": part("daily_summary").select(
            "pickup_date", "total_trips", "avg_distance", "total_revenue", "avg_revenue", "avg_tip_percentage"),
        "zone_analysis": popularity_rank(part("zone_analysis").select(
            "pickup_zone", "total_trips", "avg_revenue", "total_revenue", "avg_distance")),
        "hourly_patterns": part("hourly_patterns").select(
            "pickup_hour", "total_trips", "avg_revenue", "avg_speed", "avg_distance")
            .withColumn("time_period", time_period("pickup_hour")),
        "trip_categories": part("trip_categories").select(
            "distance_category", "day_type", "total_trips", "avg_distance", "avg_revenue",
            "avg_duration", "avg_speed", "avg_tip_percentage"),
    }
