"""The four marts kept up to date month by month.

A month's part of every mart is a set of mergeable states: for each grouping key the row count, and each measure's sum and
count (sums in their exact parts). The states of all months are one small table (``load_month`` by grouping keys), stored in month folders that a snapshot
commits, like the RAW months they come from; each records the RAW load it was made from. After a load, ``refresh`` scans only
the months whose RAW load is another one than that, and drops the states of months that are gone. ``merged_marts`` adds the
states up: it reads days x keys rows, never trips. Sums are exact, so the marts equal a full rebuild bit for bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.derive import PICKUP, time_period
from ..functions.exact import PARTS, exact_states, merged_sum
from ..operators.windows import popularity_rank
from ..sources.files import InputFile
from ..sources.months import loaded_months
from ..sources.snapshots import MonthEntry, commit, entries, load_folder, new_load, read
from .marts import _KEYS, _SETS, _gid
from .staging import clean_trips

MEASURES = ("trip_distance", "total_amount", "tip_percentage", "avg_speed_mph", "trip_duration_minutes")
_STATES = T.StructType([
    T.StructField(name, kind) for name, kind in (
        ("grouping", T.IntegerType()), ("pickup_date", T.DateType()), ("pickup_zone", T.LongType()), ("pickup_hour", T.IntegerType()),
        ("distance_category", T.StringType()), ("day_type", T.StringType()), ("total_trips", T.LongType()),
        *(field for m in MEASURES for field in (
            *((f"{p}_{m}", T.DoubleType() if p == "loose" else T.LongType()) for p in PARTS), (f"n_{m}", T.LongType()))))])


def month_states(clean: DataFrame) -> DataFrame:
    """The mergeable states of staging rows with ``load_month``, from one scan and one shuffle."""
    keyed = clean.select("load_month", F.to_date(PICKUP).alias("pickup_date"), F.col("pulocationid").alias("pickup_zone"),
                         "pickup_hour", "distance_category", "day_type", *MEASURES)
    # the month is in every set, so the grouping id is that of the marts' own sets
    sets = [["load_month", *s] for s in _SETS.values()]
    states = [x for m in MEASURES for x in (*exact_states(m, m), F.count(m).alias(f"n_{m}"))]
    return keyed.groupingSets(sets, "load_month", *_KEYS).agg(
        F.grouping_id().cast("int").alias("grouping"), F.count(F.lit(1)).alias("total_trips"), *states) \
        .select(*_STATES.fieldNames(), "load_month")


def stale_months(spark: SparkSession, raw_target: str, states_target: str) -> tuple[list[str], list[str]]:
    """(months whose states are missing or of another load, months whose RAW rows are gone)."""
    raw, held = entries(spark, raw_target), entries(spark, states_target)
    source = {m: e.sources[0].path for m, e in held.items()}
    return [m for m, e in sorted(raw.items()) if source.get(m) != e.load], sorted(set(held) - set(raw))


def refresh(spark: SparkSession, raw_target: str, states_target: str) -> list[str]:
    """Bring the states up to the RAW snapshot; returns the months that were scanned."""
    raw, held = entries(spark, raw_target), entries(spark, states_target)
    stale, gone = stale_months(spark, raw_target, states_target)
    if not stale and not gone:
        return []
    load = new_load()
    if stale:
        rows = loaded_months(spark, raw_target, months=stale)
        month_states(clean_trips(rows)).write.partitionBy("load_month").parquet(load_folder(states_target, load))
    written = spark.read.schema(T.StructType([*_STATES.fields, T.StructField("load_month", T.StringType())])) \
        .parquet(load_folder(states_target, load)).groupBy("load_month").count().collect() if stale else []
    counts = {r["load_month"]: r["count"] for r in written}
    kept = [e for m, e in held.items() if m not in stale and m not in gone]
    made = [MonthEntry(m, load, counts.get(m, 0), 0, [InputFile(raw[m].load, raw[m].rows, 0)]) for m in stale]
    commit(spark, states_target, kept + made, replace_all=True)
    return stale


def stored_states(spark: SparkSession, states_target: str) -> DataFrame:
    return read(spark, states_target, _STATES)


def _mean(measure: str) -> Column:
    return F.col(f"sum_{measure}") / F.nullif(F.col(f"n_{measure}"), F.lit(0))


def merged_marts(states: DataFrame) -> dict[str, DataFrame]:
    """The four marts from the months' states; equal, bit for bit, to those built from all staging rows."""
    def part(mart: str) -> DataFrame:
        sums = [F.sum("total_trips").alias("total_trips"), *(x for m in MEASURES for x in (merged_sum(m).alias(f"sum_{m}"), F.sum(f"n_{m}").alias(f"n_{m}")))]
        return states.filter(F.col("grouping") == _gid(_SETS[mart])).groupBy(*_SETS[mart]).agg(*sums)

    distance, revenue = _mean("trip_distance").alias("avg_distance"), _mean("total_amount").alias("avg_revenue")
    total, tip, speed = F.col("sum_total_amount").alias("total_revenue"), _mean("tip_percentage").alias("avg_tip_percentage"), _mean("avg_speed_mph").alias("avg_speed")
    return {
        "daily_summary": part("daily_summary").select("pickup_date", "total_trips", distance, total, revenue, tip),
        "zone_analysis": popularity_rank(part("zone_analysis").select("pickup_zone", "total_trips", revenue, total, distance)),
        "hourly_patterns": part("hourly_patterns").select("pickup_hour", "total_trips", revenue, speed, distance)
        .withColumn("time_period", time_period("pickup_hour")),
        "trip_categories": part("trip_categories").select(
            "distance_category", "day_type", "total_trips", distance, revenue, _mean("trip_duration_minutes").alias("avg_duration"), speed, tip),
    }
