"""Dashboard results: four RAW queries and the exploration steps on them.

The four RAW queries share one filtered base (positive distance, date
window on the pickup day, which prunes the scan, and time). Every
later step works on their small aggregated outputs; scalars (median, grand
means, window bounds) are uncorrelated scalar subqueries, not joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import derive as D
from ..functions.dates import date_label, iso_weekday
from ..functions.exact import exact_avg, exact_states, exact_sum, merged_sum
from ..functions.numeric import dec_round, share_pct
from ..operators import filters as FL
from ..operators.aggregates import (arg_max_first, arg_min_first, conditional_sum, ratio_of_sums, rollup_total,
                                    series_count, weighted_avg)
from ..operators.joins import weekday_reindex, zone_name_lookup
from ..operators.topk import bottom_k, top_k
from ..operators.windows import moving_avg

# Metrics a user may pick, period lengths in months, airports.
METRICS = ("total_trips", "total_revenue", "avg_fare", "avg_tip_pct", "avg_distance")
PERIODS = {"1M": 1, "3M": 3, "6M": 6, "1A": 12, "Tout": 0}
JFK_ZONES = (132, 138)
LGA_ZONES = (137,)
CARD_PAYMENT = 1
OTHER_PAYMENT_PCT = 3.0
PAYMENT_LABELS = ("Carte bancaire", "Espèces", "Autre")
TOP_ZONES = 100


def check_metric(metric: str, allowed=METRICS) -> str:
    if metric not in allowed:
        raise ValueError(f"metric must be one of {allowed}, got {metric!r}")
    return metric


def dash_base(trips: DataFrame, start: str = FL.WINDOW_START,
              end_exclusive: str = FL.WINDOW_END_EXCLUSIVE) -> DataFrame:
    return FL.filter_date_window(trips.filter(FL.positive_distance()), start, end_exclusive)


def _trip_metrics() -> list[Column]:
    return [F.count(F.lit(1)).alias("total_trips"),
            exact_sum("total_amount").alias("total_revenue")]


def dash_daily(trips: DataFrame, start: str = FL.WINDOW_START,
               end_exclusive: str = FL.WINDOW_END_EXCLUSIVE) -> DataFrame:
    base = dash_base(trips, start, end_exclusive).filter(FL.positive_total())
    return (base.groupBy(D.pickup_date().alias("pickup_date"))
            .agg(*_trip_metrics(),
                 exact_avg("trip_distance").alias("avg_distance"),
                 exact_avg("total_amount").alias("avg_fare"),
                 exact_avg(D.tip_pct_nullif()).alias("avg_tip_pct")))


def dash_hourly(trips: DataFrame, start: str = FL.WINDOW_START,
                end_exclusive: str = FL.WINDOW_END_EXCLUSIVE) -> DataFrame:
    # tranche is a function of the hour: group by the hour alone, label after
    per_hour = (dash_base(trips, start, end_exclusive)
                .groupBy(D.pickup_hour().alias("pickup_hour"))
                .agg(*_trip_metrics(),
                     exact_avg("total_amount").alias("avg_fare"),
                     exact_avg(D.tip_pct_nullif()).alias("avg_tip_pct"),
                     exact_avg("trip_distance").alias("avg_distance")))
    return per_hour.withColumn("tranche", D.tranche("pickup_hour"))


def dash_zones(trips: DataFrame, start: str = FL.WINDOW_START,
               end_exclusive: str = FL.WINDOW_END_EXCLUSIVE, k: int = TOP_ZONES) -> DataFrame:
    """Top k pickup zones by trips; a NULL zone is a group of its own."""
    per_zone = (dash_base(trips, start, end_exclusive)
                .groupBy(F.col("pulocationid").alias("zone_id"))
                .agg(*_trip_metrics(),
                     exact_avg("total_amount").alias("avg_fare"),
                     exact_avg("trip_distance").alias("avg_distance"),
                     exact_avg(D.tip_pct_nullif()).alias("avg_tip_pct")))
    return top_k(per_zone, "total_trips", k, "zone_id")


def _touches(zones) -> Column:
    z = list(zones)
    return F.col("pulocationid").isin(z) | F.col("dolocationid").isin(z)


def dash_profile(trips: DataFrame, start: str = FL.WINDOW_START,
                 end_exclusive: str = FL.WINDOW_END_EXCLUSIVE,
                 jfk=JFK_ZONES, lga=LGA_ZONES) -> DataFrame:
    """One row: the portrait of an average trip (one scan, one aggregate)."""
    base = dash_base(trips, start, end_exclusive).filter(FL.positive_total())
    n = F.count(F.lit(1))
    return base.agg(
        n.alias("total_trips"),
        exact_avg("trip_distance").alias("avg_distance"),
        exact_avg("total_amount").alias("avg_fare"),
        exact_avg(D.tip_pct_nullif()).alias("avg_tip_pct"),
        share_pct(conditional_sum(F.col("tip_amount") > 0), n).alias("pct_avec_pourboire"),
        share_pct(conditional_sum(F.col("payment_type") == CARD_PAYMENT), n).alias("pct_carte"),
        share_pct(conditional_sum(_touches(jfk)), n).alias("pct_aeroport_jfk"),
        share_pct(conditional_sum(_touches(lga)), n).alias("pct_aeroport_lga"),
        exact_avg("passenger_count").alias("avg_passagers"),
    )


def dashboard_load(trips: DataFrame, start: str = FL.WINDOW_START,
                   end_exclusive: str = FL.WINDOW_END_EXCLUSIVE, k: int = TOP_ZONES,
                   jfk=JFK_ZONES, lga=LGA_ZONES, materialize=None) -> dict[str, DataFrame]:
    """The dashboard's four RAW queries (``dash_daily``, ``dash_hourly``,
    ``dash_zones``, ``dash_profile``) from ONE scan of the trips.

    ``GROUPING SETS ((date), (hour), (zone))`` over the shared filtered base;
    the positive-total rule of the daily view and the profile becomes
    conditional aggregates. The one-row profile is re-aggregated from
    decomposable sums and counts over the 24 hour groups (every set covers
    each trip once), so it has one row even on an empty window, as a global
    aggregate does. ``materialize`` writes the grouped result once; the four
    outputs are then small reads of it. Sums are exact, so the results equal
    those of the one-query forms bit for bit.
    """
    pos = F.coalesce(FL.positive_total(), F.lit(False))
    keyed = dash_base(trips, start, end_exclusive).select(
        D.pickup_date().alias("pickup_date"), D.pickup_hour().alias("pickup_hour"),
        F.col("pulocationid").alias("zone_id"), pos.alias("_pos"),
        "trip_distance", "total_amount", D.tip_pct_nullif().alias("_tip"), "tip_amount",
        "payment_type", "passenger_count", _touches(jfk).alias("_jfk"), _touches(lga).alias("_lga"))
    p = F.col("_pos")

    def on_pos(c):
        return F.when(p, F.col(c) if isinstance(c, str) else c)

    sums, states = {}, []   # decomposable parts of the profile, per group
    for name, col in (("dist", "trip_distance"), ("fare", "total_amount"), ("tip", "_tip"), ("pass", "passenger_count")):
        states += exact_states(on_pos(col), name)
        sums[f"n_{name}"] = F.count(on_pos(col))
    for name, cond in (("tipped", F.col("tip_amount") > 0), ("card", F.col("payment_type") == CARD_PAYMENT),
                       ("jfk", F.col("_jfk")), ("lga", F.col("_lga"))):
        sums[f"c_{name}"] = F.count_if(p & cond)
    keys = ("pickup_date", "pickup_hour", "zone_id")
    agg = keyed.groupingSets([["pickup_date"], ["pickup_hour"], ["zone_id"]], *keys).agg(
        F.grouping_id().alias("_gid"),
        # all trips of the window (hourly, zones)
        *_trip_metrics(),
        exact_avg("total_amount").alias("avg_fare"),
        exact_avg("_tip").alias("avg_tip_pct"),
        exact_avg("trip_distance").alias("avg_distance"),
        # trips with a positive total (daily, profile)
        F.count_if(p).alias("pos_trips"),
        exact_sum(on_pos("total_amount")).alias("pos_revenue"),
        exact_avg(on_pos("trip_distance")).alias("pos_avg_distance"),
        exact_avg(on_pos("total_amount")).alias("pos_avg_fare"),
        exact_avg(on_pos("_tip")).alias("pos_avg_tip_pct"),
        *[v.alias(n) for n, v in sums.items()], *states,
    )
    if materialize is not None:
        agg = materialize(agg, "dashboard_load")

    def part(key):
        # grouping_id bit i (most significant first) is 1 when key i is not grouped
        gid = sum(1 << (len(keys) - 1 - i) for i, kk in enumerate(keys) if kk != key)
        return agg.filter(F.col("_gid") == gid)

    daily = part("pickup_date").filter(F.col("pos_trips") > 0).select(
        "pickup_date", F.col("pos_trips").alias("total_trips"), F.col("pos_revenue").alias("total_revenue"),
        F.col("pos_avg_distance").alias("avg_distance"), F.col("pos_avg_fare").alias("avg_fare"),
        F.col("pos_avg_tip_pct").alias("avg_tip_pct"))
    hourly = part("pickup_hour").select(
        "pickup_hour", "total_trips", "total_revenue", "avg_fare", "avg_tip_pct", "avg_distance"
    ).withColumn("tranche", D.tranche("pickup_hour"))
    zones = top_k(part("zone_id").select(
        "zone_id", "total_trips", "total_revenue", "avg_fare", "avg_distance", "avg_tip_pct"),
        "total_trips", k, "zone_id")

    def mean(name):
        return merged_sum(name) / F.nullif(F.sum(f"n_{name}"), F.lit(0))

    n = F.coalesce(F.sum("pos_trips"), F.lit(0)).cast("bigint")
    profile = part("pickup_hour").agg(
        n.alias("total_trips"),
        mean("dist").alias("avg_distance"),
        mean("fare").alias("avg_fare"),
        mean("tip").alias("avg_tip_pct"),
        share_pct(F.sum("c_tipped"), n).alias("pct_avec_pourboire"),
        share_pct(F.sum("c_card"), n).alias("pct_carte"),
        share_pct(F.sum("c_jfk"), n).alias("pct_aeroport_jfk"),
        share_pct(F.sum("c_lga"), n).alias("pct_aeroport_lga"),
        mean("pass").alias("avg_passagers"),
    )
    return {"dash_daily": daily, "dash_hourly": hourly, "dash_zones": zones, "dash_profile": profile}


def complete_days(daily: DataFrame, last_day: str = FL.LAST_DAY,
                  ratio: float = FL.INCOMPLETE_RATIO) -> DataFrame:
    """Drop unparseable dates, days after ``last_day`` and days under
    ``ratio`` x the median trips (median taken after the cut-off)."""
    kept = FL.filter_defensive_cutoff(FL.drop_bad_dates(daily), last_day)
    return FL.filter_incomplete_days(kept, ratio)


def coverage_caption(days: DataFrame) -> DataFrame:
    """Trips, day count, first and last month label of the kept days."""
    return series_count(days).select(
        "total_trips", "n_days",
        date_label("first_day", "MMM yyyy").alias("first_month"),
        date_label("last_day", "MMM yyyy").alias("last_month"),
    )


def kpis(days: DataFrame) -> DataFrame:
    trips = F.sum("total_trips")
    rev = F.sum("total_revenue")
    return days.agg(
        trips.cast("bigint").alias("total_trips"),
        rev.alias("total_revenue"),
        ratio_of_sums("total_revenue", "total_trips").alias("revenue_per_trip"),
        F.avg("avg_distance").alias("avg_distance"),
        F.avg("avg_fare").alias("avg_fare"),
        F.avg("avg_tip_pct").alias("avg_tip_pct"),
    )


def weekly_profile(days: DataFrame, metric: str = "total_trips") -> DataFrame:
    """Mean of ``metric`` per weekday (Monday first, all seven present), the
    mean of those seven values, an at-or-above-mean flag and the delta in %
    rounded to one decimal."""
    check_metric(metric)
    per_day = (days.groupBy(iso_weekday("pickup_date").alias("dow"))
               .agg(F.avg(F.col(metric).cast("double")).alias("value")))
    weekly = weekday_reindex(per_day, key="dow", ordered=False)
    # The grand mean of the seven values: a whole-frame window over exactly
    # seven rows (the weekday dimension), so the chain above runs once; a
    # scalar subquery would plan and run it a second time.
    with_mean = weekly.withColumn("mean_value", F.avg("value").over(Window.partitionBy()))
    mean_val = F.col("mean_value")
    return with_mean.select(
        "iso_dow", "day_name", "day_fr", F.lit(metric).alias("metric"), "value", "mean_value",
        F.coalesce(F.col("value") >= mean_val, F.lit(False)).alias("above_mean"),
        dec_round((F.col("value") - mean_val) / mean_val * 100, 1).alias("delta_pct"),
    ).orderBy("iso_dow")


def hourly_metric(hourly: DataFrame, metric: str = "total_trips") -> DataFrame:
    check_metric(metric)
    series_max = hourly.select(F.max(metric)).scalar()
    return hourly.select("pickup_hour", F.col(metric).cast("double").alias("value"),
                         series_max.cast("double").alias("series_max")).orderBy("pickup_hour")


def daily_evolution(days: DataFrame, metric: str = "total_trips") -> DataFrame:
    """Date, metric and its centred 7-row moving mean over the whole series."""
    check_metric(metric)
    series = days.select("pickup_date", F.col(metric).cast("double").alias("value"))
    return moving_avg(series, "value", "pickup_date", 3, 3, out="ma7").orderBy("pickup_date")


def period_window(days: DataFrame, period: str = "6M", offset: int = 0) -> DataFrame:
    """Visible [x_min, x_max] for a period and page offset, plus paging flags."""
    if period not in PERIODS:
        raise ValueError(f"period must be one of {tuple(PERIODS)}")
    months = PERIODS[period]
    b = days.agg(F.min("pickup_date").alias("date_min"), F.max("pickup_date").alias("date_max"))
    if months == 0:
        x_min, x_max = F.col("date_min"), F.col("date_max")
    else:
        hi = F.add_months(F.col("date_max"), -offset * months)
        lo = F.add_months(hi, -months)
        x_min = F.greatest(lo, F.col("date_min"))
        x_max = F.least(hi, F.col("date_max"))
    paged = months != 0
    return b.select(
        F.lit(period).alias("period"), F.lit(offset).alias("page_offset"),
        "date_min", "date_max", x_min.alias("x_min"), x_max.alias("x_max"),
        (F.lit(paged) & (x_min > F.col("date_min"))).alias("has_prev"),
        F.lit(paged and offset > 0).alias("has_next"),
    )


def period_extremes(days: DataFrame, metric: str = "total_trips", period: str = "6M",
                    offset: int = 0) -> DataFrame:
    """Best and worst day inside the visible window (earliest date wins ties)."""
    check_metric(metric)
    w = period_window(days, period, offset)
    bounds = days.withColumn("_w", w.select(F.struct("x_min", "x_max")).scalar())
    vis = bounds.filter(F.col("pickup_date").between(F.col("_w.x_min"), F.col("_w.x_max")))
    m = F.col(metric).cast("double")
    return vis.agg(
        arg_max_first("pickup_date", m, "pickup_date").alias("best_date"),
        F.max(m).alias("best_value"),
        arg_min_first("pickup_date", m, "pickup_date").alias("worst_date"),
        F.min(m).alias("worst_value"),
    )


def top_days(days: DataFrame, metric: str = "total_trips", n: int = 10) -> DataFrame:
    """n largest days by metric over all kept days (ties keep the earliest),
    shown in ascending order as the source shows them."""
    check_metric(metric)
    s = days.filter(F.col(metric).isNotNull()).select("pickup_date", F.col(metric).cast("double").alias("value"))
    return top_k(s, "value", n, "pickup_date").orderBy("value", "pickup_date")


def bottom_days(days: DataFrame, metric: str = "total_trips", n: int = 10) -> DataFrame:
    """n smallest days by metric (ties keep the earliest), shown in descending order."""
    check_metric(metric)
    s = days.filter(F.col(metric).isNotNull()).select("pickup_date", F.col(metric).cast("double").alias("value"))
    return bottom_k(s, "value", n, "pickup_date").orderBy(F.desc("value"), "pickup_date")


def zones_named(zones_top: DataFrame, zone_dim: DataFrame) -> DataFrame:
    return zone_name_lookup(zones_top, zone_dim, "zone_id", "zone_name")


def zone_treemap(zones_top: DataFrame, zone_dim: DataFrame, root: str = "NYC") -> DataFrame:
    """Zones named, summed per name, fare weighted by trips, plus the root total."""
    named = zones_named(zones_top, zone_dim)
    return rollup_total(named, "zone_name",
                        [F.sum("total_trips").cast("bigint").alias("total_trips"),
                         weighted_avg("avg_fare", "total_trips").alias("avg_fare")], root=root)


def trip_portrait(profile: DataFrame) -> DataFrame:
    return profile.select(
        "*",
        (F.lit(100.0) - F.col("pct_aeroport_jfk") - F.col("pct_aeroport_lga")).alias("pct_intra_ville"),
        (F.lit(100.0) - F.col("pct_carte")).alias("pct_hors_carte"),
    )


def payment_split(profile: DataFrame) -> DataFrame:
    """Card / cash / other shares; other is the fixed 3 % and cash the rest."""
    card, cash, other = PAYMENT_LABELS
    rows = F.array(
        F.struct(F.lit(1).alias("slot"), F.lit(card).alias("mode"), F.col("pct_carte").alias("share")),
        F.struct(F.lit(2).alias("slot"), F.lit(cash).alias("mode"),
                 (F.lit(100.0) - F.col("pct_carte") - F.lit(OTHER_PAYMENT_PCT)).alias("share")),
        F.struct(F.lit(3).alias("slot"), F.lit(other).alias("mode"), F.lit(OTHER_PAYMENT_PCT).alias("share")),
    )
    return profile.select(F.inline(rows))


CASH_PAYMENT = 2


def payment_split_exact(trips: DataFrame, start: str = FL.WINDOW_START,
                        end_exclusive: str = FL.WINDOW_END_EXCLUSIVE) -> DataFrame:
    """Card / cash / other shares computed from payment_type over the same
    trips as ``dash_profile`` (the alternative to the fixed 3 % "other")."""
    base = dash_base(trips, start, end_exclusive).filter(FL.positive_total())
    n = F.count(F.lit(1))
    card, cash, other = PAYMENT_LABELS
    pt = F.col("payment_type")
    one = base.agg(
        share_pct(conditional_sum(pt == CARD_PAYMENT), n).alias("c"),
        share_pct(conditional_sum(pt == CASH_PAYMENT), n).alias("k"),
        share_pct(conditional_sum(~pt.isin(CARD_PAYMENT, CASH_PAYMENT) | pt.isNull()), n).alias("o"))
    rows = F.array(*[F.struct(F.lit(i + 1).alias("slot"), F.lit(lbl).alias("mode"), F.col(c).alias("share"))
                     for i, (lbl, c) in enumerate(zip((card, cash, other), ("c", "k", "o")))])
    return one.select(F.inline(rows))


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


