"""Per-trip derived columns of the staging model and the dashboards.

All are built-in Column expressions (whole-stage codegen, no Python per row).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import epoch_ntz
from .numeric import _c, round_pct

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"

# Labels of the staging categories.
DIST_SHORT = "Courts trajets"
DIST_MEDIUM = "Trajets moyens"
DIST_LONG = "Longs trajets"
DIST_VERY_LONG = "Très longs trajets"
UNDEFINED = "Non défini"
WEEKDAYS = "Jours de semaine"
WEEKEND = "Weekend"
LONG_CATEGORIES = (DIST_LONG, DIST_VERY_LONG)

# The two hour bucketings (mart time_period, dashboard tranche).
TIME_PERIODS = [(6, 9, "Rush Matinal"), (10, 15, "Journée"), (16, 19, "Rush Soir"),
                (20, 23, "Soirée")]
TIME_PERIOD_ELSE = "Nuit"
TRANCHES = [(0, 5, "Nuit (0h-6h)"), (6, 9, "Matin (6h-10h)"), (10, 16, "Journée (10h-17h)"),
            (17, 20, "Soir (17h-21h)")]
TRANCHE_ELSE = "Soirée (21h-0h)"


def epoch_minute(ts) -> Column:
    """Whole minutes since 1970-01-01 00:00 (floor), for TIMESTAMP_NTZ input."""
    micros = F.timestamp_diff("MICROSECOND", epoch_ntz(), _c(ts))
    minute = F.lit(60_000_000)
    return F.call_function("div", micros - F.pmod(micros, minute), minute)


def trip_duration_minutes(t0=PICKUP, t1=DROPOFF) -> Column:
    """Minute boundaries crossed between t0 and t1 (DATEDIFF('minute') semantics).

    10:00:59 -> 10:01:01 is 1, not the 0 elapsed whole minutes.
    """
    return (epoch_minute(t1) - epoch_minute(t0)).cast("bigint")


def pickup_hour(ts=PICKUP) -> Column:
    return F.hour(_c(ts))


def pickup_day_of_week(ts=PICKUP) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(_c(ts)) - 1


def pickup_month(ts=PICKUP) -> Column:
    return F.month(_c(ts))


def pickup_date(ts=PICKUP) -> Column:
    return F.to_date(_c(ts))


def avg_speed_mph(distance="trip_distance", minutes="trip_duration_minutes") -> Column:
    m = _c(minutes)
    return F.when(m > 0, _c(distance) / (m.cast("double") / 60.0)).otherwise(F.lit(0.0))


def tip_percentage(tip="tip_amount", fare="fare_amount") -> Column:
    """fare > 0 ? ROUND(tip * 100 / fare, 2) : 0 ; a NULL tip stays NULL."""
    fare_c = _c(fare)
    return F.when(fare_c > 0, round_pct(_c(tip) * 100.0 / fare_c, 2)).otherwise(F.lit(0.0))


def tip_pct_nullif(tip="tip_amount", fare="fare_amount") -> Column:
    """tip / NULLIF(fare, 0) * 100, unrounded; zero fare gives NULL."""
    return _c(tip) / F.nullif(_c(fare), F.lit(0.0)) * 100


def distance_category(distance="trip_distance") -> Column:
    d = _c(distance)
    return (F.when(d <= 1, DIST_SHORT)
            .when(d.between(1.01, 5), DIST_MEDIUM)
            .when(d.between(5.01, 10), DIST_LONG)
            .when(d > 10, DIST_VERY_LONG)
            .otherwise(UNDEFINED))


def day_type(dow="pickup_day_of_week") -> Column:
    d = _c(dow)
    return (F.when(d.isin(1, 2, 3, 4, 5), WEEKDAYS)
            .when(d.isin(0, 6), WEEKEND)
            .otherwise(UNDEFINED))


def _buckets(h: Column, table, other: str) -> Column:
    expr = None
    for lo, hi, label in table:
        cond = h.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(other)


def time_period(hour="pickup_hour") -> Column:
    return _buckets(_c(hour), TIME_PERIODS, TIME_PERIOD_ELSE)


def tranche(hour="pickup_hour") -> Column:
    return _buckets(_c(hour), TRANCHES, TRANCHE_ELSE)


def zone_label(zone) -> Column:
    return F.concat(F.lit("Zone "), _c(zone).cast("string"))


def coalesce_name(name, zone) -> Column:
    return F.coalesce(_c(name), _c(zone).cast("string"))


def staging_columns() -> dict[str, Column]:
    """The eight columns the staging model adds, in order.

    Later entries refer to earlier ones by name (lateral alias), so they must
    be added with one ``withColumns`` call that keeps this order.
    """
    return {
        "trip_duration_minutes": trip_duration_minutes(),
        "pickup_hour": pickup_hour(),
        "pickup_day_of_week": pickup_day_of_week(),
        "pickup_month": pickup_month(),
        "avg_speed_mph": avg_speed_mph(minutes=trip_duration_minutes()),
        "tip_percentage": tip_percentage(),
        "distance_category": distance_category(),
        "day_type": day_type(pickup_day_of_week()),
    }
