"""Row filters and predicates of the staging model and the dashboards.

Predicates compare bare columns against literals so Catalyst can push them
into the Parquet scan. Parquet statistics prune on the numbers and on the DATE
column ``pickup_day`` of the stored tables; Spark does not prune on
TIMESTAMP_NTZ, so a date window tests both the day and the time.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.derive import DROPOFF, PICKUP

# The dashboards' date window and defensive cut-off.
WINDOW_START = "2023-01-01"
WINDOW_END_EXCLUSIVE = "2025-11-01"
LAST_DAY = "2025-10-31"
INCOMPLETE_RATIO = 0.30

# The 14 columns checked for NULLs by the quality profile.
NULL_CHECK_COLUMNS = [
    "vendorid", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
    "trip_distance", "ratecodeid", "store_and_fwd_flag", "pulocationid", "dolocationid",
    "payment_type", "fare_amount", "total_amount", "congestion_surcharge", "airport_fee",
]
# The five columns of the overview's NULL slice.
OVERVIEW_NULL_COLUMNS = ["passenger_count", "ratecodeid", "store_and_fwd_flag",
                         "congestion_surcharge", "airport_fee"]


def nonneg_amounts() -> Column:
    return (F.col("fare_amount") >= 0) & (F.col("total_amount") >= 0)


def ordered_times() -> Column:
    return F.col(DROPOFF) > F.col(PICKUP)


def distance_range(lo: float = 0.1, hi: float = 100.0) -> Column:
    return F.col("trip_distance").between(lo, hi)


def zones_present() -> Column:
    return F.col("pulocationid").isNotNull() & F.col("dolocationid").isNotNull()


def positive_distance() -> Column:
    return F.col("trip_distance") > 0


def positive_total() -> Column:
    return F.col("total_amount") > 0


def _ts_literal(d: str | _dt.date) -> Column:
    return F.lit(str(d) + " 00:00:00").cast("timestamp_ntz")


# The DATE of the pickup, stored beside the RAW columns so that scans prune.
DAY = "pickup_day"


def date_window(start: str = WINDOW_START, end_exclusive: str = WINDOW_END_EXCLUSIVE,
                col: str = PICKUP, day: str | None = None) -> Column:
    """start <= pickup < end on the bare timestamp and, where the table has
    the pickup's DATE column ``day``, on that too (both bounds are midnights)."""
    c = F.col(col)
    window = (c >= _ts_literal(start)) & (c < _ts_literal(end_exclusive))
    if day:
        d = F.col(day)
        window = (d >= F.lit(str(start)).cast("date")) & (d < F.lit(str(end_exclusive)).cast("date")) & window
    return window


def any_null(cols=None) -> Column:
    cols = NULL_CHECK_COLUMNS if cols is None else cols
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def staging_filter() -> Column:
    """The four staging filters, conjoined."""
    return nonneg_amounts() & ordered_times() & distance_range() & zones_present()


# DataFrame -> DataFrame forms -------------------------------------------------

def filter_nonneg_amounts(df: DataFrame) -> DataFrame:
    return df.filter(nonneg_amounts())


def filter_ordered_times(df: DataFrame) -> DataFrame:
    return df.filter(ordered_times())


def filter_distance_range(df: DataFrame, lo: float = 0.1, hi: float = 100.0) -> DataFrame:
    return df.filter(distance_range(lo, hi))


def filter_zones_present(df: DataFrame) -> DataFrame:
    return df.filter(zones_present())


def filter_positive_distance(df: DataFrame) -> DataFrame:
    return df.filter(positive_distance())


def filter_positive_total(df: DataFrame) -> DataFrame:
    return df.filter(positive_total())


def filter_date_window(df: DataFrame, start: str = WINDOW_START,
                       end_exclusive: str = WINDOW_END_EXCLUSIVE) -> DataFrame:
    return df.filter(date_window(start, end_exclusive, day=DAY if DAY in df.columns else None))


def filter_any_null(df: DataFrame, cols=None) -> DataFrame:
    return df.filter(any_null(cols))


def drop_bad_dates(df: DataFrame, col: str = "pickup_date") -> DataFrame:
    """Parse the column as a date; unparseable or NULL values drop the row."""
    return df.withColumn(col, F.try_to_date(F.col(col).cast("string"))).na.drop(subset=[col])


def filter_defensive_cutoff(df: DataFrame, last_day: str = LAST_DAY,
                            col: str = "pickup_date") -> DataFrame:
    return df.filter(F.col(col) <= F.lit(last_day).cast("date"))


def filter_incomplete_days(daily: DataFrame, ratio: float = INCOMPLETE_RATIO,
                           col: str = "total_trips") -> DataFrame:
    """Keep days with col >= ratio * median(col) over the given days.

    The median is an uncorrelated scalar subquery: Spark runs it once and
    compares every row with the literal result (no join, no single-task
    window over the series).
    """
    med = daily.select(F.median(col)).scalar()
    return daily.filter(F.col(col) >= med * F.lit(ratio))


def filter_selected_range(df: DataFrame, start, end, col: str = "pickup_date") -> DataFrame:
    def as_col(v):
        if isinstance(v, Column):
            return v
        return F.lit(str(v)).cast("date")
    return df.filter(F.col(col).between(as_col(start), as_col(end)))
