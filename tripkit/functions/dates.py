"""Date helpers: labels, month periods, shifted and clamped dates, epochs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import _c

def epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")

_UNIT_MICROS = {"s": 1_000_000, "ms": 1_000, "us": 1}

# Weekday order and short French labels (Monday first).
DAY_ORDER = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
DAY_FR = ["Lun.", "Mar.", "Mer.", "Jeu.", "Ven.", "Sam.", "Dim."]


def day_name(d) -> Column:
    """English weekday name."""
    return F.date_format(_c(d), "EEEE")


def iso_weekday(d) -> Column:
    """1 = Monday ... 7 = Sunday (the display order of the weekly profile)."""
    return ((F.dayofweek(_c(d)) + 5) % 7) + 1


def month_period(d) -> Column:
    """'yyyy-MM' of a date (a monthly period)."""
    return F.date_format(_c(d), "yyyy-MM")


def date_label(d, fmt: str = "d MMM yyyy") -> Column:
    return F.date_format(_c(d), fmt)


def shift_months(d, k) -> Column:
    """d minus k months, end of month clamped (2024-03-31 - 1 -> 2024-02-29)."""
    return F.add_months(_c(d), -_c(k) if isinstance(k, Column) else -int(k))


def clamp_dates(d, lo, hi) -> Column:
    """d limited to [lo, hi]; a NULL date stays NULL (``greatest``/``least``
    alone skip NULLs and would return a bound)."""
    x = _c(d)
    return F.when(x.isNotNull(), F.least(F.greatest(x, _c(lo)), _c(hi)))


# Microseconds since 1970-01-01 of 0001-01-01 00:00 and 9999-12-31 23:59:59.999999.
_MIN_MICROS = -62_135_596_800_000_000
_MAX_MICROS = 253_402_300_799_999_999


def epoch_repair(raw, unit: str = "us") -> Column:
    """TIMESTAMP_NTZ from an integer count since 1970-01-01 in ``unit``.

    Used when a timestamp column arrives as BIGINT (for instance microseconds
    that a loader took for seconds). No session time zone is involved.
    """
    per = _UNIT_MICROS[unit]
    raw_l = _c(raw).cast("bigint")
    # try_multiply: an absurd count in a dirty file gives NULL, not an ANSI
    # overflow error; so does anything outside years 1..9999
    micros = F.try_multiply(raw_l, F.lit(per).cast("bigint")) if per != 1 else raw_l
    in_range = micros.between(F.lit(_MIN_MICROS), F.lit(_MAX_MICROS))
    return F.when(in_range, F.timestamp_add("MICROSECOND", micros, epoch_ntz()))


def to_epoch(ts, unit: str = "us") -> Column:
    """Inverse of ``epoch_repair`` (floor division for non-micro units)."""
    micros = F.timestamp_diff("MICROSECOND", epoch_ntz(), _c(ts))
    per = _UNIT_MICROS[unit]
    return micros if per == 1 else F.floor(micros.cast("decimal(20,0)") / F.lit(per)).cast("bigint")
