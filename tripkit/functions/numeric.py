"""Numeric helpers: exact-half rounding and guarded division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    return F.col(x) if isinstance(x, str) else F.lit(x)


def _round_via_decimal(x, scale: int, via_scale: int) -> Column:
    """Half-up ROUND through DECIMAL(38, via_scale). What that cannot hold is
    NaN, infinite, or so large that a double has no fraction: such a value is
    its own rounding and is returned as it is."""
    c = _c(x)
    return F.coalesce(F.round(c.try_cast(f"decimal(38,{via_scale})"), scale).cast("double"), c.cast("double"))


def dec_round(x, scale: int, via_scale: int = 9) -> Column:
    """ROUND(x, scale) with half-up on the decimal value, returned as DOUBLE.

    ``round`` on a binary double rounds 2.675 down or up depending on its
    representation; going through DECIMAL(38, via_scale) first makes halves
    round away from zero the way a warehouse ROUND on NUMBER does.
    """
    return _round_via_decimal(x, scale, via_scale)


def round_pct(x, scale: int = 2) -> Column:
    """Percentage rounded the way the staging model rounds tip_percentage."""
    return _round_via_decimal(x, scale, 6)


def share_pct(part, whole) -> Column:
    """part * 100 / whole as DOUBLE, NULL on an empty whole."""
    return _c(part).cast("double") * 100.0 / F.nullif(_c(whole).cast("double"), F.lit(0.0))


def clip_nonneg(x) -> Column:
    return F.greatest(F.lit(0), _c(x))
