"""Sums of doubles that do not depend on the order of addition.

A double below 2^42 in size is cut, without loss, into whole numbers of 2^-8, 2^-28, 2^-48 and 2^-68; each part is added up as a
BIGINT, which is the same in any order, and the four sums are put together as one DECIMAL, which holds any of them, and rounded once
to a double. So a sum is the correctly rounded sum of its values, bit for bit alike for any partitioning, retry or merge of partial
sums. A part has at most 20 bits, so it adds up over 2^43 rows, and the whole ones up to a sum of 2^55; past that BIGINT overflows
with an error, as any BIGINT sum. What has bits below 2^-68, is not below 2^42, infinite or NaN goes, that part of it alone, through
an ordinary sum.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import _c

_TOP, _STEP, _PARTS = 8, 20, 4
PARTS = ("whole", "upper", "middle", "lower", "loose")


def exact_parts(x) -> dict[str, Column]:
    """The five parts of a double: four BIGINT, and what they can't hold as a double."""
    x = _c(x).cast("double")
    tame = F.abs(x) < 2.0 ** 42
    t, parts = F.when(tame, x), {}
    for k, name in enumerate(PARTS[:_PARTS]):
        unit = 2.0 ** -(_TOP + _STEP * k)
        # the remainder and the quotient by a power of two are exact, and toward zero
        parts[name] = ((t if k == 0 else t % (unit * 2.0 ** _STEP)) / unit).cast("bigint")
    return {**parts, "loose": F.when(tame, x % unit).otherwise(x)}


def exact_states(x, name: str) -> list[Column]:
    """Mergeable partial sums of ``x``: aggregates ``<part>_<name>``."""
    return [F.sum(part).alias(f"{p}_{name}") for p, part in exact_parts(x).items()]


def exact_total(sums: list[Column]) -> Column:
    """The double that five (sums of) parts stand for; NULL without a value."""
    *whole, loose = sums
    total = None
    for k, part in enumerate(whole):
        scale = F.lit(Decimal(1 << _STEP * (_PARTS - 1 - k)))
        term = part.cast("decimal(19,0)") * scale if k < _PARTS - 1 else part.cast("decimal(19,0)")
        total = term if total is None else total + term
    # every value has a loose part, if only 0: without values there is none
    return F.coalesce(total.cast("double") * 2.0 ** -(_TOP + _STEP * (_PARTS - 1)), F.lit(0.0)) + loose


def exact_sum(x) -> Column:
    """SUM(x) as the correctly rounded double, whatever the order."""
    return exact_total([F.sum(p) for p in exact_parts(x).values()])


def exact_avg(x) -> Column:
    """AVG(x): the exact sum, rounded, by the number of values."""
    return exact_sum(x) / F.nullif(F.count(_c(x)), F.lit(0))


def merged_sum(name: str) -> Column:
    """The exact sum of merged partial sums ``<part>_<name>``."""
    return exact_total([F.sum(f"{p}_{name}") for p in PARTS])
