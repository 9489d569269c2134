"""Aggregate building blocks (all partial/final hash aggregation in Spark)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import _c


def conditional_sum(pred: Column) -> Column:
    """SUM(CASE WHEN pred THEN 1 ELSE 0 END) as BIGINT."""
    return F.sum(F.when(pred, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def ratio_of_sums(num, den) -> Column:
    """sum(num) / sum(den) as DOUBLE, NULL where the divisor is 0 or NULL."""
    return F.sum(_c(num)).cast("double") / F.nullif(F.sum(_c(den)).cast("double"), F.lit(0.0))


def weighted_avg(x, w) -> Column:
    """sum(x * w) / sum(w) over rows where both are present."""
    xc, wc = _c(x), _c(w)
    both = xc.isNotNull() & wc.isNotNull()
    num = F.sum(F.when(both, xc * wc))
    den = F.sum(F.when(both, wc)).cast("double")
    return num / F.nullif(den, F.lit(0.0))


def arg_max_first(key, metric, order) -> Column:
    """key of the row with the largest (numeric) metric; ties go to the
    smallest ``order``. Rows with a NULL metric never win (as pandas idxmax)."""
    m = _c(metric)
    return F.min_by(_c(key), F.when(m.isNotNull(), F.struct(-m, _c(order))))


def arg_min_first(key, metric, order) -> Column:
    """key of the row with the smallest metric; ties go to the smallest order."""
    m = _c(metric)
    return F.min_by(_c(key), F.when(m.isNotNull(), F.struct(m, _c(order))))


def series_count(df: DataFrame, date_col: str = "pickup_date", trips_col: str = "total_trips") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_days"),
        F.sum(trips_col).cast("bigint").alias("total_trips"),
        F.min(date_col).alias("first_day"),
        F.max(date_col).alias("last_day"),
    )


def rollup_total(df: DataFrame, key: str, aggs: list[Column], root: str = "NYC") -> DataFrame:
    """Subtotals per ``key`` plus one grand-total row.

    ``node`` is the key value (or ``root`` on the total row), ``parent`` is
    ``root`` for children and NULL for the root; ``is_total`` tells them apart
    even when a key value itself is NULL.
    """
    g = df.rollup(key).agg(*aggs, F.grouping(key).alias("_g"))
    is_total = F.col("_g") == 1
    return g.select(
        F.when(is_total, F.lit(root)).otherwise(F.col(key)).alias("node"),
        F.when(is_total, F.lit(None).cast("string")).otherwise(F.lit(root)).alias("parent"),
        is_total.alias("is_total"),
        *[c for c in g.columns if c not in (key, "_g")],
    )
