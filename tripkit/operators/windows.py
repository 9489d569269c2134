"""Window operators.

These run on aggregated series (zones, days, hours), never on trips: a
window without PARTITION BY gathers its input in one task, so each function
takes the already-aggregated DataFrame whose size is bounded by the key
domain (about 265 zones, a few thousand days).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def popularity_rank(zones: DataFrame, metric: str = "total_trips",
                    out: str = "popularity_rank") -> DataFrame:
    """RANK() OVER (ORDER BY metric DESC): ties share a rank, gaps follow."""
    return zones.withColumn(out, F.rank().over(Window.orderBy(F.col(metric).desc())))


def moving_avg(series: DataFrame, metric: str, order: str = "pickup_date",
               before: int = 3, after: int = 3, out: str = "ma7") -> DataFrame:
    """Centred moving mean over rows (not calendar days), at least one row."""
    w = Window.orderBy(order).rowsBetween(-before, after)
    return series.withColumn(out, F.avg(metric).over(w))


def every_nth_row(series: DataFrame, n: int = 30, order: str = "pickup_date") -> DataFrame:
    """Rows 1, n+1, 2n+1, ... in ``order`` (range-slider options)."""
    w = Window.orderBy(order)
    return (series.withColumn("_rn", F.row_number().over(w))
            .filter((F.col("_rn") - 1) % n == 0)
            .withColumn("option_index", ((F.col("_rn") - 1) / n).cast("int"))
            .drop("_rn"))
