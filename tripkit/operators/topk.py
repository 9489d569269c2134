"""Sorting and top-k with explicit tie-breaks (TakeOrderedAndProject)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def order_by_metric_desc(df: DataFrame, metric: str, tiebreak: str) -> DataFrame:
    return df.orderBy(F.col(metric).desc(), F.col(tiebreak).asc_nulls_last())


def top_k(df: DataFrame, metric: str, k: int, tiebreak: str) -> DataFrame:
    """ORDER BY metric DESC, tiebreak ASC LIMIT k: a per-partition top-k and a
    k-row merge, so no full sort or shuffle of the input."""
    return order_by_metric_desc(df, metric, tiebreak).limit(k)


def bottom_k(df: DataFrame, metric: str, k: int, tiebreak: str) -> DataFrame:
    return df.orderBy(F.col(metric).asc(), F.col(tiebreak).asc_nulls_last()).limit(k)
