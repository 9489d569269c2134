"""Staging model: cleaned and enriched trips."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.derive import staging_columns
from ..operators.filters import staging_filter


def clean_trips(trips: DataFrame) -> DataFrame:
    """RAW.* filtered by the four staging rules plus eight derived columns.

    The filter sits directly on the scan columns so it pushes into Parquet;
    the derived columns are one projection inside the same codegen stage.
    """
    return trips.filter(staging_filter()).withColumns(staging_columns())
