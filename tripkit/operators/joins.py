"""Lookups and comparisons against small dimensions or scalars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import DAY_FR, DAY_ORDER
from ..functions.derive import coalesce_name

def zone_name_lookup(df: DataFrame, zones: DataFrame, id_col: str = "zone_id",
                     out: str = "zone_name") -> DataFrame:
    """Left lookup of ``id_col`` in (location_id, zone_name); a missing name
    falls back to the id as text (NULL id stays NULL). The join is left to the
    planner, which broadcasts a dimension under its size threshold."""
    z = zones.select(F.col("location_id").alias("_lid"), F.col("zone_name").alias("_zname"))
    j = df.join(z, df[id_col] == z["_lid"], "left")
    return j.withColumn(out, coalesce_name("_zname", id_col)).drop("_lid", "_zname")


def weekday_dim(spark: SparkSession) -> DataFrame:
    """Seven rows (iso_dow 1 = Monday .. 7, English name, French label)."""
    rows = [(i + 1, DAY_ORDER[i], DAY_FR[i]) for i in range(7)]
    return spark.createDataFrame(rows, "iso_dow int, day_name string, day_fr string")


def weekday_reindex(weekly: DataFrame, key: str = "iso_dow", ordered: bool = True) -> DataFrame:
    """All seven weekdays in Monday-first order; missing days give NULL values.

    ``ordered=False`` leaves the sort to the caller (when more steps follow).
    """
    dim = F.broadcast(weekday_dim(weekly.sparkSession))
    out = dim.join(weekly, dim["iso_dow"] == weekly[key], "left").drop(weekly[key])
    return out.orderBy("iso_dow") if ordered else out
