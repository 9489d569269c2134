"""Zone dimension: location id -> zone name.

The production lookup (263 ids) is public data and is passed in as a file,
not typed into code. For the test tables, ``zones_fixture`` derives a
dimension from ``nation`` by a rule, so several ids share one name the way
some real zones do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixture import read_table

N_ZONES = 263


def zones_from_file(spark: SparkSession, path: str, fmt: str | None = None,
                    id_col: str = "LocationID", name_col: str = "Zone") -> DataFrame:
    """Read a lookup file (CSV with header, or Parquet) into (location_id, zone_name)."""
    fmt = fmt or ("csv" if path.lower().endswith(".csv") else "parquet")
    reader = spark.read.option("header", "true") if fmt == "csv" else spark.read
    df = reader.format(fmt).load(path)
    return df.select(F.col(id_col).cast("bigint").alias("location_id"),
                     F.col(name_col).cast("string").alias("zone_name"))


def zones_fixture(spark: SparkSession, sf_dir: str, n_zones: int = N_ZONES) -> DataFrame:
    """ids 1..n_zones named after nation ((id - 1) mod |nation|), with a
    numeric suffix on every third id so some names are unique and others shared."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    n = nation.select(F.count(F.lit(1))).scalar()  # the modulus of the naming rule
    ids = spark.range(1, n_zones + 1).select(F.col("id").alias("location_id"), ((F.col("id") - 1) % n).alias("_nation"))
    named = ids.join(nation, F.col("n_nationkey") == F.col("_nation"), "left")
    name = F.when(F.col("location_id") % 3 == 0,
                  F.concat(F.col("n_name"), F.lit(" "), F.col("location_id").cast("string"))) \
        .otherwise(F.col("n_name"))
    return named.select("location_id", name.alias("zone_name"))
