"""The ``trips`` fixture: driver tables mapped onto the RAW trips schema.

Each lineitem row becomes one trip; its order supplies the calendar day
(shifted by 28 years, which keeps weekdays). Every other column is an
arithmetic rule on the line's keys, so the view grows with the tables.
Only ``l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
l_linestatus`` and ``o_orderkey, o_orderdate`` are read (column pruning
reaches the Parquet scan).
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schema import TRIPS_NAMES

LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_linestatus"]
ORDERS_COLS = ["o_orderkey", "o_orderdate"]


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _double(x) -> Column:
    return (x if isinstance(x, Column) else F.lit(x)).cast("double")


def _zone_mod(pk: Column, ok: Column, m: int = 263) -> Column:
    """(pk*pk + ok) % m, reduced before multiplying: the same value for the
    non-negative TPC-H keys, but pk*pk overflows BIGINT (an error under ANSI)
    once part keys pass ~3e9, i.e. at the 100 TB scale factors."""
    r = pk % m
    return (r * r + ok % m) % m


def trip_seconds() -> tuple[Column, Column]:
    """(second of the day of a line's pickup, length of its trip in seconds)."""
    ok, pk, sk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    return (ok * 7919 + ln * 104729 + pk * 31) % 86400, (pk * 37 + sk * 101 + ln * 613) % 5400 - 60


def _base() -> Column:
    return F.col("o_orderdate") + F.expr("INTERVAL '28' YEAR")


def pickup_time() -> Column:
    """When a line's trip begins."""
    return F.timestamp_add("SECOND", trip_seconds()[0].cast("int"), _base())


def trips_from_lines(lines: DataFrame) -> DataFrame:
    """Map joined (lineitem, o_orderdate) rows to the 19 RAW columns."""
    ok, pk, sk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    qty = F.col("l_quantity")
    sec, dur = trip_seconds()
    every7 = (ok % 7) == 0
    cents = _double(pk % 1000) / 100
    return lines.select(
        (1 + ln % 2).cast("bigint").alias("vendorid"),
        pickup_time().alias("tpep_pickup_datetime"),
        F.timestamp_add("SECOND", (sec + dur).cast("int"), _base()).alias("tpep_dropoff_datetime"),
        F.when(every7, F.lit(None)).otherwise(_double(1 + ln % 6)).alias("passenger_count"),
        F.when(ok % 997 == 0, _double(1500))
         .otherwise(_double((pk * 53 + ok * 17) % 2500) / 100).alias("trip_distance"),
        F.when(every7, F.lit(None)).otherwise(_double(1 + sk % 6)).alias("ratecodeid"),
        F.when(every7, F.lit(None)).otherwise(F.col("l_linestatus")).alias("store_and_fwd_flag"),
        F.when(ok % 53 == 0, F.lit(None))
         .otherwise((1 + _zone_mod(pk, ok)).cast("bigint")).alias("pulocationid"),
        F.when(ok % 59 == 0, F.lit(None))
         .otherwise((1 + (sk * 7 + pk) % 263).cast("bigint")).alias("dolocationid"),
        (1 + ok % 4).cast("bigint").alias("payment_type"),
        F.when(ok % 31 == 0, -qty).when(ok % 37 == 0, _double(0)).otherwise(qty).alias("fare_amount"),
        (_double(ln % 3) / 2).alias("extra"),
        _double(0.5).alias("mta_tax"),
        F.when(ok % 4 == 0, cents).otherwise(_double(0)).alias("tip_amount"),
        _double(0).alias("tolls_amount"),
        _double(1).alias("improvement_surcharge"),
        F.when(ok % 31 == 0, -qty).otherwise(qty + cents).alias("total_amount"),
        F.when(every7, F.lit(None)).otherwise(_double(2.5)).alias("congestion_surcharge"),
        F.when(every7, F.lit(None)).otherwise(_double(1.75)).alias("airport_fee"),
    )


def joined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The needed columns of ``lineitem JOIN orders ON l_orderkey = o_orderkey``, without ``o_orderkey``.

    Both sides grow with the data, so both are shuffled. The join hashes the
    orders of a partition, a small part of its rows; a sort-merge join would
    sort the lines too, which spills.
    """
    li = read_table(spark, sf_dir, "lineitem").select(*LINEITEM_COLS)
    od = read_table(spark, sf_dir, "orders").select(*ORDERS_COLS)
    return li.join(od.hint("shuffle_hash"), li.l_orderkey == od.o_orderkey, "inner").drop("o_orderkey")


def trips_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW-shaped trips: every joined line."""
    out = trips_from_lines(joined_lines(spark, sf_dir))
    assert out.columns == TRIPS_NAMES
    return out
