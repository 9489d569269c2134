"""Sinks: layered databases, create-or-replace tables, views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .schema import LAYERS


def create_layers(spark: SparkSession, layers=LAYERS) -> None:
    for db in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")


def ctas_table(df: DataFrame, name: str, partition_by: list[str] | None = None,
               path: str | None = None, fmt: str = "parquet") -> DataFrame:
    """CREATE OR REPLACE TABLE name AS df; returns a DataFrame on the saved table.

    Reading back the saved table cuts the lineage: later models start from
    files on shared storage, so a lost executor never recomputes upstream.
    """
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def view_materialization(df: DataFrame, name: str) -> DataFrame:
    """Materialise as a (temporary) view: nothing is computed until read."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
