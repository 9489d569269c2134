"""Positions of rows within their group, by range partitions: no group is gathered in a task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def numbered(rows: DataFrame, group: str, order: list[str], name: str = "numbered") -> DataFrame:
    """``rows`` with ``idx`` (from 0, within ``group`` by ``order``; nulls first) and ``size`` (rows of the group).

    The rows are range-partitioned by group, order and place of origin, so a group of any size and any number of equal rows
    spreads over the partitions; a row's position is its offset in its partition plus what the group has in earlier ones.
    Only one count a (group, partition) is shuffled besides. ``rows`` should be a written table: the partitioner samples it.
    The result is a written table.
    """
    keys = [group, *order, "_origin"]
    placed = rows.withColumn("_origin", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys) \
        .withColumn("_place", F.monotonically_increasing_id()).drop("_origin")
    # the id's upper bits are the partition's number, the lower 33 the row's in it
    placed = materialize(placed.withColumn("_task", F.shiftright("_place", 33)), f"{name}_placed")
    runs = placed.groupBy(group, "_task").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    by_group = Window.partitionBy(group)
    runs = runs.withColumns({"size": F.sum("_n").over(by_group),
                             "_before": F.sum("_n").over(by_group.orderBy("_task")) - F.col("_n")}).drop("_n")
    return materialize(placed.join(runs, [group, "_task"]).withColumn("idx", F.col("_place") - F.col("_first") + F.col("_before"))
                       .drop("_task", "_place", "_first", "_before"), name)
