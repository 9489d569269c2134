"""Whole-table order operators without gathering the table in one task.

A window without PARTITION BY sends all rows to one task. Here the rows are dealt by ranges of the order columns, and a row's
number is its place in its partition plus the rows of the partitions before: only one count a partition is gathered. Results
equal those of the windows in ``windows``, which remain the shorter way for results bounded by days or zones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def _offsets(counts: DataFrame) -> Column:
    """The rows before a partition, looked up by ``_task``: from (_task, _rows), a row a partition."""
    before, total = {}, 0
    for r in counts.orderBy("_task").collect():
        before[r["_task"]] = total
        total += r["_rows"]
    last = max(before, default=-1)
    if last < 0:
        return F.lit(0).cast("bigint")
    dense = [before.get(k, 0) for k in range(last + 1)]
    return F.element_at(F.array(*[F.lit(n).cast("bigint") for n in dense]), (F.col("_task") + 1).cast("int"))


def row_numbers(df: DataFrame, order: list[str], out: str = "row_number") -> DataFrame:
    """``df`` with ``out``: 1, 2, ... in ascending ``order`` (nulls first).

    Rows that are equal in ``order`` are numbered by all other columns and, where they are equal in those too, in any order, so a
    value that most rows share still spreads over the partitions. The result is a written table.
    """
    # the row travels as one value: no column of ``df`` meets a name of ours
    rest = [c for c in df.columns if c not in order]
    row = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.monotonically_increasing_id().alias("origin"))
    ties = [F.col(f"row.`{c}`") for c in rest if _orderable(df, c)]
    keys = [*[F.col(f"row.`{c}`") for c in order], *ties, F.col("origin")]
    # written first: the range partitioner samples its input, and the second read must be the same rows
    placed = materialize(row, "series_rows").repartitionByRange(*keys).sortWithinPartitions(*keys).select("row", F.monotonically_increasing_id().alias("place"))
    placed = materialize(placed.withColumn("_task", F.shiftright("place", 33)), "series_placed")
    counts = placed.groupBy("_task").agg(F.count("*").alias("_rows"))
    number = _offsets(counts) + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.select(*[F.col(f"row.`{c}`") for c in df.columns], number.alias(out))


def _orderable(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() not in ("map", "variant")


def value_rank(df: DataFrame, metric: str, out: str = "rank", descending: bool = True) -> DataFrame:
    """``df`` with RANK() OVER (ORDER BY metric): equal values share a rank, gaps follow; nulls come last when descending.

    The rank of a value is one more than the rows of the values before it, so the rows are counted by value first (partially,
    before the shuffle: a value that most rows have is one row a task) and only the values are put in order. The ranks join the
    rows by value; the planner broadcasts them while they are few, and splits a hot value where they are not.
    """
    order = F.col("__value").desc() if descending else F.col("__value").asc()
    # -0.0 and 0.0 are one value, as they are to ORDER BY
    values = materialize(df.groupBy(F.col(metric).alias("__value")).agg(F.count("*").alias("_n")), "series_values")
    placed = values.repartitionByRange(order).withColumn("_task", F.spark_partition_id())
    placed = materialize(placed, "series_values_placed")
    counts = placed.groupBy("_task").agg(F.sum("_n").alias("_rows"))
    inside = F.sum("_n").over(Window.partitionBy("_task").orderBy(order)) - F.col("_n")
    ranks = placed.select("__value", (_offsets(counts) + inside + 1).alias(out))
    return df.join(ranks, F.col(metric).eqNullSafe(F.col("__value")), "left").drop("__value")


def every_nth(df: DataFrame, n: int, order: list[str], out: str = "option_index") -> DataFrame:
    """Rows 1, n+1, 2n+1, ... in ``order``, with their number among those from 0."""
    numbered = row_numbers(df, order, "_number")
    return numbered.filter((F.col("_number") - 1) % n == 0) \
        .withColumn(out, F.floor((F.col("_number") - 1) / n).cast("bigint")).drop("_number")


# Rows of a block of ``moving_mean``: what one task holds of the series at a time.
BLOCK = 8192


def moving_mean(series: DataFrame, metric: str, order: list[str], before: int = 3, after: int = 3, out: str = "ma7") -> DataFrame:
    """``series`` with the mean of ``metric`` over the rows from ``before`` rows earlier to ``after`` rows later in ``order``.

    The rows are numbered and cut into blocks; a block gets the last rows of the block before and the first of the block after,
    so its own rows see their whole frame. At the ends of the series the frame is shorter, as in a window.
    """
    if before + after >= BLOCK:
        raise ValueError(f"a frame of {before + after + 1} rows does not fit a block of {BLOCK}")
    numbered = row_numbers(series, order, "_number")
    number = F.col("_number") - 1
    own = F.floor(number / BLOCK).cast("bigint")
    # the first rows of a block are seen by the one before it, the last ones by the one after it
    seen = F.array_distinct(F.array(F.floor((number - after) / BLOCK).cast("bigint"), own, F.floor((number + before) / BLOCK).cast("bigint")))
    lent = numbered.withColumn("_own", own).withColumn("_block", F.explode(seen))
    frame = Window.partitionBy("_block").orderBy("_number").rowsBetween(-before, after)
    return lent.withColumn(out, F.avg(metric).over(frame)).filter(F.col("_block") == F.col("_own")).drop("_number", "_own", "_block")
