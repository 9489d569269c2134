"""Exact medians of groups by selection: no group's values are ever held.

Each round counts the values of a group's interval in ``BUCKETS`` equal parts and keeps the part in which the wanted rank
lies, from its least to its greatest value. Rounds cut by the values and by their logarithms in turn, so that values of all
magnitudes, and values that differ in their last bits, come down to one in a dozen rounds at most. A round is one scan and one aggregate with partial
sums, at most groups x buckets rows, however the values are spread over the groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

BUCKETS = 256


def grouped_median(df: DataFrame, keys: list[str], value: str, out: str = "median") -> DataFrame:
    """(keys, out, n): the median of each group's non-null values, the mean of the middle two where they are even in number.

    Infinite values count at their ends, NaN as the greatest, as they sort. A null key is a group; a group without values has a
    null median and n = 0. ``df`` is scanned once a round, about three times for amounts with two decimals.
    """
    keyed = df.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], F.col(value).cast("double").alias("_x"))
    names = [f"_k{i}" for i in range(len(keys))]
    # -1 and 1: infinite, 2: NaN; arithmetic is for the finite ones
    kind = F.when(F.isnan("_x"), 2).when(F.col("_x") == float("inf"), 1).when(F.col("_x") == float("-inf"), -1).otherwise(0)
    finite = F.when(kind == 0, F.col("_x"))
    totals = keyed.groupBy(*names).agg(F.count("_x").alias("n"), F.count_if(F.col("_x").isNotNull() & (kind == -1)).alias("least"),
                                       F.count(finite).alias("finite"), F.count_if(F.col("_x").isNotNull() & (kind == 1)).alias("most"),
                                       F.min(finite).alias("low"), F.max(finite).alias("high"))
    totals = materialize(totals, "median_totals")
    # the wanted ranks, from 0: one or the middle two
    ranks = F.array_distinct(F.array(F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)))
    wanted = totals.filter("n > 0").withColumn("rank", F.explode(ranks))
    at = F.col("rank")
    edge = F.when(at < F.col("least"), float("-inf")).when(at < F.col("least") + F.col("finite"), None) \
        .when(at < F.col("least") + F.col("finite") + F.col("most"), float("inf")).otherwise(float("nan"))
    state = wanted.select(*names, "rank", edge.alias("found"), "low", "high", F.col("least").alias("below"))
    state = materialize(state.withColumn("found", F.when(F.col("found").isNull() & (F.col("low") == F.col("high")), F.col("low")).otherwise(F.col("found"))), "median_state")
    turn = 0
    while not state.filter("found is null").isEmpty():
        scale = (_halved, _logarithm)[turn % 2]
        state, turn = materialize(_narrowed(keyed.filter(F.col("_x").isNotNull()), state, names, scale), "median_state"), turn + 1
    middle = state.groupBy(*names).agg(F.min("found").alias("_a"), F.max("found").alias("_b"))
    joined = totals.join(middle, [totals[k].eqNullSafe(middle[k]) for k in names], "left") if names else totals.crossJoin(middle)
    # a + (b - a) / 2 would not be the mean of the two for all doubles; equal ones, infinite ones too, are themselves
    median = F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise((F.col("_a") + F.col("_b")) / 2)
    return joined.select(*[totals[f"_k{i}"].alias(k) for i, k in enumerate(keys)], median.alias(out), "n")


def _halved(x: Column) -> Column:
    """The width of an interval of halves can't overflow."""
    return x / 2


def _logarithm(x: Column) -> Column:
    """The magnitude's logarithm with the sign of x, above that of the least double: it does not fall as x grows."""
    return F.when(x == 0, 0.0).otherwise(F.signum(x) * (F.ln(F.abs(x)) + 746))


def _narrowed(rows: DataFrame, state: DataFrame, names: list[str], scale) -> DataFrame:
    """``state`` after one round: each open interval is the bucket in which its rank lies."""
    done, open_ = state.filter("found is not null"), state.filter("found is null").drop("found").withColumnsRenamed({k: f"{k}_" for k in names})
    meet = [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in names]
    inside = rows.join(open_, [*meet, F.col("_x").between(F.col("low"), F.col("high"))])
    # the scale and the quotient do not fall as x grows, so buckets keep the order; ends that the scale can't tell apart are one
    low, high = scale(F.col("low")), scale(F.col("high"))
    share = F.coalesce(F.try_divide(scale(F.col("_x")) - low, high - low), F.lit(0.0))
    bucket = F.greatest(F.lit(0), F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1))).cast("int")
    group = [f"{k}_" for k in names] + ["rank"]
    counted = inside.groupBy(*group, "below", bucket.alias("bucket")).agg(F.count("*").alias("n"), F.min("_x").alias("low"), F.max("_x").alias("high"))
    until = F.sum("n").over(Window.partitionBy(*group).orderBy("bucket"))
    placed = counted.withColumn("until", F.col("below") + until)
    mine = placed.filter((F.col("rank") < F.col("until")) & (F.col("rank") >= F.col("until") - F.col("n")))
    narrow = mine.select(*[F.col(f"{k}_").alias(k) for k in names], "rank", F.when(F.col("low") == F.col("high"), F.col("low")).alias("found"),
                         "low", "high", (F.col("until") - F.col("n")).alias("below"))
    return done.unionByName(narrow)
