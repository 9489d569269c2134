"""Order operators and medians dealt over tasks, against windows and sorted lists."""

import math
import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tripkit.operators import series as S
from tripkit.operators.medians import grouped_median
from tripkit.sources.raw import raw_trips

from conftest import SF001


def single_exchange(df):
    """Whether an executed plan gathers its rows in one partition."""
    return "SinglePartition" in df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def trips(spark):
    return raw_trips(spark, SF001).repartition(5)


def test_rank_of_trips_equals_the_window(spark, trips):
    for down in (True, False):
        order = F.col("trip_distance").desc() if down else F.col("trip_distance").asc()
        want = trips.select("trip_distance", "pulocationid", F.rank().over(Window.orderBy(order)).alias("rank"))
        got = S.value_rank(trips, "trip_distance", descending=down)
        assert sorted(map(str, got.select("trip_distance", "pulocationid", F.col("rank").cast("int")).collect())) == sorted(map(str, want.collect()))
        assert not single_exchange(got) and single_exchange(want)


def test_rank_with_a_hot_value_nulls_and_no_rows(spark):
    rows = [(5.0,)] * 500 + [(float(k % 40),) for k in range(300)] + [(None,)] * 30 + [(-0.0,), (0.0,), (math.inf,), (math.nan,)]
    df = spark.createDataFrame(rows, "v double").repartition(4)
    want = df.select("v", F.rank().over(Window.orderBy(F.col("v").desc())).alias("rank"))
    assert sorted(map(str, S.value_rank(df, "v").select("v", F.col("rank").cast("int")).collect())) == sorted(map(str, want.collect()))
    assert S.value_rank(df.limit(0), "v").count() == 0


def test_row_numbers_and_every_nth(spark, trips):
    order = ["tpep_pickup_datetime", "tpep_dropoff_datetime"]
    got = S.row_numbers(trips, order)
    rows = got.orderBy("row_number").collect()
    assert [r["row_number"] for r in rows] == list(range(1, trips.count() + 1)) and not single_exchange(got)
    times = [(r[order[0]], r[order[1]]) for r in rows]
    assert times == sorted(times)
    total = [*order, *[c for c in trips.columns if c not in order]]
    want = trips.withColumn("n", F.row_number().over(Window.orderBy(*total))).filter((F.col("n") - 1) % 100 == 0)
    got = S.every_nth(trips, 100, order)
    assert sorted(str(tuple(r)[:-1]) for r in got.collect()) == sorted(str(tuple(r)[:-1]) for r in want.collect())
    assert sorted(r["option_index"] for r in got.collect()) == list(range(-(-trips.count() // 100)))
    # one value in every row: the rows are dealt all the same
    same = S.row_numbers(spark.range(1000).select(F.lit(1).alias("k"), F.lit("x").alias("_place")), ["k"])
    assert sorted(r["row_number"] for r in same.collect()) == list(range(1, 1001))
    assert S.row_numbers(trips.limit(0), order).count() == 0


@pytest.mark.parametrize("block", [16, 8192])
def test_moving_mean_equals_the_window(spark, trips, monkeypatch, block):
    monkeypatch.setattr(S, "BLOCK", block)
    seconds = trips.groupBy(F.date_trunc("HOUR", "tpep_pickup_datetime").alias("at")).agg(F.count("*").cast("double").alias("n"))
    for before, after in ((3, 3), (6, 1)):
        want = seconds.withColumn("ma7", F.avg("n").over(Window.orderBy("at").rowsBetween(-before, after)))
        got = S.moving_mean(seconds, "n", ["at"], before, after)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and not single_exchange(got)
    with pytest.raises(ValueError):
        S.moving_mean(seconds, "n", ["at"], block, 0)


def median(values):
    a = sorted(values, key=lambda x: (math.isnan(x), x))
    low, high = a[(len(a) - 1) // 2], a[len(a) // 2]
    return low if low == high else (low + high) / 2


def test_median_of_trips_per_zone(spark, trips):
    got = {r["pulocationid"]: (r["median"], r["n"]) for r in grouped_median(trips, ["pulocationid"], "total_amount").collect()}
    values = {}
    for r in trips.select("pulocationid", "total_amount").collect():
        values.setdefault(r[0], []).append(r[1])
    assert got == {k: (statistics.median(v), len(v)) for k, v in values.items()}


def test_median_of_odd_values(spark):
    r = random.Random(4)
    groups = {"one": [1.5], "two": [1.0, 2.0], "same": [3.25] * 9, "wide": [10.0 ** r.uniform(-300, 300) * r.choice([-1, 1]) for _ in range(401)],
              "huge": [-1.7e308, 1.7e308, 1.7e308, 1e-320, -1.7e308], "infinite": [-math.inf, -math.inf, 2.0, 3.0, math.inf], "ends": [math.inf, math.inf, 1.0],
              "nan": [math.nan, math.nan, 1.0], "hot": [7.0] * 300 + [r.random() for _ in range(200)], "close": [1.0 + k * 2.0 ** -52 for k in range(100)],
              None: [0.1, 0.2, 0.3, 0.4]}
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("empty", None)] * 3 + [("two", None)] * 5
    got = grouped_median(spark.createDataFrame(rows, "k string, v double").repartition(4), ["k"], "v").collect()
    assert {r["k"]: (str(r["median"]), r["n"]) for r in got} == {**{k: (str(median(v)), len(v)) for k, v in groups.items()}, "empty": ("None", 0)}
    assert grouped_median(spark.createDataFrame([], "k string, v double"), ["k"], "v").count() == 0
