"""Exact sums: the correctly rounded sum, whatever the partitioning."""

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripkit.functions.exact import exact_avg, exact_states, exact_sum, merged_sum
from tripkit.plans import dashboard as DB
from tripkit.plans import marts
from tripkit.plans.staging import clean_trips
from tripkit.sources.raw import raw_trips
from tripkit.operators.filters import DAY

from conftest import SF001


def test_sums_are_correctly_rounded_in_any_order(spark):
    r = random.Random(1)
    groups = {"money": [round(r.uniform(-50, 200), 2) for _ in range(3000)], "small": [r.uniform(-1, 1) * 1e-3 for _ in range(3000)],
              "big": [r.uniform(-1, 1) * 2.0 ** 41 for _ in range(500)], "mixed": [r.uniform(-1, 1) * 10.0 ** r.randrange(-4, 12) for _ in range(2000)],
              "cancel": [1e12, 1e-4, -1e12, 3.0], "tenths": [0.1] * 10, "zero": [-0.0, 0.0], "halves": [2.0 ** 53, 1.0, 2.0 ** -20]}
    groups["halves"] = [2.0 ** 40, 2.0 ** -13, 2.0 ** -30]  # just above half an ulp
    odd = [("none", None), ("none", None), ("wild", 1e300), ("wild", 1.0), ("nan", math.nan), ("nan", 1.0), ("infinite", math.inf), ("infinite", 2.0)]
    rows = [(k, v) for k, vs in groups.items() for v in vs] + odd
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double")
    for n in (1, 37, 200):
        some = df.repartition(n).groupBy("k").agg(exact_sum("v").alias("s"), exact_avg("v").alias("a"), F.count("v").alias("n"))
        got = {x["k"]: x for x in some.collect()}
        assert {k: got[k]["s"] for k in groups} == {k: math.fsum(vs) for k, vs in groups.items()}
        assert all(got[k]["a"] == math.fsum(vs) / len(vs) for k, vs in groups.items())
        assert got["none"]["s"] is None and got["none"]["a"] is None and got["wild"]["s"] == 1e300
        assert math.isnan(got["nan"]["s"]) and got["infinite"]["s"] == math.inf
    # partial sums that are kept and merged later
    parts = df.repartition(9).groupBy("k", F.spark_partition_id().alias("p")).agg(*exact_states("v", "v"))
    merged = {x["k"]: x["s"] for x in parts.groupBy("k").agg(merged_sum("v").alias("s")).collect()}
    assert {k: merged[k] for k in groups} == {k: math.fsum(vs) for k, vs in groups.items()} and merged["none"] is None


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(min_value=-2.0 ** 41, max_value=2.0 ** 41).filter(lambda x: x == 0 or abs(x) > 2.0 ** -15), min_size=1, max_size=40))
def test_any_list_of_doubles(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    assert df.agg(exact_sum("v").alias("s")).first()["s"] == math.fsum(values)


@pytest.mark.parametrize("name", [*marts.MARTS, "dash_daily", "dash_hourly", "dash_zones", "dash_profile"])
def test_equal_bits_for_1_and_200_partitions(spark, name):
    trips = raw_trips(spark, SF001, with_day=True)

    def table(df):
        return marts.MARTS[name](clean_trips(df)) if name in marts.MARTS else getattr(DB, name)(df)

    one, many = (sorted(map(str, table(trips.repartition(n, F.rand(n))).collect())) for n in (1, 200))
    assert one == many and one


def test_one_scan_equals_four_queries_bit_for_bit(spark):
    trips = raw_trips(spark, SF001, with_day=True)
    for name, df in DB.dashboard_load(trips.repartition(7)).items():
        want = getattr(DB, name)(trips)
        assert sorted(map(str, df.select(*want.columns).collect())) == sorted(map(str, want.collect()))
