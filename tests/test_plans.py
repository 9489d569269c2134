"""Physical-plan properties the design relies on (checked with explain)."""

import pytest
from pyspark.sql import functions as F

from tripkit.plans.registry import REGISTRY

from conftest import SF001


def plan(df, capsys):
    df.explain(mode="formatted")
    return capsys.readouterr().out


def test_dashboard_filters_reach_the_scan(spark, capsys):
    out = plan(REGISTRY["dash_daily"](spark, SF001), capsys)
    assert "GreaterThan(trip_distance,0.0)" in out
    assert "GreaterThanOrEqual(pickup_day,2023-01-01)" in out
    read = [l for l in out.splitlines() if l.startswith("ReadSchema")][0]
    assert "vendorid" not in read and "airport_fee" not in read and "passenger_count" not in read


def test_date_window_reads_the_pages_of_its_days(spark):
    """Rows that leave the Parquet scan for one week of about seven years."""
    from tripkit.operators.filters import filter_date_window
    from tripkit.sources.raw import raw_trips
    trips = raw_trips(spark, "/root/testdata/sf0.1", with_day=True)
    week = filter_date_window(trips, "2024-03-04", "2024-03-11").select("tpep_pickup_datetime", "fare_amount")
    hits = len(week.collect())
    plan = week._jdf.queryExecution().executedPlan()
    scanned = plan.collectLeaves().head().metrics().get("numOutputRows").get().value()
    total = trips.count()
    assert 0 < hits <= scanned < total / 10


def test_partial_aggregation_before_shuffle(spark, capsys):
    out = plan(REGISTRY["daily_summary"](spark, SF001), capsys)
    assert "partial_count" in out and "partial_sum" in out


def test_topk_is_take_ordered(spark, capsys):
    assert "TakeOrderedAndProject" in plan(REGISTRY["dash_zones"](spark, SF001), capsys)


def test_zone_dimension_is_broadcast(spark, capsys):
    out = plan(REGISTRY["zone_name_lookup"](spark, SF001), capsys)
    assert "BroadcastHashJoin" in out and "SortMergeJoin" not in out


def test_quality_profile_is_one_scan(spark, capsys):
    out = plan(REGISTRY["dq_summary"](spark, SF001), capsys)
    import re
    assert len(re.findall(r"^\(\d+\) Scan parquet", out, re.M)) == 1


@pytest.mark.parametrize("name", ["weekly_profile", "complete_days", "period_extremes"])
def test_exploration_reads_the_written_aggregate(spark, capsys, name):
    out = plan(REGISTRY[name](spark, SF001), capsys)
    # scans of the written daily aggregate only, never of the trips
    assert "struct<tpep_pickup_datetime" not in out


def test_weekly_profile_plans_the_chain_once(spark, capsys):
    import re
    out = plan(REGISTRY["weekly_profile"](spark, SF001), capsys)
    # one scan for the weekly chain and one inside the median subquery of
    # complete_days (both of the stored daily aggregate); the grand mean of the
    # seven values is a window, not a second copy of the chain
    assert len(re.findall(r"^\(\d+\) Scan parquet", out, re.M)) == 2
    assert "Window" in out


def test_row_counts_scan_raw_for_both_counts_once(spark, capsys):
    import re
    out = plan(REGISTRY["row_count_check"](spark, SF001), capsys)
    raw_scans = [m for m in re.findall(r"^ReadSchema: (.*)$", out, re.M) if "tpep_pickup_datetime" in m]
    # RAW + staging counts in one scan; the marts are counted on the one-pass
    # aggregate, written when the query is built
    assert len(raw_scans) == 1


def test_data_tests_scan_raw_once(spark, capsys):
    import re
    out = plan(REGISTRY["run_tests"](spark, SF001), capsys)
    # the staging checks were counted in the marts' one pass (written when
    # the query is built); the final plan reads only that written aggregate
    raw_scans = [m for m in re.findall(r"^ReadSchema: (.*)$", out, re.M) if "tpep_pickup_datetime" in m]
    assert raw_scans == []


def test_raw_build_shuffles_and_sorts_lines_not_trips(spark, capsys, tmpdir_path):
    """No shuffle or sort of the RAW build holds a trip's 19 columns, the join sorts nothing, and the rows are those of the view."""
    import re
    from tripkit.sources.fixture import joined_lines, trips_view
    from tripkit.sources.raw import clustered_trips
    from tripkit.sources.schema import TRIPS_NAMES
    lines = spark.range(3000).selectExpr(
        "id % 700 + 1 AS l_orderkey", "id * 7 % 500 AS l_partkey", "id % 40 AS l_suppkey", "CAST(id % 7 + 1 AS INT) AS l_linenumber",
        "CAST(id % 50 AS DOUBLE) AS l_quantity", "IF(id % 2 = 0, 'O', 'F') AS l_linestatus")
    lines.unionByName(lines.limit(9).withColumn("l_orderkey", F.lit(None).cast("bigint"))).write.parquet(f"{tmpdir_path}/lineitem.parquet")
    orders = spark.range(1, 650).selectExpr("id AS o_orderkey", "IF(id % 90 = 0, NULL, CAST(date_add(DATE'1995-01-01', CAST(id % 2400 AS INT)) AS TIMESTAMP_NTZ)) AS o_orderdate")
    orders.unionByName(orders.limit(3)).write.parquet(f"{tmpdir_path}/orders.parquet")
    built = clustered_trips(joined_lines(spark, tmpdir_path))
    out = plan(built, capsys)
    assert "SortMergeJoin" not in out and "BroadcastHashJoin" not in out and "ShuffledHashJoin" in out
    moved = re.findall(r"^\(\d+\) (?:Exchange|Sort)\nInput \[(\d+)\]", out, re.M)
    assert len(moved) >= 4 and max(map(int, moved)) <= 9
    assert built.columns == [*TRIPS_NAMES, "pickup_day"]
    view = trips_view(spark, tmpdir_path)
    assert view.count() > 2500 and view.exceptAll(built.select(*TRIPS_NAMES)).count() == 0 and built.select(*TRIPS_NAMES).exceptAll(view).count() == 0
    assert built.filter("NOT pickup_day <=> to_date(tpep_pickup_datetime)").count() == 0


def test_raw_build_leaves_the_session_as_it_was(spark, tmpdir_path):
    from tripkit.session import settings
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    with pytest.raises(ValueError):
        with settings(spark, {key: "24MB"}):
            assert spark.conf.get(key) == "24MB"
            raise ValueError
    assert spark.conf.get(key) == before and spark.conf.get(key, None) is None


def test_materialize_leaves_no_shuffle_files(spark, tmpdir_path):
    """The files of the shuffles behind a written intermediate go with the write, not with the driver's next garbage collection."""
    import time
    from tripkit.session import materialize

    def shuffles():
        return set(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n"))

    before = shuffles()
    df = spark.range(100_000).groupBy((F.col("id") % 1000).alias("k")).agg(F.max("id").alias("m"))
    held = materialize(df)
    for _ in range(50):
        left = {f for f in shuffles() - before if "shuffle_" in f}
        if not left:
            break
        time.sleep(0.1)
    assert not left and held.count() == df.count() == 1000
