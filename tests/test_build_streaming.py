"""Layered build, build order and the incremental landing load."""

import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tripkit.plans.build import MODELS, Model, build, build_and_test, build_order, row_counts
from tripkit.sources.fixture import trips_view
from tripkit.streaming.landing import run_landing_load

from conftest import SF001
from test_sources import write_months


def test_build_order():
    assert build_order() == ["clean_trips", "daily_summary", "zone_analysis", "hourly_patterns", "trip_categories"]
    with pytest.raises(ValueError):
        build_order([Model("x", "final", ("missing",), lambda d: d)])


def test_build_tables_and_tests(spark, capsys):
    t = trips_view(spark, SF001)
    tables, results = build_and_test(spark, t, "table")
    assert spark.catalog.tableExists("staging.clean_trips") and spark.catalog.tableExists("final.daily_summary")
    assert all(r.passed for r in results.collect())
    # staging checks counted in the marts' pass == the same checks on the saved tables
    from tripkit.operators.expect import RULES, run_tests
    plain = run_tests(spark, {k: spark.table(f"{lyr}.{k}") for k, lyr in
                              [("clean_trips", "staging"), ("daily_summary", "final"),
                               ("zone_analysis", "final"), ("hourly_patterns", "final")]}, RULES)
    assert sorted(map(tuple, results.collect())) == sorted(map(tuple, plain.collect()))
    counts = {r.table_name: r.row_count for r in row_counts(tables).collect()}
    assert counts["clean_trips"] == tables["daily_summary"].agg(F.sum("total_trips")).first()[0]
    # staging is not split by month of year
    assert not [c.name for c in spark.catalog.listColumns("staging.clean_trips") if c.isPartition]


def test_build_as_views(spark):
    t = trips_view(spark, SF001)
    tables = build(spark, t, "view")
    assert spark.table("daily_summary").count() == tables["daily_summary"].count()
    assert len(MODELS) == 5


def test_landing_load_is_incremental(spark, tmpdir_path):
    paths = write_months(tmpdir_path)
    landing = os.path.join(tmpdir_path, "landing")
    os.makedirs(landing)
    # same-typed files only (the batch loader handles divergent types)
    pq.write_table(pq.read_table(paths["2024-01"]), os.path.join(landing, "a.parquet"))
    target = os.path.join(tmpdir_path, "raw_stream")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    assert run_landing_load(spark, landing, target, ckpt) == 3
    assert run_landing_load(spark, landing, target, ckpt) == 0      # nothing new: skipped
    pq.write_table(pq.read_table(paths["2024-01"]), os.path.join(landing, "b.parquet"))
    assert run_landing_load(spark, landing, target, ckpt) == 3
    out = spark.read.parquet(target)
    assert out.count() == 6 and out.select("load_month").distinct().first()[0] == "2024-01"
    # the file sink's commit log: readers see committed batches only
    assert os.path.isdir(os.path.join(target, "_spark_metadata"))


def test_landing_backlog_in_small_batches_and_two_loads(spark, tmpdir_path):
    """Every row of a long backlog is counted, and each landing folder has a checkpoint of its own."""
    import datetime as dt
    import os
    import pyarrow as pa
    import pyarrow.parquet as pq
    from tripkit.sources.schema import TRIPS
    from tripkit.streaming.landing import run_landing_load
    def land(name, files, rows):
        folder = os.path.join(tmpdir_path, name)
        os.makedirs(folder)
        for k in range(files):
            at = [dt.datetime(2024, 1, 1 + k % 28)] * rows
            pq.write_table(pa.table({"tpep_pickup_datetime": pa.array(at, pa.timestamp("us")), "vendorid": pa.array([k] * rows, pa.int64())}), os.path.join(folder, f"{k}.parquet"))
        return folder
    long, other = land("long", 104, 3), land("other", 2, 5)
    target = os.path.join(tmpdir_path, "a")
    assert run_landing_load(spark, long, target, max_files_per_trigger=1) == 312
    assert run_landing_load(spark, long, target) == 0
    assert run_landing_load(spark, other, os.path.join(tmpdir_path, "b")) == 10
