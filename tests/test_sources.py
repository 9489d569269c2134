"""Loading Parquet files that disagree on case, types and columns."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tripkit.sources.months import (load_months, load_summary, month_list, month_manifest, month_range,
                                    months_to_load, skip_loaded_months)
from tripkit.sources.parquet import copy_by_name, file_schemas, infer_schema, scan_parquet_glob
from tripkit.sources.schema import TRIPS, TRIPS_NAMES, catalog_df, create_fixed_schema


def _base(n, month):
    start = dt.datetime(2024, month, 1, 8, 0, 0)
    return {
        "VendorID": pa.array([1] * n, pa.int64()),
        "tpep_pickup_datetime": pa.array([start + dt.timedelta(minutes=i) for i in range(n)], pa.timestamp("us")),
        "tpep_dropoff_datetime": pa.array([start + dt.timedelta(minutes=i + 5) for i in range(n)], pa.timestamp("us")),
        "passenger_count": pa.array([1.0] * n, pa.float64()),
        "trip_distance": pa.array([2.5] * n, pa.float64()),
        "RatecodeID": pa.array([1.0] * n, pa.float64()),
        "store_and_fwd_flag": pa.array(["N"] * n),
        "PULocationID": pa.array([132] * n, pa.int64()),
        "DOLocationID": pa.array([138] * n, pa.int64()),
        "payment_type": pa.array([1] * n, pa.int64()),
        "fare_amount": pa.array([10.0] * n), "extra": pa.array([0.5] * n), "mta_tax": pa.array([0.5] * n),
        "tip_amount": pa.array([2.0] * n), "tolls_amount": pa.array([0.0] * n),
        "improvement_surcharge": pa.array([1.0] * n), "total_amount": pa.array([14.0] * n),
        "congestion_surcharge": pa.array([2.5] * n), "Airport_fee": pa.array([1.75] * n),
    }


def write_months(root):
    paths = {}
    # 2024-01: reference layout (mixed case)
    a = _base(3, 1)
    # 2024-02: INT64 passenger_count, no airport fee, an extra column
    b = _base(4, 2)
    b["passenger_count"] = pa.array([2] * 4, pa.int64())
    del b["Airport_fee"]
    b["cbd_congestion_fee"] = pa.array([0.75] * 4)
    # 2024-03: timestamps stored as raw BIGINT microseconds
    c = _base(2, 3)
    for k in ("tpep_pickup_datetime", "tpep_dropoff_datetime"):
        c[k] = pa.array([int(v.value // 1000) if hasattr(v, "value") else None for v in c[k].to_pandas()], pa.int64())
    for m, cols in (("2024-01", a), ("2024-02", b), ("2024-03", c)):
        p = os.path.join(root, f"trips_{m}.parquet")
        pq.write_table(pa.table(cols), p)
        paths[m] = p
    bad = os.path.join(root, "trips_2024-04.parquet")
    with open(bad, "wb") as f:
        f.write(b"not a parquet file")
    paths["2024-04"] = bad
    return paths


def test_copy_by_name_and_scan(spark, tmpdir_path):
    paths = write_months(tmpdir_path)
    good = [paths[m] for m in ("2024-01", "2024-02", "2024-03")]
    df = scan_parquet_glob(spark, good)
    assert df.columns == TRIPS_NAMES
    assert [f.dataType for f in df.schema.fields] == [f.dataType for f in TRIPS.fields]
    rows = df.orderBy("tpep_pickup_datetime").collect()
    assert len(rows) == 9
    feb = [r for r in rows if r.tpep_pickup_datetime.month == 2]
    assert all(r.passenger_count == 2.0 and r.airport_fee is None for r in feb)
    mar = [r for r in rows if r.tpep_pickup_datetime.month == 3]
    assert mar[0].tpep_pickup_datetime == dt.datetime(2024, 3, 1, 8, 0)
    assert rows[0].pulocationid == 132 and rows[0].vendorid == 1


def test_scan_glob_groups_many_files(spark, tmpdir_path):
    """40 files under one glob, two physical schemas: footers are read by
    tasks, each schema group is one scan, every row arrives once."""
    import glob
    import pytest
    root = os.path.join(tmpdir_path, "many")
    os.makedirs(root)
    for i in range(40):
        cols = _base(i % 5 + 1, 1 + i % 12)
        if i % 2:
            cols["passenger_count"] = pa.array([3] * (i % 5 + 1), pa.int64())
            cols["vendorid"] = cols.pop("VendorID")  # other case, same column
        pq.write_table(pa.table(cols), os.path.join(root, f"part_{i:03d}.parquet"))
    listed = file_schemas(spark, os.path.join(root, "*.parquet")).collect()
    assert len(listed) == 40 and all(r.error is None for r in listed)
    assert len({r.schema_key for r in listed}) == 2
    df = scan_parquet_glob(spark, os.path.join(root, "*.parquet"))
    assert df.columns == TRIPS_NAMES
    assert df.count() == sum(i % 5 + 1 for i in range(40))
    odd = df.filter(F.col("passenger_count") == 3.0).count()
    assert odd == sum(i % 5 + 1 for i in range(40) if i % 2)
    # an unreadable file among good ones fails the scan, as a Parquet read would
    with open(os.path.join(root, "part_bad.parquet"), "wb") as f:
        f.write(b"not a parquet file")
    bad = [r for r in file_schemas(spark, os.path.join(root, "*.parquet")).collect() if r.error]
    assert len(bad) == 1 and bad[0].schema_key is None
    with pytest.raises(Exception):
        scan_parquet_glob(spark, os.path.join(root, "*.parquet")).count()
    assert len(glob.glob(os.path.join(root, "*.parquet"))) == 41
    # all files alike: the glob is scanned as given
    same = os.path.join(tmpdir_path, "same")
    os.makedirs(same)
    for i in range(6):
        pq.write_table(pa.table(_base(3, 1 + i)), os.path.join(same, f"m_{i}.parquet"))
    df = scan_parquet_glob(spark, os.path.join(same, "*.parquet"))
    assert df.columns == TRIPS_NAMES and df.count() == 18
    assert df.filter(F.col("airport_fee") == 1.75).count() == 18


def test_load_months_isolates_bad_file(spark, tmpdir_path):
    paths = write_months(tmpdir_path)
    target = os.path.join(tmpdir_path, "raw")
    data, rep = load_months(spark, paths, target=target, truncate=True)
    r = {x.month: x for x in rep.collect()}
    assert r["2024-01"].ok and r["2024-01"].rows == 3 and r["2024-02"].rows == 4 and r["2024-03"].rows == 2
    assert not r["2024-04"].ok and r["2024-04"].error
    s = load_summary(rep).first()
    assert (s.ok_months, s.total_months, s.total_rows) == (3, 4, 9)
    assert data.count() == 9
    # reloading a month replaces its partition (idempotent)
    data2, _ = load_months(spark, {"2024-01": paths["2024-01"]}, target=target)
    assert data2.count() == 9
    man = month_manifest(data2)
    assert r["2024-01"].unrepaired == 0
    todo = months_to_load(month_range(spark, "2024-01", "2024-05").select("month"), man)
    assert sorted(x.month for x in todo.collect()) == ["2024-04", "2024-05"]
    flags = {x.month: x.already_loaded for x in
             skip_loaded_months(month_range(spark, "2024-01", "2024-04").select("month"), man).collect()}
    assert flags == {"2024-01": True, "2024-02": True, "2024-03": True, "2024-04": False}


def test_load_months_lazy_union(spark, tmpdir_path):
    paths = write_months(tmpdir_path)
    data, rep = load_months(spark, paths)
    assert data.count() == 9 and rep.filter(~F.col("ok")).count() == 1


def test_month_range(spark):
    months = [r.month for r in month_range(spark).orderBy("month").collect()]
    assert len(months) == 21 and months[0] == "2024-01" and months[-1] == "2025-09"
    assert months == month_list()


def test_infer_schema_and_catalog(spark, tmpdir_path):
    paths = write_months(tmpdir_path)
    rows = infer_schema(spark, paths["2024-02"]).collect()
    assert [r.order_id for r in rows] == list(range(len(rows)))
    by = {r.column_name: r for r in rows}
    assert by["passenger_count"].type == "bigint" and by["cbd_congestion_fee"].type == "double"
    cat = catalog_df(spark, {"trips_raw": copy_by_name(spark.read.parquet(paths["2024-01"]))})
    c = {r.column: r for r in cat.collect()}
    assert c["trip_distance"].comment == "trip distance in miles" and len(c) == 19


def test_create_fixed_schema(spark):
    create_fixed_schema(spark, "raw.trips_fixed")
    cols = spark.table("raw.trips_fixed").columns
    assert cols[:19] == TRIPS_NAMES and cols[-2:] == ["pickup_day", "load_month"]


def test_raw_layer_is_filled_and_built_from(spark, tmpdir_path):
    from tripkit.plans.build import build, row_counts
    paths = write_months(tmpdir_path)
    data, rep = load_months(spark, paths, table="raw.trips_filled", truncate=True)
    assert load_summary(rep).first().total_rows == 9 and spark.table("raw.trips_filled").count() == 9
    tables = build(spark, spark.table("raw.trips_filled").select(*TRIPS_NAMES))
    counts = {r.table_name: r.row_count for r in row_counts({"raw": spark.table("raw.trips_filled"), **tables}).collect()}
    assert counts["raw"] == counts["trips_raw"] == 9 and 0 < counts["clean_trips"] <= 9
    # a later load adds to the table, and replaces the month it names
    load_months(spark, {"2024-01": paths["2024-02"]}, table="raw.trips_filled")
    assert {r.load_month: r["count"] for r in spark.table("raw.trips_filled").groupBy("load_month").count().collect()} == \
        {"2024-01": 4, "2024-02": 4, "2024-03": 2}


def test_uncastable_month_is_isolated(spark, tmpdir_path):
    paths = write_months(tmpdir_path)
    cols = _base(5, 5)
    cols["trip_distance"] = pa.array(["n/a"] * 5)
    paths["2024-05"] = os.path.join(tmpdir_path, "trips_2024-05.parquet")
    pq.write_table(pa.table(cols), paths["2024-05"])
    for target in (None, os.path.join(tmpdir_path, "raw")):
        data, rep = load_months(spark, paths, target=target)
        r = {x.month: x for x in rep.collect()}
        assert [m for m in sorted(r) if r[m].ok] == ["2024-01", "2024-02", "2024-03"] and r["2024-05"].error
        assert data.count() == 9 and r["2024-01"].rows == 3


def test_integer_timestamps_out_of_range_are_counted(spark, tmpdir_path):
    cols = _base(3, 1)
    cols["tpep_pickup_datetime"] = pa.array([1_704_096_000_000_000, 2 ** 62, None], pa.int64())
    path = os.path.join(tmpdir_path, "trips.parquet")
    pq.write_table(pa.table(cols), path)
    for target in (None, os.path.join(tmpdir_path, "raw")):
        _, rep = load_months(spark, {"2024-01": path}, target=target)
        assert (rep.first().rows, rep.first().unrepaired) == (3, 1)


def test_raw_table_follows_its_input(spark, tmpdir_path):
    """A changed input is built anew, also where only Spark can list it."""
    from tripkit.sources.raw import raw_trips
    from conftest import SF001
    folder = "file://" + os.path.join(tmpdir_path, "sf")
    lines = spark.read.parquet(f"{SF001}/lineitem.parquet")
    spark.read.parquet(f"{SF001}/orders.parquet").write.parquet(f"{folder}/orders.parquet")
    lines.write.parquet(f"{folder}/lineitem.parquet")
    n = raw_trips(spark, folder).count()
    assert n == lines.count() and raw_trips(spark, folder).count() == n
    lines.limit(1000).write.mode("overwrite").parquet(f"{folder}/lineitem.parquet")
    assert raw_trips(spark, folder).count() == 1000


def test_unpublished_build_is_not_read(spark, tmpdir_path):
    from tripkit.sources.raw import build_once, published
    root = os.path.join(tmpdir_path, "table")

    def broken(folder):
        spark.range(3).write.parquet(folder)
        raise RuntimeError("broke off")

    try:
        build_once(spark, root, broken)
    except RuntimeError:
        pass
    assert published(spark, root) is None
    folder = build_once(spark, root, lambda f: spark.range(5).write.parquet(f))
    assert spark.read.parquet(build_once(spark, root, broken)).count() == 5 and published(spark, root) == folder


def test_zone_lookup_file(spark, tmpdir_path):
    from tripkit.operators.joins import zone_name_lookup
    from tripkit.sources.zones import zones_from_file
    path = os.path.join(tmpdir_path, "zones.csv")
    with open(path, "w") as f:
        f.write('LocationID,Borough,Zone,service_zone\n132,Queens,JFK Airport,Airports\n138,Queens,"LaGuardia, Airport",Airports\n')
    zones = zones_from_file(spark, path)
    named = zone_name_lookup(spark.createDataFrame([(132,), (138,), (7,), (None,)], "zone_id bigint"), zones)
    assert {r.zone_id: r.zone_name for r in named.collect()} == {132: "JFK Airport", 138: "LaGuardia, Airport", 7: "7", None: None}


def test_cluster_without_shared_folder_is_refused(spark):
    from types import SimpleNamespace
    import pytest
    from tripkit.session import ensure_checkpoint_dir
    conf = SimpleNamespace(get=lambda key, default=None: None)
    context = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="yarn")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=context, conf=conf))
