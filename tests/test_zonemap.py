"""Zone maps: which files a window opens, and the merged schema of a glob."""

import datetime as dt
import decimal
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tripkit.plans import load_queries as LQ
from tripkit.sources.parquet import infer_glob_schema, infer_schema, scan_parquet_glob
from tripkit.sources.schema import TRIPS_NAMES
from tripkit.sources.zonemap import files_in_window, scan_window, zone_map

from conftest import SF001
from test_sources import _base


def window(df, start, end):
    low, high = (F.lit(f"{d} 00:00:00").cast("timestamp_ntz") for d in (start, end))
    return df.filter((F.col("tpep_pickup_datetime") >= low) & (F.col("tpep_pickup_datetime") < high))


def scanned_rows(df):
    """Rows that left the scans of a collected DataFrame."""
    plan, total = df._jdf.queryExecution().executedPlan(), 0
    stack = [plan]
    while stack:
        node = stack.pop()
        if "Scan" in node.nodeName():
            total += node.metrics().get("numOutputRows").get().value()
        if node.nodeName() == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return total


@pytest.mark.parametrize("start, end, months", [("2024-03-28", "2024-04-04", {"2024-03", "2024-04"}), ("2024-05-10", "2024-05-17", {"2024-05"}),
                                                ("2031-01-01", "2031-01-08", set()), ("2024-01-01", "2025-10-01", None)])
def test_window_opens_only_the_files_that_can_hold_it(spark, start, end, months):
    paths = LQ.good_paths(spark, SF001)
    got, want = scan_window(spark, paths, start, end), window(scan_parquet_glob(spark, paths), start, end)
    assert got.columns == TRIPS_NAMES
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    if months is not None:
        assert {f.split("file_month=")[1][:7] for f in got.inputFiles()} == months
        assert scanned_rows(got) == sum(r["rows"] for r in files_in_window(zone_map(spark, paths), start, end).collect())


def test_zones_of_every_type_of_time(spark, tmpdir_path):
    """us, ms and ns timestamps, BIGINT microseconds, a text column, no column, no statistics, no rows."""
    first = dt.datetime(2024, 5, 1, 8)
    times = {"us": pa.timestamp("us"), "ms": pa.timestamp("ms"), "ns": pa.timestamp("ns"), "zoned": pa.timestamp("us", "UTC")}
    for name, kind in times.items():
        cols = _base(4, 5)
        cols["tpep_pickup_datetime"] = cols["tpep_pickup_datetime"].cast(kind.unit and pa.timestamp(kind.unit)).cast(kind)
        pq.write_table(pa.table(cols), f"{tmpdir_path}/{name}.parquet", row_group_size=3)
    cols = _base(4, 5)
    cols["tpep_pickup_datetime"] = cols["tpep_pickup_datetime"].cast(pa.int64())
    pq.write_table(pa.table(cols), f"{tmpdir_path}/bigint.parquet")
    pq.write_table(pa.table(_base(4, 5)), f"{tmpdir_path}/bare.parquet", write_statistics=False)
    pq.write_table(pa.table(_base(0, 5)), f"{tmpdir_path}/none.parquet")
    cols["tpep_pickup_datetime"] = pa.array(["2024-05-01"] * 4)
    pq.write_table(pa.table(cols), f"{tmpdir_path}/text.parquet")
    del cols["tpep_pickup_datetime"]
    pq.write_table(pa.table(cols), f"{tmpdir_path}/lacking.parquet")
    with open(f"{tmpdir_path}/broken.parquet", "wb") as f:
        f.write(b"not a parquet file")
    zones = {}
    for r in zone_map(spark, f"{tmpdir_path}/*.parquet").collect():
        zones.setdefault(os.path.basename(r["path"]).split(".")[0], []).append(r)
    micros = (first - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    for name in ("us", "ms", "zoned", "bigint"):
        assert min(r["low"] for r in zones[name]) == micros and max(r["high"] for r in zones[name]) == micros + 3 * 60_000_000
    assert [r["rows"] for r in sorted(zones["us"], key=lambda r: r["row_group"])] == [3, 1]
    assert all(r["low"] is None for name in ("bare", "none", "text", "lacking", "broken") for r in zones[name])
    assert zones["broken"][0]["error"] and not zones["bare"][0]["error"]


def test_zone_map_reads_new_footers_only(spark, tmpdir_path, monkeypatch):
    from tripkit.sources import zonemap as Z
    for k in (1, 2, 3):
        pq.write_table(pa.table(_base(k, k)), f"{tmpdir_path}/m{k}.parquet")
    root, glob = os.path.join(tmpdir_path, "zones"), f"{tmpdir_path}/m*.parquet"
    one = zone_map(spark, glob, root=root)
    assert sorted(r["rows"] for r in one.collect()) == [1, 2, 3]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("unchanged", "unchanged")
    zone_map(spark, glob, root=root)
    assert not tracker.getJobIdsForGroup("unchanged")
    spark.sparkContext._jsc.clearJobGroup()
    # the next listing: one file more, one another, one gone; a footer that is known is not read again
    os.remove(f"{tmpdir_path}/m1.parquet")
    pq.write_table(pa.table(_base(7, 2)), f"{tmpdir_path}/m2.parquet")
    pq.write_table(pa.table(_base(9, 9)), f"{tmpdir_path}/m9.parquet")
    with open(f"{tmpdir_path}/m3.parquet", "r+b") as f:  # same length; the time is put back
        stat = os.stat(f"{tmpdir_path}/m3.parquet")
        f.seek(stat.st_size - 200)
        f.write(os.urandom(200))
    os.utime(f"{tmpdir_path}/m3.parquet", ns=(stat.st_atime_ns, stat.st_mtime_ns))
    two = zone_map(spark, glob, root=root).collect()
    assert sorted(r["rows"] for r in two) == [3, 7, 9] and not any(r["error"] for r in two)


def test_merged_schema_of_files_that_disagree(spark, tmpdir_path):
    def write(name, **cols):
        pq.write_table(pa.table(cols), f"{tmpdir_path}/{name}.parquet")

    i4, i8, f8 = pa.array([1], pa.int32()), pa.array([1], pa.int64()), pa.array([1.0])
    day, time = pa.array([dt.date(2024, 1, 1)]), pa.array([dt.datetime(2024, 1, 1)], pa.timestamp("us"))
    text, money = pa.array(["x"]), pa.array([decimal.Decimal("1.00")], pa.decimal128(10, 2))
    write("a", N=i8, wide=i4, t=time, d=day, odd=f8, both=i8, money=money, same=text, onlya=i4)
    write("b", n=f8, wide=i8, t=i8, d=time, odd=text, both=i8, money=f8, same=text)
    write("c", n=i4, wide=i4, t=time, d=day, odd=i4, BOTH=i8, money=money, same=text, late=f8)
    got = {r["column_name"]: r for r in infer_glob_schema(spark, f"{tmpdir_path}/*.parquet").collect()}
    assert {n: r["type"] for n, r in got.items()} == {"N": "double", "wide": "bigint", "t": "timestamp_ntz", "d": "timestamp_ntz", "odd": "string",
                                                      "both": "bigint", "money": "double", "same": "string", "onlya": "int", "late": "double"}
    assert [n for n, _ in sorted(got.items(), key=lambda x: x[1]["order_id"])] == ["N", "wide", "t", "d", "odd", "both", "money", "same", "onlya", "late"]
    assert got["N"]["expression"] == "CAST(`N` AS DOUBLE) AS n"
    assert {(t["type"], t["n_files"], os.path.basename(t["first_file"])) for t in got["N"]["types"]} == {("bigint", 1, "a.parquet"), ("double", 1, "b.parquet"), ("int", 1, "c.parquet")}
    assert not got["onlya"]["in_all_files"] and got["onlya"]["nullable"] and got["same"]["n_files"] == 3
    # a column that may not be null in a file, and that every file has
    pq.write_table(pa.table({"k": i8}, schema=pa.schema([pa.field("k", pa.int64(), False)])), f"{tmpdir_path}/x.pq")
    assert [(r["type"], r["nullable"]) for r in infer_schema(spark, f"{tmpdir_path}/x.pq").collect()] == [("bigint", False)]
    with open(f"{tmpdir_path}/z.parquet", "wb") as f:
        f.write(b"not a parquet file")
    with pytest.raises(ValueError, match="z.parquet"):
        infer_glob_schema(spark, f"{tmpdir_path}/*.parquet")
