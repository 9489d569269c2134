"""Month loads in one job, committed by snapshots, and marts kept month by month."""

import os
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tripkit.plans import incremental as I
from tripkit.plans import marts
from tripkit.plans.staging import clean_trips
from tripkit.sources import months as M
from tripkit.sources import snapshots as S
from tripkit.sources.files import list_files

from conftest import SF001
from test_sources import _base, write_months


def counts(df):
    return {r["load_month"]: r["count"] for r in df.groupBy("load_month").count().collect()}


def listing(spark, paths):
    return spark.createDataFrame([(m, *f) for m, p in paths.items() for f in list_files(spark, p)], "month string, path string, length bigint, modified bigint")


def jobs(spark, run):
    tracker, group = spark.sparkContext.statusTracker(), uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = run()
        return out, len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_jobs_of_a_load_do_not_grow_with_its_months(spark, tmpdir_path):
    paths = {}
    for k in range(12):
        paths[f"2024-{k + 1:02}"] = os.path.join(tmpdir_path, f"m{k}.parquet")
        pq.write_table(pa.table(_base(k + 1, k + 1)), paths[f"2024-{k + 1:02}"])
    few, n_few = jobs(spark, lambda: M.load_months(spark, dict(list(paths.items())[:2]), target=os.path.join(tmpdir_path, "few")))
    many, n_many = jobs(spark, lambda: M.load_months(spark, paths, target=os.path.join(tmpdir_path, "many")))
    assert counts(many[0]) == {f"2024-{k + 1:02}": k + 1 for k in range(12)}
    assert n_many <= n_few + 1


def test_a_load_that_breaks_off_leaves_the_old_rows(spark, tmpdir_path, monkeypatch):
    paths, target = write_months(tmpdir_path), os.path.join(tmpdir_path, "raw")
    old, _ = M.load_months(spark, {"2024-01": paths["2024-01"]}, target=target)

    def broken(*args, **kwargs):
        # the rows of the new load are written by now, and not yet committed
        assert len(os.listdir(f"{target}/data")) == 2
        raise RuntimeError("broke off")

    monkeypatch.setattr(M, "commit", broken)
    with pytest.raises(RuntimeError):
        M.load_months(spark, paths, target=target, truncate=True)
    monkeypatch.undo()
    assert counts(M.loaded_months(spark, target)) == counts(old) == {"2024-01": 3}
    # a reader of the old snapshot reads on while the next one is committed
    new, _ = M.load_months(spark, {m: paths[m] for m in ("2024-02", "2024-03")}, target=target, truncate=True)
    assert counts(old) == {"2024-01": 3} and counts(new) == {"2024-02": 4, "2024-03": 2}
    gone = S.vacuum(spark, target)
    assert sum(g.startswith("data/") for g in gone) == 2 and counts(M.loaded_months(spark, target)) == {"2024-02": 4, "2024-03": 2}
    assert S.vacuum(spark, target) == []


def test_nothing_loaded_commits_nothing(spark, tmpdir_path):
    paths, target = write_months(tmpdir_path), os.path.join(tmpdir_path, "raw")
    M.load_months(spark, {"2024-01": paths["2024-01"]}, target=target)
    data, report = M.load_months(spark, {"2024-04": paths["2024-04"], "2024-05": "/no/such/file"}, target=target, truncate=True)
    assert data is None and report.filter("ok").count() == 0 and counts(M.loaded_months(spark, target)) == {"2024-01": 3}


def test_a_month_that_fails_while_it_is_read_is_alone(spark, tmpdir_path):
    """A footer that is fine and pages that are not: the job fails, the other months load all the same."""
    paths, target = write_months(tmpdir_path), os.path.join(tmpdir_path, "raw")
    for k in (5, 6, 7):
        paths[f"2024-{k:02}"] = os.path.join(tmpdir_path, f"m{k}.parquet")
        pq.write_table(pa.table(_base(1000, k)), paths[f"2024-{k:02}"])
    with open(paths["2024-06"], "r+b") as f:
        f.seek(4)
        f.write(os.urandom(4000))
    data, report = M.load_months(spark, paths, target=target)
    got = {r["month"]: r for r in report.collect()}
    assert [m for m in sorted(got) if not got[m]["ok"]] == ["2024-04", "2024-06"] and got["2024-06"]["error"]
    assert counts(data) == {"2024-01": 3, "2024-02": 4, "2024-03": 2, "2024-05": 1000, "2024-07": 1000}


def test_one_month_of_several_files_and_kinds(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "month")
    os.makedirs(folder)
    cols = _base(3, 1)
    pq.write_table(pa.table(cols), f"{folder}/a b%.parquet")  # a name that a URI encodes
    cols = {k.lower(): v for k, v in cols.items()} | {"passenger_count": pa.array([2] * 3, pa.int64()), "load_month": pa.array(["x"] * 3), "_lost": pa.array([1] * 3)}
    pq.write_table(pa.table(cols), f"{folder}/c.parquet")
    open(f"{folder}/_SUCCESS", "w").close()
    for target in (None, os.path.join(tmpdir_path, "raw")):
        data, report = M.load_months(spark, {"2024-01": folder}, target=target)
        assert (report.first()["rows"], report.first()["unrepaired"]) == (6, 0) and counts(data) == {"2024-01": 6}
        assert sorted(r[0] for r in data.select("passenger_count").collect()) == [1.0] * 3 + [2.0] * 3


def test_columns_that_differ_in_case_only_fail_their_month(spark, tmpdir_path):
    paths = write_months(tmpdir_path)
    cols = _base(3, 5)
    cols["trip_Distance"] = cols["trip_distance"]
    paths["2024-05"] = os.path.join(tmpdir_path, "twice.parquet")
    pq.write_table(pa.table(cols), paths["2024-05"])
    data, report = M.load_months(spark, paths, target=os.path.join(tmpdir_path, "raw"))
    assert [r["month"] for r in report.filter("ok").orderBy("month").collect()] == ["2024-01", "2024-02", "2024-03"] and data.count() == 9


def test_changed_months(spark, tmpdir_path):
    paths, target = write_months(tmpdir_path), os.path.join(tmpdir_path, "raw")
    assert {r["status"] for r in S.changed_months(listing(spark, {"2024-01": paths["2024-01"]}), S.manifest(spark, target)).collect()} == {"new"}
    M.load_months(spark, {m: paths[m] for m in ("2024-01", "2024-02", "2024-03")}, target=target)
    pq.write_table(pa.table(_base(9, 2)), paths["2024-02"])  # the same path, another file
    folder = os.path.join(tmpdir_path, "march")
    os.makedirs(folder)
    pq.write_table(pa.table(_base(1, 3)), f"{folder}/a.parquet")
    paths.update({"2024-03": folder, "2024-04": folder})
    found = {r["month"]: r["status"] for r in S.changed_months(listing(spark, paths), S.manifest(spark, target)).collect()}
    assert found == {"2024-01": "same", "2024-02": "replaced", "2024-03": "replaced", "2024-04": "new"}


def test_marts_after_a_new_month_equal_a_full_rebuild(spark, tmpdir_path):
    from tripkit.plans import load_queries as LQ
    paths = LQ.month_files(spark, SF001)
    months = [m for m in sorted(paths) if m != LQ.BAD_MONTH]
    raw, states = os.path.join(tmpdir_path, "raw"), os.path.join(tmpdir_path, "states")

    def same():
        clean = clean_trips(M.loaded_months(spark, raw))
        for name, mart in I.merged_marts(I.stored_states(spark, states)).items():
            full = marts.MARTS[name](clean)
            assert mart.columns == full.columns and [f.dataType for f in mart.schema] == [f.dataType for f in full.schema]
            assert sorted(map(str, mart.collect())) == sorted(map(str, full.collect())) and full.count()  # bit for bit

    M.load_months(spark, {m: paths[m] for m in months[:-1]}, target=raw)
    assert I.refresh(spark, raw, states) == months[:-1]
    same()
    assert I.refresh(spark, raw, states) == []
    # a new month and a month that another file replaces: only these are looked at
    M.load_months(spark, {months[-1]: paths[months[-1]], months[1]: paths[months[2]]}, target=raw)
    assert I.stale_months(spark, raw, states) == ([months[1], months[-1]], [])
    read = []
    real = I.month_states
    try:
        I.month_states = lambda clean: (read.extend(clean.inputFiles()), real(clean))[1]
        assert I.refresh(spark, raw, states) == [months[1], months[-1]]
    finally:
        I.month_states = real
    assert {f.split("load_month=")[1][:7] for f in read} == {months[1], months[-1]}
    same()
    # months that a truncating load drops
    M.load_months(spark, {m: paths[m] for m in months[:3]}, target=raw, truncate=True)
    I.refresh(spark, raw, states)
    same()
