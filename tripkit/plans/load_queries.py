"""Month files that disagree, made from the RAW table, and what the loaders make of them.

The files are written once per input, under the RAW table's folder, one for
each month of the reference that has trips. They differ as real ones do: column case, an
integer ``passenger_count``, a missing and an extra column, timestamps as
BIGINT microseconds; one month has a column that can't be cast.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import to_epoch
from ..operators.filters import DAY
from ..sources.files import list_files, names
from ..sources.months import load_months, loaded_months, month_list
from ..sources.raw import build_once, raw_root, raw_trips
from ..sources.schema import TRIPS_NAMES
from ..sources.snapshots import changed_months, manifest
from .incremental import merged_marts, refresh, stored_states

# Part of the key of what this module stores: raise it when the files or the loaders change.
LOAD_VERSION = 3
BAD_MONTH = "2024-06"
VARIANTS = ("plain", "upper case", "integer passengers", "other columns", "integer timestamps")


def variant(month: str) -> str:
    return "uncastable" if month == BAD_MONTH else VARIANTS[month_list().index(month) % len(VARIANTS)]


def _as_file(trips: DataFrame, kind: str) -> DataFrame:
    if kind == "upper case":
        return trips.toDF(*[c.upper() for c in trips.columns])
    if kind == "integer passengers":
        return trips.withColumn("passenger_count", F.col("passenger_count").cast("bigint"))
    if kind == "other columns":
        return trips.drop("airport_fee").withColumn("cbd_congestion_fee", F.lit(0.75))
    if kind == "integer timestamps":
        return trips.withColumns({c: to_epoch(c) for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")})
    if kind == "uncastable":
        return trips.withColumn("trip_distance", F.lit("n/a"))
    return trips


def _write_files(spark: SparkSession, sf_dir: str, folder: str, months: list[str]) -> None:
    """The months' files under ``folder``, one job a variant: ``<variant>/file_month=<month>``."""
    trips = raw_trips(spark, sf_dir, with_day=True)
    month = F.date_format("tpep_pickup_datetime", "yyyy-MM")
    for kind in sorted({variant(m) for m in months}):
        rows = trips.filter(month.isin([m for m in months if variant(m) == kind])).withColumn("file_month", month)
        first, last = (min(m for m in months if variant(m) == kind), max(m for m in months if variant(m) == kind))
        rows = rows.filter((F.col(DAY) >= F.lit(first + "-01").cast("date")) & (F.col(DAY) < F.add_months(F.lit(last + "-01").cast("date"), 1)))
        named = _as_file(rows.select(*TRIPS_NAMES), kind).columns
        _as_file(rows.select(*TRIPS_NAMES, "file_month"), kind).select(*named, "file_month") \
            .write.partitionBy("file_month").parquet(f"{folder}/{kind.replace(' ', '_')}")


def _paths(spark: SparkSession, folder: str) -> dict[str, str]:
    """{month: folder of its file}, of the months that have one."""
    found = {}
    for group in names(spark, folder):
        if not group.startswith("_"):
            found.update({n.split("=", 1)[1]: f"{folder}/{group}/{n}" for n in names(spark, f"{folder}/{group}") if n.startswith("file_month=")})
    return found


def month_files(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """{month: folder of its Parquet file}, written on first use; a month without trips has no file."""
    folder = build_once(spark, f"{raw_root(spark, sf_dir)}/months{LOAD_VERSION}", lambda f: _write_files(spark, sf_dir, f, month_list()))
    return _paths(spark, folder)


def loaded(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(rows, report) of ``load_months``, to a target and lazily; stored on first use."""
    def write(folder):
        paths = month_files(spark, sf_dir)
        _, report = load_months(spark, paths, target=f"{folder}/rows", truncate=True)
        _, lazy = load_months(spark, paths)
        both = report.withColumn("mode", F.lit("target")).unionByName(lazy.withColumn("mode", F.lit("lazy")))
        both.write.parquet(f"{folder}/report")

    folder = build_once(spark, f"{raw_root(spark, sf_dir)}/loaded{LOAD_VERSION}", write)
    return loaded_months(spark, f"{folder}/rows"), spark.read.parquet(f"{folder}/report")


def reloaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows after three months are loaded and then every month anew, in the place of all that was there; stored on first use."""
    def write(folder):
        paths = month_files(spark, sf_dir)
        load_months(spark, {m: paths[m] for m in sorted(paths)[:3]}, target=f"{folder}/rows")
        load_months(spark, paths, target=f"{folder}/rows", truncate=True)

    return loaded_months(spark, build_once(spark, f"{raw_root(spark, sf_dir)}/reloaded{LOAD_VERSION}", write) + "/rows")


def replaced(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(what the listing of the files says, the rows after its new and replaced months are loaded); stored on first use.

    All months but the last two that have files are loaded; then the files of every fourth month are written again, longer.
    """
    def write(folder):
        paths, target = month_files(spark, sf_dir), f"{folder}/rows"
        months = sorted(paths)
        load_months(spark, {m: paths[m] for m in months[:-2]}, target=target)
        twice = raw_trips(spark, sf_dir).withColumn("file_month", F.date_format("tpep_pickup_datetime", "yyyy-MM")).filter(F.col("file_month").isin(months[::4]))
        twice.unionByName(twice).write.partitionBy("file_month").parquet(f"{folder}/files")
        now = {**paths, **{m: f"{folder}/files/file_month={m}" for m in months[::4]}}
        listing = spark.createDataFrame([(m, *f) for m, p in now.items() for f in list_files(spark, p)], "month string, path string, length bigint, modified bigint")
        changed_months(listing, manifest(spark, target)).write.parquet(f"{folder}/status")
        todo = spark.read.parquet(f"{folder}/status").filter("status <> 'same'").select("month").collect()
        load_months(spark, {r["month"]: now[r["month"]] for r in todo}, target=target)

    folder = build_once(spark, f"{raw_root(spark, sf_dir)}/replaced{LOAD_VERSION}", write)
    return spark.read.parquet(f"{folder}/status"), loaded_months(spark, f"{folder}/rows")


def kept_marts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The marts from month states: made for all months but the last, brought up to date after that one is loaded and another one
    loaded again; the states are stored on first use."""
    def write(folder):
        paths = month_files(spark, sf_dir)
        months, raw, states = sorted(paths), f"{folder}/rows", f"{folder}/states"
        load_months(spark, {m: paths[m] for m in months[:-1]}, target=raw)
        refresh(spark, raw, states)
        load_months(spark, {m: paths[m] for m in (months[2], months[-1])}, target=raw)
        refresh(spark, raw, states)

    folder = build_once(spark, f"{raw_root(spark, sf_dir)}/kept_marts{LOAD_VERSION}", write)
    return merged_marts(stored_states(spark, f"{folder}/states"))


def good_paths(spark: SparkSession, sf_dir: str) -> list[str]:
    return [p for m, p in month_files(spark, sf_dir).items() if m != BAD_MONTH]


def union(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
