"""Monthly loads: month list, one job for all months with failures isolated, manifest and skipping.

The driver lists the files and groups them by schema; the rows are only ever
touched by Spark jobs, one for a load however many months it has.
"""

from __future__ import annotations

import logging
import uuid
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import epoch_repair
from ..operators.filters import DAY
from .files import InputFile, list_files, scanned_as
from .parquet import FileKind, copy_by_name, file_kinds
from .schema import TRIPS, TRIPS_NAMES
from .snapshots import MonthEntry, commit, entries, load_folder, new_load, read

log = logging.getLogger(__name__)

# The months the reference loads (first and last, inclusive).
FIRST_MONTH = "2024-01"
LAST_MONTH = "2025-09"


def month_range(spark: SparkSession, start: str = FIRST_MONTH, end: str = LAST_MONTH) -> DataFrame:
    """One row per month 'yyyy-MM' from start to end inclusive."""
    q = F.sequence(F.to_date(F.lit(start + "-01")), F.to_date(F.lit(end + "-01")), F.expr("INTERVAL 1 MONTH"))
    return spark.range(1).select(F.explode(q).alias("month_start")) \
        .select(F.date_format("month_start", "yyyy-MM").alias("month"), "month_start")


def month_list(start: str = FIRST_MONTH, end: str = LAST_MONTH) -> list[str]:
    """The same months as plain strings (for driver-side loops over files)."""
    y, m = map(int, start.split("-"))
    ey, em = map(int, end.split("-"))
    out = []
    while (y, m) <= (ey, em):
        out.append(f"{y:04d}-{m:02d}")
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def _integer_times(schema: T.StructType) -> list[str]:
    """Timestamp columns that arrive as integers."""
    kinds = {f.name: f.dataType for f in TRIPS.fields}
    return [f.name for f in schema.fields if isinstance(kinds.get(f.name.lower()), T.TimestampNTZType)
            and isinstance(f.dataType, (T.LongType, T.IntegerType))]


def _doubtful(schema: T.StructType) -> list[tuple[str, T.DataType]]:
    """Columns whose values may not be castable, with the type that they are cast to."""
    kinds = {f.name: f.dataType for f in TRIPS.fields}
    return [(f.name, kinds[f.name.lower()]) for f in schema.fields
            if f.name.lower() in kinds and f.dataType != kinds[f.name.lower()] and not isinstance(f.dataType, (T.LongType, T.IntegerType))]


def _faults(schema: T.StructType) -> dict[str, Column]:
    """``_lost``: timestamps of a row that no time of years 1 to 9999 repairs (loaded as NULL and counted); ``_bad``: whether a
    row has a value that the by-name load can't cast."""
    lost, bad = F.lit(0), F.lit(False)
    for name in _integer_times(schema):
        raw = F.col(f"`{name}`")
        lost = lost + (raw.isNotNull() & epoch_repair(raw).isNull()).cast("int")
    for name, kind in _doubtful(schema):
        raw = F.col(f"`{name}`")
        bad = bad | (raw.isNotNull() & raw.try_cast(kind).isNull())
    return {"_lost": lost, "_bad": bad}


def _error(e: Exception) -> str:
    return f"{type(e).__name__}: {e}"


def _sources(spark: SparkSession, month_paths: dict[str, str]) -> tuple[dict[str, list[InputFile]], dict[str, str]]:
    """({month: its files}, {month: error})."""
    listed, errors = {}, {}
    for month, path in sorted(month_paths.items()):
        try:
            listed[month] = list_files(spark, path)
            if not listed[month]:
                raise FileNotFoundError(path)
        except Exception as e:  # one bad month must not stop the others
            listed.pop(month, None)
            errors[month] = _error(e)
    return listed, errors


def _scan(spark: SparkSession, kind: FileKind, listed: dict[str, list[InputFile]]) -> DataFrame:
    """The rows of a kind's files that ``listed`` names, conformed, with ``load_month`` by their file's path, ``_lost`` and ``_bad``."""
    members = set(kind.paths)
    mine = [(f.path, month) for month, files in listed.items() for f in files if f.path in members]
    # the listing that this scan is planned from: one short row a file
    months = F.broadcast(spark.createDataFrame([(scanned_as(spark, p), m) for p, m in mine], "_path string, load_month string"))
    wanted = T.StructType([f for f in kind.schema.fields if f.name.lower() in TRIPS_NAMES])
    src = spark.read.schema(wanted).parquet(*sorted({p for p, _ in mine}))
    src = src.select("*", F.col("_metadata.file_path").alias("_path")).join(months, "_path").withColumns(_faults(wanted))
    rows = copy_by_name(src, TRIPS, keep=("load_month", "_lost", "_bad"), try_casts=True)
    return rows.withColumn(DAY, F.to_date("tpep_pickup_datetime"))


class _Counts(NamedTuple):
    rows: int
    lost: int
    bad: int
    load: str | None = None


def _isolated(months: list[str], run) -> tuple[dict[str, _Counts], dict[str, str]]:
    """({month: counts}, {month: error}) of ``run(months)``, one job for all; if it fails, the halves are run by themselves, until
    the month that fails is alone."""
    try:
        return run(months), {}
    except Exception as e:
        if len(months) == 1:
            return {}, {months[0]: _error(e)}
        half = len(months) // 2
        (a, x), (b, y) = _isolated(months[:half], run), _isolated(months[half:], run)
        return {**a, **b}, {**x, **y}


def load_months(spark: SparkSession, month_paths: dict[str, str], target: str | None = None,
                truncate: bool = False, fmt: str = "parquet", table: str | None = None) -> tuple[DataFrame | None, DataFrame]:
    """Load every month by one job, isolating failures.

    Files are grouped by physical schema; each group is one scan, conformed by name, its months told by the files' paths. Rows and
    faults are counted by month while the rows are written. With ``target`` (a path) or ``table`` (a table of
    ``create_fixed_schema``, whose location it is), the months that loaded are committed together by a snapshot
    (``snapshots``): each replaces its month, with ``truncate`` all others go, and a load that breaks off changes nothing. A month
    without a readable file, or with a value that can't be cast, is left out of the commit. If the job fails, its halves are run
    by themselves, so that one unreadable month costs a few more jobs and not the others' rows. Without a target, the
    counts are one aggregate and the good months are combined lazily (UNION ALL by name). Returns (data or None, load_report)
    where the report has (month, ok, rows, unrepaired, error): ``unrepaired`` counts integer timestamps out of range.
    """
    if table and not target:
        from .schema import create_fixed_schema, table_location
        create_fixed_schema(spark, table)
        target = table_location(spark, table)
    listed, errors = _sources(spark, month_paths)
    kinds, unreadable = file_kinds(spark, sorted({f.path for files in listed.values() for f in files}))
    for month, files in listed.items():
        errors.update({month: unreadable[f.path] for f in files if f.path in unreadable})

    def scans(months: list[str]):
        """(kind, its months, its rows) for the kinds that these months have."""
        some = {m: listed[m] for m in months}
        for kind in kinds:
            held = [m for m in months if any(f.path in kind.paths for f in listed[m])]
            if held:
                yield kind, held, _scan(spark, kind, some)

    def plannable(month: str) -> bool:
        try:
            list(scans([month]))
            return True
        except Exception as e:  # columns that differ in case only, or no cast between the types
            errors[month] = _error(e)
            return False

    good = [m for m in listed if m not in errors]
    doubtful = {p for kind in kinds if not _plans(kind.schema) for p in kind.paths}
    good = [m for m in good if not any(f.path in doubtful for f in listed[m]) or plannable(m)]

    def write(months: list[str]) -> dict[str, _Counts]:
        load, watch, measures = new_load(), Observation(f"load_{uuid.uuid4().hex}"), []
        parts = list(scans(months))
        lossy = {m for kind, held, _ in parts if _integer_times(kind.schema) for m in held}
        doubted = {m for kind, held, _ in parts if _doubtful(kind.schema) for m in held}
        for k, m in enumerate(months):
            here = F.col("load_month") == m
            measures.append(F.count_if(here).alias(f"rows_{k}"))
            if m in lossy:
                measures.append(F.sum(F.when(here, F.col("_lost"))).alias(f"lost_{k}"))
            if m in doubted:
                measures.append(F.count_if(here & F.col("_bad")).alias(f"bad_{k}"))
        rows = reduce(DataFrame.unionByName, [r for _, _, r in parts]).observe(watch, *measures).drop("_lost", "_bad")
        # sorted inside each write task (no shuffle): narrow page statistics on the pickup day let date windows skip data
        rows.sortWithinPartitions("load_month", DAY, "tpep_pickup_datetime").write.format(fmt).partitionBy("load_month").save(load_folder(target, load))
        got = watch.get
        return {m: _Counts(*(int(got.get(f"{name}_{k}") or 0) for name in ("rows", "lost", "bad")), load) for k, m in enumerate(months)}

    def count(months: list[str]) -> dict[str, _Counts]:
        rows = reduce(DataFrame.unionByName, [r.select("load_month", "_lost", "_bad") for _, _, r in scans(months)])
        found = rows.groupBy("load_month").agg(F.count("*").alias("rows"), F.sum("_lost").alias("lost"), F.count_if("_bad").alias("bad")).collect()
        return {m: _Counts(0, 0, 0) for m in months} | {r["load_month"]: _Counts(r["rows"], int(r["lost"]), r["bad"]) for r in found}

    counts, failed = _isolated(good, write if target else count) if good else ({}, {})
    errors.update(failed)
    errors.update({m: f"ValueError: {n.bad} rows have a value that can't be cast" for m, n in counts.items() if n.bad})
    for month, text in errors.items():
        log.error("month %s failed: %s", month, text)
    ok = [m for m in sorted(counts) if m not in errors]
    report = [(m, m in ok, counts[m].rows if m in ok else None, counts[m].lost if m in ok else None, errors.get(m)) for m in sorted(month_paths)]
    rep = spark.createDataFrame(report, "month string, ok boolean, rows bigint, unrepaired bigint, error string")
    if not ok:
        return None, rep
    if not target:
        return reduce(DataFrame.unionByName, [rows.drop("_lost", "_bad") for _, _, rows in scans(ok)]).select(*TRIPS_NAMES, DAY, "load_month"), rep
    commit(spark, target, [MonthEntry(m, counts[m].load, counts[m].rows, counts[m].lost, listed[m]) for m in ok], replace_all=truncate)
    if table:
        _point_partitions(spark, table, target)
        return spark.table(table), rep
    return loaded_months(spark, target, fmt), rep


def _plans(schema: T.StructType) -> bool:
    """Whether the by-name load surely has a plan for files of this schema."""
    lower = [f.name.lower() for f in schema.fields]
    return len(set(lower)) == len(lower) and all(isinstance(f.dataType, T.AtomicType) for f in schema.fields if f.name.lower() in TRIPS_NAMES) \
        and not _doubtful(schema)


def loaded_months(spark: SparkSession, target: str, fmt: str = "parquet", months: list[str] | None = None) -> DataFrame:
    """The RAW rows of the current snapshot under ``target`` (of some months only), with the pickup day and ``load_month``."""
    return read(spark, target, T.StructType([*TRIPS.fields, T.StructField(DAY, T.DateType())]), fmt, months)


def _point_partitions(spark: SparkSession, table: str, target: str) -> None:
    """Make the table's partitions the folders of the current snapshot."""
    held = {r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    now = {m: f"{load_folder(target, e.load)}/load_month={m}" for m, e in entries(spark, target).items() if e.rows}
    for month in sorted(held - set(now)):
        spark.sql(f"ALTER TABLE {table} DROP PARTITION (load_month = '{month}')")
    for month, folder in sorted(now.items()):
        if month in held:
            spark.sql(f"ALTER TABLE {table} PARTITION (load_month = '{month}') SET LOCATION '{folder}'")
        else:
            spark.sql(f"ALTER TABLE {table} ADD PARTITION (load_month = '{month}') LOCATION '{folder}'")
    spark.catalog.refreshTable(table)


def load_summary(report: DataFrame) -> DataFrame:
    """(ok months, total months, total rows) of a load report."""
    return report.agg(F.count_if("ok").alias("ok_months"), F.count(F.lit(1)).alias("total_months"),
                      F.sum("rows").cast("bigint").alias("total_rows"))


def month_manifest(raw: DataFrame, ts_col: str = "tpep_pickup_datetime") -> DataFrame:
    """Months present in a RAW table, with rows and first/last pickup.

    Uses the ``load_month`` partition column when there is one.
    """
    key = F.col("load_month") if "load_month" in raw.columns else F.trunc(ts_col, "MM")
    found = raw.groupBy(key.alias("month")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(ts_col).alias("first_pickup"), F.max(ts_col).alias("last_pickup"))
    # months are formatted after the grouping: once a month, not once a row
    return found if "load_month" in raw.columns else found.withColumn("month", F.date_format("month", "yyyy-MM"))


def months_to_load(requested: DataFrame, manifest: DataFrame) -> DataFrame:
    """Requested months not yet in the manifest (left anti join on month)."""
    return requested.join(manifest.select("month"), "month", "left_anti")


def skip_loaded_months(requested: DataFrame, manifest: DataFrame) -> DataFrame:
    """Each requested month with already_loaded and its current row count."""
    m = manifest.select("month", "rows")
    return requested.join(m, "month", "left").select(
        "month", F.col("rows").isNotNull().alias("already_loaded"),
        F.coalesce(F.col("rows"), F.lit(0)).cast("bigint").alias("rows"))
