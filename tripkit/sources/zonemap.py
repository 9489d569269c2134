"""A zone map of Parquet files: what each row group holds of one time column, to read only files that a window needs.

Spark does not prune on the statistics of TIMESTAMP_NTZ columns, and month files as they arrive have no DATE column, nor even one
type for the time. The zone map is a table of (file, row group, rows, least and greatest time in microseconds, schema) from the
files' footers, read by tasks; no column data is read. It is written once per listing, and a later listing reads the footers of new
files only. A window then selects files from that table, and only those are opened.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.derive import PICKUP
from ..session import shared_path
from .files import InputFile, list_files
from .parquet import _arrow_schema_key, copy_by_name, footer_tasks, kinds_of, open_file
from .raw import publish, published
from .schema import TRIPS

_ZONES = ("path string, length bigint, modified bigint, row_group int, rows bigint, low bigint, high bigint, "
          "schema_key string, error string")


def _micros(value) -> int | None:
    """A statistic as microseconds since 1970, as the by-name load reads the column; None where it is no time."""
    if isinstance(value, dt.datetime):
        naive = value.replace(tzinfo=None) if value.tzinfo is None else value.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return (naive - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    return int(value) if isinstance(value, int) and not isinstance(value, bool) else None


def _file_zones(uri: str, column: str) -> list[tuple]:
    """(row group, rows, low, high, schema_key) of a file; the times are None where the footer doesn't tell them."""
    import pyarrow.parquet as pq

    with open_file(uri) as file:
        footer = pq.read_metadata(file)
    schema = footer.schema.to_arrow_schema()
    at = [i for i in range(footer.num_columns) if footer.schema.column(i).path.lower() == column.lower()]
    out = []
    for group in range(footer.num_row_groups):
        described = footer.row_group(group)
        low = high = None
        if len(at) == 1:
            told = described.column(at[0]).statistics
            if told is not None and told.has_min_max:
                low, high = _micros(told.min), _micros(told.max)
        if low is None or high is None:
            low = high = None
        out.append((group, described.num_rows, low, high, _arrow_schema_key(schema)))
    return out or [(0, 0, None, None, _arrow_schema_key(schema))]


def _read_zones(column: str):
    def run(batches):
        import pandas as pd

        for b in batches:
            rows = []
            for path, length, modified in zip(b["path"], b["length"], b["modified"]):
                try:
                    rows += [(path, length, modified, *zone, None) for zone in _file_zones(path, column)]
                except Exception as e:  # an unknown store or an unreadable file: it is read by any window
                    rows.append((path, length, modified, None, None, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in _ZONES.split(", ")]).astype(
                {c: "Int64" for c in ("row_group", "rows", "low", "high")})
    return run


def zone_map(spark: SparkSession, path_glob: str | list[str], column: str = PICKUP, root: str | None = None) -> DataFrame:
    """(path, length, modified, row_group, rows, low, high, schema_key, error) of all files under the paths or globs.

    ``low`` and ``high`` are microseconds since 1970 (an integer column is read as that, as the by-name load does), null where a
    footer has no such statistic. The map is kept under ``root`` (by default a folder of its own for paths and column in the
    shared folder): while the listing stays, it is read as it is, without a job; when it changes, files with the same path, length
    and time keep their rows.
    """
    paths = list(path_glob) if isinstance(path_glob, (list, tuple)) else [path_glob]
    files = [f for p in paths for f in list_files(spark, p)]
    root = root or shared_path(spark, f"tripkit_zones/{hashlib.sha256(repr((column, paths)).encode()).hexdigest()[:24]}")
    folder = f"{root}/zones-{hashlib.sha256(repr((column, files)).encode()).hexdigest()[:24]}"
    last = published(spark, root)
    if last != folder:
        _write_zones(spark, files, column, last, folder)
        publish(spark, root, folder)
    return spark.read.schema(_ZONES).parquet(folder)


def _write_zones(spark: SparkSession, files: list[InputFile], column: str, last: str | None, folder: str) -> None:
    kind = T._parse_datatype_string("path string, length bigint, modified bigint")
    listing = spark.createDataFrame(files, kind)
    keys = kind.fieldNames()
    known = spark.read.schema(_ZONES).parquet(last) if last else None
    new = listing.join(known.select(*keys).distinct(), keys, "left_anti") if known is not None else listing
    zones = new.repartition(footer_tasks(spark, len(files))).mapInPandas(_read_zones(column), _ZONES)
    if known is not None:
        zones = zones.unionByName(known.join(listing, keys, "left_semi"))
    zones.write.mode("overwrite").parquet(folder)


def _bound(value: str | dt.date | dt.datetime) -> int:
    return _micros(dt.datetime.fromisoformat(str(value)))


def files_in_window(zones: DataFrame, start, end_exclusive) -> DataFrame:
    """(path, schema_key, rows): the files that may hold a time in the window, with the rows of the row groups that may."""
    may = F.col("low").isNull() | ((F.col("low") < _bound(end_exclusive)) & (F.col("high") >= _bound(start)))
    return zones.filter(may).groupBy("path", "schema_key").agg(F.sum("rows").alias("rows"))


def scan_window(spark: SparkSession, path_glob: str | list[str], start, end_exclusive, schema: T.StructType = TRIPS,
                column: str = PICKUP, root: str | None = None) -> DataFrame:
    """The rows with ``start <= column < end_exclusive`` of all Parquet files under the paths or globs, in ``schema``.

    Only files whose zone meets the window are opened; they are grouped by physical schema and conformed by name, as
    ``scan_parquet_glob`` does. The selected files' paths come to the driver, which plans the scans. A window that no file
    can hold gives an empty table. A selected file without a readable footer is an error, as in any Parquet read.
    """
    chosen = files_in_window(zone_map(spark, path_glob, column, root), start, end_exclusive)
    kinds, errors = kinds_of(spark, [(r["path"], r["schema_key"]) for r in chosen.select("path", "schema_key").toLocalIterator()])
    if errors:
        raise ValueError("; ".join(f"{p}: {e}" for p, e in sorted(errors.items())))
    low, high = (F.lit(str(dt.datetime.fromisoformat(str(v)))).cast("timestamp_ntz") for v in (start, end_exclusive))
    out = spark.createDataFrame([], schema)
    for k, kind in enumerate(kinds):
        rows = copy_by_name(spark.read.schema(kind.schema).parquet(*kind.paths), schema)
        out = rows if k == 0 else out.unionByName(rows)
    return out.filter((F.col(column) >= low) & (F.col(column) < high))
