"""The RAW trips table, materialised once per input.

The reference loads its files into one RAW table and every model and
dashboard query reads that table. Here the RAW table for a folder of driver
tables is built by Spark from the ``trips`` fixture and written as Parquet
under the shared checkpoint folder (``spark.checkpoint.dir``). Beside the 19
columns it stores the pickup's DATE (``pickup_day``): rows are clustered by it
and sorted within each file, in small Parquet pages, so a date window reads
only the pages of its days (``date_window`` tests the day, because Spark does
not use Parquet statistics of TIMESTAMP_NTZ columns). Later queries read the
written table: no lineage back to the join, nothing recomputed after a lost
executor.

A table is keyed on the listing of its input files (path, length, modification
time) and on the version of the mapping, so a changed input or rule is built
anew. Each build writes a folder of its own and publishes it last: a build that
breaks off, or two at a time, never leave a table half written.
"""

from __future__ import annotations

import hashlib
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.filters import DAY
from ..session import settings, shared_path
from .files import create, list_files, names
from .fixture import joined_lines, pickup_time, table_path, trips_from_lines
from .schema import TRIPS, TRIPS_NAMES

# Raise it when the fixture's rules or the stored layout change.
MAPPING_VERSION = 2
# Rows of a Parquet page: the unit that a date window skips.
PAGE_ROWS = 2_000
# What a task of the build reads: compressed lines, about a million, which it joins or sorts in some 100 MB without spilling.
SHUFFLED_BYTES = "24MB"


def input_key(spark: SparkSession, paths: list[str], version: int = MAPPING_VERSION) -> str:
    """A digest of the input files' listing and of the mapping version, without a Spark job."""
    listed = [f for path in paths for f in list_files(spark, path)]
    digest = hashlib.sha256(repr((version, listed)).encode()).hexdigest()[:24]
    return f"v{version}-{len(listed)}-{digest}"


def clustered_trips(lines: DataFrame) -> DataFrame:
    """The trips of joined lines with their pickup day, clustered by it and sorted by pickup within each partition.

    The lines are shuffled and sorted, and their trips made last: a trip's 19
    columns are more than twice as wide. The rebalance needs no sampling pass
    (the join runs once), and adaptive execution splits a day that holds a
    large share of the rows and joins small ones.
    """
    dealt = lines.withColumn(DAY, F.to_date(pickup_time())).hint("rebalance", DAY).drop(DAY)
    ordered = dealt.withColumn("pickup", pickup_time()).sortWithinPartitions("pickup")
    return trips_from_lines(ordered).withColumn(DAY, F.to_date("tpep_pickup_datetime"))


def write_raw(lines: DataFrame, path: str) -> None:
    with settings(lines.sparkSession, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": SHUFFLED_BYTES}):
        clustered_trips(lines).write.option("parquet.page.row.count.limit", PAGE_ROWS).parquet(path)


def published(spark: SparkSession, root: str) -> str | None:
    """The folder of the last published build under ``root``, if any."""
    marks = names(spark, f"{root}/published")
    return f"{root}/{marks[-1].split('.', 1)[1]}" if marks else None


def publish(spark: SparkSession, root: str, folder: str) -> None:
    """Make ``folder``, which lies in ``root``, the current build: one file, named by the time and the folder, appears at once."""
    create(spark, f"{root}/published/{time.time_ns():020d}.{folder.rsplit('/', 1)[1]}")


def build_once(spark: SparkSession, root: str, write, rebuild: bool = False) -> str:
    """The published folder under ``root``; ``write(folder)`` makes it on first use."""
    folder = None if rebuild else published(spark, root)
    if folder is None:
        folder = f"{root}/build-{uuid.uuid4().hex}"
        write(folder)
        publish(spark, root, folder)
    return folder


def raw_root(spark: SparkSession, sf_dir: str) -> str:
    key = input_key(spark, [table_path(sf_dir, "lineitem"), table_path(sf_dir, "orders")])
    return shared_path(spark, f"tripkit_raw/{key}")


def raw_trips(spark: SparkSession, sf_dir: str, rebuild: bool = False, with_day: bool = False) -> DataFrame:
    """The 19-column RAW table for ``sf_dir`` (built on first use), and the
    pickup day with ``with_day``."""
    folder = build_once(spark, raw_root(spark, sf_dir), lambda path: write_raw(joined_lines(spark, sf_dir), path), rebuild)
    stored = spark.read.schema(T.StructType([*TRIPS.fields, T.StructField(DAY, T.DateType())])).parquet(folder)
    return stored if with_day else stored.select(*TRIPS_NAMES)
