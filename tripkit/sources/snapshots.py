"""Month folders committed by snapshots.

A load writes its months to a folder of its own, ``data/load=<id>/load_month=<month>``, and commits by a snapshot: the list of
the months and the load that each is read from, with its rows and source files. The snapshot is published last, by one file, and
readers follow the last published one. So a reader sees all of a load or nothing of it, a load that breaks off leaves the old
rows in place, and a load that replaces every month needs no moment in which the table is empty. One load commits at a time.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import InputFile, names, remove
from .raw import publish, published

_MANIFEST = "month string, load string, rows bigint, unrepaired bigint, sources array<struct<path:string,length:bigint,modified:bigint>>"


class MonthEntry(NamedTuple):
    month: str
    load: str
    rows: int
    unrepaired: int
    sources: list[InputFile]


def new_load() -> str:
    return uuid.uuid4().hex


def load_folder(target: str, load: str) -> str:
    return f"{target}/data/load={load}"


def manifest(spark: SparkSession, target: str) -> DataFrame:
    """(month, load, rows, unrepaired, sources) of the current snapshot; without rows before the first one."""
    folder = published(spark, target)
    if folder is None:
        return spark.createDataFrame([], _MANIFEST)
    return spark.read.schema(_MANIFEST).parquet(folder)


def entries(spark: SparkSession, target: str) -> dict[str, MonthEntry]:
    """The current snapshot by month, a row each, to plan a load or a read."""
    return {r["month"]: MonthEntry(r["month"], r["load"], r["rows"], r["unrepaired"], [InputFile(*f) for f in r["sources"]])
            for r in manifest(spark, target).collect()}


def commit(spark: SparkSession, target: str, loaded: list[MonthEntry], replace_all: bool = False) -> None:
    """Publish a snapshot in which ``loaded`` takes the place of its months, or of all months with ``replace_all``."""
    old = {} if replace_all else entries(spark, target)
    months = {**old, **{e.month: e for e in loaded}}
    folder = f"{target}/snapshot-{uuid.uuid4().hex}"
    spark.createDataFrame([tuple(months[m]) for m in sorted(months)], _MANIFEST).coalesce(1).write.parquet(folder)
    publish(spark, target, folder)


def read(spark: SparkSession, target: str, schema: T.StructType, fmt: str = "parquet", months: list[str] | None = None) -> DataFrame:
    """The rows of the current snapshot with ``load_month``; filters on it prune folders. With ``months`` no other one is looked at."""
    full = T.StructType([*schema.fields, T.StructField("load", T.StringType()), T.StructField("load_month", T.StringType())])
    folders = [f"{load_folder(target, e.load)}/load_month={m}" for m, e in sorted(entries(spark, target).items())
               if e.rows and (months is None or m in months)]
    if not folders:
        return spark.createDataFrame([], full).drop("load")
    return spark.read.format(fmt).schema(full).option("basePath", f"{target}/data").load(folders).drop("load")


def vacuum(spark: SparkSession, target: str) -> list[str]:
    """Remove the snapshots before the current one and the loads it doesn't read; call it when nobody reads older ones."""
    current = published(spark, target)
    if current is None:
        return []
    used = {e.load for e in entries(spark, target).values()}
    marks = names(spark, f"{target}/published")
    gone = [f"published/{m}" for m in marks[:-1]]
    gone += [n for n in names(spark, target) if n.startswith("snapshot-") and n != current.rsplit("/", 1)[1]]
    gone += [f"data/{n}" for n in names(spark, f"{target}/data") if n.startswith("load=") and n.split("=", 1)[1] not in used]
    for name in gone:
        remove(spark, f"{target}/{name}")
    return gone


def changed_months(listing: DataFrame, held: DataFrame) -> DataFrame:
    """(month, status, files, changed_files) of every listed month.

    ``listing`` has (month, path, length, modified) of the files there are now, ``held`` is a ``manifest``. A month is ``new``
    when no snapshot has it, ``replaced`` when a file of it is not the one that was loaded, or one that was loaded is gone, else
    ``same``. A file is told by its path, length and time.
    """
    keys = ["month", "path", "length", "modified"]
    loaded = held.select("month", F.inline("sources")).select(*keys)
    now = listing.select(*keys)
    changed = now.join(loaded, keys, "left_anti").groupBy("month").agg(F.count("*").alias("changed_files"))
    gone = loaded.join(now, keys, "left_anti").select("month").distinct().withColumn("gone", F.lit(True))
    months = now.groupBy("month").agg(F.count("*").alias("files"))
    known = held.select("month").withColumn("known", F.lit(True))
    return months.join(known, "month", "left").join(changed, "month", "left").join(gone, "month", "left").select(
        "month", F.when(F.col("known").isNull(), "new").when(F.col("changed_files").isNotNull() | F.col("gone"), "replaced").otherwise("same").alias("status"),
        "files", F.coalesce("changed_files", F.lit(0)).cast("bigint").alias("changed_files"))
