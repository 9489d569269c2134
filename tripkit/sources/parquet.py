"""Parquet scans and by-name loading into the fixed RAW schema.

Monthly files do not always agree on types (an INT64 ``passenger_count``
next to a DOUBLE one cannot be read by one scan or merged schema), nor on
column case or presence. Files are grouped by their own Parquet schema; each
group is one scan, conformed by name (case-insensitive) to the target:
matched columns are cast, missing ones become typed NULLs, extra ones are
dropped. Groups are combined with UNION ALL by name.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import list_files
from .schema import TRIPS


def copy_by_name(df: DataFrame, schema: T.StructType = TRIPS,
                 timestamp_units: dict[str, str] | None = None, keep: tuple[str, ...] = (),
                 try_casts: bool = False) -> DataFrame:
    """Conform ``df`` to ``schema`` by column name, ignoring case.

    Two source columns that differ in case only are an error. With ``try_casts``
    a value that can't be cast is NULL instead of failing the job.

    ``timestamp_units`` maps a target timestamp column to the unit ('s', 'ms',
    'us') of an integer source column (epoch repair); by default an integer
    source for a timestamp target is read as microseconds. ``keep`` names
    further columns to pass on.
    """
    from ..functions.dates import epoch_repair
    src = {f.name.lower(): f for f in df.schema.fields}
    twice = sorted({f.name for f in df.schema.fields if src[f.name.lower()] is not f and f.name not in keep})
    if twice:
        raise ValueError(f"columns that differ in case only: {', '.join(twice)}")
    cols = []
    for f in schema.fields:
        s = src.get(f.name.lower())
        if s is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name, metadata=f.metadata))
            continue
        c = F.col(f"`{s.name}`")
        is_ts_target = isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType))
        if is_ts_target and isinstance(s.dataType, (T.LongType, T.IntegerType)):
            unit = (timestamp_units or {}).get(f.name, "us")
            c = epoch_repair(c, unit).cast(f.dataType)
        elif s.dataType != f.dataType:
            c = c.try_cast(f.dataType) if try_casts else c.cast(f.dataType)
        cols.append(c.alias(f.name, metadata=f.metadata))
    return df.select(*cols, *keep)


def _arrow_schema_key(schema) -> str:
    """Column names (lower case) and physical types of one Parquet footer.

    Files with equal keys read the same way, so one scan can cover them
    (column names are matched without case, as the by-name load does).
    """
    return ",".join(f"{f.name.lower()}:{f.type}" for f in schema)


def open_file(path: str):
    """An Arrow file for a path as Hadoop writes it (nothing in it is percent-encoded)."""
    from urllib.parse import quote

    from pyarrow import fs as pafs

    scheme, _, rest = path.partition(":") if ":/" in path else ("file", "", path)
    if scheme == "file":
        return pafs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    # Hadoop's S3 schemes name the same store Arrow calls s3://
    scheme = "s3" if scheme in ("s3a", "s3n") else scheme
    filesystem, rel = pafs.FileSystem.from_uri(f"{scheme}:{quote(rest)}")
    return filesystem.open_input_file(rel)


def footer_tasks(spark: SparkSession, n_files: int) -> int:
    """Tasks that read footers: a dozen or more files each, a Python worker costs more than some footers."""
    return max(1, min(-(-n_files // 16), spark.sparkContext.defaultParallelism))


def _read_footers(batches):
    """mapInPandas body: (path) -> (path, schema_key, error); reads only the
    footer of each file, through the filesystem named by its URI."""
    import pandas as pd
    import pyarrow.parquet as pq

    for b in batches:
        keys, errors = [], []
        for uri in b["path"]:
            try:
                with open_file(uri) as file:
                    keys.append(_arrow_schema_key(pq.read_schema(file)))
                errors.append(None)
            except Exception as e:  # unknown scheme or unreadable file: the driver decides
                keys.append(None)
                errors.append(f"{type(e).__name__}: {e}")
        yield pd.DataFrame({"path": b["path"], "schema_key": keys, "error": errors})


def file_schemas(spark: SparkSession, path_glob: str | list[str]) -> DataFrame:
    """(path, schema_key, error) for every file under the paths or globs.

    Spark lists the files (``binaryFile`` with its content column pruned
    reads no data; globs are resolved by the cluster's filesystem) and the
    footers are read in parallel tasks, so ten thousand files cost one short
    job, not ten thousand driver round trips.
    """
    paths = list(path_glob) if isinstance(path_glob, (list, tuple)) else [path_glob]
    files = spark.read.format("binaryFile").load(paths).select("path")
    return (files.repartition(spark.sparkContext.defaultParallelism)
            .mapInPandas(_read_footers, "path string, schema_key string, error string"))


def scan_parquet_glob(spark: SparkSession, path_glob: str | list[str],
                      schema: T.StructType = TRIPS) -> DataFrame:
    """All Parquet files under a glob as one DataFrame in ``schema``.

    Files sharing a physical schema are read by one scan, so a thousand
    same-typed monthly files cost one plan node, not a thousand. Footers are
    read once, by Spark tasks, and listed in the shared folder; when all files
    share one schema the given paths are scanned as they are. Otherwise the
    paths come to the driver one schema at a time, without gathering them in a
    task: each scan's plan needs its paths, as any Parquet read does. Files
    that a task could not open (a filesystem Arrow doesn't know) are one scan
    with merged schemas; an unreadable file fails it, as any Parquet read.
    """
    from ..session import materialize

    listed = materialize(file_schemas(spark, path_glob), "parquet_footers")
    # one small row per physical schema first; the usual case (every file
    # alike) scans the given paths or globs and ships no file list at all
    kinds = listed.groupBy("schema_key").agg(F.count(F.lit(1)).alias("n_files")).orderBy("schema_key").collect()
    if not kinds:
        return spark.createDataFrame([], schema)
    if len(kinds) == 1 and kinds[0]["schema_key"] is not None:
        paths = list(path_glob) if isinstance(path_glob, (list, tuple)) else [path_glob]
        return copy_by_name(spark.read.parquet(*paths), schema)
    frames = []
    for kind in kinds:
        mine = listed.filter(F.col("schema_key").eqNullSafe(kind["schema_key"])).select("path").orderBy("path")
        merge = "true" if kind["schema_key"] is None else "false"
        frames.append(copy_by_name(spark.read.option("mergeSchema", merge).parquet(*[r["path"] for r in mine.toLocalIterator()]), schema))
    return reduce(lambda a, b: a.unionByName(b), frames)


class FileKind(NamedTuple):
    """Files that one scan reads: they have one physical schema."""

    schema: T.StructType
    paths: list[str]


def file_kinds(spark: SparkSession, paths: list[str]) -> tuple[list[FileKind], dict[str, str]]:
    """(the files grouped by physical schema, {path: error} of those without a readable footer).

    Footers are read by tasks; Spark's own reader then names the types of one file a group, and of those that the tasks could
    not open.
    """
    if not paths:
        return [], {}
    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(footer_tasks(spark, len(paths)))
    found = listed.mapInPandas(_read_footers, "path string, schema_key string, error string").collect()
    return kinds_of(spark, [(r["path"], r["schema_key"]) for r in found])


def kinds_of(spark: SparkSession, keyed: list[tuple[str, str | None]]) -> tuple[list[FileKind], dict[str, str]]:
    """``file_kinds`` of (path, schema_key) pairs; a file without a key is looked at by itself."""
    groups: dict[str, list[str]] = {}
    for path, key in sorted(keyed):
        groups.setdefault(key or f"alone:{path}", []).append(path)
    kinds, errors = {}, {}
    for members in groups.values():
        try:
            schema = spark.read.parquet(members[0]).schema
            kinds.setdefault(schema.json(), FileKind(schema, [])).paths.extend(members)
        except Exception as e:  # not a Parquet file, or gone
            errors.update({p: f"{type(e).__name__}: {e}" for p in members})
    return list(kinds.values()), errors


_COLUMNS = "path string, name string, type string, nullable boolean, place int, error string"


def _read_columns(batches):
    """mapInPandas body: a row for each column of each file's footer, with the type's name in Spark."""
    import pandas as pd
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_type

    def spark_name(kind) -> str:
        try:
            return from_arrow_type(kind, prefer_timestamp_ntz=True).simpleString()
        except Exception:  # a type that Spark has not
            return str(kind)

    for b in batches:
        rows = []
        for uri in b["path"]:
            try:
                with open_file(uri) as file:
                    schema = pq.read_schema(file)
                rows += [(uri, f.name, spark_name(f.type), f.nullable, i, None) for i, f in enumerate(schema)]
            except Exception as e:
                rows.append((uri, None, None, None, None, f"{type(e).__name__}: {e}"))
        yield pd.DataFrame(rows, columns=[f.split()[0] for f in _COLUMNS.split(", ")]).astype({"place": "Int32", "nullable": "boolean"})


# Types that widen to one another, the narrowest first; of integers and fractions together, DOUBLE is the least that holds both.
_INTEGERS = ("tinyint", "smallint", "int", "bigint")
_FRACTIONS = ("float", "double")


def _merged_type(types: Column) -> Column:
    """The least type that holds all of a column's (distinct) types; ``string`` where no other does.

    Integers widen, an integer and a fraction are DOUBLE, decimals of different sizes or with other numbers too; a DATE widens to a
    timestamp, and an integer beside a timestamp is one (the by-name load repairs it).
    """
    def only(allowed):
        return F.forall(types, lambda t: t.isin(*allowed) if "decimal" not in allowed else t.isin(*allowed) | t.startswith("decimal"))

    def has(some):
        return F.exists(types, lambda t: t.isin(*some))

    widest = F.element_at(F.array(*map(F.lit, _INTEGERS)), F.array_max(F.transform(types, lambda t: F.array_position(F.array(*map(F.lit, _INTEGERS)), t))).cast("int"))
    times = ("timestamp_ntz", "timestamp")
    return F.when(F.size(types) == 1, types[0]).when(only(_INTEGERS), widest) \
        .when(only((*_INTEGERS, *_FRACTIONS, "decimal")), F.lit("double")) \
        .when(has(("timestamp_ntz",)) & only((*times, "date", *_INTEGERS)), F.lit("timestamp_ntz")) \
        .when(has(times) & only((*times, "date", *_INTEGERS)), F.lit("timestamp")).otherwise(F.lit("string"))


def infer_glob_schema(spark: SparkSession, path_glob: str | list[str]) -> DataFrame:
    """(column_name, type, nullable, expression, order_id, n_files, in_all_files, types) of all Parquet files under the paths or globs.

    Every footer is read, by tasks; a grouped aggregate merges a column's types over all files, whatever the case of its
    name. The name is that of the first file by path, and so is the order, columns that come later behind. A column that a file
    lacks is nullable. ``types`` has for each type the number of files and the first one. An unreadable file is an error.
    """
    from ..session import materialize

    paths = list(path_glob) if isinstance(path_glob, (list, tuple)) else [path_glob]
    files = [(f.path,) for p in paths for f in list_files(spark, p)]
    listed = spark.createDataFrame(files, "path string").repartition(footer_tasks(spark, len(files)))
    columns = materialize(listed.mapInPandas(_read_columns, _COLUMNS), "parquet_columns")
    broken = columns.filter("error is not null").select("path", "error").take(3)
    if broken:
        raise ValueError("; ".join(f"{r['path']}: {r['error']}" for r in broken))
    by_type = columns.groupBy(F.lower("name").alias("key"), "type").agg(
        F.count("*").alias("n_files"), F.min("path").alias("first_file"), F.max("nullable").alias("nullable"),
        F.min(F.struct("path", "place", "name")).alias("first"))
    merged = by_type.groupBy("key").agg(
        F.sum("n_files").alias("n_files"), F.max("nullable").alias("nullable"), F.min("first").alias("first"),
        F.sort_array(F.collect_list(F.struct("type", "n_files", "first_file"))).alias("types"))
    told = merged.select(F.col("first.name").alias("column_name"), _merged_type(F.col("types.type")).alias("type"),
                         (F.col("nullable") | (F.col("n_files") < len(files))).alias("nullable"), "first", "n_files",
                         (F.col("n_files") == len(files)).alias("in_all_files"), "types")
    # one row a column: the window is as small as a schema
    order = F.row_number().over(Window.orderBy("first.path", "first.place")) - 1
    name, kind = F.col("column_name"), F.upper("type")
    return told.select("column_name", "type", "nullable",
                       F.concat(F.lit("CAST(`"), name, F.lit("` AS "), kind, F.lit(") AS "), F.lower(name)).alias("expression"),
                       order.alias("order_id"), "n_files", "in_all_files", "types").orderBy("order_id")


def infer_schema(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(column_name, type, nullable, expression, order_id) of a Parquet file, or of all under the paths or globs.

    ``expression`` is the cast a by-name load would apply to the column.
    """
    return infer_glob_schema(spark, path).select("column_name", "type", "nullable", "expression", "order_id")
