"""Input files listed by Hadoop's FileSystem from the driver: no Spark job, on whatever store Spark reads."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import SparkSession


class InputFile(NamedTuple):
    path: str  # as Hadoop writes a path: with its scheme, nothing percent-encoded
    length: int
    modified: int  # milliseconds


def _system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _hidden(name: str) -> bool:
    return name.startswith(("_", "."))


def list_files(spark: SparkSession, path: str) -> list[InputFile]:
    """The files under a path or glob, by path; hidden ones (``_SUCCESS`` and the like) are left out, as in a scan.

    A path that does not exist is an error, a glob without a match an empty list.
    """
    system, p = _system(spark, path)
    found = system.globStatus(p)
    if found is None:
        raise FileNotFoundError(path)
    out, pending = [], [(s, True) for s in found]
    while pending:
        status, named = pending.pop()
        if not named and _hidden(status.getPath().getName()):
            continue
        if status.isDirectory():
            pending += [(s, False) for s in system.listStatus(status.getPath())]
        else:
            out.append(InputFile(status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return sorted(out)


def scanned_as(spark: SparkSession, path: str) -> str:
    """What ``_metadata.file_path`` says of a file's path: its URI, without an empty authority."""
    return re.sub(r"^([A-Za-z][A-Za-z0-9+.-]*):///", r"\1:/", spark._jvm.org.apache.hadoop.fs.Path(path).toUri().toString())


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, sorted; none where it doesn't exist."""
    system, p = _system(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(p)) if system.exists(p) else []


def create(spark: SparkSession, path: str) -> None:
    """An empty file; an error if it exists."""
    system, p = _system(spark, path)
    system.create(p, False).close()


def remove(spark: SparkSession, path: str) -> None:
    system, p = _system(spark, path)
    system.delete(p, True)
