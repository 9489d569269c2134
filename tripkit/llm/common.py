"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A word is a run of characters other than space, tab, LF, VT, FF and CR.
# ``bytes.split()`` cuts UTF-8 text at exactly these six.
WHITE_SPACE = r"[\x20\x09-\x0D]+"

# Text handled by one vectorised step of a Python task, in bytes.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole(docs: DataFrame, *named: Column) -> DataFrame:
    """Every column of ``docs`` as one struct ``whole``, beside the columns that the work needs: no name of theirs meets one of ours."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), *named)


def unpacked(docs: DataFrame, without: tuple[str, ...] = (), **instead: Column) -> list[Column]:
    """The columns of ``docs`` from ``whole``, without some, others in the place of some."""
    return [instead[c].alias(c) if c in instead else F.col(f"whole.`{c}`").alias(c) for c in docs.columns if c not in without]


def apart(docs: DataFrame, *names: str) -> DataFrame:
    """The columns ``names`` beside all others as one struct ``whole``."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in names] or [F.lit(0).alias("none")]
    return docs.select(F.struct(*others).alias("whole"), *names)


def together(docs: DataFrame, *names: str, **instead: Column) -> list[Column]:
    """The columns of ``docs`` again, from ``apart`` with the same ``names``."""
    return [instead[c].alias(c) if c in instead else F.col(c) if c in names else F.col(f"whole.`{c}`").alias(c) for c in docs.columns]


def held_out(mod: int = 4, remainder: int = 2, id_col: str = "doc_id") -> Column:
    """True where crc32(id as text) mod ``mod`` is ``remainder``; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % mod == remainder, F.lit(False))


def with_fields(schema: T.StructType, *fields: tuple[str, str]) -> T.StructType:
    """``schema`` plus nullable (name, type) fields."""
    out = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    for name, kind in fields:
        out = out.add(name, T._parse_datatype_string(kind), True)
    return out


_M_MMAP_THRESHOLD = -3  # of malloc.h
_KEPT: dict = {"stage": None, "things": {}}


def forget() -> None:
    """Drop what this Python worker kept for another stage: workers live on, and one stage's words are no use to the next."""
    import ctypes
    import gc

    import pyarrow as pa
    from pyspark import TaskContext

    context = TaskContext.get()
    stage = context.stageId() if context else None
    if stage != _KEPT["stage"]:
        _KEPT.update(stage=stage, things={})
        gc.collect()
        pa.default_memory_pool().release_unused()
        libc = ctypes.CDLL(None)
        if hasattr(libc, "malloc_trim"):  # glibc keeps freed arrays; from now on those of a MB and more go back at once
            libc.mallopt(_M_MMAP_THRESHOLD, 1 << 20)
            libc.malloc_trim(0)


def kept(name, make):
    """What ``make`` returned when this Python worker first asked for ``name`` in the running stage."""
    forget()
    things = _KEPT["things"]
    if name not in things:
        things[name] = make()
    return things[name]


def slices(batches: Iterable, text_col: str = "text", max_bytes: int = SLICE_BYTES) -> Iterator:
    """Cut Arrow batches so that each slice holds about ``max_bytes`` of text (one row at least)."""
    import numpy as np

    forget()
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        col = batch.column(batch.schema.get_field_index(text_col))
        width = np.dtype(np.int64 if "large" in str(col.type) else np.int32)
        if col.buffers()[1] is None:
            yield batch
            continue
        offsets = np.frombuffer(col.buffers()[1], width)[col.offset:col.offset + n + 1]
        begin = 0
        while begin < n:
            end = int(np.searchsorted(offsets, offsets[begin] + max_bytes, "right")) - 1
            end = min(max(end, begin + 1), n)
            yield batch.slice(begin, end - begin)
            begin = end


def utf8(batch, text_col: str = "text") -> list[bytes]:
    """The text column as UTF-8 bytes; null is empty."""
    import pyarrow as pa

    col = batch.column(batch.schema.get_field_index(text_col))
    return [x or b"" for x in col.cast(pa.large_binary() if "large" in str(col.type) else pa.binary()).to_pylist()]


def strings(batch, text_col: str = "text") -> list[str | None]:
    return batch.column(batch.schema.get_field_index(text_col)).to_pylist()


def append(batch, **columns):
    """An Arrow batch with more columns, in order."""
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()], [*batch.schema.names, *columns])


def split_heavy(groups: DataFrame, count_col: str, total: int, at_most: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """(heavy, light) groups by their row counts, which add up to ``total`` at most.

    A group is heavy from ``total / at_most`` rows on, so there are never more than ``at_most`` heavy ones:
    they can be broadcast, and no key of a shuffled join has more rows than that share.
    """
    heavy = F.col(count_col) * at_most >= max(total, 1)
    return groups.filter(heavy), groups.filter(~heavy)


def join_groups(rows: DataFrame, groups: DataFrame, key: str, count_col: str, total: int, how: str = "left") -> DataFrame:
    """``rows`` joined to ``groups`` (one row a key, with the number of its rows) without a hot key in the shuffle: heavy
    groups are broadcast, at most 10,000 of them. The groups' other columns come with the rows, ``count_col`` does not."""
    heavy, light = split_heavy(groups, count_col, total)
    mark = F.lit(True).alias("_heavy")
    told = rows.join(F.broadcast(heavy.drop(count_col).select("*", mark)), key, "left")
    extra = [c for c in groups.columns if c not in (key, count_col)]
    rest = told.filter("_heavy is null").drop("_heavy", *extra).join(light.drop(count_col), key, how)
    return told.filter("_heavy").drop("_heavy").unionByName(rest)
