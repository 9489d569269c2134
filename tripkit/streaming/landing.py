"""Incremental load of monthly files dropped into a landing folder.

A Structured Streaming file source remembers, in its checkpoint, which
files it has already committed; re-running the query with an
``availableNow`` trigger loads only new files. That is the "a month already
loaded is not fetched again" rule, with exactly-once bookkeeping that
survives a lost executor or a restarted driver.

The stream is conformed to the RAW schema by name (a projection) and
written by Spark's Parquet file sink, partitioned by pickup month. The sink
commits each micro-batch to its ``_spark_metadata`` log together with the
source checkpoint, so a batch retried after a failure is never appended
twice; readers (``spark.read.parquet(target)``) see committed files only.
The target is therefore owned by the stream: the batch loader writes its
own table. Files whose physical types differ from the declared landing
schema must go through the batch loader
(``tripkit.sources.months.load_months``), which reads each file with its own
schema.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..session import shared_path
from ..sources.parquet import copy_by_name
from ..sources.schema import TRIPS


def landing_stream(spark: SparkSession, landing_dir: str, schema: T.StructType = TRIPS,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(landing_dir)


def conform_landing(stream: DataFrame) -> DataFrame:
    """RAW columns by name plus the ``load_month`` partition column."""
    return copy_by_name(stream, TRIPS).withColumn(
        "load_month", F.date_format("tpep_pickup_datetime", "yyyy-MM"))


def start_landing_load(spark: SparkSession, landing_dir: str, target: str,
                       checkpoint: str | None = None, available_now: bool = True,
                       schema: T.StructType = TRIPS, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the incremental load; with ``available_now`` it stops by itself
    once every file present at start is committed. Without ``checkpoint``, each
    pair of landing folder and target has one of its own."""
    if checkpoint is None:
        pair = hashlib.sha256(f"{landing_dir}\n{target}".encode()).hexdigest()[:16]
        checkpoint = shared_path(spark, f"landing_load_checkpoint/{pair}")
    w = (conform_landing(landing_stream(spark, landing_dir, schema, max_files_per_trigger)).writeStream
         .format("parquet")
         .partitionBy("load_month")
         .option("path", target)
         .option("checkpointLocation", checkpoint)
         .outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def committed_rows(spark: SparkSession, target: str) -> int:
    """Rows in the files that the sink has committed (0 before the first batch)."""
    try:
        return spark.read.parquet(target).count()
    except AnalysisException:
        return 0


def run_landing_load(spark: SparkSession, landing_dir: str, target: str, checkpoint: str | None = None,
                     max_files_per_trigger: int | None = None) -> int:
    """Run one catch-up pass, in batches of ``max_files_per_trigger`` files;
    returns the number of rows appended (from the committed files: a query's
    progress keeps its last 100 batches only)."""
    before = committed_rows(spark, target)
    start_landing_load(spark, landing_dir, target, checkpoint, True,
                       max_files_per_trigger=max_files_per_trigger).awaitTermination()
    return committed_rows(spark, target) - before
