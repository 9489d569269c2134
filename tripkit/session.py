"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on. The session time zone is pinned to UTC so
# that date/hour extraction on zoned intermediates never shifts a trip.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # A dashboard/report session runs dozens of plan shapes; the default
    # 100-entry cache of generated classes would evict and recompile them.
    "spark.sql.codegen.cache.maxEntries": "1000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tripkit", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    On a cluster ``master`` stays None and the launcher decides; tests pass
    ``local[*]`` and a small partition count.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    # getOrCreate may hand back a running session; the zone must hold anyway.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session. Only in local mode,
    when it is unset (tests), a private folder is created and registered;
    on a cluster a missing folder is an error, since executors would each
    write to their own disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tripkit-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediates.

    The configured ``spark.checkpoint.dir`` is preferred over the per-session
    subfolder Spark creates in it, so tables written here outlive a session.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), name) if "://" not in base else base.rstrip("/") + "/" + name


def remove_run_files(spark: SparkSession) -> None:
    """Delete what ``materialize`` wrote in this application (call it when no
    DataFrame that reads those files is needed any more)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_path(spark, f"tripkit_tmp/{spark.sparkContext.applicationId}"))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the jobs that run inside; the ones before come back."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def materialize(df, name: str = "result"):
    """Write ``df`` as Parquet under the shared folder and read it back.

    Cuts the lineage with one computation (an eager ``checkpoint()`` of an
    unpersisted plan computes it twice). Meant for small aggregates that many
    later steps and scalar subqueries read. Files go to
    ``<spark.checkpoint.dir>/tripkit_tmp/<application id>/``.
    """
    import uuid

    from pyspark.sql.types import StructField, StructType

    spark = df.sparkSession
    # one folder per application (as Spark's own checkpoints): a finished
    # application's intermediates are removed as one unit (remove_run_files)
    app = spark.sparkContext.applicationId
    path = shared_path(spark, f"tripkit_tmp/{app}/{name}-{uuid.uuid4().hex}")
    # once written, nobody reads the shuffles behind it: Spark removes their files now, not when the driver happens to collect garbage
    with settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        df.write.mode("overwrite").parquet(path)
    # The schema is known: reading with it skips the footer-inference job.
    # Columns come back nullable, as an inferred Parquet schema would be.
    known = StructType([StructField(f.name, f.dataType, True, f.metadata) for f in df.schema.fields])
    found = spark.read.schema(known).parquet(path)
    found.stored_at = path
    return found


def discard(*stored) -> None:
    """Delete what ``materialize`` wrote for these frames: for intermediates that no frame in use, or returned, reads any more."""
    for df in stored:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
