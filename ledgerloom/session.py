"""Spark session defaults and the shared checkpoint folder.

The library never creates a session on a cluster by itself: jobs receive
the caller's ``SparkSession``.  ``local_session`` is for tests, the bench
and the command line only.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every query plan in this package is written against.  AQE
# coalesces shuffle partitions and splits skewed join partitions at run
# time; the broadcast threshold is the size check Spark applies before it
# turns a join side into a broadcast (stats-based, never forced).  It is
# compared with parquet bytes, shared out to columns by their types: 9 million
# keys of orders count as 31 MB there, and are many times that as a hash table
# on the driver.
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(2 * 1024 * 1024),
    # the JVM never compiles a method of more than 8,000 bytes: a stage of many text rules would be interpreted for all its rows
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ledgerloom") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LEDGERLOOM_DRIVER_MEM", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in PLAN_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_plan_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings the plans assume, where the caller left
    them unset.

    The session time zone is left as the caller set it: every date in the
    plans comes from ``timestamp_ntz`` columns or ``date`` values, which do
    not shift with the zone.
    """
    chosen = spark.conf.getAll
    for key, value in PLAN_CONF.items():
        if key != "spark.sql.session.timeZone" and key not in chosen:
            spark.conf.set(key, value)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is set by the deployment (a shared file system
    path).  Only when it is unset in local mode -- tests and local runs -- do
    we pick a fresh scratch folder; on a cluster that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="ledgerloom-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return conf_dir


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path in the shared folder, for the files of one run."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    For frames that several branches must see as *one* evaluation (a range
    partitioning, say): Spark may evaluate a branch anew, the files stay as
    they are, whichever executor is lost.
    """
    path = run_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Spark's own removal of a query's shuffle files at its end; without it they stay until the driver collects garbage.
_FREES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes and collects of this block leave no shuffle files behind.  For
    frames that are run once: one run again would shuffle again."""
    was = spark.conf.get(_FREES, None)
    spark.conf.set(_FREES, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREES) if was is None else spark.conf.set(_FREES, was)


def stored_parts(parts: Iterable[DataFrame], name: str) -> DataFrame:
    """The frames written one after the other to one folder (as zstd, each
    one's shuffle files removed before the next) and read back as one, until
    ``forget``.  At least one frame; all have the same columns."""
    path = None
    for df in parts:
        spark, schema = df.sparkSession, df.schema
        path = path or run_folder(spark, name)
        with freed_shuffles(spark):
            df.write.mode("append").option("compression", "zstd").parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._stored_at = path
    return out


def stored_lean(df: DataFrame, name: str) -> DataFrame:
    """``stored`` for wide rows: see ``stored_parts``."""
    return stored_parts([df], name)


def forget(df: DataFrame) -> None:
    """Deletes the files of a frame from ``stored_parts`` that nothing reads any more."""
    path = getattr(df, "_stored_at", None)
    if path is None:
        return
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)
