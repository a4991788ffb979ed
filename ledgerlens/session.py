"""Spark session defaults and shared-storage helpers.

The library never creates state outside what the session names: lineage is cut
by Parquet tables written under ``spark.checkpoint.dir`` (a shared folder on a
cluster). Only a local session without that setting gets a scratch folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # wide roll-ups (4-5 aggregates per column) stay inside whole-stage codegen
    "spark.sql.codegen.maxFields": "400",
    # keep driver-side bookkeeping of finished executions small (wide plans)
    "spark.sql.ui.retainedExecutions": "50",
    "spark.ui.retainedJobs": "200",
    "spark.ui.retainedStages": "200",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "ledgerlens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor (default heap is 1g)
        conf["spark.driver.memory"] = "8g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder. Only a local session without that
    setting gets a temporary one; on a cluster its absence is an error, as a
    folder of the driver's machine is not seen by executors."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return configured


def materialize(df, name: str = "frame"):
    """Cut lineage: write ``df`` once as Parquet to the shared folder and read it
    back, so later jobs prune its columns and a lost executor costs nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_ONCE: dict = {}


def once(spark: SparkSession, name: str, sf_dir: str, make):
    """``make()``, a written frame or a fit, once per application and input folder: the queries
    that start from it share it."""
    key = (spark.sparkContext.applicationId, name, sf_dir)
    if key not in _ONCE:
        _ONCE[key] = make()
    return _ONCE[key]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for a written intermediate table, in this application's own folder
    under the shared checkpoint folder; that folder goes when the session ends."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerlens-{spark.sparkContext.applicationId}"
    if base not in _OWN_FOLDERS:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(base)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _OWN_FOLDERS.add(base)
    return f"{base}/{name}"


_OWN_FOLDERS: set[str] = set()
