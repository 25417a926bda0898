"""Session helpers.

Library functions never set a master or global state; they take the session
they are given. ``local_session`` is for tests and the local benchmark only.
Scratch output (round trips, lineage cuts) goes under the directory the
cluster names in ``spark.checkpoint.dir``; a default is set only where none
is configured, as in tests.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings every session of this library should have.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    # HotSpot leaves methods over 8000 bytes of code uncompiled; stages with a larger one run operator by operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Static settings: only honoured when a session is built (spark.conf.set on a
# running session rejects them).
STATIC_CONF = {
    # Python call-site capture on every Column operation (error context only)
    # costs extra JVM round trips while plans are built.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    checkpoint_dir: str | None = None,
    app: str = "tripgrid",
    event_log_dir: str | None = None,
) -> SparkSession:
    """A ``local[cores]`` session for tests and the benchmark (UI off)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TRIPGRID_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**SQL_CONF, **STATIC_CONF}.items():
        b = b.config(k, v)
    if event_log_dir:
        b = b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, checkpoint_dir)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint directory of this session, if any."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext, read the session conf
        return spark.conf.get("spark.checkpoint.dir", None) or None
    jdir = sc._jsc.sc().getCheckpointDir()
    if jdir.isDefined():
        return jdir.get()
    return sc.getConf().get("spark.checkpoint.dir", None) or None


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """Keep the configured checkpoint dir; set ``fallback`` only when none is set."""
    current = checkpoint_dir(spark)
    if current:
        try:
            sc = spark.sparkContext
        except Exception:  # Spark Connect: the server side owns the setting
            return current
        if not sc._jsc.sc().getCheckpointDir().isDefined():
            sc.setCheckpointDir(current)
        return current
    try:
        sc = spark.sparkContext
    except Exception as exc:  # Spark Connect: set spark.checkpoint.dir on the server
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this session") from exc
    if fallback is None:
        if not sc.master.startswith("local"):
            # A machine-local folder is not shared by executors on a cluster.
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on this cluster")
        import tempfile

        fallback = tempfile.mkdtemp(prefix="tripgrid-ckpt-")
    sc.setCheckpointDir(fallback)
    return checkpoint_dir(spark)


def _scratch_root(spark: SparkSession) -> str:
    base = checkpoint_dir(spark)
    if not base:
        raise RuntimeError("no spark.checkpoint.dir configured; call ensure_checkpoint_dir first")
    return f"{base.rstrip('/')}/tripgrid-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in this application's scratch folder, under the shared checkpoint directory."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``, and the class of its paths."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path
    return hadoop_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def delete_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch folders that nothing reads any more."""
    for path in paths:
        fs, hadoop_path = file_system(spark, path)
        fs.delete(hadoop_path(path), True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch folder; frames that read from it must not be used afterwards."""
    delete_paths(spark, [_scratch_root(spark)])
