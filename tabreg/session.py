"""Session helpers: building a session and finding the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tabreg") -> SparkSession:
    """Return the active session, or build one with the settings this library expects.

    On a cluster the session normally exists already (spark-submit); then nothing here
    overrides the cluster's settings. Locally we build one with AQE on and the UI off.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def size_shuffle_partitions(spark: SparkSession, input_bytes: int, target_bytes: int = 256 << 20,
                            max_partition_bytes: int = 256 << 20) -> int:
    """Set ``spark.sql.shuffle.partitions`` so one shuffle partition holds about
    ``target_bytes`` of the input (AQE then merges small ones), and the scan split size to
    ``max_partition_bytes``. For a 100 TB input and 256 MiB this is ~400,000 partitions;
    the range sorts of the exact-rank operators use the same count. Returns the count."""
    n = max(int(spark.sparkContext.defaultParallelism), int(-(-input_bytes // target_bytes)))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(max_partition_bytes))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(min(target_bytes, 128 << 20)))
    return n


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; we only pick our own when the setting is
    unset in local mode (tests). On a cluster an unset setting is an error: a
    machine-local folder would not survive the loss of the machine.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc_dir = spark.sparkContext.getCheckpointDir()
        if not sc_dir:
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    sc_dir = spark.sparkContext.getCheckpointDir()
    if sc_dir:
        return sc_dir
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):      # local-cluster has executors of its own
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder every executor can reach "
                           "(e.g. on the cluster's shared file system) before running tabreg operators")
    local = tempfile.mkdtemp(prefix="tabreg-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def cut_lineage(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    This cuts the lineage (a lost executor re-reads the files instead of recomputing the
    plan; never a local checkpoint) and, unlike ``Dataset.checkpoint``, gives the planner
    the real file size: a checkpointed relation keeps the size estimate of the plan it
    replaced, and join estimates are products of their inputs, so in an iterative job
    the estimates compound until planning itself stalls.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.mode("overwrite").parquet(path, compression=compression)
    out = spark.read.schema(df.schema).parquet(path)
    out._tabreg_path = path
    return out


def release_tables(*tables: DataFrame) -> None:
    """Delete tables that ``cut_lineage`` wrote, once everything computed from them is written."""
    for table in tables:
        path = getattr(table, "_tabreg_path", None)
        if path in _WRITTEN:
            _WRITTEN.remove(path)
            spark = table.sparkSession
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_path(spark: SparkSession) -> str:
    """A new folder name below the shared checkpoint folder, released like the tables of
    ``cut_lineage``."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/tabreg-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


_WRITTEN: list[str] = []


def release_materialized(spark: SparkSession | None = None) -> int:
    """Delete the tables this process wrote with ``cut_lineage`` (through the Hadoop
    FileSystem API, so any shared store works). Call it when the results built on them
    have been written or collected; it also runs, best effort, when the interpreter exits.
    Returns the number of folders removed."""
    spark = spark or SparkSession.getActiveSession()
    if spark is None or not _WRITTEN:
        return 0
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    while _WRITTEN:
        path = _WRITTEN.pop()
        try:
            p = jvm.org.apache.hadoop.fs.Path(path)
            if p.getFileSystem(conf).delete(p, True):
                removed += 1
        except Exception:  # a stopped context or a vanished folder: nothing left to do
            pass
    return removed


def _cleanup_at_exit() -> None:
    try:
        release_materialized()
    except Exception:
        pass


atexit.register(_cleanup_at_exit)
