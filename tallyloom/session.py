"""Session construction and the shared working folder.

On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS, object
store). We read it from the session and only set our own when it is unset,
which happens in local tests and the bench.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # No broadcast from *estimated* sizes, which can be wrong by orders of
    # magnitude for built texts; AQE broadcasts a side by its measured size.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # checkpoint files of DataFrames that are gone are removed by the cleaner
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # AQE merges small shuffle partitions; the text jobs are CPU-bound per row,
    # so keep small shuffles spread over the cores (no effect on large data,
    # whose partitions are far above this floor).
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(256 * 1024),
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "tallyloom", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("TALLYLOOM_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and snapshot tables.

    Taken from ``spark.checkpoint.dir``. In local mode a fresh local folder is
    set when the session has none; on a cluster that is an error, since
    executors cannot read a folder of the driver's machine.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tallyloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared folder for one write."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def travels(module: str) -> None:
    """Task classes of a module travel with their tasks: executors need not have this package."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[module])


def materialize(df, name: str):
    """Cut lineage with a reliable checkpoint in the shared folder.

    The input is persisted (memory and disk) for the duration of the eager
    checkpoint, so it is computed once: the checkpoint's count fills the cache
    and the checkpoint write reads it; the cache is dropped right after. Later
    readers, and task retries after a lost executor, read the checkpoint files.
    ``name`` is kept for logs and call sites.
    """
    from pyspark import StorageLevel

    shared_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist()
