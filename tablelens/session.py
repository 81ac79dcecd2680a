"""Spark session defaults for tablelens jobs.

On a cluster the session is created by the platform; ``get_spark`` only fills
in settings that are still unset, so cluster-level values (shuffle partitions,
checkpoint directory, AQE) always win.
"""

from __future__ import annotations

import atexit
import os

from pyspark.sql import SparkSession

# Settings applied only when the session does not define them already.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # a few-row stats frame is broadcast; anything larger is shuffled
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def get_spark(master: str | None = None, app: str = "tablelens", shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests and benches."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("TABLELENS_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Where the session leaves it unset (local tests) a folder inside the SQL
    warehouse is used: like the warehouse, every executor can reach it.  It is
    deleted with everything in it when the driver ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints-{spark.sparkContext.applicationId}"
        spark.conf.set("spark.checkpoint.dir", configured)
        atexit.register(_delete, spark, configured)
    spark.sparkContext.setCheckpointDir(configured)
    return configured


def _delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder of ours through Hadoop's file system (nothing to do once the JVM is gone)."""
    try:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001 - at interpreter exit
        return
