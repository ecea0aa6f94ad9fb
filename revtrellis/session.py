"""Session settings the library relies on."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def ensure_settings(spark: SparkSession) -> SparkSession:
    """Pin the settings that affect results or skew handling; leave sizing to the cluster."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # Split a skewed join even where that costs one more shuffle of its output.
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and every executor can reach: the one in spark.checkpoint.dir, else one in the warehouse.

    A warehouse on a local disk is only accepted where driver and executors run in one process. Elsewhere each machine
    would write to its own disk and a later read would miss rows, so a cluster must name the folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", "")
    if configured:
        return configured
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    local = "://" not in warehouse and not warehouse.startswith("hdfs:") or warehouse.startswith("file:")
    if local and not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return os.path.join(warehouse, "_revtrellis_intermediate")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder. What is written there is deleted when the application ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path
