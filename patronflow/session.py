"""Session settings the reports rely on."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# AQE splits hot join partitions and coalesces small ones at run time. UTC
# keeps timestamp -> date casts stable. ANSI mode stays on (the default).
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    # Recording a Python call site per column expression slows plan building.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(app_name: str = "patronflow", master: str | None = None,
                **extra: str) -> SparkSession:
    """Session with :data:`SETTINGS`; cluster sizing is left to the submitter."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _is_local(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getUri().getScheme() == "file"


def shared_folder(spark: SparkSession) -> str:
    """A fresh path in storage that the driver and every executor can reach.

    The cluster names that storage in ``spark.checkpoint.dir``. Where it is
    unset the warehouse folder is used, which Spark itself takes to be shared; a
    warehouse on the driver's own disk is refused unless Spark runs locally.
    The path is deleted when the application ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir")
        local = spark.sparkContext.master.startswith("local")
        if not local and (root.startswith("file:") or "://" not in root) and _is_local(spark, root):
            raise ValueError("name shared storage in spark.checkpoint.dir: the warehouse "
                             f"{root} is a local folder")
    path = f"{root.rstrip('/')}/patronflow/{uuid.uuid4().hex}"
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path
