"""Reports that appear as a whole or not at all.

Each run writes a folder of its own below the report's path and marks it when the
write, and the comparison of its control totals, have succeeded. A reader takes the last marked
folder, so it never sees a half-written report, and a failed run leaves the
report before it in place.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..operators.totals import Totals
from .writers import save_table, write_report

MARKER = "_PUBLISHED"


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def publish(df: DataFrame, path: str, totals: Totals | None = None, fmt: str = "csv",
            sep: str = ",") -> str:
    """Write a report as the new version below ``path`` and return its folder.

    ``totals`` are verified after the write, before the version is marked:
    :class:`~..operators.totals.TotalsDiffer` leaves it unpublished.
    """
    if fmt not in ("csv", "parquet"):
        raise ValueError("fmt must be 'csv' or 'parquet'")
    spark = df.sparkSession
    version = f"{path.rstrip('/')}/version={time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    if fmt == "csv":
        write_report(df, version, sep=sep, mode="errorifexists")
    else:
        save_table(df, version, mode="errorifexists")
    if totals is not None:
        totals.verify()
    files, marker = _files(spark, f"{version}/{MARKER}")
    files.create(marker, False).close()
    return version


def published(spark: SparkSession, path: str) -> str:
    """Folder of the last published version."""
    files, place = _files(spark, path)
    found = files.listStatus(place) if files.exists(place) else []
    names = sorted((s.getPath().getName() for s in found if s.isDirectory()), reverse=True)
    for name in names:
        version = f"{path.rstrip('/')}/{name}"
        if name.startswith("version=") and files.exists(_files(spark, f"{version}/{MARKER}")[1]):
            return version
    raise FileNotFoundError(f"nothing published at {path}")
