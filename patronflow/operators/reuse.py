"""Hand-off of a table that a report reads more than once."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame

from ..session import shared_folder
from ..sources.writers import save_table

Keep = Callable[[DataFrame], DataFrame]


def hold(df: DataFrame) -> DataFrame:
    """Write the table to the shared folder and return it read back.

    Used for per-customer tables that feed both a global statistic and the
    report itself. The order tables behind them are scanned once, later steps
    plan on a plain scan of known size, and a lost executor costs a re-read
    rather than a recomputation. Running the write is an action.
    """
    return save_table(df, shared_folder(df.sparkSession))


def hold_by(*keys: str, buckets: int | None = None) -> Keep:
    """A :func:`hold` whose table is bucketed by ``keys``.

    Joins and aggregates on the keys then read it as it lies, without an
    exchange; worth it for a table that several of them read. The rows are dealt to
    buckets before the write, so there is one file a bucket. By default there are
    as many buckets as shuffle partitions, which is what the other side of a
    join is dealt into. A bucketed table needs a name: the session's catalog knows it
    by a random one, and its files lie in the shared folder.
    """
    def keep(df: DataFrame) -> DataFrame:
        spark = df.sparkSession
        n = buckets or int(
            spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
            or spark.conf.get("spark.sql.shuffle.partitions"))
        name = f"patronflow_{uuid.uuid4().hex}"
        (df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys)
         .option("path", shared_folder(spark)).saveAsTable(name))
        return spark.table(name)
    return keep


def lazily(df: DataFrame) -> DataFrame:
    """Keep nothing: each read recomputes (Spark still reuses exchanges)."""
    return df
