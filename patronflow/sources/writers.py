"""Sinks. Each writes a folder of part files, one task per partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_report(df: DataFrame, path: str, sep: str = ",",
                 mode: str = "overwrite") -> None:
    """Report table as headered CSV; missing values are written as ``NA``.

    Quotes inside a field are doubled, blanks at its ends are kept; a field with
    a line break is quoted and needs a reader with ``multi_line``.
    """
    (df.write.mode(mode)
     .options(header=True, sep=sep, nullValue="NA", quote='"', escape='"',
              ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
     .csv(path))


def save_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
               mode: str = "overwrite") -> DataFrame:
    """Persist a table for other reports and return it read back.

    The result starts from files in shared storage, so losing an executor does
    not cost the work that led to it.
    """
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
