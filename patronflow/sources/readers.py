"""Scans. Column and predicate pushdown are Catalyst's job; these helpers only
make sure the fields and the filter are part of the plan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan(spark: SparkSession, path: str, fields: Sequence[str] | Mapping[str, str] | None = None,
         where: Column | str | None = None, fmt: str = "parquet",
         schema: str | None = None) -> DataFrame:
    """Read an exported collection (parquet, json, orc).

    ``fields`` are (nested) field names, or a mapping from output name to
    field. A nested field listed by name becomes its dotted path with
    underscores (``createdBy.userAgent`` -> ``createdBy_userAgent``).
    """
    reader = spark.read.format(fmt)
    if schema:
        reader = reader.schema(schema)
    df = reader.load(path)
    if where is not None:
        df = df.where(where)
    if fields is None:
        return df
    if not isinstance(fields, Mapping):
        fields = {f.replace(".", "_"): f for f in fields}
    return df.select(*[F.col(f).alias(name) for name, f in fields.items()])


def scan_delimited(spark: SparkSession, path: str, schema: str,
                   sep: str = ";", multi_line: bool = False) -> DataFrame:
    """Read a headered delimited extract with a fixed schema.

    The text ``NA`` is a missing value, as is a field left empty without
    quotes; a quoted empty field stays an empty text. Quotes inside a field are
    doubled and blanks at its ends are kept. A row that does not fit the schema
    fails the read. Fields with line breaks need ``multi_line``, which makes a
    file unsplittable.
    """
    return (spark.read.schema(schema)
            .options(sep=sep, header=True, nullValue="NA", quote='"', escape='"',
                     ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
                     multiLine=multi_line, mode="FAILFAST")
            .csv(path))


def load_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a table another report saved."""
    return spark.read.parquet(path)
