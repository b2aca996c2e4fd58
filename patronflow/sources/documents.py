"""Exported document collections: one JSON document a line."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RAW = "__line"
NOT_JSON, WRONG_TYPE = "not a JSON document", "a value of another type"


class Documents(NamedTuple):
    """The documents that fit a schema, and the lines that do not."""

    good: DataFrame
    #: ``line, reason``: nothing of a bad line reaches ``good``.
    bad: DataFrame

    def counts(self) -> DataFrame:
        """One row per reason with its number of lines; NULL: good documents."""
        return (self.good.select(F.lit(None).cast("string").alias("reason"))
                .unionByName(self.bad.select("reason"))
                .groupBy("reason").agg(F.count(F.lit(1)).alias("n")))


def scan_documents(spark: SparkSession, path: str, schema: str | T.StructType,
                   required: Sequence[str] = ()) -> Documents:
    """Read nested documents with a fixed schema.

    A line that is no JSON document, holds a value that its field cannot
    take, or lacks one of the ``required`` (dotted) fields is set apart with its reason: the
    reader's habit of turning such values into missing ones would be taken for
    data. Fields that a document leaves out are missing, fields that the
    schema does not name are not read. Empty lines are no documents. Both tables
    are lazy and read the files by themselves.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if _RAW in schema.names:
        raise ValueError(f"a field cannot be named {_RAW}")
    whole = T.StructType([*schema.fields, T.StructField(_RAW, T.StringType())])
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = F.from_json("value", whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _RAW})
    read = lines.select("value", parsed.alias("document"))
    broken = F.col("document").isNull() | F.col(f"document.{_RAW}").isNotNull()
    reason = F.when(broken, F.when(
        F.from_json("value", "map<string,string>", {"mode": "PERMISSIVE"}).isNull(),
        NOT_JSON).otherwise(WRONG_TYPE))
    for field in required:
        path_ = ".".join(f"`{part}`" for part in ("document", *field.split(".")))
        reason = F.coalesce(reason, F.when(F.col(path_).isNull(), f"no {field}"))
    judged = read.select("*", reason.alias("reason"))
    return Documents(
        judged.where("reason IS NULL").select(*[F.col(f"document.`{n}`") for n in schema.names]),
        judged.where("reason IS NOT NULL").select(F.col("value").alias("line"), "reason"))
