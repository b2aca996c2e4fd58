"""Grouped summaries. All combine on the map side before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._cols import ColumnLike, as_col
from .quantiles import exact_quantiles


def first_last(value: ColumnLike, order: Sequence[str]) -> tuple[Column, Column]:
    """Aggregates: the value on the first and on the last row by ``order``."""
    key = F.struct(*order)
    return F.min_by(as_col(value), key), F.max_by(as_col(value), key)


def first_by_key(df: DataFrame, keys: Sequence[str],
                 order: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order``; a NULL key is a key.

    An aggregate rather than ``row_number``, so the rows of a hot key are
    reduced before they are exchanged.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("first")
    return (df.groupBy(*keys).agg(first)
            .select(*keys, *[F.col("first")[c].alias(c) for c in rest])
            .select(*df.columns))


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def frequency_table(df: DataFrame, column: str) -> DataFrame:
    """Count and share per value; missing values are left out."""
    counts = (df.where(F.col(column).isNotNull())
              .groupBy(column).agg(F.count(F.lit(1)).alias("n")))
    # The total sums the counts, so it reuses their exchange: one scan.
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def global_median(df: DataFrame, column: str) -> Column:
    """Scalar subquery with the median of a column, NULL without values."""
    return (exact_quantiles(df, {column: [0.5]})
            .select(F.col(column)[0].alias("median")).scalar())


def median_by(df: DataFrame, column: str, by: Sequence[str],
              name: str = "median") -> DataFrame:
    return (exact_quantiles(df, {column: [0.5]}, by=by)
            .select(*by, F.col(column)[0].alias(name)))


def control_totals(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """One row of named totals over the whole table (a data-quality report)."""
    return df.agg(*[check.alias(name) for name, check in checks.items()])
