"""Missing-value rules.

The reports were defined on a system where aggregates return "missing" as soon
as one input is missing, where missing counts as a distinct value, and where a
conditional on a missing test is itself missing. Spark's defaults differ, so
each rule has one helper here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import ColumnLike, as_col


def _strict(agg: Column, column: Column) -> Column:
    return F.when(F.count(column) == F.count(F.lit(1)), agg)


def collated(column: ColumnLike, collate: str | None) -> Column:
    """A sort key: the text in the order of a collation, then of its bytes.

    Source systems sort texts by their locale (``a`` before ``B``, ``é`` next to
    ``e``); Spark's default is the order of the bytes, as with ``collate=None``.
    Names are Spark's: ``UNICODE``, ``de``, ``fr_CI`` and so on. Texts that a
    collation takes for equal keep the order of their bytes, so a pick among them
    does not depend on partitioning.
    """
    column = as_col(column)
    return column if collate is None else F.struct(
        F.collate(column, collate).alias("key"), column.alias("text"))


def _pick(pick, column: Column, collate: str | None) -> Column:
    if collate is None:
        return pick(column)
    return pick(F.when(column.isNotNull(), collated(column, collate)))["text"]


def strict_min(column: ColumnLike, collate: str | None = None) -> Column:
    """Aggregate: minimum, NULL if any input of the group is NULL; a text by the
    order of ``collate`` (see :func:`collated`)."""
    column = as_col(column)
    return _strict(_pick(F.min, column, collate), column)


def strict_max(column: ColumnLike, collate: str | None = None) -> Column:
    """Aggregate: maximum, NULL if any input of the group is NULL; a text by the
    order of ``collate`` (see :func:`collated`)."""
    column = as_col(column)
    return _strict(_pick(F.max, column, collate), column)


def strict_sum(column: ColumnLike) -> Column:
    """Aggregate: sum, NULL if any input of the group is NULL."""
    column = as_col(column)
    return _strict(F.sum(column), column)


def count_distinct_na(column: ColumnLike) -> Column:
    """Aggregate: number of distinct values, NULL counting as one value."""
    column = as_col(column)
    has_null = F.coalesce(F.max(column.isNull().cast("int")), F.lit(0))
    return F.count_distinct(column) + has_null


def if_na(test: Column, yes: ColumnLike, no: ColumnLike, *, on: ColumnLike) -> Column:
    """``yes`` where the test holds, ``no`` where it fails, NULL if ``on`` is NULL."""
    return (F.when(as_col(on).isNull(), F.lit(None))
            .when(test, as_col(yes)).otherwise(as_col(no)))


def empty_fallback(column: ColumnLike, other: ColumnLike) -> Column:
    """``other`` where the text is empty; a NULL text stays NULL."""
    column = as_col(column)
    return if_na(F.length(column) == 0, other, column, on=column)


def fill_from(column: ColumnLike, *others: ColumnLike) -> Column:
    """First non-NULL of the column and its substitutes."""
    return F.coalesce(as_col(column), *[as_col(o) for o in others])
