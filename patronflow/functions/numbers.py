"""Ratios, rounding and tolerant numeric casts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._cols import ColumnLike, as_col


def ratio(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Division that gives NULL instead of failing on a zero denominator."""
    return F.try_divide(as_col(numerator), as_col(denominator))


def round_half_even(column: ColumnLike, digits: int | None) -> Column:
    """Round half to even; ``digits=None`` leaves the value unrounded."""
    column = as_col(column)
    return column if digits is None else F.bround(column, digits)


def cast_numeric(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Cast columns to double; booleans become 0/1, bad text becomes NULL."""
    types = dict(df.dtypes)
    casts = {}
    for name in columns:
        column = F.col(name)
        if types[name] == "boolean":
            column = column.cast("int")
        casts[name] = (column.try_cast("double") if types[name] == "string"
                       else column.cast("double"))
    return df.withColumns(casts)
