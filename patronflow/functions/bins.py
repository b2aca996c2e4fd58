"""Interval lookup and recoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import ColumnLike, as_col


def bin_index(column: ColumnLike, breaks: Column, n_bins: int) -> Column:
    """1-based interval of a value among sorted ``breaks`` (an array column).

    Counts the breaks at or below the value and puts the maximum into the last
    bin. Repeated breaks therefore leave bins empty, which ``ntile`` or
    ``width_bucket`` would not do.
    """
    column = as_col(column)
    below = F.size(F.filter(breaks, lambda b: b <= column))
    return F.when(column.isNotNull(), F.least(below, F.lit(n_bins)))


def equal_width_bin(column: ColumnLike, low: ColumnLike, high: ColumnLike,
                    n_bins: int) -> Column:
    """Bin among ``n_bins + 1`` equally spaced breaks from low to high.

    The break comparison is written without division, so integer scores are
    binned exactly.
    """
    column, low, high = as_col(column), as_col(low), as_col(high)
    reached = sum(
        ((column - low) * n_bins >= (high - low) * i).cast("int")
        for i in range(n_bins + 1)
    )
    return F.when(column.isNotNull(), F.least(reached, F.lit(n_bins)))


def recode(column: ColumnLike, labels: dict) -> Column:
    """Code to label; codes without a label become NULL."""
    pairs = [F.lit(x) for kv in labels.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), as_col(column))
