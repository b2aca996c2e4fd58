"""Day and month arithmetic. Months are dates on the first of the month."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import ColumnLike, as_col


def day_of(column: ColumnLike, pattern: str | None = None) -> Column:
    """Timestamp or text to date; text that does not parse becomes NULL."""
    if pattern is None:
        return F.to_date(as_col(column))
    return F.try_to_date(as_col(column), pattern)


def month_of(column: ColumnLike) -> Column:
    return F.trunc(as_col(column), "month")


def month_offset(later: ColumnLike, earlier: ColumnLike) -> Column:
    """Whole calendar months between two dates, an exact integer."""
    later, earlier = as_col(later), as_col(earlier)
    return ((F.year(later) - F.year(earlier)) * 12
            + F.month(later) - F.month(earlier))


def days_between(later: ColumnLike, earlier: ColumnLike) -> Column:
    return F.datediff(as_col(later), as_col(earlier))


def start_of_month(column: ColumnLike) -> Column:
    return month_of(column)


def start_of_previous_month(column: ColumnLike) -> Column:
    return F.add_months(month_of(column), -1)


def format_day(column: ColumnLike, pattern: str = "yyyy-MM-dd") -> Column:
    """Date as text, NULL as the empty text."""
    return F.coalesce(F.date_format(as_col(column), pattern), F.lit(""))


def month_label(column: ColumnLike) -> Column:
    """``Mon YYYY`` label of a month."""
    return F.date_format(as_col(column), "MMM yyyy")
