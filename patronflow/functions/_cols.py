from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_col(column: ColumnLike) -> Column:
    return F.col(column) if isinstance(column, str) else column
