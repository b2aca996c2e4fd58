"""Order-keeping codes for text columns of few values.

Spark aggregates by hash only while every aggregate buffer has a fixed width;
one text minimum makes the whole aggregation sort its input rows. A code, the
place of a value in the sorted list of all values, is a number that compares as
the text does, so picks over codes stay in the hash aggregate.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions._cols import ColumnLike, as_col

#: Longest list of values; a column with more keeps its texts.
MOST_VALUES = 256


class TextCodes:
    """Sorted values of named text columns; aggregates that pick among them.

    A column without a list is aggregated as text: the same result from a
    sorting aggregate.
    """

    def __init__(self, columns: Mapping[str, Column], values: Mapping[str, list[str] | None]):
        self.columns, self.values = dict(columns), dict(values)

    def __or__(self, other: TextCodes) -> TextCodes:
        return TextCodes(self.columns | other.columns, self.values | other.values)

    def over(self, names: Iterable[str]) -> TextCodes:
        """The same values for columns of these names."""
        return TextCodes({n: F.col(n) for n in names}, {n: self.values[n] for n in names})

    def _list(self, name: str) -> Column:
        return F.array(*[F.lit(v) for v in self.values[name]]).cast("array<string>")

    def code(self, name: str) -> Column:
        """The text's place from 1; NULL for NULL. An unlisted text fails the query."""
        text = self.columns[name]
        if self.values[name] is None:
            return text
        place = F.array_position(self._list(name), text)
        return F.when(place == 0, F.raise_error(
            F.concat(F.lit(f"{name} has a value that was not there before: "), text))
            .cast("bigint")).otherwise(place)

    def text(self, name: str, code: Column) -> Column:
        if self.values[name] is None:
            return code
        return F.get(self._list(name), (code - 1).cast("int"))

    def _strict(self, name: str, pick) -> Column:
        code = self.code(name)
        return F.when(F.count(code) == F.count(F.lit(1)), self.text(name, pick(code)))

    def strict_min(self, name: str) -> Column:
        """Aggregate: smallest text, NULL if any of the group is NULL."""
        return self._strict(name, F.min)

    def strict_max(self, name: str) -> Column:
        """Aggregate: greatest text, NULL if any of the group is NULL."""
        return self._strict(name, F.max)

    def first_by(self, name: str, key: Column) -> Column:
        """Aggregate: the text of the row with the smallest key."""
        return self.text(name, F.min_by(self.code(name), key))


def text_codes(df: DataFrame, columns: Mapping[str, ColumnLike],
               most: int = MOST_VALUES) -> TextCodes:
    """Codes for the named columns or expressions of a table.

    Reads the columns once (an action) and brings at most ``most`` values of
    each to the driver; a column with more keeps its texts. Texts compare by
    their bytes, as Spark compares them.
    """
    columns = {name: as_col(c) for name, c in columns.items()}
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("name"), c.cast("string").alias("value"))
        for name, c in columns.items()])).alias("pair")).select("pair.*").dropna().distinct()
    place = F.row_number().over(Window.partitionBy("name").orderBy("value"))
    found = pairs.withColumn("place", place).where(F.col("place") <= most + 1).collect()
    values: dict[str, list[str] | None] = {name: [] for name in columns}
    for row in found:
        values[row["name"]].append(row["value"])
    return TextCodes(columns, {
        name: None if len(texts) > most else sorted(texts, key=str.encode)
        for name, texts in values.items()})


def packed_order(df: DataFrame, at: str, then: str) -> Column:
    """A sort key by a time and then a whole number, as one fixed-width number.

    Missing values come first, as in a struct of the two columns, which is
    returned where ``then`` is no whole number (it makes the aggregate sort).
    """
    if not isinstance(df.schema[then].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.struct(at, then)
    whole = lambda x: F.lit(str(x)).cast("decimal(20,0)")
    micros = F.coalesce(F.unix_micros(F.col(at).cast("timestamp")), F.lit(-4 * 10 ** 18))
    number = F.coalesce(F.col(then).cast("decimal(20,0)") + whole(1 << 63), whole(-1))
    return (micros.cast("decimal(19,0)") * whole(2 * 10 ** 19) + number).cast("decimal(38,0)")
