"""Long and wide forms, nested columns and missing-value fills."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .reuse import Keep, hold


def flatten_structs(df: DataFrame, separator: str = "_") -> DataFrame:
    """Nested records to top-level columns, at any depth."""
    def leaves(struct: T.StructType, path: tuple[str, ...]):
        for field in struct.fields:
            here = path + (field.name,)
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, here)
            else:
                source = ".".join(f"`{part}`" for part in here)
                yield F.col(source).alias(separator.join(here))
    return df.select(*leaves(df.schema, ()))


def values_of(df: DataFrame, column: str, most: int) -> list:
    """The distinct values of a column in order, missing ones apart (an action).

    They become columns or cells, so more than ``most`` of them are refused.
    """
    found = [r[0] for r in df.select(column).dropna().distinct().take(most + 1)]
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values")
    return sorted(found)


def pivot_wide(df: DataFrame, index: Sequence[str], column: str, value: str,
               values: Sequence | None = None, prefix: str = "", keep: Keep = hold) -> DataFrame:
    """Long to wide, one column per value of ``column``, in order of the values.

    With ``values`` the columns are fixed and no extra job runs; a row with
    another value fails the query, nothing is dropped. Without, the cells are
    stored once by ``keep``, the values present are read from them (more than
    ``spark.sql.pivotMaxValues`` are refused), and the stored cells are
    spread: the plan below runs once. Rows without a value of ``column`` keep
    their index. Each cell holds at most one row.
    """
    if values is None:
        df = keep(df.select(*index, column, value))
        values = values_of(df, column, int(df.sparkSession.conf.get("spark.sql.pivotMaxValues")))
    else:
        known = F.col(column).isNull() | F.col(column).isin(list(values))
        other = F.raise_error(F.concat(F.lit(f"{column} has a value without a column: "),
                                       F.col(column).cast("string")))
        df = df.withColumn(column, F.when(known, F.col(column)).otherwise(other))
    if not values:
        return df.select(*index).distinct()
    wide = df.groupBy(*index).pivot(column, list(values)).agg(F.first(value))
    return wide.withColumnsRenamed({c: f"{prefix}{c}" for c in wide.columns
                                    if c not in index})


def pivot_flags(df: DataFrame, index: Sequence[str], column: str,
                labels: Mapping[str, str]) -> DataFrame:
    """Categories to 0/1 columns; ``labels`` maps a category to its column."""
    return df.groupBy(*index).agg(*[
        F.max(F.when(F.col(column) == value, 1).otherwise(0)).alias(name)
        for value, name in labels.items()
    ])


def melt_pairs(df: DataFrame, ids: Sequence[str],
               pairs: Sequence[tuple[str | Column, str | Column]],
               names: tuple[str, str] = ("channel", "weight"),
               position: str | None = None) -> DataFrame:
    """Several (key, value) column pairs to one row each, in one pass."""
    as_struct = [
        F.struct(*([F.lit(i).alias(position)] if position else []),
                 _col(k).alias(names[0]), _col(v).alias(names[1]))
        for i, (k, v) in enumerate(pairs, start=1)
    ]
    return df.select(*ids, F.inline(F.array(*as_struct)))


def pair_counts(df: DataFrame, rows: str, columns: str) -> DataFrame:
    """Counts of two categories as (rows, columns, n), present pairs only.

    Rows missing either category are left out. The sparse form: its size
    follows the pairs that occur, whatever the number of categories.
    """
    return (df.where(F.col(rows).isNotNull() & F.col(columns).isNotNull())
            .groupBy(rows, columns).agg(F.count(F.lit(1)).alias("n")))


def crosstab(df: DataFrame, rows: str, columns: str, categories: Sequence | None = None,
             most: int = 1000, keep: Keep = hold) -> DataFrame:
    """Dense counts of two categories as (rows, columns, n).

    Every combination of observed values appears, absent ones with 0. Rows
    missing either category are left out.

    ``categories`` are the values that the column category may have: the table
    is then one aggregate with a conditional count for each, and a value
    outside them fails the query. Without, the present pairs are stored by ``keep`` and the
    categories read from them; more than ``most`` are refused, as a dense table
    would be too large (:func:`pair_counts` is the sparse form).
    """
    fixed = categories is not None
    if not fixed:
        cells = keep(pair_counts(df, rows, columns))
        categories = values_of(cells, columns, most)
        counts = [F.coalesce(F.sum(F.when(F.col(columns) == c, F.col("n"))), F.lit(0))
                  for c in categories]
    else:
        known = F.col(columns).isin(list(categories))
        cells = df.where(F.col(rows).isNotNull() & F.col(columns).isNotNull()).withColumn(
            columns, F.when(known, F.col(columns)).otherwise(F.raise_error(F.concat(
                F.lit(f"{columns} has another value: "), F.col(columns).cast("string")))))
        counts = [F.count_if(F.col(columns) == c) for c in categories]
    if not categories:
        return cells.select(rows, columns, F.lit(0).cast("bigint").alias("n")).limit(0)
    names = [f"__count_{k}" for k in range(len(categories))]
    table = cells.groupBy(rows).agg(*[c.alias(name) for c, name in zip(counts, names)])
    kind = df.schema[columns].dataType
    dense = melt_pairs(table, [rows], [(F.lit(c).cast(kind), name)
                                       for c, name in zip(categories, names)], (columns, "n"))
    if not fixed:
        return dense
    # A known category that no row has is no part of the observed table. The
    # totals sum the counts, so they reuse their exchange.
    totals = table.agg(F.array(*[F.sum(name) for name in names]).alias("n")).scalar()
    place = F.array_position(F.array(*[F.lit(c).cast(kind) for c in categories]), F.col(columns))
    return dense.where(F.get(totals, (place - 1).cast("int")) > 0)


def explode_array(df: DataFrame, array: str, name: str) -> DataFrame:
    """One row per list element; an empty or missing list keeps one NULL row."""
    return df.withColumn(name, F.explode_outer(array)).drop(array)


def explode_named(df: DataFrame, mapping: str, ids: Sequence[str],
                  names: tuple[str, str] = ("name", "value")) -> DataFrame:
    """One row per entry of a named list; an empty one gives no row."""
    return df.select(*ids, F.explode(mapping).alias(*names))


def concat_by_group(value: str, order: str, separator: str = "") -> Column:
    """Aggregate: text values of a group joined in a fixed order.

    Meant for the few values one key repeats (address lines, topics).
    """
    ordered = F.array_sort(F.collect_list(F.struct(order, value)))
    return F.array_join(ordered.getField(value), separator)


def fill_na(df: DataFrame, number: float = 0, text: str | None = None,
            columns: Sequence[str] | None = None) -> DataFrame:
    """Missing numbers (and, if asked, texts) to constants."""
    df = df.na.fill(number, subset=columns)
    return df if text is None else df.na.fill(text, subset=columns)


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
