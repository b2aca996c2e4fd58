"""Equi-joins in which a missing key matches a missing key.

Physical strategy is left to Spark. A side under the auto-broadcast threshold
is broadcast. Otherwise both sides are exchanged on the key and sort-merged;
because each side gets its own exchange, adaptive execution can split a hot
key (a popular voucher code, orders without an invoice) over many tasks.
Nothing is hinted as broadcast here, as no size is known.

Null-safe equality costs an exchange even where a side is already partitioned
by its key, as a grouped table is. ``missing="lookup"`` avoids that: see
:func:`left_join`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Keys = str | Sequence[str] | Mapping[str, str]


def _pairs(on: Keys) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    if isinstance(on, Mapping):
        return list(on.items())
    return [(k, k) for k in on]


def _renamed(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]
             ) -> tuple[DataFrame, dict[str, str]]:
    """The right side with key names that the left side cannot have."""
    names = {r: f"__key_{i}" for i, (_, r) in enumerate(pairs)}
    clashes = set(left.columns) & (set(right.columns) - set(names))
    if clashes:
        raise ValueError(f"rename before joining: {sorted(clashes)}")
    return right.withColumnsRenamed(names), names


def _join(left: DataFrame, right: DataFrame, on: Keys, how: str) -> DataFrame:
    pairs = _pairs(on)
    right, names = _renamed(left, right, pairs)
    same = reduce(lambda a, b: a & b,
                  [F.col(l).eqNullSafe(F.col(names[r])) for l, r in pairs])
    joined = left.join(right, same, how)
    if how == "right":
        joined = joined.withColumns({l: F.col(names[r]) for l, r in pairs})
    return joined.drop(*names.values())


def _plain_join(left: DataFrame, right: DataFrame, on: Keys) -> DataFrame:
    pairs = _pairs(on)
    right, names = _renamed(left, right, pairs)
    same = reduce(lambda a, b: a & b, [F.col(l) == F.col(names[r]) for l, r in pairs])
    return left.join(right, same, "left").drop(*names.values())


def _spread_key(left: DataFrame, key: str, spread: Sequence[str]) -> Column:
    """The key; for a missing one some value of its type that follows the
    ``spread`` columns, so that such rows go to many tasks."""
    kind = left.schema[key].dataType
    place = F.xxhash64(*spread)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        place = F.pmod(place, F.lit(127))
    elif not isinstance(kind, (T.LongType, T.StringType)):
        raise ValueError(f"cannot spread missing keys of type {kind.simpleString()}")
    return F.coalesce(F.col(key), place.cast(kind))


def _lookup_join(left: DataFrame, right: DataFrame, on: Keys, spread: Sequence[str]) -> DataFrame:
    pairs = _pairs(on)
    if len(pairs) != 1:
        raise ValueError("missing='lookup' takes one key")
    right, names = _renamed(left, right, pairs)
    key, other = pairs[0][0], names[pairs[0][1]]
    values = [c for c in right.columns if c != other]
    alone = right.where(F.col(other).isNull()).agg(
        F.count(F.lit(1)).alias("n"), F.first(F.struct(*values)).alias("row"))
    row = alone.select(F.when(F.col("n") > 1, F.raise_error(F.lit(
        f"the right side has several rows without {pairs[0][1]}"))).otherwise(F.col("row"))
        .alias("row")).scalar()
    if spread:
        left = left.withColumn("__place", _spread_key(left, key, spread))
    place = F.col("__place") if spread else F.col(key)
    joined = left.join(right.where(F.col(other).isNotNull()), place == F.col(other), "left")
    missing = F.col(key).isNull()
    return joined.withColumn("__row", row).select(
        *[c for c in left.columns if c != "__place"],
        *[F.when(missing, F.col("__row")[c]).otherwise(F.col(c)).alias(c) for c in values])


def left_join(left: DataFrame, right: DataFrame, on: Keys, validate: str | None = None,
              missing: str = "match", spread: Sequence[str] = ()) -> DataFrame:
    """Left outer join in which a missing key matches a missing key; ``on`` may
    map left to right names.

    Repeated right keys multiply rows. ``validate="m:1"`` runs a check for
    them first (this is an action) and fails if it finds any.

    ``missing`` says how missing keys meet:

    * ``"match"``: null-safe equality. Both sides are exchanged, so a hot key,
      missing or not, can be split over tasks.
    * ``"lookup"``: rows without key are taken aside. All others are joined by
      plain equality, so a right side that is grouped by its key is not
      exchanged once more; its one row without key is looked up for the left rows
      without key (a second such row fails the query). ``spread`` names left columns
      that deal left rows without key to many tasks. Needs a single key; meant
      for right sides with one row per key. A hot key that is not missing
      stays in one task here.
    * ``"never"``: the right side has no missing key (document ids), so a left
      row without key finds nothing.
    """
    if validate == "m:1":
        keys = [r for _, r in _pairs(on)]
        if not duplicate_keys(right, keys).isEmpty():
            raise ValueError(f"right side repeats keys {keys}")
    elif validate is not None:
        raise ValueError("validate must be 'm:1' or None")
    if missing == "match":
        return _join(left, right, on, "left")
    if missing == "lookup":
        return _lookup_join(left, right, on, spread)
    if missing == "never":
        return _plain_join(left, right, on)
    raise ValueError("missing must be 'match', 'lookup' or 'never'")


def right_join(left: DataFrame, right: DataFrame, on: Keys) -> DataFrame:
    """Right outer join on null-safe keys; the key keeps the right value."""
    return _join(left, right, on, "right")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))
