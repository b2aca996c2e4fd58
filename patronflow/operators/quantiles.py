"""Exact quantiles of a distributed column.

The built-in ``percentile`` is exact but gathers every distinct value in one
task; ``percentile_approx`` scales but does not interpolate. This operator is
exact *and* distributed:

1. count each distinct value (partial aggregation first, so a value shared by
   a third of the rows is a single row afterwards);
2. cut the distinct values into ``fan_out`` ranges with a bounded sketch;
3. count each range, and keep only the ranges that hold a wanted rank;
4. rank the values of those ranges, which are about ``1 / fan_out`` of all.

The cut points only balance the work: whatever they are, ranges are disjoint
and ordered, so the ranks found are exact.

Where a stated accuracy will do, :func:`sketch_quantiles` needs one aggregation
and nothing but a bounded, mergeable sketch per group crosses the network.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import left_join


def exact_quantiles(df: DataFrame, probs: Mapping[str, Sequence[float]],
                    by: Sequence[str] = (), fan_out: int = 256) -> DataFrame:
    """Quantiles with linear interpolation between order statistics.

    ``probs`` maps a numeric column to its probabilities. The result has one
    array column per entry and one row per ``by`` group (one row if there is
    none). NULL values are left out, as is a group without any value.
    """
    by = list(by)
    clashes = {"series", "value", "n", "positions", "range", "i"} & set(by)
    if clashes:
        raise ValueError(f"rename the grouping columns {sorted(clashes)}")
    series = F.explode(F.array(*[
        F.struct(F.lit(name).alias("series"),
                 F.col(name).cast("double").alias("value"))
        for name in probs
    ])).alias("s")
    keys = by + ["series"]
    counts = (df.select(*by, series).select(*by, "s.series", "s.value")
              .where(F.col("value").isNotNull())
              .groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n")))

    grid = ", ".join(f"{i / fan_out}d" for i in range(1, fan_out))
    wanted_probs = F.lit(None)
    for name, ps in probs.items():
        listed = F.expr("array(" + ", ".join(f"{float(p)}d" for p in ps) + ")")
        wanted_probs = F.when(F.col("series") == name, listed).otherwise(wanted_probs)
    # Positions among the sorted values, counted from 0; a fractional position
    # lies between two neighbours.
    cuts = counts.groupBy(*keys).agg(
        F.expr(f"percentile_approx(value, array({grid}))").alias("cuts"),
        F.sum("n").alias("total"),
    ).select(*keys, "cuts", F.transform(
        wanted_probs, lambda p: p * (F.col("total") - 1)).alias("positions"))
    if not by:
        cuts = F.broadcast(cuts)  # one row per entry of ``probs``
    ranged = left_join(counts, cuts, keys).select(
        *keys, "value", "n", "positions",
        F.size(F.filter("cuts", lambda c: c < F.col("value"))).alias("range"))

    before = (Window.partitionBy(*keys).orderBy("range")
              .rowsBetween(Window.unboundedPreceding, -1))
    wanted = (ranged.groupBy(*keys, "range")
              .agg(F.sum("n").alias("size"), F.max("positions").alias("positions"))
              .withColumn("low", F.coalesce(F.sum("size").over(before), F.lit(0)))
              .withColumn("high", F.col("low") + F.col("size"))
              .where(f"exists(positions, at -> {_holds('floor(at)')} OR {_holds('ceil(at)')})")
              .select(*keys, "range", F.col("low").alias("start")))
    if not by:
        wanted = F.broadcast(wanted)  # at most two rows per probability

    within = (Window.partitionBy(*keys, "range").orderBy("value")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = (left_join(ranged, wanted, keys + ["range"])
              .where(F.col("start").isNotNull())
              .withColumn("high", F.col("start") + F.sum("n").over(within))
              .withColumn("low", F.col("high") - F.col("n")))
    neighbours = F.expr(
        "filter(transform(positions, (at, i) -> struct(i, at - floor(at) AS part, "
        f"CASE WHEN {_holds('floor(at)')} THEN value END AS lower, "
        f"CASE WHEN {_holds('ceil(at)')} THEN value END AS upper)), "
        "hit -> hit.lower IS NOT NULL OR hit.upper IS NOT NULL)")
    found = ranked.select(*keys, F.inline(neighbours))
    # Two rows per probability and group are left.
    hits = found.groupBy(*by).agg(*[
        F.collect_list(F.when(F.col("series") == name,
                              F.struct("i", "part", "lower", "upper"))).alias(name)
        for name in probs])
    return hits.select(*by, *[
        _interpolated(f"`{name}`", len(ps)).alias(name) for name, ps in probs.items()])


def _holds(rank: str) -> str:
    return f"({rank} >= low AND {rank} < high)"


def _interpolated(hits: str, n_probs: int) -> Column:
    lower, upper, part = (
        f"array_max(transform(filter({hits}, hit -> hit.i = k), hit -> hit.{field}))"
        for field in ("lower", "upper", "part"))
    return F.expr(
        f"CASE WHEN size({hits}) > 0 THEN transform(sequence(0, {n_probs - 1}), "
        f"k -> {lower} + ({upper} - {lower}) * {part}) END")


def sketch_size(accuracy: float) -> int:
    """Size ``k`` of a KLL sketch whose rank error stays below ``accuracy`` (a share
    of the rows) with 99% confidence: the error is 2.296 / k ** 0.9723."""
    if accuracy < 5e-5:
        raise ValueError("the accuracy has to be 5e-5 at least; use exact_quantiles")
    return max(8, math.ceil((2.296 / accuracy) ** (1 / 0.9723)))


def sketch_quantiles(df: DataFrame, probs: Mapping[str, Sequence[float]], by: Sequence[str] = (),
                     accuracy: float = 0.001) -> DataFrame:
    """Quantiles whose ranks are off by at most a share ``accuracy`` of the group.

    Takes and returns what :func:`exact_quantiles` does, interpolating between
    two order statistics. Four fifths of the accuracy are the sketch's (with
    99% confidence a quantile), the rest is that of the grid of ranks at which it
    is read; a group of fewer values than either has is exact. The grid has
    2.5 / ``accuracy`` values, held per group while its quantiles are taken.
    """
    by, k, steps = list(by), sketch_size(0.8 * accuracy), math.ceil(2.5 / accuracy)
    numbers = {name: F.col(name).cast("double") for name in probs}
    found = df.groupBy(*by).agg(*[
        F.struct(F.kll_sketch_agg_double(column, F.lit(k)).alias("sketch"),
                 F.count(column).alias("n")).alias(name) for name, column in numbers.items()])
    ranks = F.split(F.lit(",".join(repr(i / steps) for i in range(steps + 1))), ",").cast("array<double>")
    read = found.select(*by, *[
        F.when(F.col(f"`{name}`.n") > 0, F.struct(
            F.kll_sketch_get_quantile_double(F.col(f"`{name}`.sketch"), ranks).alias("grid"),
            F.col(f"`{name}`.n").alias("n"))).alias(name) for name in probs])

    def at(name: str, rank: Column) -> Column:
        # The grid's rank next to the middle of the order statistic's own share.
        share = (rank + 0.5) / F.col(f"`{name}`.n")
        return F.get(F.col(f"`{name}`.grid"), F.round(share * steps).cast("int"))

    def quantile(name: str, p: float) -> Column:
        place = F.lit(float(p)) * (F.col(f"`{name}`.n") - 1)
        low, high = at(name, F.floor(place)), at(name, F.ceil(place))
        return low + (high - low) * (place - F.floor(place))

    return read.select(*by, *[
        F.when(F.col(name).isNotNull(), F.array(*[quantile(name, p) for p in ps])).alias(name)
        for name, ps in probs.items()])
