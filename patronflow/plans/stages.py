"""Lifecycle stages and their month-to-month transitions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (days_between, ratio, start_of_month, start_of_previous_month,
                         strict_max, strict_min)
from ..functions._cols import ColumnLike, as_col
from ..functions.dates import day_of
from ..operators.aggregates import frequency_table, global_median
from ..operators.joins import left_join
from ..operators.reshape import crosstab
from ..operators.reuse import Keep, hold
from ..operators.totals import Totals, watched

# The four stages.
STAGES = ("Stage 1A", "Stage 1B", "Stage 2", "Stage 3")


def order_gap(first: ColumnLike, last: ColumnLike, orders: ColumnLike) -> Column:
    """Mean days between orders, NULL with a single order."""
    return ratio(days_between(last, first), as_col(orders) - 1)


def lifecycle_stage(orders: ColumnLike, since: ColumnLike, gap: ColumnLike) -> Column:
    """Stage by order count while the customer is still within its usual gap.

    Anything else, including an unknown gap, is the last stage.
    """
    orders = as_col(orders)
    active = as_col(since) < as_col(gap)
    return (F.when(active & (orders == 1), STAGES[0])
            .when(active & (orders == 2), STAGES[1])
            .when(active & (orders > 2), STAGES[2])
            .otherwise(STAGES[3]))


def stage_base(rows: DataFrame) -> DataFrame:
    """First, last and number of valid orders by customer, segment and city.

    A valid order without a date makes first, last and gap unknown.
    """
    return (rows.where(F.col("is_valid") == 1)
            .groupBy("customer", "segment", "location")
            .agg(strict_min(day_of("created_at")).alias("first_order"),
                 strict_max(day_of("created_at")).alias("last_order"),
                 F.sum("is_valid").alias("orders"))
            .withColumn("gap", order_gap("first_order", "last_order", "orders")))


def segment_gaps(base: DataFrame) -> DataFrame:
    """Mean gap of returning customers per known segment."""
    return (base.where((F.col("orders") > 1) & F.col("segment").isNotNull())
            .groupBy("segment").agg(F.avg("gap").alias("segment_gap")))


def impute_gaps(base: DataFrame) -> DataFrame:
    """Fill an unknown gap by the segment's mean, else by the global median."""
    median = global_median(base.where(F.col("orders") > 1), "gap")
    return (left_join(base, segment_gaps(base), "segment")
            .withColumn("filled_gap", F.coalesce("gap", "segment_gap", median)))


def stage_report(rows: DataFrame, as_of: date, keep: Keep = hold,
                 totals: Totals | None = None) -> DataFrame:
    """Stage and lifespan per customer, segment and city.

    ``keep`` stores the base, which the gap statistics and the report read.
    With ``totals`` the orders of the base have to be the valid orders.
    """
    rows = watched(totals, rows, "orders", valid=F.sum("is_valid"))
    base = watched(totals, stage_base(rows), "stage_base", orders=F.sum("orders"),
                   groups=F.count(F.lit(1)))
    if totals is not None:
        totals.agree("orders.valid", "stage_base.orders")
        totals.agree("stage_base.groups", "stage_report.groups")
    filled = watched(totals, impute_gaps(keep(base)), "stage_report", groups=F.count(F.lit(1)))
    since = days_between(F.lit(as_of), "last_order")
    return filled.withColumns({
        "since_last_order": since,
        "stage": lifecycle_stage("orders", since, "filled_gap"),
        "lifespan": days_between("last_order", "first_order"),
    })


def stage_distribution(report: DataFrame) -> DataFrame:
    return frequency_table(report, "stage")


def transition_report(rows: DataFrame, as_of: date, keep: Keep = hold) -> DataFrame:
    """Stage of each customer at the start of the last and of this month.

    One aggregation with conditional sums by cut-off. An order on a cut-off
    day belongs to the earlier slice, one without a date to none. Customers whose first valid order came
    after the earlier cut-off are left out. A single-order gap is filled with
    the median of the earlier slice at both cut-offs. The location is that of
    the first order, valid or not.

    The per-customer table is read twice, for the median and for the report;
    ``keep`` stores it in between, so the orders are scanned once.
    """
    now = F.lit(as_of)
    this_month, last_month = start_of_month(now), start_of_previous_month(now)
    valid = F.col("is_valid") == 1
    day = day_of("created_at")
    before = valid & (day <= last_month)
    after = valid & (day > last_month) & (day <= this_month)
    spans = (rows.groupBy("customer").agg(
        F.min(F.when(before, day)).alias("first_order"),
        F.max(F.when(before, day)).alias("last_before"),
        F.count_if(before).alias("orders_before"),
        F.min(F.when(after, day)).alias("first_after"),
        F.max(F.when(after, day)).alias("last_after"),
        F.count_if(after).alias("orders_after"),
        F.min_by("location", F.struct("created_at", "order")).alias("location"))
        .where(F.col("orders_before") > 0)
        .withColumn("gap_before", order_gap("first_order", "last_before", "orders_before")))
    spans = keep(spans)
    median = global_median(spans.where(F.col("orders_before") > 1), "gap_before")

    last = F.coalesce("last_after", "last_before")
    total = F.col("orders_before") + F.col("orders_after")
    since_before = days_between(last_month, "last_before")
    return spans.withColumn("median", median).select(
        "customer", "first_order", "last_before", "orders_before",
        F.coalesce("gap_before", "median").alias("gap_before"),
        since_before.alias("since_before"),
        lifecycle_stage("orders_before", since_before,
                        F.coalesce("gap_before", "median")).alias("former_stage"),
        "first_after", last.alias("last_after"), "orders_after",
        total.alias("orders"),
        days_between(this_month, last).alias("since_after"),
        F.coalesce(order_gap("first_order", last, total), "median").alias("gap_after"),
        "location",
    ).withColumn("new_stage", lifecycle_stage("orders", "since_after", "gap_after"))


def transition_matrix(report: DataFrame) -> DataFrame:
    """Former by new stage, long and dense: count, row percentage and labels."""
    table = crosstab(report, "former_stage", "new_stage", categories=STAGES)
    row_total = F.sum("n").over(Window.partitionBy("former_stage"))
    return table.withColumns({
        "row_percent": F.col("n") * 100 / row_total,
        "former_label": F.concat_ws("In", "former_stage", F.lit("Existing")),
        "new_label": F.concat_ws("In", "new_stage", F.lit("New")),
    })
