"""Retention, revenue and orders-per-user cohorts.

All cohort reports share two compact tables:

* :func:`customer_days` sums the orders of a customer on a day (and city).
  The first order is then a window over at most one row per calendar day and
  city, so a customer with a huge number of orders never lands whole in one
  task; before that point, partial aggregation has already collapsed them.
* :func:`cohort_cells` counts users, orders and revenue per cohort cell.
  The rows are already partitioned by customer, so de-duplicating customers
  costs no shuffle, and only cells (months x months) are exchanged.

The initial counts stand in the same table as the returning ones; a window
over a cohort attaches them, in place of a second scan and a join.

``sets=True`` gives the cells by ``by`` and the overall ones in one table, told
apart by ``grouping_id``, from one scan and one pass over the customers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (month_label, month_of, month_offset, ratio,
                         round_half_even, strict_min, valid_only)
from ..functions.dates import day_of
from ..functions.states import COMPLETED
from ..operators.joins import left_join
from ..operators.reshape import pivot_wide

# First cohort shown per city in the orders-per-user report.
LAUNCH_MONTHS = {"de_berlin": date(2015, 1, 1), "fr_paris": date(2016, 5, 1)}


def first_order(rows: DataFrame, customer: str = "customer",
                at: str = "created_at") -> DataFrame:
    """(customer, first_order): earliest valid order, NULL-strict."""
    return (rows.where(valid_only("state")).groupBy(customer)
            .agg(strict_min(at).alias("first_order")))


def cohort_rows(rows: DataFrame, customer: str = "customer",
                grain: str = "day") -> DataFrame:
    """Completed orders with first order, cohort month, offset and status.

    Row-level form. ``grain`` is the precision of the returning test:
    ``"day"`` or ``"timestamp"``. Status is 1 for an order after the first
    one, else 0. The per-customer minimum is joined back, which adaptive
    execution splits for hot customers; a window would not be split.
    """
    if grain not in ("day", "timestamp"):
        raise ValueError("grain must be 'day' or 'timestamp'")
    firsts = first_order(rows, customer)
    completed = left_join(rows.where(F.col("state") == COMPLETED), firsts, customer)
    at, first = F.col("created_at"), F.col("first_order")
    later = at > first if grain == "timestamp" else day_of(at) > day_of(first)
    return completed.withColumns({
        "first_order": day_of(first),
        "initial_cohort": month_of(first),
        "since_first_order": month_offset(at, first),
        "status": F.when(later, 1).otherwise(0),
    })


def customer_days(rows: DataFrame, customer: str = "customer",
                  by: Sequence[str] = (), gross: str | None = None,
                  label: str | None = None) -> DataFrame:
    """Valid orders summed by customer, day and ``by``, with the first order.

    Columns: customer, day, ``by``, orders (completed), first_order, cohort,
    status, since_first_order; with ``gross`` the completed revenue and its
    missing values; with ``label`` the smallest label and its missing values.
    """
    done = F.col("state") == COMPLETED
    sums = [F.count_if(done).alias("orders")]
    if gross:
        sums += [F.sum(F.when(done, F.col(gross))).alias("gross"),
                 F.count_if(done & F.col(gross).isNull()).alias("gross_missing")]
    if label:
        sums += [F.min(F.when(done, F.col(label))).alias("label"),
                 F.count_if(done & F.col(label).isNull()).alias("label_missing")]
    days = (rows.where(valid_only("state"))
            .withColumn("day", day_of("created_at"))
            .groupBy(customer, "day", *by).agg(*sums))

    mine = Window.partitionBy(customer)
    first = F.when(F.count("day").over(mine) == F.count(F.lit(1)).over(mine),
                   F.min("day").over(mine))
    days = days.withColumn("first_order", first)
    later = F.col("day") > F.col("first_order")
    return days.where(F.col("orders") > 0).withColumns({
        "initial_cohort": month_of("first_order"),
        "status": F.when(later, 1).otherwise(0),
        "since_first_order": F.when(later, month_offset("day", "first_order")),
    })


def with_first_label(days: DataFrame, customer: str, name: str) -> DataFrame:
    """Attach the smallest label of a customer's initial completed orders.

    NULL if one of those orders has no label.
    """
    mine = Window.partitionBy(customer)
    initial = F.col("status") == 0
    missing = F.sum(F.when(initial, F.col("label_missing"))).over(mine)
    smallest = F.min(F.when(initial, F.col("label"))).over(mine)
    return days.withColumn(name, F.when(missing == 0, smallest))


#: ``grouping_id`` of the cells by city (or other ``by`` columns) and of all.
BY, OVERALL = 0, 1


def _with_overall(days: DataFrame, by: Sequence[str]) -> DataFrame:
    """Each row once with its ``by`` values and once without, under a grouping id.

    The rows of SQL's grouping sets. They are made by a generator, which keeps
    the partitioning by customer, where the built-in expansion would
    exchange all rows again.
    """
    level = lambda k, get: F.struct(F.lit(k).alias("grouping_id"), *[get(c).alias(c) for c in by])
    none = lambda c: F.lit(None).cast(days.schema[c].dataType)
    rest = [c for c in days.columns if c not in by]
    return days.select(*rest, F.inline(F.array(level(BY, F.col), level(OVERALL, none))))


def cohort_cells(days: DataFrame, customer: str = "customer", by: Sequence[str] = (),
                 gross: bool = False, sets: bool = False) -> DataFrame:
    """Users, orders and revenue per cohort, offset and ``by``.

    Initial cells have status 0 and no offset, returning cells status 1. With
    ``sets`` the overall cells follow under ``grouping_id`` 1, with NULL in the
    ``by`` columns; a customer of two cities counts once in them.
    """
    if sets:
        days, by = _with_overall(days, by), ["grouping_id", *by]
    cell = ["initial_cohort", "status", "since_first_order", *by]
    per_customer = [F.sum("orders").alias("orders")]
    totals = [F.count(F.lit(1)).alias("users"), F.sum("orders").alias("orders")]
    if gross:
        per_customer += [F.sum("gross").alias("gross"),
                         F.sum("gross_missing").alias("gross_missing")]
        totals.append(F.when(F.sum("gross_missing") == 0, F.sum("gross")).alias("revenue"))
    return (days.groupBy(customer, *cell).agg(*per_customer)
            .groupBy(*cell).agg(*totals))


def of_level(table: DataFrame, grouping_id: int) -> DataFrame:
    """The cells of one grouping of a table made with ``sets``."""
    return table.where(F.col("grouping_id") == grouping_id).drop("grouping_id")


def _against_initial(cells: DataFrame, measure: str, by: Sequence[str]) -> DataFrame:
    """Returning cells next to the initial cell of their cohort."""
    by = [c for c in ("grouping_id",) if c in cells.columns] + list(by)
    cohort = Window.partitionBy("initial_cohort", *by)
    initial = F.max(F.when(F.col("status") == 0, F.col(measure))).over(cohort)
    return (cells.withColumn("initial", initial).where(F.col("status") == 1)
            .select("initial_cohort", "since_first_order", *by,
                    F.col(measure).alias("returning"), "initial"))


def user_retention(rows: DataFrame, customer: str = "customer_id", by: Sequence[str] = (),
                   digits: int | None = 4, sets: bool = False) -> DataFrame:
    """Returning over initial distinct users, per cohort and month offset."""
    cells = cohort_cells(customer_days(rows, customer, by), customer, by, sets=sets)
    return _with_percent(_against_initial(cells, "users", by), digits)


def revenue_retention(rows: DataFrame, customer: str = "customer",
                      by: Sequence[str] = (), gross: str = "gross_before_discount",
                      digits: int | None = 4, sets: bool = False) -> DataFrame:
    """Returning over initial revenue, per cohort and month offset.

    Revenue of a cell with an unknown amount is unknown. By-city reports drop
    rows with a missing value: apply ``na.drop`` as :func:`city_rows` does.
    """
    cells = cohort_cells(customer_days(rows, customer, by, gross=gross),
                         customer, by, gross=True, sets=sets)
    return _with_percent(_against_initial(cells, "revenue", by), digits)


def orders_per_user(rows: DataFrame, customer: str = "customer", by: Sequence[str] = (),
                    digits: int | None = 2, sets: bool = False) -> DataFrame:
    """Orders per returning user, per cohort and month offset."""
    cells = cohort_cells(customer_days(rows, customer, by), customer, by, sets=sets)
    by = [c for c in ("grouping_id",) if sets] + list(by)
    per_user = round_half_even(ratio("orders", "users"), digits)
    return (cells.where(F.col("status") == 1)
            .select("initial_cohort", "since_first_order", *by, "orders",
                    F.col("users").alias("customers"), per_user.alias("proportion")))


def label_cohorts(rows: DataFrame, label: str, name: str,
                  customer: str = "customer_id", by: Sequence[str] = ()) -> DataFrame:
    """Returning users per cohort, offset, first label and ``by``.

    The first label is that of the customer's initial completed orders;
    ``cohort`` is the number of initial users, 0 if there were none.
    """
    days = with_first_label(customer_days(rows, customer, by, label=label),
                            customer, name)
    keys = [name, *by]
    table = _against_initial(cohort_cells(days, customer, keys), "users", keys)
    return table.select("initial_cohort", "since_first_order", *keys, "returning",
                        F.coalesce("initial", F.lit(0)).alias("cohort"))


def _with_percent(table: DataFrame, digits: int | None) -> DataFrame:
    return table.withColumn(
        "percent", round_half_even(ratio("returning", "initial"), digits))


def city_rows(table: DataFrame, city: str = "location",
              floors: Mapping[str, date] | None = None) -> DataFrame:
    """By-city cells as the city reports show them.

    Drops cells with any missing value, and cohorts before a city's launch.
    """
    table = table.na.drop("any")
    for name, floor in (floors or {}).items():
        table = table.where((F.col(city) != name)
                            | (F.col("initial_cohort") >= F.lit(floor)))
    return table


def cohort_matrix(table: DataFrame, value: str, by: Sequence[str] = (),
                  offsets: Sequence[int] | None = None, labels: bool = False,
                  prefix: str = "m") -> DataFrame:
    """Cohort by offset matrix; ``by`` columns become further row keys.

    One pivot serves all cities. ``offsets`` fixes the columns; without it there
    is one per offset present, read from the stored cells.
    ``labels`` turns cohorts into ``Mon YYYY`` text and sorts the rows.
    """
    wide = pivot_wide(table, ["initial_cohort", *by], "since_first_order", value,
                      offsets, prefix)
    if not labels:
        return wide
    return (wide.orderBy(*by, "initial_cohort")
            .withColumn("initial_cohort", month_label("initial_cohort")))


def heat_breaks(table: DataFrame, value: str = "percent") -> DataFrame:
    """One row with the eleven deciles of all matrix cells.

    There is a cell per pair of months at most, so ``percentile`` is safe.
    """
    deciles = F.array(*[F.lit(i / 10) for i in range(11)])
    return table.agg(F.percentile(value, deciles).alias("breaks"))


def heat_bucket(value: str, breaks: Column) -> Column:
    """Number of breaks below the value: the index of the cell's colour."""
    below = F.size(F.filter(breaks, lambda b: b < F.col(value)))
    return F.when(F.col(value).isNotNull(), below)
