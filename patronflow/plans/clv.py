"""Simple customer lifetime value per month, city and first channel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import days_between, month_of, ratio
from ..operators.aggregates import global_median, median_by
from ..operators.joins import left_join
from ..operators.reuse import Keep, hold, hold_by
from ..operators.totals import Totals, watched
from .stages import STAGES

# Cities that take the global lifespan.
OVERRIDDEN = ("fr_paris",)
DAYS_PER_MONTH = 30


def customer_channels(customers: DataFrame, first_channel: DataFrame) -> DataFrame:
    """(customer, first_channel): channels moved to the customer reference.

    Channels are known by document id, which the customer documents map to the
    reference. One row per reference, the missing one included: where several
    documents share it, the channel is that of the smallest id.
    """
    named = left_join(customers.select(F.col("_id").alias("customer_id"),
                                       F.col("reference").alias("customer")),
                      first_channel, "customer_id", missing="never")
    return named.groupBy("customer").agg(
        F.min_by("first_channel", "customer_id").alias("first_channel"))


def customer_lifespan(stages: DataFrame, channels: DataFrame) -> DataFrame:
    """One row per customer over its (segment, city) stage rows.

    City, stage and first order come from the earliest row, the last order
    from the latest row, ordered by first order and city.
    """
    order = F.struct("first_order", "location")
    # Few rows per customer, so plain equality: the rows are exchanged once, for
    # the join and the aggregate, and a table bucketed by customer not at all.
    rows = left_join(stages.select("customer", "location", "orders", "stage",
                                   "first_order", "last_order"), channels, "customer",
                     missing="lookup")
    per_customer = rows.groupBy("customer").agg(
        F.min_by(F.struct("location", "stage", "first_channel", "first_order"), order)
        .alias("first"),
        F.sum("orders").alias("orders"),
        F.max_by("last_order", order).alias("last_order"))
    return per_customer.select("customer", "first.*", "orders", "last_order").withColumn(
        "lifespan", days_between("last_order", "first_order"))


def average_lifespan(lifespans: DataFrame) -> Column:
    """Scalar: median lifespan of customers with several orders."""
    return global_median(lifespans.where(F.col("orders") > 1), "lifespan")


def lifespan_by_city(lifespans: DataFrame) -> DataFrame:
    """Median lifespan of lapsed customers with several orders, by city."""
    lapsed = lifespans.where((F.col("orders") > 1) & (F.col("stage") == STAGES[3]))
    return median_by(lapsed, "lifespan", ["location"], name="lifespan")


def monthly_metrics(facts: DataFrame, channels: DataFrame,
                    totals: Totals | None = None) -> DataFrame:
    """Orders per user and order value by month, city and first channel.

    Facts are summed per customer, month and city before the channel is
    looked up, so that lookup is small even for a customer with very many
    orders. Order value divides all known gross amounts, valid or not, by the
    valid orders among them. Months without a valid order are left out. With
    ``totals`` the cells have to hold all valid orders.
    """
    facts = watched(totals, facts, "facts", valid=F.sum("is_valid"))
    priced = F.col("gross_before_discount").isNotNull()
    monthly = facts.groupBy("customer", month_of("created_at").alias("month"),
                            "location").agg(
        F.sum("is_valid").alias("orders"),
        F.sum("gross_before_discount").alias("gross"),
        F.sum(F.when(priced, F.col("is_valid"))).alias("priced_orders"))
    cell = ["month", "location", "first_channel"]
    per_customer = (left_join(monthly, channels, "customer", missing="lookup")
                    .groupBy("customer", *cell)
                    .agg(*[F.sum(c).alias(c) for c in ("orders", "gross", "priced_orders")]))
    cells = per_customer.groupBy(*cell).agg(
        F.count_if(F.col("orders") > 0).alias("customers"),
        *[F.sum(c).alias(c) for c in ("orders", "gross", "priced_orders")])
    if totals is not None:
        totals.agree("facts.valid", "monthly.orders")
    cells = watched(totals, cells, "monthly", orders=F.sum("orders"))
    return cells.where(F.col("customers") > 0).withColumns({
        "orders_per_user": ratio("orders", "customers"),
        "aov": ratio("gross", "priced_orders"),
    })


def clv_report(facts: DataFrame, customers: DataFrame, stages: DataFrame,
               first_channel: DataFrame, overridden: Sequence[str] = OVERRIDDEN,
               fill_text: str | None = "0", keep: Keep = hold,
               totals: Totals | None = None) -> DataFrame:
    """Order value x lifespan in months x orders per user.

    Missing values become 0, in text columns the text given by ``fill_text``
    (None keeps NULL). ``keep`` stores the two per-customer tables that are
    read more than once, the channels bucketed by customer: both joins that look
    a channel up read them without an exchange.
    """
    bucketed = hold_by("customer") if keep is hold else keep
    channels = bucketed(customer_channels(customers, first_channel))
    lifespans = keep(customer_lifespan(stages, channels))
    table = left_join(monthly_metrics(facts, channels, totals), lifespan_by_city(lifespans),
                      "location")
    overall = average_lifespan(lifespans)
    final = F.when(F.col("location").isin(*overridden), overall).otherwise(
        F.col("lifespan"))
    table = table.withColumn("final_lifespan", final).withColumn(
        "clv", F.col("aov") * F.col("final_lifespan") / DAYS_PER_MONTH
        * F.col("orders_per_user"))
    table = table.na.fill(0)
    return table if fill_text is None else table.na.fill(fill_text)
