"""Recency, frequency and monetary scoring."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bin_index, days_between, equal_width_bin, recode, strict_max, strict_min
from ..functions.dates import day_of
from ..operators.codes import text_codes
from ..operators.joins import left_join
from ..operators.quantiles import exact_quantiles
from ..operators.reuse import Keep, hold
from ..operators.totals import Totals, watched

# Quantiles that bound the five ranks of each measure.
PROBS = {
    "recency": (0, 0.1, 0.2, 0.3, 0.5, 1),
    "frequency": (0, 0.55, 0.7, 0.85, 0.95, 1),
    "amount": (0, 0.3, 0.5, 0.7, 0.9, 1),
}
# Points per rank, i.e. 20 x weight (0.4, 0.3, 0.3).
POINTS = {"recency": 8, "frequency": 6, "amount": 6}
# Customer classes by equal-width bin of the score.
CLASSES = {1: "Churned", 2: "Dormant", 3: "Prospective", 4: "Active", 5: "Loyal"}


def rfm_base(facts: DataFrame, as_of: date, totals: Totals | None = None) -> DataFrame:
    """Per customer: days since the last order, orders, mean gross amount.

    Counts valid orders with a known gross amount. The recency is unknown if one
    of them has no date.
    """
    orders = facts.where((F.col("is_valid") == 1)
                         & F.col("gross_before_discount").isNotNull())
    orders = watched(totals, orders, "priced_orders", orders=F.sum("is_valid"))
    per_customer = orders.groupBy("customer").agg(
        strict_max(day_of("created_at")).alias("last_order"),
        F.sum("is_valid").alias("frequency"),
        F.avg("gross_before_discount").alias("amount"))
    return per_customer.select(
        "customer", days_between(F.lit(as_of), "last_order").alias("recency"),
        "frequency", "amount")


def rfm_breaks(base: DataFrame) -> DataFrame:
    """One row: the six rank breaks of each measure as arrays."""
    return exact_quantiles(base, PROBS)


def rfm_rank(base: DataFrame) -> DataFrame:
    """Rank 1..5 of each measure; the most recent customers get 5."""
    breaks = rfm_breaks(base).select(F.struct(*PROBS).alias("breaks")).scalar()
    ranked = base.withColumn("breaks", breaks)
    bins = {m: bin_index(m, F.col(f"breaks.{m}"), 5) for m in PROBS}
    return ranked.select(
        "*", (6 - bins["recency"]).alias("rank_r"),
        bins["frequency"].alias("rank_f"),
        bins["amount"].alias("rank_m")).drop("breaks")


def rfm_points(base: DataFrame) -> DataFrame:
    """Weighted points per rank and their sum (all integers)."""
    return rfm_rank(base).withColumns({
        "recency_points": F.col("rank_r") * POINTS["recency"],
        "frequency_points": F.col("rank_f") * POINTS["frequency"],
        "monetary_points": F.col("rank_m") * POINTS["amount"],
    }).withColumn("score", F.col("recency_points") + F.col("frequency_points")
                  + F.col("monetary_points"))


def rfm_class(base: DataFrame) -> DataFrame:
    """Class 1..5 by equal-width bins of the score, and its name."""
    scored = rfm_points(base)
    span = scored.agg(F.struct(F.min("score").alias("low"),
                               F.max("score").alias("high")).alias("span")).scalar()
    return (scored.withColumn("span", span)
            .withColumn("rfm_class",
                        equal_width_bin("score", "span.low", "span.high", 5))
            .drop("span")
            .withColumn("class_name", recode("rfm_class", CLASSES)))


def customer_city(order_rows: DataFrame, collate: str | None = None) -> DataFrame:
    """First location in text order over all orders of a customer.

    NULL as soon as one order has no location. The order is that of the bytes, or
    of a collation.
    """
    if collate:
        return order_rows.groupBy("customer").agg(
            strict_min("location", collate).alias("location"))
    codes = text_codes(order_rows, {"location": "location"})
    return order_rows.groupBy("customer").agg(codes.strict_min("location").alias("location"))


def rfm_report(facts: DataFrame, order_rows: DataFrame, as_of: date,
               ordered: bool = False, keep: Keep = hold,
               totals: Totals | None = None) -> DataFrame:
    """Scores, class and city per customer.

    ``order_rows`` needs only customer and location: passing the plain order
    rows keeps invoices and rates out of the city lookup. ``ordered`` sorts by
    falling score (a range-partitioned global sort). ``keep`` stores the
    per-customer measures, which the breaks and the scoring both read. With
    ``totals`` the orders of all customers have to be those that went in, and
    the report has to show each measured customer once.
    """
    base = watched(totals, rfm_base(facts, as_of, totals), "rfm_base",
                   orders=F.sum("frequency"), customers=F.count(F.lit(1)))
    report = left_join(rfm_class(keep(base)), customer_city(order_rows), "customer")
    if ordered:
        report = report.orderBy(F.desc("score"), "customer")
    if totals is not None:
        totals.agree("priced_orders.orders", "rfm_base.orders")
        totals.agree("rfm_base.customers", "rfm_report.customers")
    return watched(totals, report, "rfm_report", customers=F.count(F.lit(1)))
