"""Order facts: orders with customer, invoice and exchange rate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import day_of, is_valid, ratio
from ..functions._cols import ColumnLike, as_col
from ..operators.joins import left_join

# The location billed in foreign currency, and that currency.
FOREIGN_LOCATION = "gb_london"
FOREIGN_CURRENCY = "GBP"

AMOUNTS = {
    "net_after_discount": "netTotal",
    "net_before_discount": "netTotalWithoutDiscounts",
    "gross_after_discount": "grossTotal",
    "gross_before_discount": "grossTotalWithoutDiscounts",
}


def convert_amount(amount: ColumnLike, location: ColumnLike, rate: ColumnLike,
                   foreign: str = FOREIGN_LOCATION) -> Column:
    """Amount in home currency: divided by the day's rate at the foreign location.

    NULL if the location is unknown, or if the rate of that day is missing.
    """
    amount, location = as_col(amount), as_col(location)
    return (F.when(location == foreign, ratio(amount, rate))
            .when(location.isNotNull(), amount))


def customer_dimension(customers: DataFrame) -> DataFrame:
    """(customer_id, customer, segment): document id, reference, segment."""
    return customers.select(
        F.col("_id").alias("customer_id"), F.col("reference").alias("customer"),
        F.col("internalData.segmentation").alias("segment"))


# Flat order columns and the (nested) document fields they come from.
ORDER_FIELDS = {
    "order_id": "_id", "order": "reference", "customer_id": "customer",
    "state": "state", "created_at": "createdAt",
    "location": "locationIdentifier", "invoice": "invoice",
    "voucher_code": "voucherCode", "user_agent": "createdBy.userAgent",
    "referrer_id": "referral.referrerId",
    "service_class": "chosenServiceClass.reference",
    "provider": "paymentData.provider",
}


def flat_orders(orders: DataFrame, *columns: str) -> DataFrame:
    """The named flat columns of the order documents, with ``is_valid``."""
    return orders.select(
        *[F.col(ORDER_FIELDS[c]).alias(c) for c in columns],
        is_valid("state").alias("is_valid"))


def order_rows(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with both customer identifiers and the segment, no amounts."""
    base = flat_orders(orders, "order_id", "order", "customer_id", "state",
                       "created_at", "location", "invoice")
    return left_join(base, customer_dimension(customers), "customer_id")


def daily_rates(rates: DataFrame, currency: str = FOREIGN_CURRENCY) -> DataFrame:
    """(rate_date, exchange_rate) of one currency."""
    return (rates.where(F.col("currency_code") == currency)
            .select(F.col("exchange_rate_date").alias("rate_date"),
                    F.col("exchange_rate_value").alias("exchange_rate")))


def order_facts(orders: DataFrame, customers: DataFrame, invoices: DataFrame,
                rates: DataFrame) -> DataFrame:
    """The base table of the reports: one row per order.

    Amounts are bound by name and converted to home currency. Customers,
    invoices and rates are looked up with left joins; orders without a match
    keep NULLs.
    """
    bills = invoices.select(F.col("_id").alias("invoice"),
                            *[F.col(f).alias(name) for name, f in AMOUNTS.items()])
    facts = left_join(order_rows(orders, customers), bills, "invoice")
    facts = left_join(facts.withColumn("rate_date", day_of("created_at")),
                      daily_rates(rates), "rate_date")
    return facts.withColumns({
        name: convert_amount(name, "location", "exchange_rate") for name in AMOUNTS
    })
