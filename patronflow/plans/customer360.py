"""One wide row per customer."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (cast_numeric, days_between, device_class, first_name, fold_ascii,
                         format_day, is_canceled, is_open, ratio, round_half_even,
                         split_pick, strict_max)
from ..functions._cols import ColumnLike, as_col
from ..functions.dates import day_of
from ..operators.aggregates import first_last
from ..operators.codes import TextCodes, packed_order, text_codes
from ..operators.joins import left_join
from .facts import flat_orders

# Service-class tokens and the columns that count them.
SERVICE_CLASSES = {"CLASSIC": "classic", "EXPRESS": "express", "LITE": "lite",
                   "PERSIL": "persil", "PLUS": "plus"}
# Rated topics and their columns.
TOPICS = {"Punctuality": "punctuality", "CleaningQ": "cleaning", "DamagedI": "damaged",
          "DriverB": "driver", "IroningQ": "ironing", "MissingI": "missing"}
# Topics that reach the customer row.
CUSTOMER_TOPICS = ("punctuality", "cleaning", "ironing")
# Fixed value: prefix of the mailing key.
SUBSCRIBER_PREFIX = "ZJ"

NUMERIC = (
    "days_since_first_order", "individual_frequency", "overtime", "open_orders",
    "canceled_orders", "valid_orders", "vouchers_used", *SERVICE_CLASSES.values(),
    "no_class", "total_orders", "rating", "punctuality", "ironing", "cleaning",
    "newsletter_subscribed", "branch_credits", "recency", "frequency", "amount",
    "rank_r", "recency_points", "rank_f", "frequency_points", "rank_m",
    "monetary_points", "score", "rfm_class",
)


def _first_address(field: str) -> Column:
    return F.get("addresses", F.lit(0))[field]


def customer_address(customers: DataFrame) -> DataFrame:
    """(customer_id, address_line, zip) of the first address on file.

    With several addresses the reports also take the first one, even if a
    field of it is empty; without any address both are NULL.
    """
    return customers.select(F.col("_id").alias("customer_id"),
                            _first_address("addressLine").alias("address_line"),
                            _first_address("zip").alias("zip"))


def service_class(reference: ColumnLike) -> Column:
    return split_pick(reference, "-", 1)


def _class_counts(valid: Column) -> list[Column]:
    token = service_class("service_class")
    return [F.count_if(valid & (token == value)).alias(name)
            for value, name in SERVICE_CLASSES.items()]


def _no_class() -> Column:
    known = sum(F.col(name) for name in SERVICE_CLASSES.values())
    return F.col("valid_orders") - known


def service_class_counts(orders: DataFrame) -> DataFrame:
    """Valid orders per service class and customer; order references unique."""
    rows = flat_orders(orders, "customer_id", "state", "service_class")
    valid = F.col("is_valid") == 1
    return (rows.where(valid).groupBy("customer_id")
            .agg(F.count(F.lit(1)).alias("valid_orders"), *_class_counts(valid))
            .withColumn("no_class", _no_class()))


def order_codes(rows: DataFrame, *more: str) -> TextCodes:
    """Codes of the texts that are picked per customer; reads those columns once."""
    return text_codes(rows, {"location": "location", "device": device_class("user_agent"),
                             **{name: name for name in more}})


def _order_features(codes: TextCodes) -> list[Column]:
    valid = F.col("is_valid") == 1
    at = F.when(valid, F.col("created_at"))
    undated = F.count_if(valid & F.col("created_at").isNull())
    return [
        # A valid order without a date leaves first and last order unknown.
        F.when(undated == 0, F.min(at)).alias("first_order"),
        F.when(undated == 0, F.max(at)).alias("last_order"),
        # No valid order: no summary row, so the counts are unknown, not zero.
        F.sum(F.when(valid, 1)).alias("valid_orders"),
        F.sum(F.when(valid, F.col("voucher_code").isNotNull().cast("int")))
        .alias("vouchers_used"),
        codes.strict_min("location").alias("city"),
        codes.strict_min("device").alias("device"),
        F.sum(is_open("state")).alias("open_orders"),
        F.sum(is_canceled("state")).alias("canceled_orders"),
    ]


def distinct_orders(orders: DataFrame) -> DataFrame:
    """Distinct order references per customer; a missing one counts.

    Kept apart from the other order features: next to a distinct count Spark
    would carry all of them per (customer, order) through one more shuffle.
    """
    return (flat_orders(orders, "customer_id", "order").select("customer_id", "order")
            .distinct().groupBy("customer_id")
            .agg(F.count(F.lit(1)).alias("total_orders")))


def order_summary(orders: DataFrame) -> DataFrame:
    """First, last, valid, open, canceled and distinct orders per customer."""
    rows = flat_orders(orders, "customer_id", "created_at", "state", "location",
                       "voucher_code", "user_agent")
    summary = rows.groupBy("customer_id").agg(*_order_features(order_codes(rows)))
    return left_join(summary, distinct_orders(orders), "customer_id")


def customer_status(valid_orders: ColumnLike) -> Column:
    """``New`` with one valid order, ``Returning`` with more, else ``NA``."""
    valid_orders = as_col(valid_orders)
    return (F.when(valid_orders == 1, "New").when(valid_orders > 1, "Returning")
            .otherwise("NA"))


def order_ratings(ratings: DataFrame, order: Sequence[str] = ("_id",),
                  latest: bool = False) -> DataFrame:
    """First rating per order, or its ``latest``, with its topics as columns.

    A rating without any topic is kept, with NULL topics; next to other topics
    an unmarked topic is the empty text. Topics are entries of one record, so
    spreading them needs neither a pivot nor a join back.
    """
    pick = F.max_by if latest else F.min_by
    firsts = ratings.groupBy("orderReference").agg(
        pick(F.struct("rating", "topics"), F.struct(*order)).alias("one")).select(
        "orderReference", "one.rating", "one.topics")
    return firsts.select(
        F.col("orderReference").alias("order"), "rating",
        *[F.when(F.size("topics") > 0,
                 F.coalesce(F.try_element_at("topics", F.lit(topic)), F.lit("")))
          .alias(name) for topic, name in TOPICS.items()])


def _rating_features(codes: TextCodes) -> list[Column]:
    return [strict_max("rating").alias("rating"),
            *[codes.strict_max(c).alias(c) for c in CUSTOMER_TOPICS]]


def mark_codes(ratings: DataFrame) -> TextCodes:
    """Codes of the topic marks, over all ratings."""
    names = {name: topic for topic, name in TOPICS.items() if name in CUSTOMER_TOPICS}
    return text_codes(ratings, {name: F.coalesce(F.try_element_at("topics", F.lit(topic)), F.lit(""))
                                for name, topic in names.items()}).over(CUSTOMER_TOPICS)


def rating_features(orders: DataFrame, ratings: DataFrame) -> DataFrame:
    """Highest rating and topic marks per customer, over all orders.

    NULL as soon as one order of the customer has no mark.
    """
    marks = order_ratings(ratings)
    rows = left_join(flat_orders(orders, "order", "customer_id"), marks, "order")
    return rows.groupBy("customer_id").agg(*_rating_features(mark_codes(ratings)))


def last_notification(notifications: DataFrame,
                      order: Sequence[str] = ("_id",)) -> DataFrame:
    """Last public reference and newsletter flag per e-mail address."""
    last = F.max_by(F.struct("publicReference", "newsletterSubscribed"),
                    F.struct(*order))
    return (notifications.groupBy("email").agg(last.alias("last"))
            .select("email", F.col("last.publicReference").alias("public_reference"),
                    F.col("last.newsletterSubscribed").alias("newsletter_subscribed")))


def first_provider(orders: DataFrame,
                   order: Sequence[str] = ("created_at", "order")) -> DataFrame:
    """Payment provider of the first order per customer."""
    rows = flat_orders(orders, "customer_id", "order", "created_at", "provider")
    return rows.groupBy("customer_id").agg(
        first_last("provider", order)[0].alias("provider"))


def cadence(df: DataFrame, as_of: date) -> DataFrame:
    """Days since the first order, mean days between orders, days overdue.

    Overdue uses the rounded frequency.
    """
    now = F.lit(as_of)
    frequency = round_half_even(
        ratio(days_between("last_order", "first_order"), F.col("valid_orders") - 1), 0)
    return df.withColumns({
        "days_since_first_order": days_between(now, "first_order"),
        "individual_frequency": frequency,
        "overtime": round_half_even(days_between(now, "last_order") - frequency, 0),
    })


def customer_features(orders: DataFrame, ratings: DataFrame) -> DataFrame:
    """All order-based features per customer.

    Orders are joined with their rating once and aggregated once: summary,
    class counts, marks and first provider share a single shuffle. Texts are
    picked by code (:mod:`..operators.codes`), so it is a hash aggregate.
    """
    rows = flat_orders(orders, "customer_id", "order", "created_at", "state",
                       "location", "voucher_code", "user_agent", "service_class",
                       "provider")
    codes = order_codes(rows, "provider") | mark_codes(ratings)
    rows = left_join(rows, order_ratings(ratings), "order")
    valid = F.col("is_valid") == 1
    first = packed_order(rows, "created_at", "order")
    features = rows.groupBy("customer_id").agg(
        *_order_features(codes), *_class_counts(valid), *_rating_features(codes),
        codes.first_by("provider", first).alias("provider"))
    # Customers without a valid order have no class counts either.
    has_valid = F.col("valid_orders").isNotNull()
    features = features.withColumns({
        name: F.when(has_valid, F.col(name)) for name in SERVICE_CLASSES.values()
    }).withColumn("no_class", _no_class())
    return left_join(features, distinct_orders(orders), "customer_id")


def customer_360(customers: DataFrame, orders: DataFrame, ratings: DataFrame,
                 notifications: DataFrame, credits: DataFrame, rfm: DataFrame,
                 as_of: date) -> DataFrame:
    """Customer master data with order, rating, contact and RFM features.

    ``rfm`` is the RFM report. Unknown measures become 0, unknown dates the
    empty text.
    """
    base = customers.select(
        F.col("_id").alias("customer_id"), F.col("reference").alias("customer"),
        F.col("userAccount.email").alias("email"),
        fold_ascii("person.name").alias("name"),
        F.col("internalData.segmentation").alias("segment"),
        F.col("internalData.gender").alias("gender"),
        F.col("internalData.basketGender").alias("basket_gender"),
        F.col("meta.language").alias("language"), "addresses")
    base = base.withColumn("zip", _first_address("zip")).drop("addresses")

    wide = left_join(base, customer_features(orders, ratings), "customer_id")
    wide = left_join(wide, last_notification(notifications), "email")
    wide = left_join(wide, credits.select(F.col("reference").alias("customer"),
                                          "branch_credits"), "customer")
    wide = left_join(wide, rfm.withColumnRenamed("location", "rfm_location"), "customer")

    wide = wide.withColumns({
        "first_order": day_of("first_order"), "last_order": day_of("last_order"),
        "customer_status": customer_status("valid_orders"),
        "subscriber_key": F.concat_ws("_", F.lit(SUBSCRIBER_PREFIX),
                                      F.col("customer_id").cast("string")),
        "first_name": first_name("name"),
        # A mean depends in its last bits on the order of summation; settle those
        # first, so that a half is a half.
        "amount": round_half_even(round_half_even("amount", 6), 0),
    })
    wide = cast_numeric(cadence(wide, as_of), NUMERIC)
    return wide.na.fill(0, subset=list(NUMERIC)).withColumns({
        "first_order": format_day("first_order"),
        "last_order": format_day("last_order"),
    })
