"""Marketing channels: voucher channels, attribution and channel priority.

The rule lists are data; their order is part of the result. Voucher rules and
attribution recodes test the original name, the last match winning. The
priority-channel rules rewrite step by step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cascade, device_class, if_na, is_valid, last_match, strict_min
from ..functions.dates import day_of
from ..functions.text import Rule
from ..operators.aggregates import first_by_key
from ..operators.joins import left_join
from ..operators.reshape import melt_pairs
from ..operators.reuse import Keep, hold
from ..operators.totals import Totals, watched
from .cohorts import customer_days, first_order, label_cohorts
from .facts import flat_orders

NOT_SET = "not set"

# Patterns that turn a voucher block name into a channel.
VOUCHER_RULES = [
    Rule("CRM-Campaign", ["Campaign"], exact=["CRM"]),
    Rule("CRM-Journey", ["Journey"]),
    Rule("Cooperations", ["PR", "Cooperations", "Airbnb", "Enjoy"]),
    Rule("CC", ["Apology", "CC", "Thank you", "Survey", "Thank"]),
    Rule("Flyering", [
        "Free", "Helper", "Flyering", "Friends", "Percentage", "Santa", "Friday",
        "GrabOne", "HubSpot", "Lorenzo", "Mailings", "Rabbit", "Reclean", "XMAS",
        "Fiksu", "FixedBlock", "£", "Google", "Groupon", "Scheme", "Rabit",
        "Welcome", "External", "Berenberg", "Promo", "Huei", "SANTA", "EUR15",
        "St Giles", "Hassle", "Big Boss", "Expansion"]),
    Rule("Display", ["Appstore", "Display", "Deal"]),
    Rule("Facebook", ["Facebook", "Social Media Paid"]),
    Rule("Internal", ["Internal", "Team"]),
    Rule("Out Of Home", ["OOH", "Out of Home"]),
    Rule("SEM", ["SEA", "SEM"]),
    Rule("Twitter", ["Twitter"]),
    Rule("Flash Sales", ["Flash Sales"]),
    Rule("Refer a Friend", ["Refer a Friend", "Refer a Friend ", "Refer"]),
    Rule("Affiliate", ["Affiliate"]),
    Rule("Appco/Direct Sales", ["Appco/Direct Sales"]),
    Rule("Print Ads", ["Print", "Print Ad", "Print Ads"]),
    Rule("Website", ["Website"]),
    Rule("SEO", ["SEO"]),
    Rule("Social Media Unpaid", ["Socia Media Unpaid", "Socia Media Unpaid ", "Unpaid"]),
]

# Recodes of the channels of all touchpoints.
TOUCHPOINT_RULES = [
    Rule("SEO", ["SEO", "Organic Search"]),
    Rule("SEM", ["SEM", "Paid Search"]),
    Rule("Refer a Friend", ["Refer a Friend", "Referral", "Refer"]),
    Rule("CRM-Journey", ["email", "Email", "Journey"]),
    Rule("Facebook", ["Facebook", "Network"]),
]

# Web-analytics channels written off as direct, then as search.
WEB_RULES = [
    Rule("Direct", ["(not set)", "(direct)", "Unknown"]),
    Rule("SEO", ["Organic", "organic"]),
]

# Step-by-step recodes of the priority channel.
PRIORITY_RULES = [
    Rule("SEM", ["SEM DE", "SEM", "cpc", "SEM UK", "SEM FR"]),
    Rule("Cooperations", ["Partnerships", "cooperation", "Cooperations", "referral",
                          "partnerships"]),
    Rule("CRM-Campaign", ["email", "CRM-Campaign", "Email", "leadads", "newsletter",
                          "crm"]),
    Rule("SEO", ["SEO", "googlemybusiness", "Google Universal App Campaigns"]),
    Rule("Facebook", ["Facebook", "maia", "Off-Facebook Installs",
                      "Instagram Installs", "Social_Facebook", "Facebook Installs"]),
    Rule("Affiliate", ["affliate", "zanox", "Affiliate"]),
    Rule("Display", ["Deep Link", "UIM", "Display", "display", "Plista"]),
    Rule("Social Media Unpaid", ["social", "Social Media Unpaid"]),
    Rule("Flyering", ["Offline", "Flyer", "Flyering"]),
    Rule("Website", ["website", "Website"]),
    Rule("Twitter", ["Twitter", "Twitter Installs"]),
    Rule("Direct", ["Organic", "Direct"]),
]

# Weight of each touchpoint by how many of the three are set.
TOUCHPOINT_WEIGHTS = {1: 1.0, 2: 0.5, 3: 0.33}


def voucher_channels(blocks: DataFrame, models: DataFrame,
                     items: DataFrame) -> DataFrame:
    """(voucher_code, voucher_channel) of every voucher item.

    The text before the first dash of the block name is classified; a name
    that matches nothing, or no name, is ``Other``.
    """
    named = blocks.select(
        "reference", F.regexp_replace("name", "-.*", "").alias("block_channel"))
    chain = left_join(models.select(F.col("_id").alias("model"), "blockId"),
                      named, {"blockId": "reference"})
    chain = left_join(items.select(F.col("code").alias("voucher_code"), "modelId"),
                      chain.select("model", "block_channel"), {"modelId": "model"})
    return chain.select(
        "voucher_code",
        last_match("block_channel", VOUCHER_RULES, "'Other'").alias("voucher_channel"))


def funnel_channels(funnel: DataFrame, collate: str | None = None) -> DataFrame:
    """Smallest first and last channel per order, NULL-strict, in the order of the
    bytes or of a collation.

    Repeated funnel rows need no separate de-duplication: they do not change
    a minimum.
    """
    return funnel.groupBy(F.col("order_reference").alias("order")).agg(
        strict_min("first_channel", collate).alias("first_channel"),
        strict_min("last_channel", collate).alias("last_channel"))


def touchpoints(orders: DataFrame, vouchers: DataFrame, funnel: DataFrame) -> DataFrame:
    """Orders with voucher, first and last channel; unknown ones ``not set``."""
    rows = flat_orders(orders, "order", "customer_id", "created_at", "state",
                       "location", "user_agent", "voucher_code").drop("is_valid")
    rows = left_join(rows, vouchers, "voucher_code")
    rows = left_join(rows, funnel_channels(funnel), "order", missing="lookup",
                     spread=["customer_id", "created_at"])
    return rows.withColumns({
        c: F.when(F.col(c) == "(unavailable)", NOT_SET)
        .otherwise(F.coalesce(F.col(c), F.lit(NOT_SET)))
        for c in ("voucher_channel", "first_channel", "last_channel")
    })


def fractional_weights(points: DataFrame) -> DataFrame:
    """Weights of the three touchpoints and of the untracked rest.

    Every set touchpoint gets the same weight, by how many are set; the rest
    makes the sum one.
    """
    names = {"voucher_channel": "voucher_weight", "first_channel": "first_weight",
             "last_channel": "last_weight"}
    is_set = {c: F.col(c) != NOT_SET for c in names}
    count = sum(test.cast("int") for test in is_set.values())
    share = F.lit(0.0)
    for n, weight in TOUCHPOINT_WEIGHTS.items():
        share = F.when(count == n, weight).otherwise(share)
    weighted = points.withColumns({
        w: F.when(is_set[c], share).otherwise(0.0) for c, w in names.items()})
    tracked = F.col("voucher_weight") + F.col("first_weight") + F.col("last_weight")
    return weighted.withColumn("rest_weight", 1 - tracked)


def attribution_long(points: DataFrame) -> DataFrame:
    """Weight per order and final channel (weights of an order sum to one)."""
    pairs = [("voucher_channel", "voucher_weight"), ("first_channel", "first_weight"),
             ("last_channel", "last_weight"), (F.lit(NOT_SET), "rest_weight")]
    long = melt_pairs(fractional_weights(points), ["order"], pairs)
    final = last_match("channel", TOUCHPOINT_RULES, "channel").alias("final_channel")
    return (long.groupBy("order", final)
            .agg(F.sum("weight").alias("sum_weight")))


def attribution_report(orders: DataFrame, vouchers: DataFrame, funnel: DataFrame,
                       keep: Keep = hold, totals: Totals | None = None) -> DataFrame:
    """Channel weights with order fields, device and customer status.

    The status compares timestamps, so a second order on the first day is
    already returning. ``keep`` stores the touchpoints: the orders are joined
    with vouchers and funnel once, and weights, first orders and order fields
    are read from that table. An order whose voucher code is on file twice
    stands in it twice, for its weights and for its fields. With ``totals`` the
    weights have to sum to the touchpoint rows.
    """
    points = keep(watched(totals, touchpoints(orders, vouchers, funnel), "touchpoints",
                          orders=F.count(F.lit(1))))
    firsts = first_order(points, "customer_id")
    fields = points.select("order", "customer_id", "created_at", "state", "location",
                           "user_agent", is_valid("state").alias("is_valid"))
    fields = left_join(fields, firsts, "customer_id")
    weights = watched(totals, attribution_long(points), "attribution", weight=F.sum("sum_weight"))
    if totals is not None:
        totals.agree("touchpoints.orders", "attribution.weight", tolerance=1e-9)
    rows = left_join(weights, fields, "order")
    returning = F.col("created_at") > F.col("first_order")
    return rows.select(
        "customer_id", "order", "final_channel", "sum_weight",
        day_of("created_at").alias("created_on"), "state", "location", "user_agent",
        "is_valid", device_class("user_agent").alias("device"),
        day_of("first_order").alias("first_order"),
        F.when(returning, "Returning").otherwise("New").alias("customer_status"))


def tracker_networks(events: DataFrame) -> DataFrame:
    """(order, network): first submit-order event of the install tracker."""
    submitted = events.where(F.col("event") == "submit_order").select(
        F.col("reference_id").alias("order"), "network", "_id")
    return first_by_key(submitted, ["order"], ["_id"]).drop("_id")


def web_channels(web: DataFrame) -> DataFrame:
    """(order, web_channel) of the web-analytics export, one per transaction.

    The medium, or the source if there is no medium. Of repeated transactions
    the first by source and medium is taken.
    """
    rows = web.select(F.col("`ga.transactionID`").alias("order"),
                      F.col("`ga.source`").alias("source"),
                      F.col("`ga.medium`").alias("medium"))
    rows = first_by_key(rows, ["order"], ["source", "medium"])
    initial = if_na(F.col("medium").isin("(none)", "(not set)"), "source", "medium",
                    on="medium")
    return cascade(rows.select("order", initial.alias("web_channel")),
                   "web_channel", WEB_RULES)


def priority_channel(orders: DataFrame, vouchers: DataFrame, networks: DataFrame,
                     web: DataFrame, recoded: bool = True) -> DataFrame:
    """Orders with their marketing channel.

    Referral first, then voucher channel, tracker network, web channel, and
    ``Direct`` if nothing is known; ``recoded`` applies the channel recodes.
    """
    rows = flat_orders(orders, "order", "customer_id", "created_at", "state",
                       "location", "voucher_code", "referrer_id")
    rows = left_join(rows, vouchers, "voucher_code")
    rows = left_join(left_join(rows, networks, "order"), web, "order")

    def known(column: str):
        # The text "NA" stands for an unset channel.
        return F.when(F.col(column) != "NA", F.col(column))

    voucher = F.when(F.col("referrer_id").isNull(), F.col("voucher_channel"))
    chosen = F.coalesce(
        F.when(F.col("referrer_id").isNotNull(), "Refer a Friend"),
        F.when(voucher != "NA", voucher), known("network"), known("web_channel"),
        F.lit("Direct"))
    rows = rows.withColumn("channel", chosen).drop(
        "referrer_id", "voucher_channel", "network", "web_channel", "voucher_code")
    return cascade(rows, "channel", PRIORITY_RULES) if recoded else rows


def first_channel(rows: DataFrame) -> DataFrame:
    """(customer_id, first_channel): smallest channel of the initial orders.

    Initial orders are completed ones on the day of the first valid order.
    """
    days = customer_days(rows, "customer_id", label="channel")
    return (days.where(F.col("status") == 0).groupBy("customer_id")
            .agg(F.when(F.sum("label_missing") == 0, F.min("label"))
                 .alias("first_channel")))


def channel_cohorts(rows: DataFrame) -> DataFrame:
    """Cohorts by first channel and city, from priority-channel rows."""
    return label_cohorts(rows, "channel", "first_channel", by=["location"])

