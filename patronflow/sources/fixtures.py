"""The input entities, derived from the TPC-H-like driver tables.

``FIXTURES.md`` part B states every rule. All functions are plain lazy
selects over whole tables; each takes the session and the table folder. The
tables hold no NULLs, so the rules create some to exercise missing-value
handling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Block names of the voucher tables, by voucher number. Rules
# overlap in some, one has no name, some match no rule.
BLOCK_NAMES = [
    "Campaign Spring-1", "CRM-2", "Journey Welcome-3", "PR-4", "Airbnb-5",
    "Apology-6", "CC-7", "Thank you Free-8", "Free Wash-9", "Santa-10",
    "St Giles-11", "£5 off-12", "Appstore-13", "Deal-14", "Facebook-15",
    "Social Media Paid-16", "Internal-17", "Team-18", "OOH-19",
    "Out of Home-20", "SEA-21", "SEM DE-22", "Twitter-23", "Flash Sales-24",
    "Refer a Friend-25", "Affiliate-26", "Appco/Direct Sales-27",
    "Print PR-28", "Website-29", "SEO Website-30", "Unpaid-31",
    "Socia Media Unpaid-32", None, "Mystery-33", "crm-34", "Survey-35",
    "Helper-36", "Groupon-37", "Display-38", "Enjoy-39", "Cooperations-40",
    "Huei-41", "Big Boss-42", "Expansion-43", "Journey", "Free Friends SEM",
    "Google Promo-46", "Referral-47", "Print Ads-48", "Nothing-49",
]
# Channels the funnel extract cycles through.
FIRST_CHANNELS = ["Organic Search", "Paid Search", "(unavailable)", "email",
                  "Social Network", None, "Direct"]
LAST_CHANNELS = ["Referral", "(unavailable)", "Organic Search", "SEM", "Display",
                 None, "Email", "Paid Search", "Facebook", "Direct", "Journey"]
# Networks of the install tracker.
NETWORKS = ["Organic", "SEM UK", "Partnerships", "newsletter",
            "Google Universal App Campaigns", "Off-Facebook Installs", "zanox",
            "Deep Link", "social", "Offline", "website", "Twitter Installs",
            None, "Unknown Net", "Instagram Installs"]
# Web-analytics mediums and sources.
MEDIUMS = ["(none)", "(not set)", "cpc", "organic", "referral", None, "email",
           "display", "affliate"]
SOURCES = ["(direct)", "google", "newsletter", "googlemybusiness", "Unknown",
           "not set at all"]
# Service-class tokens by order number; the last has no token.
SERVICE_CLASSES = ["gb-CLASSIC", "gb-EXPRESS", "gb-LITE", "gb-PERSIL",
                   "gb-PLUS", "gb"]
# Regional order locations by region number.
LOCATIONS = ["gb_london", "de_berlin", "fr_paris", "other_city", None]
TOPICS = ["CleaningQ", "DamagedI", "DriverB", "IroningQ", "MissingI",
          "Punctuality"]


# Column types of the driver tables that are read; naming them saves a job per
# read that would look them up.
TABLES = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
              "props string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def _pick(values: list, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _order_state() -> Column:
    priority = F.col("o_orderpriority")
    return (F.when(F.col("o_orderstatus") == "F", "completed")
            .when(F.col("o_orderstatus") == "P", "processing")
            .when(priority == "1-URGENT", "canceled")
            .when(priority == "2-HIGH", "reserved")
            .when(priority == "3-MEDIUM", "payment_authorisation_error")
            .otherwise("new"))


def orders(spark: SparkSession, folder: str, located: bool = True) -> DataFrame:
    """Orders; ``located=False`` leaves out the city and its lookups."""
    df = table(spark, folder, "orders")
    key, priority = F.col("o_orderkey"), F.col("o_orderpriority")
    agent = (F.when(priority == "1-URGENT", "App (iPhone)")
             .when(priority == "2-HIGH", "App (Android)")
             .when(priority == "4-NOT SPECIFIED", "iPhone Android")
             .when(priority == "5-LOW", "Mozilla/5.0"))
    columns = {
        "_id": key, "reference": key, "customer": F.col("o_custkey"),
        "createdAt": F.col("o_orderdate"), "state": _order_state(),
        "invoice": key,
        "voucherCode": F.when(key % 3 == 0, F.concat(F.lit("V"), key % 60)),
        "languageCode": F.when(key % 2 == 0, "en").otherwise("de"),
        "chosenServiceClass": F.struct(
            _pick(SERVICE_CLASSES, key % 6).alias("reference")),
        "createdBy": F.struct(agent.alias("userAgent")),
        "referral": F.struct(F.when(key % 17 == 0, key).alias("referrerId")),
        "paymentData": F.struct(priority.alias("provider")),
    }
    if located:
        home = (table(spark, folder, "customer")
                .join(table(spark, folder, "nation"),
                      F.col("c_nationkey") == F.col("n_nationkey"), "left")
                .select(F.col("c_custkey"), F.col("n_regionkey")))
        df = df.join(home, F.col("o_custkey") == F.col("c_custkey"), "left")
        columns["locationIdentifier"] = (
            F.when(key % 23 == 0, "de_berlin")
            .otherwise(_pick(LOCATIONS, F.col("n_regionkey"))))
    return df.select(*[c.alias(name) for name, c in columns.items()])


def customers(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    first_zip = F.when(key % 10 == 0, "").otherwise(F.concat(F.lit("Z"), key % 97))

    def address(line: str, zip_code: Column) -> Column:
        return F.struct(F.concat(F.lit(line), key).alias("addressLine"),
                        F.lit("").alias("addressLine2"), zip_code.alias("zip"))

    one = address("Street ", first_zip)
    two = address("Avenue ", F.concat(F.lit("Y"), key % 89))
    addresses = (F.when(key % 3 == 1, F.array(one))
                 .when(key % 3 == 2, F.array(one, two)))
    return table(spark, folder, "customer").select(
        key.alias("_id"), F.concat(F.lit("C"), key).alias("reference"),
        F.struct(
            F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_mktsegment"))
            .alias("segmentation"),
            F.when(key % 2 == 0, "f").otherwise("m").alias("gender"),
            F.when(key % 5 == 0, "mixed").alias("basketGender"),
        ).alias("internalData"),
        F.struct(F.concat(F.lit("Zoë "), F.col("c_name")).alias("name")).alias("person"),
        F.struct(F.concat(F.lit("u"), key, F.lit("@x")).alias("email")).alias("userAccount"),
        addresses.alias("addresses"),
        F.struct(F.when(key % 2 == 0, "en").otherwise("de").alias("language")).alias("meta"),
    )


def invoices(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("o_totalprice")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("_id"),
        (price * 0.9).alias("grossTotal"),
        F.when(F.col("o_orderkey") % 97 != 0, price).alias("grossTotalWithoutDiscounts"),
        (price * 0.72).alias("netTotal"),
        (price * 0.8).alias("netTotalWithoutDiscounts"),
    )


def exchange_rates(spark: SparkSession, folder: str) -> DataFrame:
    """One GBP and one EUR row per calendar day the orders span."""
    span = table(spark, folder, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("low"),
        F.to_date(F.max("o_orderdate")).alias("high"))
    day = F.col("exchange_rate_date")
    return (span.select(F.explode(F.sequence("low", "high")).alias("exchange_rate_date"))
            .where(F.dayofmonth(day) != 13)
            .select(day, F.explode(F.array(F.lit("GBP"), F.lit("EUR"))).alias("currency_code"))
            .withColumn("exchange_rate_value",
                        F.when(F.col("currency_code") == "GBP",
                               F.lit(0.7) + F.dayofmonth(day) / 1000).otherwise(1.0)))


def _numbered(spark: SparkSession) -> DataFrame:
    return spark.range(len(BLOCK_NAMES)).withColumnRenamed("id", "i")


def voucher_blocks(spark: SparkSession, folder: str) -> DataFrame:
    i = F.col("i")
    return _numbered(spark).select(
        F.concat(F.lit("B"), i).alias("reference"),
        _pick(BLOCK_NAMES, i).alias("name"),
        F.lit(None).cast("string").alias("campaignId"))


def voucher_models(spark: SparkSession, folder: str) -> DataFrame:
    i = F.col("i")
    return _numbered(spark).select(
        F.concat(F.lit("M"), i).alias("_id"), F.concat(F.lit("B"), i).alias("blockId"),
        F.lit("std").alias("template"))


def voucher_items(spark: SparkSession, folder: str) -> DataFrame:
    i = F.col("i")
    return _numbered(spark).select(
        F.concat(F.lit("I"), i).alias("_id"), F.concat(F.lit("V"), i).alias("code"),
        F.concat(F.lit("M"), i).alias("modelId"))


def _twice_if(df: DataFrame, test: Column) -> DataFrame:
    """Repeat the rows that pass the test, numbered by ``copy``."""
    return df.withColumn("copy", F.explode(
        F.when(test, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))


def funnel(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of three priorities; every tenth row is repeated."""
    key = F.col("o_orderkey")
    df = table(spark, folder, "orders").where(
        F.col("o_orderpriority").isin("1-URGENT", "3-MEDIUM", "5-LOW"))
    return _twice_if(df, key % 10 == 0).select(
        key.alias("order_reference"),
        _pick(FIRST_CHANNELS, key % len(FIRST_CHANNELS)).alias("first_channel"),
        _pick(LAST_CHANNELS, key % len(LAST_CHANNELS)).alias("last_channel"))


def tracker_events(spark: SparkSession, folder: str) -> DataFrame:
    """App events of the orders made with two kinds of app."""
    key = F.col("o_orderkey")
    df = table(spark, folder, "orders").where(
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return _twice_if(df, key % 12 == 1).select(
        (key * 2 + F.col("copy")).alias("_id"), key.alias("reference_id"),
        _pick(NETWORKS, (key + F.col("copy")) % len(NETWORKS)).alias("network"),
        F.when(key % 8 == 1, "open_app").otherwise("submit_order").alias("event"))


def web_analytics(spark: SparkSession, folder: str) -> DataFrame:
    """Web sessions of the orders made in a browser."""
    key = F.col("o_orderkey")
    df = table(spark, folder, "orders").where(
        F.col("o_orderpriority").isin("4-NOT SPECIFIED", "5-LOW"))
    return _twice_if(df, key % 14 == 2).select(
        key.alias("ga.transactionID"),
        _pick(SOURCES, (key + F.col("copy")) % len(SOURCES)).alias("ga.source"),
        _pick(MEDIUMS, key % len(MEDIUMS)).alias("ga.medium"),
        F.lit("wash").alias("ga.keyword"))


def order_links(spark: SparkSession, folder: str) -> DataFrame:
    """(reference, subProcesses) rows: the suppliers that served an order."""
    return (table(spark, folder, "lineitem")
            .select(F.col("l_orderkey").alias("reference"),
                    F.col("l_suppkey").alias("subProcesses")).distinct())


def subprocesses(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, folder, "supplier").select(
        key.alias("_id"), F.lit("done").alias("fulfillment"),
        F.concat(F.lit("D"), key).alias("dropOff"))


def driver_deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """Deliveries of the suppliers in credit."""
    key = F.col("s_suppkey")
    return (table(spark, folder, "supplier").where(F.col("s_acctbal") >= 0)
            .select(F.concat(F.lit("D"), key).alias("_id"), (key % 8).alias("facility")))


def facilities(spark: SparkSession, folder: str) -> DataFrame:
    """One facility per region and two more; number 7 is not on file."""
    return spark.range(7).select(
        F.col("id").alias("_id"), F.concat(F.lit("Facility_"), "id").alias("name"))


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Ratings of the orders that were not left open; some are repeated."""
    key = F.col("o_orderkey")
    marks = F.map_from_arrays(
        F.array(*[F.lit(t) for t in TOPICS]),
        F.array(*[((key + i) % 4).cast("string") for i in range(len(TOPICS))]))
    given = F.map_filter(marks, lambda name, mark: mark != "3")
    df = table(spark, folder, "orders").where(F.col("o_orderstatus") != "O")
    copy = F.col("copy")
    return _twice_if(df, key % 12 == 0).select(
        (key * 2 + copy).alias("_id"), F.lit("1.0").alias("appVersion"),
        key.alias("orderReference"), F.col("o_custkey").alias("customerReference"),
        F.when(key % 50 != 0, 1 + (key + copy) % 5).cast("int").alias("rating"),
        F.lit(False).alias("skipped"),
        F.when(key % 8 != 0, given).alias("topics"))


def notifications(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("event_id").alias("_id"),
        F.concat(F.lit("u"), "user_id", F.lit("@x")).alias("email"),
        F.concat(F.lit("P"), "event_id").alias("publicReference"),
        F.col("user_id").alias("reference"),
        F.col("event_type").isin("signup", "purchase").alias("newsletterSubscribed"),
        F.col("ts"))


def branch_credits(spark: SparkSession, folder: str) -> DataFrame:
    """Credits of the customers with a positive balance."""
    return (table(spark, folder, "customer").where(F.col("c_acctbal") > 0)
            .select(F.concat(F.lit("C"), "c_custkey").alias("reference"),
                    F.col("c_acctbal").alias("branch_credits"),
                    F.lit("2001-08-31").alias("last_updated")))
