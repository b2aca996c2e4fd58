"""Every operator of the inventory as a query over the driver tables.

A query takes the session and the table folder and returns a lazy DataFrame.
Dates are returned as ISO text, integers as bigint, and money or means rounded
to a fixed number of digits, so that results compare by value.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patronflow import functions as fn
from patronflow import operators as op
from patronflow.plans import channels, clv, cohorts, customer360, facilities, facts, rfm, stages
from patronflow.session import shared_folder
from patronflow.sources import fixtures as fx
from patronflow.sources import (load_table, save_table, scan, scan_delimited, scan_documents,
                                schemas, write_report)
from patronflow.sources.publish import publish, published

AS_OF = date(2001, 9, 1)
TRANSITION_AS_OF = date(2001, 7, 15)
FLOORS = {"de_berlin": date(1997, 1, 1), "fr_paris": date(1998, 5, 1)}


class Inputs:
    """The entities and shared tables of one table folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def entity(self, name: str, **options) -> DataFrame:
        return getattr(fx, name)(self.spark, self.folder, **options)

    def table(self, name: str) -> DataFrame:
        return fx.table(self.spark, self.folder, name)

    @cached_property
    def orders(self) -> DataFrame:
        return self.entity("orders")

    @cached_property
    def unlocated(self) -> DataFrame:
        return self.entity("orders", located=False)

    @cached_property
    def customers(self) -> DataFrame:
        return self.entity("customers")

    @cached_property
    def ratings(self) -> DataFrame:
        return self.entity("ratings")

    @cached_property
    def rows(self) -> DataFrame:
        return facts.order_rows(self.orders, self.customers)

    @cached_property
    def facts(self) -> DataFrame:
        return facts.order_facts(self.orders, self.customers, self.entity("invoices"),
                                 self.entity("exchange_rates"))

    def flat(self, *columns: str) -> DataFrame:
        source = self.orders if "location" in columns else self.unlocated
        return facts.flat_orders(source, *columns)

    @cached_property
    def cohort_input(self) -> DataFrame:
        return self.flat("customer_id", "created_at", "state")

    @cached_property
    def city_input(self) -> DataFrame:
        return self.flat("customer_id", "created_at", "state", "location")

    @cached_property
    def rfm_base(self) -> DataFrame:
        return rfm.rfm_base(self.facts, AS_OF)

    @cached_property
    def stage_base(self) -> DataFrame:
        return stages.stage_base(self.rows)

    @cached_property
    def vouchers(self) -> DataFrame:
        return channels.voucher_channels(self.entity("voucher_blocks"),
                                         self.entity("voucher_models"),
                                         self.entity("voucher_items"))

    def touchpoints(self, located: bool = False) -> DataFrame:
        source = self.orders if located else self.unlocated.withColumn(
            "locationIdentifier", F.lit(None).cast("string"))
        return channels.touchpoints(source, self.vouchers, self.entity("funnel"))

    def priority(self, recoded: bool = True) -> DataFrame:
        return channels.priority_channel(
            self.orders, self.vouchers,
            channels.tracker_networks(self.entity("tracker_events")),
            channels.web_channels(self.entity("web_analytics")), recoded)

    def served(self, lists: bool = False) -> DataFrame:
        """Orders with facilities; ``lists`` reads the links from a list column of
        the order documents, as exports have them."""
        links = self.entity("order_links")
        if lists:
            held = links.groupBy("reference").agg(F.collect_list("subProcesses").alias("subProcesses"))
            documents = self.unlocated.drop("subProcesses").join(held, "reference", "left")
            links = facilities.subprocess_links(documents)
        return facilities.order_facilities(
            self.unlocated, links, self.entity("subprocesses"),
            self.entity("driver_deliveries"), self.entity("facilities"))

    def lifespans(self) -> DataFrame:
        bridge = clv.customer_channels(self.customers, channels.first_channel(self.priority()))
        return clv.customer_lifespan(stages.stage_report(self.rows, AS_OF), bridge)


def tidy(df: DataFrame, **digits: int) -> DataFrame:
    """Comparable output types; keyword arguments round the named columns."""
    columns = []
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if name in digits:
            exact = column.cast("double").cast(f"decimal(38,{digits[name] + 3})")
            column = F.round(exact, digits[name]).cast("double")
        elif kind in ("tinyint", "smallint", "int"):
            column = column.cast("bigint")
        elif kind in ("date", "timestamp", "timestamp_ntz"):
            column = F.date_format(column, "yyyy-MM-dd")
        columns.append(column.alias(name))
    return df.select(*columns)


QUERIES: dict = {}


def query(name: str, **digits: int):
    def register(build):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return tidy(build(Inputs(spark, folder)), **digits)
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        return build
    return register


# ---- sources and sinks

@query("SRC1_scan_projected")
def _(i: Inputs):
    return scan(i.spark, f"{i.folder}/orders.parquet",
                {"order": "o_orderkey", "customer_id": "o_custkey", "created_at": "o_orderdate"})


def _documents(i: Inputs):
    """The nested orders as an export of one document a line. The lines of reserved
    orders are cut short, canceled orders hold a text for their time."""
    whole = F.to_json(F.struct(*i.orders.columns))
    late = F.to_json(F.struct(*[F.lit("later").alias(c) if c == "createdAt" else F.col(c)
                                for c in i.orders.columns]))
    line = (F.when(F.col("state") == "reserved", F.substring(whole, F.lit(1), F.length(whole) - 9))
            .when(F.col("state") == "canceled", late).otherwise(whole))
    path = shared_folder(i.spark)
    i.orders.select(line.alias("value")).write.text(path)
    schema = schemas.ORDERS.replace("timestamp", "timestamp_ntz")
    return scan_documents(i.spark, path, schema, required=["_id", "paymentData.provider"])


@query("SRC1_json_documents")
def _(i: Inputs):
    """Nested documents, flattened; broken ones are set apart."""
    return facts.flat_orders(_documents(i).good, "order_id", "order", "customer_id", "created_at",
                             "state", "location", "voucher_code", "user_agent", "referrer_id",
                             "service_class", "provider")


@query("SRC1_json_counts")
def _(i: Inputs):
    """Good and broken documents of the same export."""
    return _documents(i).counts()


@query("SRC2_scan_filtered", value=4)
def _(i: Inputs):
    return scan(i.spark, f"{i.folder}/events.parquet", ["event_id", "user_id", "value"],
                where=F.col("event_type") == "purchase")


@query("SRC3_csv_semicolon")
def _(i: Inputs):
    path = shared_folder(i.spark)
    write_report(i.entity("funnel"), path, sep=";")
    return scan_delimited(i.spark, path, schemas.FUNNEL)


@query("SRC4_csv_comma")
def _(i: Inputs):
    path = shared_folder(i.spark)
    write_report(i.entity("web_analytics"), path)
    df = scan_delimited(i.spark, path, schemas.WEB_ANALYTICS, sep=",")
    return df.toDF(*[c.replace("ga.", "ga_") for c in df.columns])


@query("SRC5_load_intermediate", gross=2)
def _(i: Inputs):
    path = shared_folder(i.spark)
    save_table(i.facts, path)
    return load_table(i.spark, path).select(
        "order", "customer", "state", F.col("gross_before_discount").alias("gross"))


@query("SNK1_write_csv", percent=4)
def _(i: Inputs):
    path = shared_folder(i.spark)
    write_report(cohorts.user_retention(i.cohort_input), path)
    return scan_delimited(
        i.spark, path, "initial_cohort date, since_first_order int, returning bigint, "
        "initial bigint, percent double", sep=",")


@query("SNK2_save_intermediate", gap=6)
def _(i: Inputs):
    return save_table(i.stage_base, shared_folder(i.spark), partition_by=["segment"])


# ---- projections and filters

@query("PRJ1_select_rename")
def _(i: Inputs):
    return i.flat("order", "customer_id", "state", "created_at", "voucher_code").drop("is_valid")


@query("PRJ2_flatten_struct")
def _(i: Inputs):
    return op.flatten_structs(i.customers.drop("addresses")).withColumnsRenamed(
        {"_id": "customer_id"})


@query("PRJ3_drop_column")
def _(i: Inputs):
    return cohorts.user_retention(i.cohort_input).drop("returning", "initial")


@query("PRJ4_const_default")
def _(i: Inputs):
    """A constant column with overrides by state."""
    flag = F.when(F.col("state").isin("completed", "processing"), 0).otherwise(F.lit(1))
    return i.flat("order", "state").select("order", flag.alias("stuck"))


@query("FLT1_valid_order_flag")
def _(i: Inputs):
    return i.flat("order", "state")


@query("FLT2_filter_equality")
def _(i: Inputs):
    return i.flat("order", "state", "location").where(
        (F.col("state") == "completed") & (F.col("location") == "gb_london"))


@query("FLT3_filter_conjunction_notnull", gross=2)
def _(i: Inputs):
    return i.facts.where((F.col("is_valid") == 1) & F.col("gross_before_discount").isNotNull()) \
        .select("order", F.col("gross_before_discount").alias("gross"))


@query("FLT4_date_range_slice")
def _(i: Inputs):
    now, day = F.lit(TRANSITION_AS_OF), fn.day_of("created_at")
    return i.flat("order", "created_at").where(
        (day > fn.start_of_previous_month(now)) & (day <= fn.start_of_month(now))
    ).select("order", day.alias("day"))


@query("FLT5_cohort_floor")
def _(i: Inputs):
    return cohorts.city_rows(cohorts.orders_per_user(i.rows, by=["location"]), floors=FLOORS)


@query("FLT6_drop_na_rows", percent=6)
def _(i: Inputs):
    table = cohorts.revenue_retention(i.facts, by=["location"], digits=None)
    return cohorts.city_rows(table.drop("returning", "initial"))


@query("FLT7_open_cancel_flags")
def _(i: Inputs):
    return i.flat("order", "state").select(
        "order", fn.is_open("state").alias("open_order"),
        fn.is_canceled("state").alias("canceled_order"))


# ---- joins

@query("JN1_left_join_dim")
def _(i: Inputs):
    return facts.order_rows(i.unlocated.withColumn("locationIdentifier", F.lit(None)),
                            i.customers).select("order", "customer", "segment")


@query("JN2_left_join_rate", exchange_rate=4)
def _(i: Inputs):
    rows = i.flat("order", "created_at").select("order", fn.day_of("created_at").alias("rate_date"))
    return op.left_join(rows, facts.daily_rates(i.entity("exchange_rates")), "rate_date")


@query("JN3_left_join_firstorder")
def _(i: Inputs):
    firsts = cohorts.first_order(i.cohort_input, "customer_id")
    return op.left_join(i.flat("order", "customer_id"), firsts, "customer_id") \
        .select("order", "first_order")


@query("JN4_multi_key_join")
def _(i: Inputs):
    """Returning cells joined with initial cells on cohort and city."""
    days = cohorts.customer_days(i.city_input, "customer_id", ["location"])
    cells = cohorts.cohort_cells(days, "customer_id", ["location"])
    keys = ["initial_cohort", "location"]
    x = cells.where("status = 1").select(*keys, "since_first_order",
                                         F.col("users").alias("returning"))
    y = cells.where("status = 0").select(*keys, F.col("users").alias("initial"))
    return op.left_join(x, y, keys)


@query("JN5_different_key_names")
def _(i: Inputs):
    people = i.customers.select("_id", F.col("person.name").alias("name"))
    return op.left_join(i.unlocated.select("reference", "customer"), people,
                        {"customer": "_id"})


@query("JN6_join_chain")
def _(i: Inputs):
    return i.served().select("order", "facility_name")


@query("JN7_voucher_chain")
def _(i: Inputs):
    return op.left_join(i.flat("order", "voucher_code"), i.vouchers, "voucher_code") \
        .select("order", "voucher_code", "voucher_channel")


def _topics_wide(i: Inputs) -> DataFrame:
    firsts = op.first_by_key(i.ratings.select("_id", "orderReference", "topics"),
                             ["orderReference"], ["_id"])
    long = op.explode_named(firsts, "topics", ["orderReference"], ("topic", "mark"))
    return long.groupBy("orderReference").pivot("topic", fx.TOPICS).agg(
        op.concat_by_group("mark", "topic"))


@query("JN8_right_join")
def _(i: Inputs):
    """Topics joined with ratings; a rating without topics is kept."""
    firsts = op.first_by_key(i.ratings.select("_id", "orderReference", "rating"),
                             ["orderReference"], ["_id"]).drop("_id")
    return op.right_join(_topics_wide(i), firsts, "orderReference")


@query("JN9_star_join", branch_credits=2)
def _(i: Inputs):
    people = i.customers.select(F.col("_id").alias("customer_id"),
                                F.col("reference").alias("customer"),
                                F.col("userAccount.email").alias("email"))
    wide = op.left_join(people, customer360.order_summary(i.orders), "customer_id")
    wide = op.left_join(wide, customer360.service_class_counts(i.unlocated)
                        .drop("valid_orders"), "customer_id")
    wide = op.left_join(wide, customer360.last_notification(i.entity("notifications")), "email")
    credits = i.entity("branch_credits").select(F.col("reference").alias("customer"),
                                                "branch_credits")
    return op.left_join(wide, credits, "customer")


@query("JN10_zip_columns")
def _(i: Inputs):
    return customer360.last_notification(i.entity("notifications"))


# ---- aggregations

@query("AGG1_first_valid_order")
def _(i: Inputs):
    return cohorts.first_order(i.cohort_input, "customer_id")


@query("AGG2_minmax_count", amount=6)
def _(i: Inputs):
    return (i.facts.where("is_valid = 1").groupBy("customer").agg(
        F.min(fn.day_of("created_at")).alias("first_order"),
        F.max(fn.day_of("created_at")).alias("last_order"),
        F.sum("is_valid").alias("orders"),
        F.avg("gross_before_discount").alias("amount")))


@query("AGG3_conditional_count")
def _(i: Inputs):
    return i.flat("customer_id", "state", "voucher_code").groupBy("customer_id").agg(
        F.count("voucher_code").alias("vouchers"), F.sum("is_valid").alias("valid_orders"),
        F.count_if(F.col("state") == "canceled").alias("canceled"))


@query("AGG4_distinct_count")
def _(i: Inputs):
    # Two distinct counts in one aggregate would double every row before the shuffle.
    codes = i.flat("location", "voucher_code").groupBy("location").agg(
        fn.count_distinct_na("voucher_code").alias("codes"))
    customers = i.flat("customer_id", "location").groupBy("location").agg(
        fn.count_distinct_na("customer_id").alias("customers"))
    return op.left_join(codes, customers, "location")


@query("AGG5_sum_by_cohort", revenue=2)
def _(i: Inputs):
    days = cohorts.customer_days(i.facts, by=["location"], gross="gross_before_discount")
    return cohorts.cohort_cells(days, by=["location"], gross=True) \
        .select("initial_cohort", "status", "since_first_order", "location", "revenue")


@query("AGG6_strict_min_max")
def _(i: Inputs):
    return i.flat("customer_id", "location", "user_agent").groupBy("customer_id").agg(
        fn.strict_min("location").alias("city"),
        fn.strict_max(fn.device_class("user_agent")).alias("device"))


@query("AGG7_median_global", gap=6)
def _(i: Inputs):
    gaps = op.exact_quantiles(i.stage_base.where("orders > 1"), {"gap": [0.5]})
    return gaps.select(F.col("gap")[0].alias("gap"))


@query("AGG8_median_by_group", median=4)
def _(i: Inputs):
    return op.median_by(i.facts, "gross_before_discount", ["location"])


@query("AGG9_mean_by_group", segment_gap=6)
def _(i: Inputs):
    return stages.segment_gaps(i.stage_base)


@query("AGG10_quantiles", value=4)
def _(i: Inputs):
    breaks = rfm.rfm_breaks(i.rfm_base)
    return op.melt_pairs(breaks, [], [(F.lit(m), m) for m in rfm.PROBS],
                         names=("measure", "breaks")) \
        .select("measure", F.posexplode("breaks").alias("position", "value"))


@query("AGG11_first_last_in_group")
def _(i: Inputs):
    first, last = op.first_last("location", ["created_at", "order"])
    return i.flat("customer_id", "order", "created_at", "location").groupBy("customer_id") \
        .agg(first.alias("first_location"), last.alias("last_location"))


@query("AGG12_string_concat_agg")
def _(i: Inputs):
    long = op.explode_named(i.ratings, "topics", ["_id"], ("topic", "mark"))
    return long.groupBy("_id").agg(op.concat_by_group("mark", "topic").alias("marks"))


@query("AGG13_sum_weights", sum_weight=6)
def _(i: Inputs):
    return channels.attribution_long(i.touchpoints())


@query("AGG14_group_by_month", revenue=2)
def _(i: Inputs):
    return i.facts.groupBy(fn.month_of("created_at").alias("month"), "location").agg(
        fn.count_distinct_na("customer").alias("customers"),
        F.sum("is_valid").alias("orders"), F.sum("gross_before_discount").alias("revenue"))


@query("AGG15_frequency_table", share=9)
def _(i: Inputs):
    devices = i.flat("user_agent").select(fn.device_class("user_agent").alias("device"))
    return op.frequency_table(devices, "device")


@query("AGG16_global_totals", gross=2)
def _(i: Inputs):
    return op.control_totals(i.facts, {
        "orders": F.count(F.lit(1)), "valid_orders": F.sum("is_valid"),
        "customers": fn.count_distinct_na("customer"),
        "without_location": F.count_if(F.col("location").isNull()),
        "gross": F.sum("gross_before_discount")})


@query("AGG16_observed_totals", value=6)
def _(i: Inputs):
    """Totals observed in the jobs that write four reports, verified and published."""
    totals = op.Totals()
    for report in (
            rfm.rfm_report(i.facts, i.rows, AS_OF, totals=totals),
            stages.stage_report(i.rows, AS_OF, totals=totals),
            channels.attribution_report(i.orders, i.vouchers, i.entity("funnel"), totals=totals),
            clv.monthly_metrics(i.facts, clv.customer_channels(
                i.customers, channels.first_channel(i.priority())), totals=totals)):
        path = shared_folder(i.spark)
        publish(report, path, fmt="parquet")
        load_table(i.spark, published(i.spark, path)).schema
    values = totals.verify()
    return i.spark.range(1).select(F.explode(F.map_from_arrays(
        F.array(*[F.lit(name) for name in values]),
        F.array(*[F.lit(float(value)) for value in values.values()]))).alias("name", "value"))


# ---- distinct, window, sort, reshape

@query("DED1_dedup_by_key")
def _(i: Inputs):
    return channels.tracker_networks(i.entity("tracker_events"))


@query("DED2_distinct_rows")
def _(i: Inputs):
    return i.entity("funnel").distinct()


@query("DED3_distinct_values")
def _(i: Inputs):
    return op.distinct_values(i.flat("location", "state"), "location", "state")


@query("WIN1_first_value_broadcast")
def _(i: Inputs):
    return cohorts.customer_days(i.cohort_input, "customer_id")


@query("WIN2_share_of_row_total", row_percent=9)
def _(i: Inputs):
    """Share of each state within its location, over the dense table."""
    table = op.crosstab(i.flat("location", "state"), "location", "state")
    total = F.sum("n").over(Window.partitionBy("location"))
    return table.withColumn("row_percent", F.col("n") * 100 / total)


@query("SRT1_sort_desc")
def _(i: Inputs):
    return cohorts.user_retention(i.cohort_input, digits=None).orderBy(
        F.desc("initial_cohort"), F.desc("since_first_order")).drop("percent")


@query("RSH1_pivot_wide")
def _(i: Inputs):
    table = cohorts.user_retention(i.cohort_input)
    return cohorts.cohort_matrix(table, "returning")


@query("RSH2_pivot_flags")
def _(i: Inputs):
    rows = i.flat("order", "service_class").withColumn(
        "token", customer360.service_class("service_class"))
    return op.pivot_flags(rows, ["order"], "token", customer360.SERVICE_CLASSES)


@query("RSH3_pivot_attributes")
def _(i: Inputs):
    return _topics_wide(i)


@query("RSH4_melt_pairs", weight=6)
def _(i: Inputs):
    weighted = channels.fractional_weights(i.touchpoints())
    return op.melt_pairs(weighted, ["order"], [
        ("voucher_channel", "voucher_weight"), ("first_channel", "first_weight"),
        ("last_channel", "last_weight")], position="touchpoint")


@query("RSH5_crosstab")
def _(i: Inputs):
    return op.crosstab(i.flat("location", "state"), "location", "state")


@query("RSH6_explode_array")
def _(i: Inputs):
    one = op.explode_array(i.customers.select("_id", "addresses"), "addresses", "address")
    return one.select(F.col("_id").alias("customer_id"), F.col("address.zip").alias("zip"))


@query("RSH7_explode_named")
def _(i: Inputs):
    return op.explode_named(i.ratings, "topics", ["_id"], ("topic", "mark"))


# ---- scalar functions

@query("FN1_to_date")
def _(i: Inputs):
    text = F.when(F.col("state") != "new", F.date_format("created_at", "yyyy-MM-dd")) \
        .otherwise("no date")
    return i.flat("order", "created_at", "state").select(
        "order", fn.day_of("created_at").alias("day"),
        fn.day_of(text, "yyyy-MM-dd").alias("parsed"))


@query("FN2_month_bucket")
def _(i: Inputs):
    return i.flat("order", "created_at").select("order", fn.month_of("created_at").alias("month"))


@query("FN3_month_offset")
def _(i: Inputs):
    return i.flat("order", "created_at").select(
        "order", fn.month_offset(F.lit(AS_OF), "created_at").alias("months"))


@query("FN4_days_between")
def _(i: Inputs):
    return i.flat("order", "created_at").select(
        "order", fn.days_between(F.lit(AS_OF), "created_at").alias("days"))


@query("FN5_start_of_month")
def _(i: Inputs):
    return i.flat("order", "created_at").select(
        "order", fn.start_of_month("created_at").alias("this_month"),
        fn.start_of_previous_month("created_at").alias("last_month"))


@query("FN6_format_date")
def _(i: Inputs):
    firsts = customer360.order_summary(i.orders)
    return firsts.select("customer_id", fn.format_day("first_order").alias("first_order"),
                         fn.month_label("first_order").alias("label"))


@query("FN7_regex_match")
def _(i: Inputs):
    return i.table("part").select(
        "p_partkey", fn.matches("p_type", ["BRASS", "^STANDARD"]).alias("metal"),
        fn.matches("p_name", "(a|e) ?b").alias("pattern"))


@query("FN8_regex_replace")
def _(i: Inputs):
    return i.customers.select(
        "_id", fn.first_name("person.name").alias("first_name"),
        F.regexp_replace("person.name", "#.*", "").alias("stem"))


@query("FN9_split_pick")
def _(i: Inputs):
    return i.flat("order", "service_class").select(
        "order", customer360.service_class("service_class").alias("token"))


@query("FN10_concat")
def _(i: Inputs):
    return i.customers.select(
        "_id", F.concat_ws("_", F.lit(customer360.SUBSCRIBER_PREFIX), F.col("_id").cast("string"))
        .alias("subscriber_key"))


@query("FN11_ascii_fold")
def _(i: Inputs):
    accents = F.concat(F.lit("Žofie Ångström-Müller "), "person.name")
    return i.customers.select("_id", fn.fold_ascii(accents).alias("name"))


@query("FN12_empty_fallback")
def _(i: Inputs):
    """Zip of the first address; if it is empty, that of the second."""
    first, second = (F.get("addresses", F.lit(n))["zip"] for n in (0, 1))
    return i.customers.select(F.col("_id").alias("customer_id"),
                              fn.empty_fallback(first, second).alias("zip"))


@query("FN13_null_fill", gross=2)
def _(i: Inputs):
    df = i.facts.select("order", "location", F.col("gross_before_discount").alias("gross"))
    return op.fill_na(df, 0, "not set")


@query("FN14_null_fill_from_column")
def _(i: Inputs):
    return i.flat("order", "voucher_code", "state", "provider").select(
        "order", fn.fill_from("voucher_code", "provider").alias("code"))


@query("FN15_value_replace")
def _(i: Inputs):
    return i.entity("funnel").replace("(unavailable)", channels.NOT_SET,
                                      ["first_channel", "last_channel"])


@query("FN16_round")
def _(i: Inputs):
    price = F.col("o_totalprice")
    return i.table("orders").select(
        "o_orderkey", fn.round_half_even(price / 7, 0).alias("whole"),
        fn.round_half_even(price / 7, 2).alias("cents"),
        fn.round_half_even(F.col("o_orderkey") / 2, 0).alias("half"))


@query("FN17_ratio", ratio=6)
def _(i: Inputs):
    return i.table("orders").select(
        "o_orderkey", fn.ratio("o_totalprice", F.col("o_orderkey") % 4).alias("ratio"))


@query("FN18_bin_by_breaks")
def _(i: Inputs):
    parts = i.table("part")
    breaks = op.exact_quantiles(parts, {"p_size": [0, 0.2, 0.4, 0.6, 0.8, 1]}) \
        .select("p_size").scalar()
    return parts.withColumn("breaks", breaks).select(
        "p_partkey", fn.bin_index("p_size", F.col("breaks"), 5).alias("bin"))


@query("FN19_equal_width_breaks")
def _(i: Inputs):
    parts = i.table("part")
    span = parts.agg(F.struct(F.min("p_size").alias("low"), F.max("p_size").alias("high"))
                     .alias("span")).scalar()
    return parts.withColumn("span", span).select(
        "p_partkey", fn.equal_width_bin("p_size", "span.low", "span.high", 5).alias("bin"))


@query("FN20_recode")
def _(i: Inputs):
    return i.table("orders").select(
        "o_orderkey", fn.recode("o_orderstatus", {"F": "finished", "O": "open"}).alias("label"))


@query("FN21_cast_numeric")
def _(i: Inputs):
    rows = i.flat("order", "voucher_code", "user_agent").select(
        "order", F.substring("voucher_code", 2, 9).alias("number"),
        F.col("user_agent").alias("text"), F.col("user_agent").isNull().alias("flag"))
    return fn.cast_numeric(rows, ["number", "text", "flag"])


@query("FN22_cast_string")
def _(i: Inputs):
    return i.table("orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("label"))


@query("FN23_currency_convert", gross_after=2, gross_before=2, net_after=2, net_before=2)
def _(i: Inputs):
    return i.facts.select("order", *[F.col(f"{k}_discount").alias(k) for k in
                                     ("gross_after", "gross_before", "net_after", "net_before")])


@query("FN24_array_len_is_null")
def _(i: Inputs):
    return i.customers.select("_id", F.col("addresses").isNull().alias("missing"),
                              F.size("addresses").alias("n_raw")) \
        .select("_id", "missing", F.when(~F.col("missing"), F.col("n_raw")).alias("n"))


# ---- reports

@query("BIZ1_order_facts", net_after=2, net_before=2, gross_after=2, gross_before=2,
       exchange_rate=4)
def _(i: Inputs):
    return i.facts.drop("rate_date", "invoice", "order_id").withColumnsRenamed(
        {name: name.removesuffix("_discount") for name in facts.AMOUNTS})


@query("BIZ2_rfm_base", amount=6)
def _(i: Inputs):
    return i.rfm_base


@query("BIZ3_rfm_rank", amount=6)
def _(i: Inputs):
    return rfm.rfm_rank(op.hold(i.rfm_base))


@query("BIZ4_rfm_points", amount=6)
def _(i: Inputs):
    return rfm.rfm_points(op.hold(i.rfm_base))


@query("BIZ5_rfm_class", amount=6)
def _(i: Inputs):
    return rfm.rfm_class(op.hold(i.rfm_base))


@query("BIZ6_rfm_report", amount=6)
def _(i: Inputs):
    return rfm.rfm_report(i.facts, i.rows, AS_OF, ordered=True)


@query("BIZ7_device_class")
def _(i: Inputs):
    return i.flat("order", "user_agent").select(
        "order", fn.device_class("user_agent").alias("device"))


@query("BIZ8_service_class_counts")
def _(i: Inputs):
    return customer360.service_class_counts(i.unlocated)


@query("BIZ9_order_summary")
def _(i: Inputs):
    return customer360.order_summary(i.orders)


@query("BIZ10_customer_address")
def _(i: Inputs):
    return customer360.customer_address(i.customers)


@query("BIZ11_customer_status")
def _(i: Inputs):
    summary = customer360.order_summary(i.orders)
    return summary.select(
        "customer_id", customer360.customer_status("valid_orders").alias("customer_status"))


@query("BIZ12_rating_features")
def _(i: Inputs):
    return customer360.rating_features(i.unlocated, i.ratings)


@query("BIZ13_last_notification")
def _(i: Inputs):
    return customer360.last_notification(i.entity("notifications"), ["_id"])


@query("BIZ14_first_provider")
def _(i: Inputs):
    return customer360.first_provider(i.unlocated)


@query("BIZ15_cadence")
def _(i: Inputs):
    return customer360.cadence(customer360.order_summary(i.orders), AS_OF).select(
        "customer_id", "days_since_first_order", "individual_frequency", "overtime")


@query("BIZ16_customer_360", branch_credits=2)
def _(i: Inputs):
    return customer360.customer_360(
        i.customers, i.orders, i.ratings, i.entity("notifications"),
        i.entity("branch_credits"), rfm.rfm_report(i.facts, i.rows, AS_OF), AS_OF)


@query("BIZ17_voucher_channel_rules")
def _(i: Inputs):
    return op.left_join(i.flat("order", "voucher_code"), i.vouchers, "voucher_code") \
        .groupBy("voucher_channel").agg(F.count(F.lit(1)).alias("orders"))


@query("BIZ18_touchpoint_join")
def _(i: Inputs):
    return i.touchpoints().select("order", "voucher_channel", "first_channel", "last_channel")


@query("BIZ19_fractional_weights", voucher_weight=6, first_weight=6, last_weight=6,
       rest_weight=6)
def _(i: Inputs):
    return channels.fractional_weights(i.touchpoints()).select(
        "order", "voucher_weight", "first_weight", "last_weight", "rest_weight")


@query("BIZ20_attribution_long", sum_weight=6)
def _(i: Inputs):
    return channels.attribution_long(i.touchpoints())


@query("BIZ21_attribution_report", sum_weight=6)
def _(i: Inputs):
    return channels.attribution_report(i.orders, i.vouchers, i.entity("funnel"))


@query("BIZ22_ga_channel")
def _(i: Inputs):
    return channels.web_channels(i.entity("web_analytics"))


@query("BIZ23_channel_priority")
def _(i: Inputs):
    return i.priority(recoded=False).select("order", "channel")


@query("BIZ24_channel_cascade")
def _(i: Inputs):
    return i.priority().select("order", "channel")


@query("BIZ25_cohort_base")
def _(i: Inputs):
    rows = i.flat("order", "customer_id", "created_at", "state")
    return cohorts.cohort_rows(rows, "customer_id").select(
        "order", "customer_id", "first_order", "initial_cohort", "since_first_order", "status")


@query("BIZ26_user_retention_long")
def _(i: Inputs):
    return cohorts.user_retention(i.cohort_input)


@query("BIZ27_user_retention_matrix")
def _(i: Inputs):
    table = cohorts.user_retention(i.cohort_input)
    return cohorts.cohort_matrix(table, "percent", labels=True)


@query("BIZ28_user_retention_by_city")
def _(i: Inputs):
    return cohorts.user_retention(i.city_input, by=["location"])


@query("BIZ28_user_retention_sets")
def _(i: Inputs):
    """Overall and by-city cells of one scan."""
    return cohorts.user_retention(i.city_input, by=["location"], sets=True)


@query("BIZ28_user_retention_sets_matrix")
def _(i: Inputs):
    """Overall and by-city matrices of one scan."""
    table = cohorts.user_retention(i.city_input, by=["location"], sets=True)
    return cohorts.cohort_matrix(table, "percent", by=["grouping_id", "location"])


@query("BIZ29_revenue_retention_long", returning=2, initial=2, percent=6)
def _(i: Inputs):
    return cohorts.revenue_retention(i.facts, digits=None)


@query("BIZ29_revenue_retention_matrix")
def _(i: Inputs):
    table = cohorts.revenue_retention(i.facts, by=["location"], digits=None)
    table = tidy(cohorts.city_rows(table.drop("returning", "initial")), percent=6)
    return cohorts.cohort_matrix(table, "percent", by=["location"])


@query("BIZ29_revenue_retention_sets", returning=2, initial=2, percent=6)
def _(i: Inputs):
    """Overall and by-city cells of one scan."""
    return cohorts.revenue_retention(i.facts, by=["location"], digits=None, sets=True)


@query("BIZ29_revenue_retention_by_city", returning=2, initial=2, percent=6)
def _(i: Inputs):
    return cohorts.revenue_retention(i.facts, by=["location"], digits=None)


@query("BIZ30_orders_per_user_long")
def _(i: Inputs):
    return cohorts.orders_per_user(i.rows)


@query("BIZ30_orders_per_user_matrix")
def _(i: Inputs):
    table = cohorts.orders_per_user(i.rows)
    return cohorts.cohort_matrix(table, "proportion", labels=True)


@query("BIZ30_orders_per_user_sets")
def _(i: Inputs):
    """Overall and by-city cells of one scan."""
    return cohorts.orders_per_user(i.rows, by=["location"], sets=True)


@query("BIZ30_orders_per_user_by_city")
def _(i: Inputs):
    return cohorts.city_rows(cohorts.orders_per_user(i.rows, by=["location"]), floors=FLOORS)


@query("BIZ31_channel_cohorts")
def _(i: Inputs):
    return channels.channel_cohorts(i.priority())


@query("BIZ32_facility_cohorts")
def _(i: Inputs):
    return facilities.facility_cohorts(i.served(lists=True))


@query("BIZ33_heat_breaks", percent=9)
def _(i: Inputs):
    """By-city cells in the colour buckets of the global cells."""
    cells = cohorts.user_retention(i.cohort_input, digits=None)
    breaks = cohorts.heat_breaks(cells).scalar()
    cities = cohorts.user_retention(i.city_input, by=["location"], digits=None)
    return cities.withColumn("breaks", breaks).select(
        "initial_cohort", "since_first_order", "location", "percent",
        cohorts.heat_bucket("percent", F.col("breaks")).alias("bucket"))


@query("BIZ34_stage_base", gap=6)
def _(i: Inputs):
    return i.stage_base


@query("BIZ35_gap_imputation", gap=6, segment_gap=6, filled_gap=6)
def _(i: Inputs):
    return stages.impute_gaps(op.hold(i.stage_base))


@query("BIZ36_lifecycle_stage", gap=6, segment_gap=6, filled_gap=6)
def _(i: Inputs):
    return stages.stage_report(i.rows, AS_OF)


@query("BIZ37_stage_distribution", share=9)
def _(i: Inputs):
    return stages.stage_distribution(stages.stage_report(i.rows, AS_OF))


@query("BIZ38_stage_at_cutoffs", gap_before=6, gap_after=6)
def _(i: Inputs):
    return stages.transition_report(i.rows, TRANSITION_AS_OF).drop("location")


@query("BIZ39_transition_matrix", row_percent=9)
def _(i: Inputs):
    return stages.transition_matrix(stages.transition_report(i.rows, TRANSITION_AS_OF))


@query("BIZ40_transition_report")
def _(i: Inputs):
    return stages.transition_report(i.rows, TRANSITION_AS_OF).select(
        "customer", "former_stage", "new_stage", "location")


@query("BIZ41_customer_lifespan")
def _(i: Inputs):
    return i.lifespans()


@query("BIZ42_lifespan_by_city", lifespan=6, overall=6)
def _(i: Inputs):
    lifespans = op.hold(i.lifespans())
    return clv.lifespan_by_city(lifespans).withColumn(
        "overall", clv.average_lifespan(lifespans))


def _monthly(i: Inputs) -> DataFrame:
    bridge = clv.customer_channels(i.customers, channels.first_channel(i.priority()))
    return clv.monthly_metrics(i.facts, bridge)


@query("BIZ43_orders_per_user_monthly", orders_per_user=9)
def _(i: Inputs):
    return _monthly(i).select("month", "location", "first_channel", "customers", "orders",
                              "orders_per_user")


@query("BIZ44_aov_monthly", gross=2, aov=2)
def _(i: Inputs):
    return _monthly(i).select("month", "location", "first_channel", "gross", "priced_orders",
                              "aov")


@query("BIZ45_clv", gross=2, orders_per_user=9, aov=2, lifespan=6, final_lifespan=6, clv=2)
def _(i: Inputs):
    stage_rows = stages.stage_report(i.rows, AS_OF)
    return clv.clv_report(i.facts, i.customers, stage_rows, channels.first_channel(i.priority()))
