"""Missing-key lookups, text codes, data-driven tables and grouping sets."""

import random
import re
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES, Inputs
from patronflow import functions as fn
from patronflow import operators as op
from patronflow.plans import channels, clv, cohorts, customer360, stages

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- joins -------------------------------------------------------------------------

@pytest.mark.parametrize("kind,keys", [
    ("string", ["x", "y", "z", None]), ("long", [1, 2, 3, None]), ("int", [1, 2, 3, None])])
def test_lookup_joins_as_null_safe_equality(spark, rows, kind, keys):
    left = spark.createDataFrame([(k, n) for n, k in enumerate(keys * 3)], f"k {kind}, a int")
    right = spark.createDataFrame([(keys[0], 10, "p"), (None, 20, None), (keys[2], None, "q")],
                                  f"j {kind}, b int, c string")
    want = rows(op.left_join(left, right, {"k": "j"}))
    assert (None, 3, 20, None) in want
    for spread in ([], ["a"]):
        assert rows(op.left_join(left, right, {"k": "j"}, missing="lookup", spread=spread)) == want
    alone = right.where("j IS NOT NULL")
    want = rows(op.left_join(left, alone, {"k": "j"}))
    assert rows(op.left_join(left, alone, {"k": "j"}, missing="lookup")) == want
    assert rows(op.left_join(left, alone, {"k": "j"}, missing="never")) == want
    empty = right.limit(0)
    assert rows(op.left_join(left, empty, {"k": "j"}, missing="lookup")) == \
        rows(op.left_join(left, empty, {"k": "j"}))


def test_lookup_refuses_what_it_cannot_do(spark):
    left = spark.createDataFrame([(None, 1, 2.0)], "k string, a int, d double")
    right = spark.createDataFrame([(None, 1), (None, 2)], "k string, b int")
    with pytest.raises(Exception, match="several rows without"):
        op.left_join(left, right, "k", missing="lookup").collect()
    with pytest.raises(ValueError, match="one key"):
        op.left_join(left, right.withColumnRenamed("b", "a"), ["k", "a"], missing="lookup")
    with pytest.raises(ValueError, match="missing must"):
        op.left_join(left, right, "k", missing="drop")
    with pytest.raises(ValueError, match="spread"):
        op.left_join(left, right.select(F.lit(1.0).alias("d"), "b"), "d", missing="lookup",
                     spread=["a"])


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def exchanges(df) -> int:
    return len(re.findall("Exchange hashpartitioning", plan_of(df)))


def test_a_grouped_side_is_not_exchanged_again(spark, no_broadcast):
    left = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
    right = spark.range(50).groupBy((F.col("id") % 9).alias("k")).agg(F.max("id").alias("top"))
    safe = plan_of(op.left_join(left, right, "k"))
    plan = plan_of(op.left_join(left, right, "k", missing="lookup"))
    again = r"Exchange hashpartitioning\(coalesce"
    assert len(re.findall(again, safe)) == 2 and not re.findall(again, plan)
    # The left side, the aggregate, and the aggregate over rows without key.
    assert len(re.findall("Exchange hashpartitioning", plan)) == 3


def test_rows_without_key_are_spread(spark, no_broadcast):
    """A third of the rows has no key: no task joins more than a part of them."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(9000).select(
            F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), F.col("id").alias("a"))
        right = left.groupBy("k").agg(F.count("a").alias("n"))
        for spread in ([], ["a"]):
            done = op.left_join(left, right, "k", missing="lookup", spread=spread)
            placed = done.select(F.spark_partition_id().alias("p"), "n")
            sizes = [r[1] for r in placed.groupBy("p").agg(F.count("n")).collect()]
            assert sum(sizes) == 9000 and (max(sizes) < 3500) == bool(spread)
            assert done.where("k IS NULL").agg(F.min("n"), F.count("n")).first()[:] == (3000, 3000)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_attribution_reads_orders_once(spark, no_broadcast):
    """The null-safe form had 32 exchanges over four scans of the orders."""
    i = Inputs(spark, SF)
    report = channels.attribution_report(i.orders, i.vouchers, i.entity("funnel"))
    points = plan_of(i.touchpoints(located=True))
    assert exchanges(report) <= 6
    assert exchanges(report) + len(re.findall("Exchange hashpartitioning", points)) <= 19
    assert "orders.parquet" not in plan_of(report)


def test_orders_without_reference_share_their_weights(spark):
    """Missing order references are one key, as in the null-safe join."""
    orders = spark.createDataFrame(
        [(None, "a", datetime(2020, 1, 1), "completed", None, None),
         (None, "b", datetime(2020, 1, 2), "completed", None, None),
         ("1", "a", datetime(2020, 1, 3), "completed", None, None)],
        "reference string, customer string, createdAt timestamp, state string, "
        "locationIdentifier string, voucherCode string").withColumn(
        "createdBy", F.struct(F.lit(None).cast("string").alias("userAgent")))
    vouchers = spark.createDataFrame([], "voucher_code string, voucher_channel string")
    funnel = spark.createDataFrame([(None, "email", None), ("1", "Direct", "Direct")],
                                   "order_reference string, first_channel string, last_channel string")
    got = {(r.customer_id, r.order, r.final_channel, r.sum_weight) for r in
           channels.attribution_report(orders, vouchers, funnel).collect() if r.sum_weight}
    assert got == {("a", "1", "Direct", 1.0), ("a", None, "CRM-Journey", 2.0),
                   ("b", None, "CRM-Journey", 2.0)}


def test_one_channel_per_reference(spark, rows):
    customers = spark.createDataFrame([("1", "R"), ("2", "R"), ("3", None), ("4", None), ("5", "S")],
                                      "_id string, reference string")
    firsts = spark.createDataFrame([("1", "SEM"), ("2", "SEO"), ("4", "CC")],
                                   "customer_id string, first_channel string")
    assert rows(clv.customer_channels(customers, firsts)) == [
        ("R", "SEM"), ("S", None), (None, None)]


# --- codes -------------------------------------------------------------------------

def test_codes_pick_as_texts_do(spark, rows):
    rng = random.Random(4)
    texts = ["b", "a", "Z", "é", "z", "", "日本", "\U0001f600", "aa", None]
    data = [(rng.randrange(40), rng.choice(texts), rng.choice([None, rng.randrange(5)]),
             rng.choice([None, datetime(2020, 1, 1) + timedelta(days=rng.randrange(3))]))
            for _ in range(400)]
    df = spark.createDataFrame(data, "g int, t string, n long, at timestamp")
    order = F.struct("at", "n", "t")
    for most in (256, 3):
        codes = op.text_codes(df, {"t": "t"}, most)
        assert (codes.values["t"] is None) == (most == 3)
        got = df.groupBy("g").agg(codes.strict_min("t"), codes.strict_max("t"))
        want = df.groupBy("g").agg(fn.strict_min("t"), fn.strict_max("t"))
        assert rows(got) == rows(want)
        assert ("SortAggregate" in plan_of(got)) == (most == 3)
    unique = df.groupBy("g", "at", "n").agg(F.min("t").alias("t"))
    codes = op.text_codes(unique, {"t": "t"})
    got = unique.groupBy("g").agg(codes.first_by("t", op.packed_order(unique, "at", "n")).alias("t"))
    assert rows(got) == rows(unique.groupBy("g").agg(F.min_by("t", order).alias("t")))
    assert "SortAggregate" not in plan_of(unique.groupBy("g").agg(
        codes.first_by("t", op.packed_order(unique, "at", "n")))).split("HashAggregate")[0]


def test_a_new_text_fails_instead_of_vanishing(spark):
    df = spark.createDataFrame([(1, "a")], "g int, t string")
    codes = op.text_codes(df, {"t": "t"})
    with pytest.raises(Exception, match="not there before"):
        df.withColumn("t", F.lit("b")).groupBy("g").agg(codes.strict_min("t")).collect()


def test_customer_features_hash_the_raw_orders(spark):
    i = Inputs(spark, SF)
    assert "SortAggregate(key=[customer_id" not in plan_of(
        customer360.customer_features(i.orders, i.ratings))
    assert "SortAggregate" not in plan_of(customer360.order_summary(i.orders))


# --- tables with columns from the data ----------------------------------------------

def test_matrix_keeps_late_offsets(spark):
    """An offset of 90 months has its column; the plan below the pivot runs once."""
    data = [("a", datetime(2010, 1, 5), "completed"), ("a", datetime(2017, 7, 5), "completed"),
            ("b", datetime(2010, 1, 6), "completed")]
    df = spark.createDataFrame(data, "customer_id string, created_at timestamp, state string")
    runs = []

    def keep(cells):
        runs.append(1)
        return op.hold(cells)

    table = cohorts.user_retention(df)
    wide = op.pivot_wide(table, ["initial_cohort"], "since_first_order", "returning", prefix="m",
                         keep=keep)
    assert [tuple(r) for r in wide.collect()] == [(date(2010, 1, 1), 1)]
    assert wide.columns == ["initial_cohort", "m90"] and runs == [1]
    empty = op.pivot_wide(table.limit(0), ["initial_cohort"], "since_first_order", "returning")
    assert empty.columns == ["initial_cohort"] and empty.count() == 0


def test_crosstab_forms_agree(spark, rows):
    df = spark.createDataFrame([("x", "a"), ("x", "a"), ("y", "b"), (None, "a"), ("y", None)],
                               "r string, c string")
    want = [("x", "a", 2), ("x", "b", 0), ("y", "a", 0), ("y", "b", 1)]
    assert rows(op.crosstab(df, "r", "c")) == want
    known = op.crosstab(df, "r", "c", categories=["a", "b", "z"])
    assert rows(known) == want
    assert "collect_set" not in plan_of(op.crosstab(df, "r", "c", categories=["a", "b", "z"]))
    assert rows(op.pair_counts(df, "r", "c")) == [("x", "a", 2), ("y", "b", 1)]
    assert rows(op.crosstab(df.limit(0), "r", "c")) == []
    with pytest.raises(ValueError, match="more than 1 values"):
        op.crosstab(df, "r", "c", most=1)
    with pytest.raises(Exception, match="another value"):
        op.crosstab(df, "r", "c", categories=["a"]).collect()


# --- grouping sets ------------------------------------------------------------------

def test_sets_hold_both_reports(spark, rows):
    rng = random.Random(9)
    data = [(f"c{rng.randrange(30)}", datetime(2020, 1, 1) + timedelta(days=rng.randrange(300)),
             "completed", rng.choice(["x", "y", None]), rng.choice([None, 5.0, 7.0, 9.0, 3.0]))
            for _ in range(600)]
    df = spark.createDataFrame(
        data, "customer_id string, created_at timestamp, state string, location string, gross double")
    by = ["location"]
    for build in (lambda by=(), **k: cohorts.user_retention(df, by=by, **k),
                  lambda by=(), **k: cohorts.revenue_retention(df, "customer_id", by, "gross", **k),
                  lambda by=(), **k: cohorts.orders_per_user(df, "customer_id", by, **k)):
        both = build(by, sets=True)
        assert rows(cohorts.of_level(both, cohorts.BY)) == rows(build(by))
        overall = cohorts.of_level(both, cohorts.OVERALL)
        assert overall.where("location IS NOT NULL").count() == 0
        assert rows(overall.drop("location")) == rows(build())


def test_sets_scan_and_exchange_customers_once(spark, no_broadcast):
    i = Inputs(spark, SF)
    both = cohorts.user_retention(i.city_input, by=["location"], sets=True)
    one = cohorts.user_retention(i.city_input, by=["location"])
    assert exchanges(both) == exchanges(one)
    assert plan_of(both).count("orders.parquet") == plan_of(one).count("orders.parquet") == 1


def test_transition_table_is_one_aggregate(spark):
    report = spark.createDataFrame([("Stage 2", "Stage 3"), ("Stage 2", "Stage 2")],
                                   "former_stage string, new_stage string")
    got = {(r.former_stage, r.new_stage): (r.n, r.row_percent)
           for r in stages.transition_matrix(report).collect()}
    assert got == {("Stage 2", "Stage 2"): (1, 50.0), ("Stage 2", "Stage 3"): (1, 50.0)}
    assert "collect_set" not in plan_of(stages.transition_matrix(report))


def test_by_city_sets_are_registered():
    assert {"BIZ28_user_retention_sets", "BIZ28_user_retention_sets_matrix",
            "BIZ29_revenue_retention_sets", "BIZ30_orders_per_user_sets"} <= set(QUERIES)
