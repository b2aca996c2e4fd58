"""Hot keys, partitioning independence and plan shapes."""

import random
import re
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from checks.queries import Inputs
from patronflow import operators as op
from patronflow.plans import channels, cohorts, stages

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all orders belongs to one customer, a third to none."""
    rng = random.Random(11)
    data = []
    for i in range(3000):
        customer = ("hot", None, f"c{rng.randrange(80)}")[i % 3]
        day = datetime(2020, 1, 1) + timedelta(days=rng.randrange(400), hours=rng.randrange(24))
        state = rng.choice(["completed", "completed", "processing", "new"])
        data.append((i, customer, day, state, rng.choice(["x", "y", None])))
    df = spark.createDataFrame(
        data, "order long, customer_id string, created_at timestamp, state string, "
        "location string")
    return data, df.repartition(16)


def brute_retention(data):
    first = {}
    for _, c, t, s, _ in data:
        if s != "new":
            first[c] = min(first.get(c, t.date()), t.date())
    initial, returning = defaultdict(set), defaultdict(set)
    for _, c, t, s, _ in data:
        if s == "completed":
            f, d = first[c], t.date()
            cohort = f.replace(day=1)
            if d > f:
                returning[cohort, (d.year - f.year) * 12 + d.month - f.month].add(c)
            else:
                initial[cohort].add(c)
    return {k: (len(v), len(initial[k[0]]) or None) for k, v in returning.items()}


def test_retention_with_hot_customers_matches_brute_force(skewed):
    data, df = skewed
    got = {(r.initial_cohort, r.since_first_order): (r.returning, r.initial)
           for r in cohorts.user_retention(df).collect()}
    assert got == brute_retention(data)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_see_aggregated_rows_only(skewed):
    """Below each window over customers there is an aggregate by day."""
    plan = plan_of(cohorts.user_retention(skewed[1]))
    deepest = plan[plan.rindex("Window"):]
    assert "HashAggregate(keys=[customer_id" in deepest and "partial_count" in deepest


def test_hot_key_of_a_row_level_join_is_split(spark, skewed):
    data, df = skewed
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000b",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1000b",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        done = cohorts.cohort_rows(df, "customer_id")
        got = done.collect()
        assert "skew=true" in plan_of(done)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert len(got) == sum(1 for r in data if r[3] == "completed")
    first = {}
    for _, c, t, s, _ in data:
        if s != "new":
            first[c] = min(first.get(c, t.date()), t.date())
    assert all(r.first_order == first[r.customer_id] for r in got)


@pytest.mark.parametrize("build", [
    lambda df: cohorts.user_retention(df, by=["location"]),
    lambda df: cohorts.label_cohorts(df.withColumn("l", F.col("location")), "l", "first"),
    lambda df: stages.transition_report(
        df.withColumn("customer", F.col("customer_id")).withColumn(
            "is_valid", F.when(F.col("state") == "new", 0).otherwise(1)), date(2020, 12, 5),
        keep=op.lazily),
], ids=["retention", "labels", "transitions"])
def test_results_do_not_depend_on_partitioning(skewed, build, rows):
    df = skewed[1]
    assert rows(build(df.repartition(3, "state"))) == rows(build(df.coalesce(1)))


def test_scans_are_pruned(spark):
    inputs = Inputs(spark, SF)
    plan = plan_of(cohorts.user_retention(inputs.cohort_input))
    read = set(re.findall(r"ReadSchema: struct<([^>]*)>", plan))
    assert read == {"o_custkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz,"
                    "o_orderpriority:string"}


def test_no_unbounded_cross_join_or_python_worker(spark):
    inputs = Inputs(spark, SF)
    for df in (channels.attribution_report(inputs.orders, inputs.vouchers,
                                           inputs.entity("funnel")),
               channels.channel_cohorts(inputs.priority()),
               cohorts.revenue_retention(inputs.facts, by=["location"])):
        plan = plan_of(df)
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        assert "Python" not in plan and "Pandas" not in plan


def test_quantile_branches_share_their_exchange(spark):
    df = op.hold(spark.range(2000).select((F.col("id") % 97).cast("double").alias("x")))
    done = op.exact_quantiles(df, {"x": [0.1, 0.5]})
    done.collect()
    assert plan_of(done).count("ReusedExchange") >= 2
