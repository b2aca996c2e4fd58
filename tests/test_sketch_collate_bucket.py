"""Sketch quantiles, collated picks and bucketed hand-offs."""

import bisect
import random
import re

import pytest
from pyspark.sql import functions as F

from patronflow import functions as fn
from patronflow import operators as op
from patronflow.plans import channels, clv, rfm


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_groups_are_exact(spark, rows):
    rng = random.Random(2)
    data = [(rng.choice(["a", "b", None]), rng.choice([None, rng.random(), 1.0])) for _ in range(900)]
    data += [("empty", None)]
    df = spark.createDataFrame(data, "k string, x double")
    probs = {"x": [0, 0.1, 0.5, 0.55, 0.95, 1]}
    got = {r.k: r.x for r in op.sketch_quantiles(df, probs, by=["k"]).collect()}
    want = {r.k: r.x for r in op.exact_quantiles(df, probs, by=["k"]).collect()}
    assert got.pop("empty") is None and set(got) == set(want)
    for key, values in want.items():
        assert got[key] == pytest.approx(values)
    assert op.sketch_quantiles(df.limit(0), probs).collect()[0].x is None


@pytest.mark.parametrize("accuracy", [0.02, 0.005])
def test_rank_error_is_bounded(spark, accuracy):
    """A skewed column far larger than the sketch, with a value a fifth of the rows share."""
    df = spark.range(200_000).select(F.when(F.col("id") % 5 == 0, 7.0).otherwise(
        F.pow(F.pmod(F.xxhash64("id"), F.lit(100_003)) / 1000.0, 2)).alias("x"))
    probs = [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]
    assert op.sketch_size(accuracy) < 2000
    got = op.sketch_quantiles(df, {"x": probs}, accuracy=accuracy).collect()[0].x
    values = sorted(r[0] for r in df.collect())
    for p, v in zip(probs, got):
        low, high = (f(values, v) / len(values) for f in (bisect.bisect_left, bisect.bisect_right))
        assert low - accuracy <= p <= high + accuracy
    exact = op.exact_quantiles(df, {"x": probs}).collect()[0].x
    for p, v in zip(probs, exact):
        assert bisect.bisect_left(values, v) / len(values) <= p + 1e-5


def test_accuracy_has_a_bound():
    for bad in (0, -1, 1e-6):
        with pytest.raises(ValueError):
            op.sketch_size(bad)


def test_collated_picks(spark):
    data = [("1", t) for t in ("Zebra", "apfel", "Äpfel", "banane")] + [("2", "b"), ("2", "B"), ("2", "a"),
                                                                         ("3", "x"), ("3", None)]
    df = spark.createDataFrame(data, "customer string, location string")

    def picks(collate):
        got = df.groupBy("customer").agg(fn.strict_min("location", collate).alias("low"),
                                         fn.strict_max("location", collate).alias("high"))
        return {r.customer: (r.low, r.high) for r in got.collect()}

    assert picks(None) == {"1": ("Zebra", "Äpfel"), "2": ("B", "b"), "3": (None, None)}
    assert picks("UNICODE") == {"1": ("apfel", "Zebra"), "2": ("a", "B"), "3": (None, None)}
    # Equal under the collation: the order of the bytes decides.
    assert picks("UNICODE_CI")["2"] == ("a", "b")
    assert {r.customer: r.location for r in rfm.customer_city(df, "de").collect()} == {
        "1": "apfel", "2": "a", "3": None}
    assert {r.customer: r.location for r in rfm.customer_city(df).collect()}["1"] == "Zebra"
    order = [r.location for r in df.where("customer = '1'").orderBy(
        fn.collated("location", "de")).collect()]
    assert order == ["apfel", "Äpfel", "banane", "Zebra"]
    funnel = spark.createDataFrame([("o", "email", "b"), ("o", "Direct", "A")],
                                   "order_reference string, first_channel string, last_channel string")
    assert channels.funnel_channels(funnel).collect()[0][1:] == ("Direct", "A")
    assert channels.funnel_channels(funnel, "UNICODE").collect()[0][1:] == ("Direct", "A")


def test_bucketed_tables_join_as_they_lie(spark, rows):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        stage_rows = spark.range(300).select(
            F.when(F.col("id") % 10 > 0, F.concat(F.lit("c"), F.col("id") % 40)).alias("customer"),
            F.lit("x").alias("location"), F.col("id").alias("orders"), F.lit("Stage 3").alias("stage"),
            F.lit("2020-01-01").cast("date").alias("first_order"),
            F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("last_order"))
        firsts = spark.range(40).select(
            F.when(F.col("id") > 0, F.concat(F.lit("c"), "id")).alias("customer"),
            F.concat(F.lit("ch"), "id").alias("first_channel"))
        keep = op.hold_by("customer")
        plain = clv.customer_lifespan(stage_rows, firsts)
        kept = clv.customer_lifespan(keep(stage_rows), keep(firsts))
        moved = [len(re.findall("Exchange hashpartitioning", plan_of(df))) for df in (plain, kept)]
        assert moved == [2, 0]
        assert rows(kept) == rows(plain)
    finally:
        spark.conf.set(name, before)
