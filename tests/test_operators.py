"""Joins, quantiles, reshaping, sources and sinks on small tables."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from patronflow import operators as op
from patronflow.session import shared_folder
from patronflow.sources import save_table, scan, scan_delimited, schemas, write_report


def test_missing_keys_match(spark, rows):
    left = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a int")
    right = spark.createDataFrame([(None, 10)], "k string, b int")
    assert rows(op.left_join(left, right, "k")) == [("x", 2, None), (None, 1, 10)]


def test_repeated_right_keys_multiply_and_can_be_refused(spark):
    left = spark.createDataFrame([("x", 1)], "k string, a int")
    right = spark.createDataFrame([("x", 1), ("x", 2)], "k2 string, b int")
    assert op.left_join(left, right, {"k": "k2"}).count() == 2
    with pytest.raises(ValueError, match="repeats"):
        op.left_join(left, right, {"k": "k2"}, validate="m:1")


def test_join_refuses_name_clashes(spark):
    left = spark.createDataFrame([("x", 1)], "k string, a int")
    with pytest.raises(ValueError, match="rename"):
        op.left_join(left, left, "k")


def test_right_join_keeps_right_rows(spark, rows):
    left = spark.createDataFrame([("x", 1)], "k string, a int")
    right = spark.createDataFrame([("x", 5), ("y", 6)], "k string, b int")
    assert rows(op.right_join(left, right, "k").select("k", "a", "b")) == [
        ("x", 1, 5), ("y", None, 6)]


def type7(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    low = int(at)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (at - low)


def test_quantiles_by_hand(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (2.0,), (4.0,), (10.0,), (None,)], "x double")
    got = op.exact_quantiles(df, {"x": [0, 0.1, 0.55, 1]}).collect()[0].x
    assert got == pytest.approx([1, 1, 2.4, 10])


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert op.exact_quantiles(df, {"x": [0.5]}).collect()[0].x is None
    assert spark.range(1).select(op.global_median(df, "x").alias("m")).collect()[0].m is None


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.integers(-5, 5).map(float),
                          st.floats(-1e6, 1e6, allow_nan=False)), min_size=1, max_size=60),
       st.sampled_from([2, 7, 256]))
def test_quantiles_are_exact(spark, values, fan_out):
    probs = [0, 0.1, 0.25, 0.5, 0.55, 0.9, 1]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = op.exact_quantiles(df, {"x": probs}, fan_out=fan_out).collect()[0].x
    assert got == pytest.approx([type7(values, p) for p in probs], rel=1e-9, abs=1e-9)


def test_quantiles_by_group_with_a_hot_value(spark):
    rng = random.Random(3)
    data = [("a" if rng.random() < 0.8 else None, 1.0 if rng.random() < 0.4 else rng.random() * 9)
            for _ in range(3000)]
    df = spark.createDataFrame(data, "k string, x double")
    got = {r.k: r.median for r in op.median_by(df, "x", ["k"]).collect()}
    for key in ("a", None):
        assert got[key] == pytest.approx(type7([x for k, x in data if k == key], 0.5))


def test_first_by_key_keeps_a_missing_key(spark, rows):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, None), (None, 5, "z"), (None, 4, "w")],
                               "k string, o int, v string")
    assert rows(op.first_by_key(df, ["k"], ["o"])) == [("a", 1, None), (None, 4, "w")]


def test_frequency_table_leaves_missing_out(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string")
    assert rows(op.frequency_table(df, "x")) == [("a", 2, pytest.approx(2 / 3)),
                                                 ("b", 1, pytest.approx(1 / 3))]


def test_flatten(spark):
    df = spark.createDataFrame([((1, (2, "x")), 3)], "a struct<b: int, c: struct<d: int, e: string>>, f int")
    flat = op.flatten_structs(df)
    assert flat.columns == ["a_b", "a_c_d", "a_c_e", "f"]
    assert tuple(flat.collect()[0]) == (1, 2, "x", 3)


def test_pivot_fixed_and_found_columns(spark, rows):
    df = spark.createDataFrame([("r", 0, 1.5), ("r", 2, 2.5), ("s", 2, 3.5)],
                               "i string, c int, v double")
    fixed = op.pivot_wide(df, ["i"], "c", "v", [0, 1, 2], "m")
    assert fixed.columns == ["i", "m0", "m1", "m2"]
    assert rows(fixed) == [("r", 1.5, None, 2.5), ("s", None, None, 3.5)]
    assert op.pivot_wide(df, ["i"], "c", "v").columns == ["i", "0", "2"]


def test_crosstab_is_dense_over_observed_values(spark, rows):
    df = spark.createDataFrame([("1A", "1A"), ("2", "3"), ("2", "3"), (None, "3"), ("2", None)],
                               "former string, new string")
    got = rows(op.crosstab(df, "former", "new"))
    assert got == [("1A", "1A", 1), ("1A", "3", 0), ("2", "1A", 0), ("2", "3", 2)]


def test_explode_and_concat(spark, rows):
    df = spark.createDataFrame([("a", ["x", "y"]), ("b", None), ("c", [])],
                               "k string, xs array<string>")
    assert rows(op.explode_array(df, "xs", "x")) == [
        ("a", "x"), ("a", "y"), ("b", None), ("c", None)]
    named = spark.createDataFrame([("a", {"p": "1", "q": "2"}), ("b", None)],
                                  "k string, m map<string, string>")
    long = op.explode_named(named, "m", ["k"])
    assert rows(long) == [("a", "p", "1"), ("a", "q", "2")]
    assert rows(long.groupBy("k").agg(op.concat_by_group("value", "name"))) == [("a", "12")]


def test_pivot_flags_and_fill(spark, rows):
    df = spark.createDataFrame([(1, "A"), (1, "B"), (2, None)], "k int, c string")
    assert rows(op.pivot_flags(df, ["k"], "c", {"A": "a", "B": "b"})) == [(1, 1, 1), (2, 0, 0)]
    gaps = spark.createDataFrame([(None, None)], "n double, t string")
    assert rows(op.fill_na(gaps, 0, "not set")) == [(0.0, "not set")]


def test_delimited_round_trip(spark, rows):
    df = spark.createDataFrame([("1", "a;b", None), ("2", "", "Z")], schemas.FUNNEL)
    path = shared_folder(spark)
    write_report(df, path, sep=";")
    assert rows(scan_delimited(spark, path, schemas.FUNNEL)) == rows(df)


def test_nested_documents_scan_only_named_fields(spark):
    path = shared_folder(spark)
    df = spark.createDataFrame(
        [("1", ("UA",), "completed"), ("2", (None,), "new")],
        "_id string, createdBy struct<userAgent: string>, state string")
    df.write.json(path + "/json")
    got = scan(spark, path + "/json", ["_id", "createdBy.userAgent"],
               where=F.col("state") == "completed", fmt="json", schema=schemas.ORDERS)
    assert [tuple(r) for r in got.collect()] == [("1", "UA")]
    save_table(df, path + "/parquet")
    pruned = scan(spark, path + "/parquet", ["createdBy.userAgent"], where="state = 'new'")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(state,new)" in plan
    assert "_id" not in plan
