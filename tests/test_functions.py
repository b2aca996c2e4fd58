"""Hand-computed values for the column rules."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from patronflow import functions as fn
from patronflow.functions.text import Rule
from patronflow.plans.channels import (PRIORITY_RULES, TOUCHPOINT_RULES, VOUCHER_RULES,
                                       WEB_RULES)


def one(spark, column):
    return spark.range(1).select(column.alias("v")).collect()[0].v


def test_strict_aggregates(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("a", 3), ("b", 2), ("b", 5)],
                               "k string, x int")
    out = {r.k: r for r in df.groupBy("k").agg(
        fn.strict_min("x").alias("lo"), fn.strict_max("x").alias("hi"),
        fn.strict_sum("x").alias("total"), F.min("x").alias("loose")).collect()}
    assert (out["a"].lo, out["a"].hi, out["a"].total, out["a"].loose) == (None, None, None, 1)
    assert (out["b"].lo, out["b"].hi, out["b"].total) == (2, 5, 7)


def test_missing_counts_as_a_distinct_value(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",)], "x string")
    assert df.agg(fn.count_distinct_na("x").alias("n")).collect()[0].n == 2
    assert df.where("x = 'z'").agg(fn.count_distinct_na("x").alias("n")).collect()[0].n == 0


def test_if_na_and_fallback(spark):
    df = spark.createDataFrame([("", "b"), ("a", "b"), (None, "b")], "x string, y string")
    assert [r[0] for r in df.select(fn.empty_fallback("x", "y")).collect()] == ["b", "a", None]


def test_division_by_zero_is_missing(spark):
    assert one(spark, fn.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, fn.ratio(F.lit(0), F.lit(0))) is None
    assert one(spark, fn.ratio(F.lit(1), F.lit(4))) == 0.25


@pytest.mark.parametrize("value, digits, want",
                         [(0.125, 2, 0.12), (0.375, 2, 0.38), (2.5, 0, 2.0), (3.5, 0, 4.0)])
def test_round_half_even(spark, value, digits, want):
    assert one(spark, fn.round_half_even(F.lit(value), digits)) == want


def test_months_and_days(spark):
    late, early = F.lit(date(2001, 3, 1)), F.lit(date(2000, 12, 31))
    assert one(spark, fn.month_offset(late, early)) == 3
    assert one(spark, fn.days_between(late, early)) == 60
    assert one(spark, fn.start_of_previous_month(late)) == date(2001, 2, 1)
    assert one(spark, fn.start_of_month(F.lit(date(2001, 3, 31)))) == date(2001, 3, 1)
    assert one(spark, fn.month_label(late)) == "Mar 2001"
    assert one(spark, fn.format_day(F.lit(None).cast("date"))) == ""
    assert one(spark, fn.day_of(F.lit("no date"), "yyyy-MM-dd")) is None


def test_bins_with_repeated_breaks(spark):
    breaks = F.array(*[F.lit(x) for x in (1, 1, 2, 3, 9, 20)])
    got = [one(spark, fn.bin_index(F.lit(x), breaks, 5)) for x in (1, 2, 20)]
    assert got == [2, 3, 5]


def test_equal_width_bins(spark):
    got = [one(spark, fn.equal_width_bin(F.lit(x), F.lit(20), F.lit(100), 5))
           for x in (20, 35, 36, 84, 100)]
    assert got == [1, 1, 2, 5, 5]
    assert one(spark, fn.equal_width_bin(F.lit(7), F.lit(7), F.lit(7), 5)) == 5


def test_recode_and_split(spark):
    assert one(spark, fn.recode(F.lit(5), {5: "Loyal", 1: "Churned"})) == "Loyal"
    assert one(spark, fn.recode(F.lit(3), {5: "Loyal"})) is None
    assert one(spark, fn.split_pick(F.lit("a-B-c"), "-", 1)) == "B"
    assert one(spark, fn.split_pick(F.lit("a"), "-", 1)) is None


def test_cast_numeric(spark):
    df = spark.createDataFrame([("12", True, 3), ("abc", False, 4)], "a string, b boolean, c int")
    assert [tuple(r) for r in fn.cast_numeric(df, ["a", "b", "c"]).collect()] == [
        (12.0, 1.0, 3.0), (None, 0.0, 4.0)]


def test_fold_ascii(spark):
    assert one(spark, fn.fold_ascii(F.lit("Zoë Müller-Straße Łódź Ærø"))) == \
        "Zoe Muller-Strasse Lodz AEro"


@pytest.mark.parametrize("state, want", [
    ("new", 0), ("payment_authorisation_error", 0), ("canceled", 0), ("reserved", 0),
    ("completed", 1), ("processing", 1), (None, 1)])
def test_valid_order(spark, state, want):
    column = F.lit(state).cast("string")
    assert one(spark, fn.is_valid(column)) == want
    assert spark.range(1).where(fn.valid_only(column)).count() == want


@pytest.mark.parametrize("agent, want", [
    ("App (iPhone)", "iOS app"), ("App (Android)", "android app"),
    ("iPhone Android", "android app"), ("Mozilla/5.0", "web app"), (None, None)])
def test_device_class(spark, agent, want):
    assert one(spark, fn.device_class(F.lit(agent).cast("string"))) == want


def label(spark, value, rules, default="c"):
    df = spark.createDataFrame([(value,)], "c string")
    return df.select(fn.last_match("c", rules, default)).collect()[0][0]


@pytest.mark.parametrize("rule", VOUCHER_RULES, ids=lambda r: r.label)
def test_every_voucher_pattern_selects_its_label_or_a_later_one(spark, rule):
    later = [r.label for r in VOUCHER_RULES[VOUCHER_RULES.index(rule):]]
    df = spark.createDataFrame([(p,) for p in [*rule.patterns, *rule.exact]], "p string")
    got = [r[0] for r in df.select(fn.last_match("p", VOUCHER_RULES, "'Other'")).collect()]
    assert set(got) <= set(later)


@pytest.mark.parametrize("value, want", [
    ("Thank you Free", "Flyering"), ("Print PR", "Print Ads"), ("SEO Website", "SEO"),
    ("CRM", "CRM-Campaign"), ("crm", "Other"), (None, "Other"), ("Mystery", "Other"),
    ("Free Friends SEM", "SEM"), ("Referral", "Refer a Friend")])
def test_voucher_overlaps(spark, value, want):
    assert label(spark, value, VOUCHER_RULES, "'Other'") == want


@pytest.mark.parametrize("value, want", [
    ("Organic Search", "SEO"), ("Paid Search", "SEM"), ("Referral", "Refer a Friend"),
    ("email", "CRM-Journey"), ("Social Network", "Facebook"), ("not set", "not set")])
def test_touchpoint_recodes(spark, value, want):
    assert label(spark, value, TOUCHPOINT_RULES) == want


@pytest.mark.parametrize("value, want", [
    ("Appco/Direct Sales", "Direct"), ("Google Universal App Campaigns", "SEO"),
    ("Organic", "Direct"), ("zanox", "Affiliate"), ("Social_Facebook", "Facebook"),
    ("Social Media Unpaid", "Social Media Unpaid"), ("cpc", "SEM"), ("Other", "Other")])
def test_priority_cascade(spark, value, want):
    df = spark.createDataFrame([(value,)], "c string")
    assert fn.cascade(df, "c", PRIORITY_RULES).collect()[0].c == want


def test_web_patterns_are_regular_expressions(spark):
    df = spark.createDataFrame([("not set at all",), ("(direct)",), ("organic",), (None,)],
                               "c string")
    assert [r.c for r in fn.cascade(df, "c", WEB_RULES).collect()] == [
        "Direct", "Direct", "SEO", None]


def test_special_characters_in_rules(spark):
    rules = [Rule("it's", ["a+b"]), Rule("x", ["it's"], exact=["back\\slash"]), Rule("y", ["q."])]
    df = spark.createDataFrame([("aab",), ("a+b",), ("it's",), ("back\\slash",), ("q",), ("qq",)],
                               "c string")
    got = [r[0] for r in df.select(fn.last_match("c", rules, "c")).collect()]
    assert got == ["it's", "a+b", "x", "x", "q", "y"]


def test_cascade_sees_rewritten_values(spark):
    rules = [Rule("beta", ["alpha"]), Rule("gamma", ["eta"]), Rule("delta", ["zeta"])]
    df = spark.createDataFrame([("alpha",), ("zeta",), ("x",)], "c string")
    # alpha -> beta -> gamma; zeta matches "eta" first.
    assert [r.c for r in fn.cascade(df, "c", rules).collect()] == ["gamma", "gamma", "x"]
