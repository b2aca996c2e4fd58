"""Reports on hand-made tables with known answers, and their invariants."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from patronflow import operators as op
from patronflow.plans import channels, clv, cohorts, customer360, facts, rfm, stages
from patronflow.plans.facilities import subprocess_links
from patronflow.sources import schemas


def at(text):
    return datetime.fromisoformat(text)


ROWS = "customer string, created_at timestamp, state string, location string, gross double"


def order_table(spark, data):
    return spark.createDataFrame([(c, at(t), s, l, g) for c, t, s, l, g in data], ROWS)


COHORT_DATA = [
    ("a", "2020-01-05T09:00", "completed", "x", 10.0),
    ("a", "2020-01-05T17:00", "completed", "x", 5.0),   # same day: initial by day
    ("a", "2020-01-20T08:00", "completed", "x", 20.0),  # returning, offset 0
    ("a", "2020-03-01T08:00", "completed", "y", 30.0),
    ("b", "2020-01-31T08:00", "processing", "x", 99.0),  # first valid, not completed
    ("b", "2020-02-01T08:00", "completed", "x", 40.0),
    ("c", "2020-01-02T08:00", "canceled", "x", 7.0),
    ("c", "2020-01-09T08:00", "completed", None, 50.0),
    (None, "2020-01-03T08:00", "completed", "x", 1.0),
    (None, "2020-03-03T08:00", "completed", "x", None),
]


def test_user_retention(spark, rows):
    got = cohorts.user_retention(order_table(spark, COHORT_DATA), "customer")
    jan = date(2020, 1, 1)
    # Initial users: a, c and the missing customer, which counts as one.
    assert rows(got) == [(jan, 0, 1, 3, 0.3333), (jan, 1, 1, 3, 0.3333), (jan, 2, 2, 3, 0.6667)]


def test_user_retention_by_city_keeps_cells_without_initial_users(spark, rows):
    got = cohorts.user_retention(order_table(spark, COHORT_DATA), "customer", by=["location"])
    jan = date(2020, 1, 1)
    assert rows(got) == [
        (jan, 0, "x", 1, 2, 0.5), (jan, 1, "x", 1, 2, 0.5), (jan, 2, "x", 1, 2, 0.5),
        (jan, 2, "y", 1, None, None)]
    assert cohorts.city_rows(got).count() == 3


def test_revenue_retention_is_strict(spark, rows):
    got = cohorts.revenue_retention(order_table(spark, COHORT_DATA), gross="gross")
    jan = date(2020, 1, 1)
    assert rows(got) == [(jan, 0, 20.0, 66.0, 0.303), (jan, 1, 40.0, 66.0, 0.6061),
                         (jan, 2, None, 66.0, None)]


def test_orders_per_user_and_matrix(spark, rows):
    table = cohorts.orders_per_user(order_table(spark, COHORT_DATA))
    jan = date(2020, 1, 1)
    assert rows(table) == [(jan, 0, 1, 1, 1.0), (jan, 1, 1, 1, 1.0), (jan, 2, 2, 2, 1.0)]
    wide = cohorts.cohort_matrix(table, "orders", offsets=[0, 1, 2, 3], labels=True)
    assert rows(wide) == [("Jan 2020", 1, 1, 2, None)]
    found = cohorts.cohort_matrix(table, "orders")
    assert found.columns == ["initial_cohort", "m0", "m1", "m2"]


def test_cohort_floor(spark):
    table = spark.createDataFrame(
        [(date(2014, 12, 1), "de_berlin"), (date(2015, 1, 1), "de_berlin"),
         (date(2016, 4, 1), "fr_paris"), (date(2000, 1, 1), "gb_london")],
        "initial_cohort date, location string")
    kept = cohorts.city_rows(table, floors=cohorts.LAUNCH_MONTHS).collect()
    assert {r.location for r in kept} == {"de_berlin", "gb_london"}


def test_grain_of_the_returning_test(spark):
    table = order_table(spark, COHORT_DATA).where("customer = 'a'")

    def statuses(grain):
        done = cohorts.cohort_rows(table, grain=grain).orderBy("created_at").collect()
        return [r.status for r in done]

    assert statuses("day") == [0, 0, 1, 1]
    assert statuses("timestamp") == [0, 1, 1, 1]
    with pytest.raises(ValueError):
        cohorts.cohort_rows(table, grain="week")


def test_rows_and_days_give_the_same_cells(spark, rows):
    table = order_table(spark, COHORT_DATA)
    by_row = cohorts.cohort_rows(table).groupBy(
        "initial_cohort", "status",
        F.when(F.col("status") == 1, F.col("since_first_order")).alias("since_first_order")
    ).agg(F.count(F.lit(1)).alias("orders"))
    by_day = cohorts.cohort_cells(cohorts.customer_days(table)).drop("users")
    assert rows(by_row) == rows(by_day)


def test_first_label_is_missing_if_one_initial_label_is(spark):
    data = [("a", "2020-01-05", "completed", "x", "L2"), ("a", "2020-01-05", "completed", "x", "L1"),
            ("a", "2020-02-05", "completed", "x", "L0"),
            ("b", "2020-01-05", "completed", "x", "L1"), ("b", "2020-01-05", "completed", "x", None),
            ("b", "2020-02-05", "completed", "x", "L1")]
    table = spark.createDataFrame([(c, at(t), s, l, n) for c, t, s, l, n in data],
                                  "customer_id string, created_at timestamp, state string, "
                                  "location string, name string")
    got = {r.first: (r.returning, r.cohort) for r in
           cohorts.label_cohorts(table, "name", "first").collect()}
    assert got == {"L1": (1, 1), None: (1, 1)}


def test_heat_buckets(spark):
    table = spark.createDataFrame([(float(i),) for i in range(11)] + [(None,)], "percent double")
    breaks = cohorts.heat_breaks(table)
    assert breaks.collect()[0].breaks == [float(i) for i in range(11)]
    got = table.withColumn("b", breaks.scalar()).select(
        "percent", cohorts.heat_bucket("percent", F.col("b")).alias("k")).collect()
    assert {r.percent: r.k for r in got} == {None: None, **{float(i): i for i in range(11)}}


def test_currency_conversion(spark, rows):
    df = spark.createDataFrame(
        [(10.0, "gb_london", 0.5), (10.0, "gb_london", None), (10.0, "fr_paris", 0.5),
         (10.0, None, 0.5)], "a double, l string, r double")
    got = [r[0] for r in df.select(facts.convert_amount("a", "l", "r")).collect()]
    assert got == [20.0, None, 10.0, None]


def test_rfm_class_order_follows_the_score(spark):
    base = spark.createDataFrame(
        [(f"c{i}", i * 7 % 101, 1 + i % 9, float(i * 13 % 77)) for i in range(200)],
        "customer string, recency int, frequency long, amount double")
    got = rfm.rfm_class(base).collect()
    assert all(1 <= r.rank_r <= 5 and 1 <= r.rank_f <= 5 and 1 <= r.rank_m <= 5 for r in got)
    assert all(r.score == r.recency_points + r.frequency_points + r.monetary_points for r in got)
    ordered = sorted(got, key=lambda r: r.score)
    assert [r.rfm_class for r in ordered] == sorted(r.rfm_class for r in got)
    assert max(got, key=lambda r: r.score).class_name == "Loyal"
    assert min(got, key=lambda r: r.score).class_name == "Churned"
    assert max(r.rank_r for r in got if r.recency == min(x.recency for x in got)) == 5


@pytest.mark.parametrize("n, since, gap, want", [
    (1, 4, 5.0, "Stage 1A"), (2, 4, 5.0, "Stage 1B"), (3, 4, 5.0, "Stage 2"),
    (2, 5, 5.0, "Stage 3"), (1, 4, None, "Stage 3"), (3, 0, 0.0, "Stage 3")])
def test_lifecycle_stage(spark, n, since, gap, want):
    got = spark.range(1).select(stages.lifecycle_stage(
        F.lit(n), F.lit(since), F.lit(gap).cast("double")).alias("s")).collect()[0].s
    assert got == want


def test_gap_imputation(spark):
    data = [("a", "s1", 1, None), ("b", "s1", 2, 10.0), ("c", "s1", 3, 20.0),
            ("d", None, 1, None), ("e", "s2", 1, None), ("f", None, 2, 40.0)]
    base = spark.createDataFrame(data, "customer string, segment string, orders int, gap double")
    got = {r.customer: r.filled_gap for r in stages.impute_gaps(base).collect()}
    # Segment mean first; without one the median of 10, 20, 40.
    assert got == {"a": 15.0, "b": 10.0, "c": 20.0, "d": 20.0, "e": 20.0, "f": 40.0}


TRANSITION = [
    ("old", "2020-05-01"), ("old", "2020-05-11"), ("old", "2020-05-31"),
    ("edge", "2020-06-01"),          # on the earlier cut-off: earlier slice
    ("edge", "2020-06-20"),
    ("late", "2020-06-02"),          # first order after the earlier cut-off
    ("lapsed", "2020-01-01"), ("lapsed", "2020-01-11"),
    ("next", "2020-05-30"), ("next", "2020-07-02"),  # after both cut-offs
]


def transition_rows(spark):
    return spark.createDataFrame(
        [(c, at(d), f"o{i}", 1, f"city{i}") for i, (c, d) in enumerate(TRANSITION)],
        "customer string, created_at timestamp, order string, is_valid int, location string")


@pytest.mark.parametrize("keep", [op.hold, op.lazily])
def test_transitions(spark, keep):
    report = stages.transition_report(transition_rows(spark), date(2020, 7, 15), keep=keep)
    got = {r.customer: r for r in report.collect()}
    assert set(got) == {"old", "edge", "lapsed", "next"}
    # Median of the earlier gaps: old 15 days, lapsed 10 days.
    assert got["edge"].gap_before == 12.5
    assert (got["edge"].orders_before, got["edge"].orders_after) == (1, 1)
    assert (got["edge"].former_stage, got["edge"].new_stage) == ("Stage 1A", "Stage 1B")
    assert (got["old"].former_stage, got["old"].new_stage) == ("Stage 2", "Stage 3")
    assert (got["lapsed"].former_stage, got["lapsed"].new_stage) == ("Stage 3", "Stage 3")
    assert (got["next"].orders_after, got["next"].new_stage) == (0, "Stage 3")
    assert got["old"].location == "city0"

    matrix = stages.transition_matrix(report).collect()
    assert sum(r.n for r in matrix) == len(got)
    assert {(r.former_stage, r.new_stage): r.n for r in matrix if r.n} == {
        ("Stage 1A", "Stage 1B"): 1, ("Stage 1A", "Stage 3"): 1, ("Stage 2", "Stage 3"): 1,
        ("Stage 3", "Stage 3"): 1}
    for former in {r.former_stage for r in matrix}:
        assert sum(r.row_percent for r in matrix if r.former_stage == former) == \
            pytest.approx(100)
    assert {r.former_label for r in matrix} == {"Stage 1AInExisting", "Stage 2InExisting",
                                                "Stage 3InExisting"}


def points(spark, data):
    return spark.createDataFrame(
        [(f"o{i}", v, f, l) for i, (v, f, l) in enumerate(data)],
        "order string, voucher_channel string, first_channel string, last_channel string")


def test_fractional_weights(spark):
    n = "not set"
    got = channels.fractional_weights(points(spark, [
        (n, n, n), ("a", n, n), ("a", n, "b"), ("a", "b", "c")])).orderBy("order").collect()
    assert [(r.voucher_weight, r.first_weight, r.last_weight) for r in got] == [
        (0, 0, 0), (1, 0, 0), (0.5, 0, 0.5), (0.33, 0.33, 0.33)]
    assert [r.rest_weight for r in got] == pytest.approx([1, 0, 0, 0.01])


def test_attribution_weights_sum_to_one_per_order(spark):
    n = "not set"
    long = channels.attribution_long(points(spark, [
        ("SEO", "Organic Search", n), ("Refer a Friend", "Referral", "email"), (n, n, n)]))
    got = {(r.order, r.final_channel): r.sum_weight for r in long.collect()}
    assert got[("o0", "SEO")] == 1.0
    assert got[("o1", "Refer a Friend")] == pytest.approx(0.66)
    assert got[("o2", n)] == 1.0
    for order in ("o0", "o1", "o2"):
        assert sum(w for (o, _), w in got.items() if o == order) == pytest.approx(1)


def documents(spark, orders):
    return spark.createDataFrame(orders, schemas.ORDERS)


def document(ref, customer, when, state="completed", voucher=None, location="x", agent=None,
             service="gb-PLUS", referrer=None, provider="card", subs=None):
    return (ref, ref, customer, at(when), state, location, ref, voucher, "en", (service,),
            (agent,), subs, (referrer,), (provider,))


def test_attribution_report_status_and_repeated_codes(spark):
    orders = documents(spark, [
        document("1", "a", "2020-01-01T09:00", voucher="V1"),
        document("2", "a", "2020-01-01T17:00", state="new"),
        document("3", "b", "2020-01-01T17:00", state="new")])
    vouchers = spark.createDataFrame([("V1", "SEM"), ("V1", "SEM")],
                                     "voucher_code string, voucher_channel string")
    funnel = spark.createDataFrame([("2", "email", None), ("2", "email", "Direct")],
                                   schemas.FUNNEL)
    got = channels.attribution_report(orders, vouchers, funnel).collect()
    status = {r.order: r.customer_status for r in got}
    # Customer b has no valid order and stays new.
    assert status == {"1": "New", "2": "Returning", "3": "New"}
    # A code on file twice doubles rows and weights, as a left join does.
    doubled = [r.sum_weight for r in got if r.order == "1" and r.final_channel == "SEM"]
    assert doubled == [2.0, 2.0]
    # One missing last channel makes the smallest last channel missing.
    assert {(r.final_channel, r.sum_weight) for r in got if r.order == "2"} == {
        ("CRM-Journey", 1.0), ("not set", 0.0)}


def test_channel_priority(spark):
    orders = documents(spark, [
        document("1", "a", "2020-01-01", voucher="V1", referrer="r"),
        document("2", "a", "2020-01-01", voucher="V1"),
        document("3", "a", "2020-01-01", voucher="V9"),
        document("4", "a", "2020-01-01"), document("5", "a", "2020-01-01"),
        document("6", "a", "2020-01-01")])
    vouchers = spark.createDataFrame([("V1", "Flyering")],
                                     "voucher_code string, voucher_channel string")
    events = spark.createDataFrame(
        [("2", "3", "late", "submit_order"), ("1", "3", "SEM UK", "submit_order"),
         ("0", "3", "first", "open_app"), ("3", "5", None, "submit_order")],
        schemas.TRACKER_EVENTS)
    web = spark.createDataFrame(
        [("4", "google", "organic", "k"), ("5", "newsletter", "(none)", "k"),
         ("6", "(direct)", None, "k")], schemas.WEB_ANALYTICS)
    got = channels.priority_channel(orders, vouchers, channels.tracker_networks(events),
                                    channels.web_channels(web))
    assert {r.order: r.channel for r in got.collect()} == {
        "1": "Refer a Friend", "2": "Flyering", "3": "SEM", "4": "SEO", "5": "CRM-Campaign",
        "6": "Direct"}


def test_explode_subprocesses(spark, rows):
    orders = documents(spark, [document("1", "a", "2020-01-01", subs=["s1", "s2"]),
                               document("2", "a", "2020-01-01")])
    assert rows(subprocess_links(orders)) == [("1", "s1"), ("1", "s2"), ("2", None)]


def test_service_class_counts(spark, rows):
    orders = documents(spark, [
        document("1", "a", "2020-01-01", service="gb-PLUS"),
        document("2", "a", "2020-01-01", service="gb"),
        document("3", "a", "2020-01-01", service="de-LITE"),
        document("4", "a", "2020-01-01", service="gb-PLUS", state="new")])
    got = customer360.service_class_counts(orders).collect()[0]
    assert (got.valid_orders, got.plus, got.lite, got.classic, got.no_class) == (3, 1, 1, 0, 1)


def test_rating_features_are_strict(spark, rows):
    orders = documents(spark, [document("1", "a", "2020-01-01"), document("2", "a", "2020-01-02"),
                               document("3", "b", "2020-01-01"), document("4", "b", "2020-01-01")])
    ratings = spark.createDataFrame(
        [("r1", "1", "1", "a", 3, False, {"Punctuality": "2"}),
         ("r2", "1", "2", "a", 5, False, {"CleaningQ": "1", "Punctuality": "4"}),
         ("r0", "1", "3", "b", 1, False, None), ("r9", "1", "3", "b", 9, False, None)],
        schemas.RATINGS)
    got = {r.customer_id: r for r in customer360.rating_features(orders, ratings).collect()}
    assert (got["a"].rating, got["a"].punctuality, got["a"].cleaning, got["a"].ironing) == \
        (5, "4", "1", "")
    assert (got["b"].rating, got["b"].punctuality) == (None, None)


def test_cadence_uses_the_rounded_frequency(spark):
    df = spark.createDataFrame(
        [("a", date(2020, 1, 1), date(2020, 1, 6), 3), ("b", date(2020, 1, 1), date(2020, 1, 1), 1)],
        "customer string, first_order date, last_order date, valid_orders long")
    got = {r.customer: r for r in customer360.cadence(df, date(2020, 1, 10)).collect()}
    assert (got["a"].individual_frequency, got["a"].overtime) == (2.0, 2.0)  # 2.5 -> 2
    assert (got["b"].individual_frequency, got["b"].days_since_first_order) == (None, 9)


def test_customer_360_has_one_row_per_customer(spark):
    customers = spark.createDataFrame(
        [("a", "R1", (None, "f", None), ("Zoë Ä",), ("e1",), [("s", "", "")], None, (None, "en")),
         ("z", "R2", ("seg", None, None), ("Max",), (None,), None, None, (None, None))],
        schemas.CUSTOMERS)
    orders = documents(spark, [document("1", "a", "2020-01-01"),
                               document("2", "a", "2020-01-05", state="new", provider="cash")])
    ratings = spark.createDataFrame([], schemas.RATINGS)
    notes = spark.createDataFrame(
        [("n1", "e1", "P1", "x", True), ("n2", "e1", "P2", "x", False),
         ("n3", None, "P3", "x", True)], schemas.NOTIFICATIONS)
    credits = spark.createDataFrame([("R2", 5.5, "t")], schemas.BRANCH_CREDITS)
    base = spark.createDataFrame([("R1", 3, 1, 10.5)],
                                 "customer string, recency int, frequency long, amount double")
    report = rfm.rfm_class(base).withColumn("location", F.lit("x"))
    got = {r.customer: r for r in customer360.customer_360(
        customers, orders, ratings, notes, credits, report, date(2020, 2, 1)).collect()}
    a, z = got["R1"], got["R2"]
    assert (a.subscriber_key, a.first_name, a.customer_status, a.zip) == \
        ("ZJ_a", "Zoe", "New", "")
    assert (a.valid_orders, a.total_orders, a.open_orders, a.plus, a.amount) == (1, 2, 1, 1, 10)
    assert (a.first_order, a.provider, a.public_reference) == ("2020-01-01", "card", "P2")
    assert (a.individual_frequency, a.rating, a.newsletter_subscribed) == (0, 0, 0)
    # No orders: zeros and empty dates. A missing e-mail matches a missing e-mail.
    assert (z.valid_orders, z.total_orders, z.first_order, z.customer_status) == (0, 0, "", "NA")
    assert (z.branch_credits, z.public_reference, z.newsletter_subscribed) == (5.5, "P3", 1)


def test_lifetime_value(spark):
    order_data = [("o1", "1", "C1", "2020-01-10", 1, "fr_paris", 30.0),
                  ("o2", "1", "C1", "2020-03-10", 1, "fr_paris", None),
                  ("o3", "2", "C2", "2020-01-11", 1, None, 60.0),
                  ("o4", "2", "C2", "2020-01-12", 0, None, 60.0)]
    table = spark.createDataFrame(
        [(o, i, c, at(t), v, l, g) for o, i, c, t, v, l, g in order_data],
        "order string, customer_id string, customer string, created_at timestamp, "
        "is_valid int, location string, gross_before_discount double")
    stage_rows = spark.createDataFrame(
        [("C1", "fr_paris", 2, "Stage 3", date(2020, 1, 10), date(2020, 3, 10)),
         ("C2", None, 1, "Stage 3", date(2020, 1, 11), date(2020, 1, 11))],
        "customer string, location string, orders long, stage string, first_order date, "
        "last_order date")
    firsts = spark.createDataFrame([("1", "SEM")], "customer_id string, first_channel string")
    people = spark.createDataFrame([("1", "C1"), ("2", "C2")], "_id string, reference string")
    got = {(r.month, r.location): r for r in
           clv.clv_report(table, people, stage_rows, firsts).collect()}
    jan, mar = date(2020, 1, 1), date(2020, 3, 1)
    paris = got[(jan, "fr_paris")]
    assert (paris.first_channel, paris.aov, paris.final_lifespan) == ("SEM", 30.0, 60.0)
    assert paris.clv == pytest.approx(30.0 * 60 / 30 * 1)
    # No known amount in March: all measures 0.
    assert (got[(mar, "fr_paris")].aov, got[(mar, "fr_paris")].clv) == (0, 0)
    # Both amounts over the one valid order; no lifespan without a city on file.
    unknown = got[(jan, "0")]
    assert (unknown.first_channel, unknown.aov, unknown.clv) == ("0", 120.0, 0)
