"""Document exports, control totals, published reports and the jobs around them."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from checks.queries import Inputs
from patronflow import jobs
from patronflow import operators as op
from patronflow.plans import channels, cohorts, customer360, facts, rfm, stages
from patronflow.session import shared_folder
from patronflow.sources import scan, scan_documents, schemas, write_report
from patronflow.sources.publish import publish, published

SF = "/root/testdata/sf0.001"


def export(spark, lines):
    path = shared_folder(spark)
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(path)
    return path


# --- documents ---------------------------------------------------------------------

def test_documents_that_do_not_fit_are_set_apart(spark, rows):
    schema = "_id string, n int, at timestamp_ntz, who struct<name: string, tags: array<string>>"
    good = [{"_id": "1", "n": 5, "at": "2020-01-01T10:00:00", "who": {"name": "Zoë", "tags": ["a", None]}},
            {"_id": "2"}, {"_id": "3", "n": None, "who": {}, "extra": {"x": 1}}]
    lines = [*map(json.dumps, good), "", "  ", '{"_id": "4", "n": "many"}', '{"_id": "5", "n": 3000000000}',
             '{"_id": "6", "at": "soon"}', '{"_id": "7"', "nonsense", "[1, 2]", '{"n": 1}',
             '{"_id": "8", "who": 3}']
    read = scan_documents(spark, export(spark, lines), schema, required=["_id"])
    assert rows(read.good) == [
        ("1", 5, datetime(2020, 1, 1, 10), ("Zoë", ["a", None])), ("2", None, None, None),
        ("3", None, None, (None, None))]
    assert {r.line: r.reason for r in read.bad.collect()} == {
        '{"_id": "4", "n": "many"}': "a value of another type",
        '{"_id": "5", "n": 3000000000}': "a value of another type",
        '{"_id": "6", "at": "soon"}': "a value of another type",
        '{"_id": "7"': "not a JSON document", "nonsense": "not a JSON document",
        "[1, 2]": "not a JSON document", '{"n": 1}': "no _id",
        '{"_id": "8", "who": 3}': "a value of another type"}
    counts = {r.reason: r.n for r in read.counts().collect()}
    assert counts == {None: 3, "a value of another type": 4, "not a JSON document": 3, "no _id": 1}


def test_pruned_fields_do_not_hide_bad_ones(spark):
    """A query of one field still leaves out documents that another field breaks."""
    path = export(spark, ['{"_id": "1", "n": 1}', '{"_id": "2", "n": "x"}'])
    read = scan_documents(spark, path, "_id string, n int")
    assert [r[0] for r in read.good.select("_id").collect()] == ["1"]
    assert read.good.count() == 1 and read.bad.count() == 1


def test_no_documents(spark):
    read = scan_documents(spark, export(spark, []), "_id string")
    assert read.good.count() == read.bad.count() == read.counts().count() == 0


# --- totals and publishing ----------------------------------------------------------

def read_csv(spark, path):
    return sorted(tuple(r) for r in spark.read.option("header", True).csv(path).collect())


def test_totals_that_agree(spark):
    totals = op.Totals()
    df = totals.watch(spark.range(100), "in", rows=F.count("id"), total=F.sum("id"))
    out = totals.watch(df.groupBy((F.col("id") % 3).alias("k")).agg(F.count("id").alias("n"),
                                                                  F.sum("id").alias("s")),
                       "out", rows=F.sum("n"), total=F.sum("s"))
    totals.agree("in.rows", "out.rows")
    totals.agree("in.total", "out.total")
    version = publish(out, shared_folder(spark), totals)
    assert totals.verify() == {"in.rows": 100, "in.total": 4950, "out.rows": 100, "out.total": 4950}
    assert len(read_csv(spark, version)) == 3
    with pytest.raises(ValueError, match="already"):
        totals.watch(df, "in", rows=F.count("id"))


def test_a_mismatch_leaves_the_last_report(spark):
    path = shared_folder(spark)
    first = publish(spark.range(2), path)
    totals = op.Totals()
    df = totals.watch(spark.range(10), "in", rows=F.count("id"))
    lost = totals.watch(df.where("id < 9"), "out", rows=F.count("id"))
    totals.agree("in.rows", "out.rows")
    with pytest.raises(op.TotalsDiffer, match="in.rows = 10, out.rows = 9"):
        publish(lost, path, totals)
    assert published(spark, path) == first


def test_a_failed_write_is_never_seen(spark):
    path = shared_folder(spark)
    with pytest.raises(FileNotFoundError):
        published(spark, path)
    publish(spark.range(3).select(F.col("id").cast("string")), path)
    broken = spark.range(0, 8, 1, 8).select(
        F.when(F.col("id") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        publish(broken, path)
    assert read_csv(spark, published(spark, path)) == [("0",), ("1",), ("2",)]
    second = publish(spark.range(1), path, fmt="parquet")
    assert published(spark, path) == second
    assert scan(spark, second).count() == 1
    with pytest.raises(ValueError, match="fmt"):
        publish(broken, path, fmt="xls")


def test_reports_that_lose_rows_are_caught(spark):
    """A join that doubles customers makes the attribution weights differ."""
    i = Inputs(spark, SF)
    totals = op.Totals()
    doubled = i.vouchers.union(i.vouchers.where("voucher_code = 'V0'"))
    report = channels.attribution_report(i.orders, doubled, i.entity("funnel"), totals=totals)
    totals.watch(report, "shown", weight=F.sum("sum_weight")).write.format("noop").mode("overwrite").save()
    values = totals.verify()
    assert values["touchpoints.orders"] > 1500
    totals.agree("attribution.weight", "shown.weight", tolerance=1e-9)
    with pytest.raises(op.TotalsDiffer):
        totals.verify()


# --- strict dates and ratings --------------------------------------------------------

def test_an_undated_order_makes_the_gap_unknown(spark):
    data = [("a", "s", "x", datetime(2020, 1, 1), 1), ("a", "s", "x", None, 1),
            ("b", "s", "x", datetime(2020, 1, 1), 1), ("b", "s", "x", datetime(2020, 1, 5), 1),
            ("b", "s", "x", None, 0)]
    rows = spark.createDataFrame(data, "customer string, segment string, location string, "
                                       "created_at timestamp, is_valid int")
    got = {r.customer: (r.first_order, r.last_order, r.orders, r.gap)
           for r in stages.stage_base(rows).collect()}
    assert got == {"a": (None, None, 2, None), "b": (date(2020, 1, 1), date(2020, 1, 5), 2, 4.0)}
    measures = {r.customer: r.recency for r in rfm.rfm_base(
        rows.withColumn("gross_before_discount", F.lit(1.0)), date(2020, 1, 11)).collect()}
    assert measures == {"a": None, "b": 6}


def test_first_and_latest_rating(spark):
    data = [("1", "o", 2, {"CleaningQ": "1"}), ("2", "o", 5, None), ("3", None, 1, None)]
    df = spark.createDataFrame(data, "_id string, orderReference string, rating int, "
                                     "topics map<string,string>")
    first = {r.order: (r.rating, r.cleaning, r.driver) for r in customer360.order_ratings(df).collect()}
    last = {r.order: (r.rating, r.cleaning) for r in customer360.order_ratings(df, latest=True).collect()}
    assert first == {"o": (2, "1", ""), None: (1, None, None)}
    assert last == {"o": (5, None), None: (1, None)}


# --- jobs ----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def exported(spark):
    """All collections of the smallest tables as export files."""
    i, path = Inputs(spark, SF), shared_folder(spark)
    for name in jobs.DOCUMENTS:
        df = i.entity(name)
        df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.text(f"{path}/{name}.json")
    for name, (_, separator) in jobs.EXTRACTS.items():
        write_report(i.entity(name), f"{path}/{name}.csv", sep=separator)
    return path


def test_jobs_publish_what_the_reports_hold(spark, exported):
    i, target, as_of = Inputs(spark, SF), shared_folder(spark), date(2001, 9, 1)

    def shown(name):
        version = jobs.run(spark, name, exported, target, as_of)
        assert published(spark, f"{target}/{name}") == version
        return spark.read.options(header=True, nullValue="NA").csv(version)

    want = {(r.customer, r.score, r.class_name) for r in rfm.rfm_report(i.facts, i.rows, as_of).collect()}
    got = {(r.customer, int(r.score), r.class_name) for r in shown("rfm").collect()}
    assert got == want
    want = i.entity("orders").count()
    weights = shown("attribution").agg(F.sum("sum_weight")).first()[0]
    assert weights == pytest.approx(want)
    matrix = shown("user_cohorts")
    table = cohorts.user_retention(facts.flat_orders(i.orders, "customer_id", "created_at", "state"))
    want = table.where("percent IS NOT NULL").count()
    overall = matrix.where("grouping_id = 1").drop("initial_cohort", "grouping_id", "location")
    assert sum(v is not None for r in overall.collect() for v in r) == want
    assert shown("transition").count() == stages.transition_report(i.rows, as_of).count()
    assert shown("clv").count() > 0


def test_jobs_stop_at_bad_documents(spark, exported):
    path = export(spark, ['{"_id": "1"}', "{", '{"reference": "x"}'])
    orders, folder = f"{shared_folder(spark)}/in", None
    spark.read.text(path).write.text(f"{orders}/orders.json")
    folder = jobs.Exports(spark, orders)
    with pytest.raises(ValueError, match="not a JSON document"):
        folder["orders"]
    assert jobs.Exports(spark, orders, most_bad=2)["orders"].count() == 1


def test_job_names_cover_the_reports():
    assert {"rfm", "crm", "attribution", "channel_cohorts", "stages", "transition", "clv",
            "user_cohorts", "revenue_cohorts", "order_cohorts"} <= set(jobs.REPORTS)
    assert schemas.ORDERS is jobs.DOCUMENTS["orders"][0]
