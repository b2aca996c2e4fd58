"""Reports as jobs: exported collections in, published report files out.

    python -m patronflow.jobs rfm --source /exports/2020-01-31 --target /reports --as-of 2020-01-31

A source folder holds one export per collection: ``<name>.json`` with a document a
line, or ``<name>.csv`` (see :data:`DOCUMENTS` and :data:`EXTRACTS`). Documents
that do not fit their schema stop the job unless ``most_bad`` allows for them.
A report is published only as a whole, and only if its control totals agree.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from .operators.totals import Totals
from .plans import channels, clv, cohorts, customer360, facts, rfm, stages
from .session import get_session
from .sources import scan_delimited, scan_documents, schemas
from .sources.publish import publish

#: Collections exported as documents, with their schema and the fields that each needs.
DOCUMENTS = {
    "orders": (schemas.ORDERS, ["_id"]), "customers": (schemas.CUSTOMERS, ["_id"]),
    "invoices": (schemas.INVOICES, ["_id"]), "notifications": (schemas.NOTIFICATIONS, ["_id"]),
    "ratings": (schemas.RATINGS, ["_id"]), "voucher_blocks": (schemas.VOUCHER_BLOCKS, []),
    "voucher_models": (schemas.VOUCHER_MODELS, ["_id"]),
    "voucher_items": (schemas.VOUCHER_ITEMS, ["_id"]),
    "tracker_events": (schemas.TRACKER_EVENTS, ["_id"]),
}
#: Delimited extracts, with their schema and separator.
EXTRACTS = {
    "exchange_rates": (schemas.EXCHANGE_RATES, ";"), "funnel": (schemas.FUNNEL, ";"),
    "branch_credits": (schemas.BRANCH_CREDITS, ";"), "web_analytics": (schemas.WEB_ANALYTICS, ","),
}


class Exports:
    """The collections of one source folder, and the tables several reports share."""

    def __init__(self, spark: SparkSession, folder: str, most_bad: int = 0):
        self.spark, self.folder, self.most_bad = spark, folder.rstrip("/"), most_bad

    def __getitem__(self, name: str) -> DataFrame:
        if name in EXTRACTS:
            schema, separator = EXTRACTS[name]
            return scan_delimited(self.spark, f"{self.folder}/{name}.csv", schema, separator)
        schema, required = DOCUMENTS[name]
        documents = scan_documents(self.spark, f"{self.folder}/{name}.json", schema, required)
        reasons = {r["reason"]: r["n"] for r in documents.counts().collect() if r["reason"]}
        if sum(reasons.values()) > self.most_bad:
            raise ValueError(f"{name}: documents that do not fit: {reasons}")
        return documents.good

    def rows(self) -> DataFrame:
        return facts.order_rows(self["orders"], self["customers"])

    def facts(self) -> DataFrame:
        return facts.order_facts(self["orders"], self["customers"], self["invoices"],
                                 self["exchange_rates"])

    def vouchers(self) -> DataFrame:
        return channels.voucher_channels(self["voucher_blocks"], self["voucher_models"],
                                         self["voucher_items"])

    def priority(self) -> DataFrame:
        return channels.priority_channel(
            self["orders"], self.vouchers(), channels.tracker_networks(self["tracker_events"]),
            channels.web_channels(self["web_analytics"]))


def _crm(x: Exports, as_of: date, totals: Totals) -> DataFrame:
    scores = rfm.rfm_report(x.facts(), x.rows(), as_of, totals=totals)
    return customer360.customer_360(x["customers"], x["orders"], x["ratings"], x["notifications"],
                                    x["branch_credits"], scores, as_of)


def _clv(x: Exports, as_of: date, totals: Totals) -> DataFrame:
    return clv.clv_report(x.facts(), x["customers"], stages.stage_report(x.rows(), as_of),
                          channels.first_channel(x.priority()), totals=totals)


def _matrix(build: Callable[[Exports], DataFrame], value: str):
    """Overall and by-city matrices of one scan, told apart by ``grouping_id``."""
    return lambda x, as_of, totals: cohorts.cohort_matrix(
        build(x), value, by=["grouping_id", "location"])


REPORTS: dict[str, Callable[[Exports, date, Totals], DataFrame]] = {
    "rfm": lambda x, as_of, totals: rfm.rfm_report(
        x.facts(), x.rows(), as_of, ordered=True, totals=totals),
    "crm": _crm,
    "attribution": lambda x, as_of, totals: channels.attribution_report(
        x["orders"], x.vouchers(), x["funnel"], totals=totals),
    "channel_cohorts": lambda x, as_of, totals: channels.channel_cohorts(x.priority()),
    "stages": lambda x, as_of, totals: stages.stage_report(x.rows(), as_of, totals=totals),
    "transition": lambda x, as_of, totals: stages.transition_report(x.rows(), as_of),
    "clv": _clv,
    "user_cohorts": _matrix(lambda x: cohorts.user_retention(
        facts.flat_orders(x["orders"], "customer_id", "created_at", "state", "location"),
        by=["location"], sets=True), "percent"),
    "revenue_cohorts": _matrix(lambda x: cohorts.revenue_retention(
        x.facts(), by=["location"], sets=True), "percent"),
    "order_cohorts": _matrix(lambda x: cohorts.orders_per_user(
        x.rows(), by=["location"], sets=True), "proportion"),
}


def run(spark: SparkSession, report: str, source: str, target: str, as_of: date,
        most_bad: int = 0) -> str:
    """Make one report and return the folder of its published version."""
    totals = Totals()
    df = REPORTS[report](Exports(spark, source, most_bad), as_of, totals)
    return publish(df, f"{target.rstrip('/')}/{report}", totals)


def main() -> None:
    parser = argparse.ArgumentParser(description="Make and publish one report.")
    parser.add_argument("report", choices=sorted(REPORTS))
    parser.add_argument("--source", required=True)
    parser.add_argument("--target", required=True)
    parser.add_argument("--as-of", required=True, type=date.fromisoformat)
    parser.add_argument("--most-bad", type=int, default=0)
    args = parser.parse_args()
    print(run(get_session(f"patronflow-{args.report}"), args.report, args.source, args.target,
              args.as_of, args.most_bad))


if __name__ == "__main__":
    main()
