"""Cohorts by the facility that handled the first orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import left_join
from ..operators.reshape import explode_array
from .cohorts import label_cohorts
from .facts import flat_orders


def subprocess_links(orders: DataFrame) -> DataFrame:
    """(reference, subProcesses) rows from the list column of the orders."""
    links = explode_array(orders.select("reference", "subProcesses"),
                          "subProcesses", "link")
    return links.withColumnRenamed("link", "subProcesses")


def order_facilities(orders: DataFrame, links: DataFrame, subprocesses: DataFrame,
                     deliveries: DataFrame, facilities: DataFrame) -> DataFrame:
    """Orders, one row per subprocess, with the facility name.

    Order to subprocess to delivery to facility; whatever does not resolve
    leaves the name NULL, and every order stays.
    """
    steps = left_join(
        subprocesses.select(F.col("_id").alias("subprocess"), "dropOff"),
        deliveries.select("_id", "facility"), {"dropOff": "_id"})
    steps = left_join(steps, facilities.select("_id", F.col("name").alias("facility_name")),
                      {"facility": "_id"}).select("subprocess", "facility_name")
    named = left_join(links, steps, {"subProcesses": "subprocess"})
    rows = flat_orders(orders, "order", "customer_id", "created_at", "state")
    return left_join(rows, named.select("reference", "facility_name"),
                     {"order": "reference"})


def facility_cohorts(rows: DataFrame) -> DataFrame:
    """Returning and initial users per cohort, offset and first facility."""
    return label_cohorts(rows, "facility_name", "first_facility")
