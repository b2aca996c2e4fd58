"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores and
``BENCH_RUNS`` the timed runs per query (after one warm-up run; the best
counts). Results go to the no-op sink, so every row and column is computed.
Plan building and stored intermediates are part of the time.
"""

from __future__ import annotations

import json
import os
import time

from checks.queries import QUERIES
from patronflow.session import get_session

HEADLINE = {
    "user_retention": "BIZ26_user_retention_long",
    "revenue_retention_by_city": "BIZ29_revenue_retention_by_city",
    "orders_per_user_matrix": "BIZ30_orders_per_user_matrix",
    "rfm_report": "BIZ6_rfm_report",
    "stage_report": "BIZ36_lifecycle_stage",
    "transition_matrix": "BIZ39_transition_matrix",
    "attribution_long": "BIZ20_attribution_long",
    "attribution_report": "BIZ21_attribution_report",
    "channel_cohorts": "BIZ31_channel_cohorts",
    "facility_cohorts": "BIZ32_facility_cohorts",
    "clv": "BIZ45_clv",
    "customer_360": "BIZ16_customer_360",
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = get_session("patronflow-bench", master=f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for short, name in HEADLINE.items():
        seconds(name)
        times[short] = round(min(seconds(name) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "total seconds of the headline reports", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
