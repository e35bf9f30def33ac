"""Time the headline queries and print one JSON line.

Scores, alerts and flags that other queries read are first written as tables, as the runs do, so that a report is timed
on its stored inputs and the scoring in its own queries. Each query runs once to warm up and then ``BENCH_RUNS`` times;
the median counts. ``BENCH_BROADCAST=-1`` turns broadcast joins off, as they would be at the size of a cluster.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from clientpulse.session import build_session, remove_path, scratch_path
from pulsechecks import catalog

HEADLINE = (
    "f2_roi_mean_last3", "f6_roi_by_period", "f6_score_rows", "f15_features_sql_v1", "f17_status_sql_v1",
    "f17_status_pandas_v1", "f17_status_warehouse_v1_1", "f19_asof_backfill", "l3_status_change", "l14_alerts_script",
    "l14_alerts_warehouse", "u1_upsell_flags", "u5_product_opportunities", "a1_weekly_calls",
    "a4_activity_full_join", "a6_coverage_from_calls", "a9_coverage_table", "d2_dim_clients_warehouse",
    "r3_retention_warehouse", "r7_retention_local", "q1_client_360", "q2_last_known_values", "q6_status_by_month",
    "q13_alert_centre", "q16_detractor_alert_count",
)
# Inputs that are facts of earlier runs, and the queries that compute one of them and so keep the unstored inputs.
STORED = ("history", "warehouse_scores", "alert_base", "script_alerts")
SCORING = ("f15_", "f17_", "f19_", "f6_")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    catalog.load()
    settings = {"spark__sql__autoBroadcastJoinThreshold": os.environ["BENCH_BROADCAST"]} if "BENCH_BROADCAST" in os.environ else {}
    spark = build_session(
        "bench", f"local[{cpus}]", spark__ui__enabled="false", spark__driver__memory="8g",
        spark__sql__shuffle__partitions=cpus, **settings)
    spark.sparkContext.setLogLevel("ERROR")
    inputs, paths = catalog.inputs_for(spark, sf_dir), []
    chosen = sys.argv[1:] or HEADLINE
    times: dict[str, float] = {}

    def timed(key: str) -> None:
        taken = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            catalog.QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        times[key] = round(statistics.median(taken[1:]), 4)

    for key in [k for k in chosen if k.startswith(SCORING)]:
        timed(key)
    for name in STORED:
        paths.append(scratch_path(spark, f"bench-{name}"))
        getattr(inputs, name).write.parquet(paths[-1])
        inputs.__dict__[name] = spark.read.parquet(paths[-1])
    for key in [k for k in chosen if not k.startswith(SCORING)]:
        timed(key)
    for path in paths:
        remove_path(spark, path)
    spark.stop()
    scale = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": {k: times[k] for k in chosen}, "sf": float(scale) if scale.replace(".", "").isdigit() else scale}))


if __name__ == "__main__":
    main()
