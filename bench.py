"""Time the registered queries over the tables in $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line. Each query is built, planned and run in full (all rows are
produced and dropped). The figure per headline query is the median of $BENCH_RUNS runs after
one run to warm up; "value" is their sum. The other registered queries are timed once, in a session that is
warm but has not seen the query, and are listed under "others", as far as they begin within $BENCH_SECONDS
of the start; those left out are listed under "not_timed". Headline queries come first and are never left out.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

from pyspark.sql import SparkSession

from closeworks.plans.registry import all_queries

HEADLINE = """
fx_processed fx_latest fx_monthly_avg ledger_processed cuts_processed segments_processed forecasts_processed
segment_completeness segment_pivot adjustments_by_account null_profile domain_violations ledger_issues dq_rules_ledger
dq_scorecard bu_missing review_summary dataset_completeness recon_prelim_segment alerts prelim_results
prelim_republished top_variances final_results kpi_metrics ledger_by_bu cuts_summary segments_by_type forecast_by_bu
data_completeness financial_summary forecast_accuracy task_summary task_timeline task_daily_performance raw_fx_stats
raw_ledger_by_bu raw_segments_by_product v_bu_submission v_top_adjustments v_final_segmented v_trends
v_variance_analysis
""".split()


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("closeworks-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    last = time.perf_counter() + float(os.environ.get("BENCH_SECONDS", "900"))
    spark = session(cpus)
    queries = all_queries()

    def once(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    rest = [] if sys.argv[1:] else [n for n in queries if n not in seconds]
    others = {}
    for name in rest:
        if time.perf_counter() > last:
            break
        others[name] = round(once(name), 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "others": others,
                "not_timed": [n for n in rest if n not in others],
                "sf": float(scale.group(1)) if scale else None,
                "cpus": int(cpus),
                "runs": runs,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
