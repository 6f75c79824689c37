"""Benchmark: store the processed tables once, then run the headline queries.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8). Prints one JSON
line. Every query is evaluated in full from the raw tables; `etl` builds and writes all five
processed tables, and the `stored_*` entries read those. With BENCH_MODELS set, the
model fits, which take over five minutes, come last; they are not in the total.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from ledgerloom import catalog
from ledgerloom.plans import reports
from ledgerloom.session import build_session
from ledgerloom.sources import benchmark_tables, tables

HEADLINE = [
    "q01_monthly_revenue", "q02_top_states", "q03_payment_mix", "q04_delivery_by_state",
    "q05_review_vs_delivery", "q06_hourly", "q07_weekday", "q08_top_customers",
    "q09_status_funnel", "q10_mom_growth", "q11_segment_summary", "q12_campaign",
    "rfm_ml_scored", "demand_features", "ab_metrics", "ab_tests", "eda_summary",
]

# Fits with full parameters: k = 2..8 with ten starts each, always; three demand models with five
# folds each on request. Neither is part of the total.
MODELS = ["cluster_selection"]
LONG_MODELS = ["demand_leaderboard"]

STORED = {
    "stored_q01": lambda t: reports.monthly_revenue(t["master"]),
    "stored_q02": lambda t: reports.top_states(t["master"]),
    "stored_q08": lambda t: reports.top_customers(t["master"]),
    "stored_q11": lambda t: reports.segment_summary(t["rfm"]),
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name, run):
        start = time.perf_counter()
        result = run()
        if result is not None:
            result.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)

    out = tempfile.mkdtemp(prefix="bench-")
    stored: dict = {}
    raw = benchmark_tables.domain_tables(spark, folder)
    timed("etl", lambda: stored.update(tables.run_etl(spark, raw, out)))
    for name in HEADLINE:
        timed(name, lambda: catalog.QUERIES[name](spark, folder))
    for name, run in STORED.items():
        timed(name, lambda: run(stored))
    for name in MODELS + (LONG_MODELS if os.environ.get("BENCH_MODELS") else []):
        timed(name, lambda: catalog.QUERIES[name](spark, folder))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "etl_and_headline_queries_total",
                "value": round(sum(s for n, s in seconds.items() if n not in MODELS + LONG_MODELS), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
