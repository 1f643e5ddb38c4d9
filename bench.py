"""Seconds per headline query on local Spark; prints one JSON line.

BENCH_SF_DIR names the trial tables (default /root/testdata/sf0.1) and BENCH_CPUS the cores (default 8). Raw tables and
star are built first and timed as ``build_raw`` and ``build_star``; the questions then read the written tables, as they
would in use. Every result is computed in full and thrown away. All of it first runs once, untimed, on the smallest
trial tables next to BENCH_SF_DIR if they are there: a warehouse answers warm, a new JVM does not.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from starmart.session import local_session  # noqa: E402
from starmart.trial import mart  # noqa: E402
from starmart.trial.queries import QUERIES  # noqa: E402

RAW = ["inpatient_charges", "landed_readmissions", "hrrp_readmissions"]
HEADLINE = [
    "dq_report",
    "q1_price_variation",
    "q2_markup",
    "q3_cost_vs_quality",
    "cost_quality_corr",
    "headline_metrics",
    "markup_by_state",
    "leaders_per_group",
    "percentiles_by_group",
    "percentiles_scaled",
    "ntile_scaled",
    "ntile_100",
    "dq_report_dirty",
    "load_audit",
    "csv_rejects",
    "stg_charges",
    "stg_readmissions",
    "fact_charges",
    "csv_load",
    "paged_json",
    "initcap_names",
    "initcap_texts",
    "try_cast_clean",
    "surrogate_keys",
    "check_unique",
    "check_relationships",
    "check_grain",
]


def run(spark, sf_dir: str) -> dict[str, float]:
    seconds: dict[str, float] = {}

    def timed(name, work):
        start = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - start, 3)

    timed("build_raw", lambda: [mart.raw(spark, sf_dir, t) for t in RAW])
    timed("build_star", lambda: mart.star(spark, sf_dir))
    for name in HEADLINE:
        timed(name, lambda q=QUERIES[name]: q(spark, sf_dir).write.format("noop").mode("overwrite").save())
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    smallest = str(Path(sf_dir).with_name("sf0.001"))
    warm = smallest != sf_dir and Path(smallest).is_dir()
    if warm:
        run(spark, smallest)
    seconds = run(spark, sf_dir)
    scale = Path(sf_dir).name.removeprefix("sf")
    result = {
        "metric": "headline queries, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "warmed_up": warm,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
