"""Time the headline queries: prints one JSON line.

BENCH_SF_DIR (default sf0.1) and BENCH_CPUS choose data and threads. A query is timed from
building its plan to having every result row on the JVM side. Each query runs twice and the
second run counts: the first one compiles its generated code.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = (
    "W1_rolling_means", "A1_daily_panel", "A3_monthly_summary", "J2_densify_calendar_by_year",
    "W1_rolling_means_all_series", "C13_holiday_features", "C18_pre_holiday_surge", "J5_yoy_volume",
    "J6_lunar_yoy_volume", "W8_sliding_windows", "F1_sample_weights", "F14_postprocess_brand",
    "E6_segmented_metrics", "E8_percentile_errors", "E11_brand_accuracy", "F2_fit_direct",
)


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from cargotide.plans.catalog import load
    from cargotide.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("OFF")
    queries, _ = load()
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        for _ in range(2):
            start = time.time()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - start, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
