"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma list).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from scorelake.plans import catalog, load_queries  # noqa: E402
from scorelake.session import clear_staging, get_spark  # noqa: E402

HEADLINE = [
    "a13_resume_stage",
    "c1_knn_impute",
    "d12_column_quantiles",
    "e1_stratified_split",
    "e2_median_fill",
    "e3_knn_impute_all",
    "e4_winsorize",
    "e5_group_components",
    "e10_smote",
    "f2_entropy_edges",
    "f3_woe_table",
    "f7_iv_ranking",
    "f12_score_all",
    "g1_challenger",
    "g2_boosted_trees",
    "g3_scorecard_metrics",
    "h6_all_metrics",
    "i4_decision_row",
    "j1_row_count_chunks",
    "j2_cbpe_estimate",
    "j4_univariate_drift",
    "j8_drift_report",
    "j9_multivariate_drift",
    "j13_monitor_run",
    "k1_score_batch",
    "k1_score_stream",
    "k2_request_rate",
    "k3_histogram_quantile",
    "k10_rate_limit",
    "l3_alias_state",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = get_spark(
        "scorelake-bench",
        f"local[{cpus}]",
        **{
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    load_queries()
    # Untimed, so that the first timed query does not pay for starting the JVM and its workers.
    catalog.QUERIES["d1_split_stats"](spark, sf_dir).collect()
    times: dict[str, float] = {}
    for name in chosen:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        clear_staging(spark)
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
