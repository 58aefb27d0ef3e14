"""Time headline queries and print one JSON line.

BENCH_SF_DIR: table folder (default /root/testdata/sf0.1). BENCH_CPUS: local cores (default 8).
Each query runs once to warm up, then BENCH_RUNS times (default 3); the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from reviewpulse.plans import QUERIES  # noqa: E402
from reviewpulse.session import build_session  # noqa: E402

HEADLINES = [
    "quality_report", "clean_all", "raw_collection_metrics", "p_time_anomaly", "p_spam_suspect", "w_dedupe_first",
    "a1_rating_distribution", "a2_rating_counts_by_app", "a3_length_summary", "a4_length_stats_by_rating",
    "b1_per_app_stats", "b2_score_skew_by_app", "b3_daily_volume", "b5_top_duplicate_texts", "c1_language_counts",
    "d1_top30_words", "d2_top_words_low_vs_high", "e_summary_rates", "hist_length_60", "box_length_by_rating",
    "w_spike_rank_orders", "w_per_day_cap_orders", "hourly_volume_events", "newest_n_per_app", "warehouse_constraints",
    "m_quality_history", "m_distribution_history", "m_drift_alerts", "m_overall_status", "p_detect_lang",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
        spark__driver__memory="16g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINES:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_headline_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "cores": cpus,
    }))


if __name__ == "__main__":
    main()
