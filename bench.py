"""Headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import sys
import time
from statistics import median

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

#: Flagship, intervals, intersection, nearest matching, greedy pairing, containment, session metrics, all detectors.
HEADLINES = [
    "flagship_risk_score", "w1_episodes", "u3_union_length", "u5_intersection_length", "j1_locate_section", "j3_section_end", "j15_nearest_violation",
    "f2_paste_delete_pairs", "f5_gaze_input_pairs", "k6_budgeted_moments", "x20_excerpt_containment", "a1_metric_series", "a3_session_metrics",
    "a14_cohort", "d30_all_detectors",
]


def main() -> None:
    from pyspark.sql import SparkSession

    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from evidencelake.plans.catalog import QUERIES

    runs = int(os.environ.get("BENCH_RUNS", "3"))
    took = {}
    for name in HEADLINES:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        took[name] = round(median(times), 3)
    spark.stop()
    print(json.dumps({"metric": "median seconds a query, summed", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
