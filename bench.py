"""Time headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.registry import queries  # noqa: E402
from wattline.session import build_session  # noqa: E402

HEADLINE = [
    "national_features",
    "align_periods",
    "gold_regional",
    "weather_half_hourly",
    "gold_carbon_weather",
    "quality_carbon",
    "quality_report",
    "flatten_regional",
    "merge_insert_only",
    "append_last_wins",
    "evaluation_table",
    "decision_quality",
    "folds",
    "optimise_sessions",
    "fleet_demand",
    "greenest_window",
    "train_regional",
    "stream_tumbling",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("OFF")
    known = queries()
    # One untimed run: JVM start-up and class loading are not part of any query.
    known["national_features"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    took = {}
    for name in HEADLINE:
        start = time.perf_counter()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
        print(name, took[name], file=sys.stderr, flush=True)
    total = round(sum(took.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": took, "sf": sf}))


if __name__ == "__main__":
    main()
