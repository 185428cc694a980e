"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the number of local
cores, ``BENCH_QUERIES`` an optional comma-separated choice.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stationflow.plans.catalog import QUERIES  # noqa: E402
from stationflow.session import build_session  # noqa: E402

HEADLINE = (
    "clean_observations",
    "normalize_observations",
    "json_decode",
    "restamp_publish",
    "risk_score",
    "comfort_indices",
    "trend_features",
    "lag_features",
    "rolling_features",
    "all_features",
    "unpivot_align",
    "fill_series",
    "quality_score",
    "iqr_filter",
    "latest_per_city",
    "all_metrics",
    "latest_predictions_all",
    "history_plus_future",
    "prediction_upsert",
    "stream_clean_parquet",
    "stream_latest_state",
    "train_score",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        # Small shuffles here still mean CPU-heavy windows: keep one task per core.
        spark__sql__adaptive__coalescePartitions__minPartitionSize="64k",
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["clean_observations"](spark, folder).write.format("noop").mode("overwrite").save()  # warm-up
    seconds = {}
    for name in chosen:
        begin = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
