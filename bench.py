"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores, BENCH_RUNS how often each query runs (the fastest run counts).
Each run computes the whole result and throws it away; streams run from a fresh checkpoint to the end of the input.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from tickflow.plans.catalog import QUERIES
from tickflow.plans.session import session_settings

HEADLINE = (
    "moving_stats",
    "moving_stats_reference",
    "moving_stats_join",
    "zscore_by_window",
    "shortest_windows",
    "forward_pairs",
    "conflate_latest",
    "locf_resample",
    "decode_ticks",
    "encode_moving_json",
    "replay_ticks",
    "stream_ticks_passthrough",
    "stream_moving_stats",
    "stream_zscore",
    "stream_shortest_windows",
    "stream_late_data",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    settings = session_settings(shuffle_partitions=8 if cpus == "*" else int(cpus), driver_memory="8g")
    settings |= {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timings = {name: round(min(seconds(name) for _ in range(runs)), 3) for name in HEADLINE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total of the fastest runs",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
