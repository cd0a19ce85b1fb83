"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores. Every query is run
BENCH_RUNS times to a sink that discards rows; its best run counts, the first being a warm-up.
"""

from __future__ import annotations

import json
import os
import time

from barloom.session import build_session
from workload.bars import QUERIES

HEADLINE = [
    "validation_report", "validation_report_history", "report_summary", "upsert_keep_last",
    "dedupe_keep_last", "repair_ohlc", "repair_assets", "resume_plan", "row_counts",
    "date_gaps", "duplicate_rows", "check_ohlc", "build_universe", "parse_listing",
    "upsert_assets", "status_summary", "scan_bars", "store_upsert", "stream_ingest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").write.format("noop").mode("overwrite").save()

    seconds: dict[str, float] = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs):
            begun = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - begun)
        seconds[name] = round(min(taken), 3)
    print(json.dumps({
        "metric": "headline queries, sum of best runs",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
