"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed in full through the ``noop`` sink (every row is
produced, nothing is collected to the driver): one warm-up run, then the
median of ``BENCH_RUNS`` timed runs. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from viewlog.plans import queries as Q  # noqa: E402
from viewlog.session import build_session  # noqa: E402


HEADLINE = [
    "gold_usage",
    "silver_summary",
    "usage_pivot",
    "device_count",
    "upsert_merge",
    "latest_snapshot",
    "v_kpi",
    "v_content",
    "v_top",
    "offset_slice",
    "flatten_source",
    "file_stream_usage",
    "dedup_on_key",
    "v_segment",
    "incremental_ingest",
    "stream_ingest",
    "pipeline_serving",
    "pipeline_serving_incremental",
]


def run_once(df) -> float:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus), app="viewlog-bench")
    reg = Q.registry()
    jobs = {n: reg[n] for n in HEADLINE if n in reg}
    times: dict[str, float] = {}
    for name, fn in jobs.items():
        samples = []
        # Building the DataFrame is part of the query (ingest queries write
        # their source files and tables there), so it is timed too.
        for i in range(runs + 1):
            t0 = time.perf_counter()
            df = fn(spark, sf_dir)
            build = time.perf_counter() - t0
            dt = build + run_once(df)
            if i > 0:
                samples.append(dt)
        times[name] = round(statistics.median(samples), 4)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        "spark": spark.version,
        "rows_gold": None,
    }
    out["rows_gold"] = Q.q_gold_usage(spark, sf_dir).select(F.count(F.lit(1))).first()[0]
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
