"""Write PLANS.md: the physical plan tree of the key queries.

    python tools/plans.py [--sf-dir /root/testdata/sf0.01]

Static plans (AQE off, so the tree shows what Catalyst chose before any
runtime re-planning; AQE then only coalesces partitions, converts joins to
broadcast after measuring, and splits skewed partitions). Scan lines list the
columns read and the pushed filters.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

QUERIES = ["gold_usage", "usage_pivot", "device_count", "upsert_merge", "latest_snapshot", "v_top", "dedup_on_key"]

NOTES = {
    "gold_usage": "Two scans (five event columns and two), four exchanges, each on a partial or final "
                  "aggregate; the contract window sits on the contract exchange; the join meets two "
                  "contract-partitioned sides; the Active window needs neither sort nor exchange.",
    "usage_pivot": "One scan, one exchange: six conditional sums with map-side partial aggregation.",
    "device_count": "Distinct devices: partial on (Contract, Mac), then on Contract.",
    "upsert_merge": "Two gold builds (the early export and the re-export) then a left-anti join on the "
                    "serving key and a union.",
    "latest_snapshot": "The latest day is a scalar subquery over bronze (one column); gold is built once.",
    "v_top": "TakeOrderedAndProject: per-partition top-n, then a merge of n rows per partition; the rank "
             "window runs on those n rows only.",
    "dedup_on_key": "One row per key as a grouped max over a struct: partial aggregation, no per-key window.",
}


def tree(plan: str) -> str:
    out = []
    for line in plan.splitlines():
        if not line.strip():
            break
        out.append(line)
    return "\n".join(out)


def scans(plan: str) -> list[str]:
    found = []
    for block in plan.split("\n\n"):
        lines = block.strip().splitlines()
        if lines and lines[0].startswith("(") and "Scan " in lines[0]:
            keep = [ln for ln in lines if re.match(r"(PushedFilters|PartitionFilters|ReadSchema)", ln)]
            found.append("; ".join(keep))
    return found


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    args = ap.parse_args()
    from viewlog.plans import queries as Q
    from viewlog.session import build_session

    spark = build_session("local[8]", 8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    parts = ["# Physical plans\n", f"Generated by `tools/plans.py` on `{args.sf_dir}` (AQE off: static plans).\n"]
    for name in QUERIES:
        df = Q.registry()[name](spark, args.sf_dir)
        plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        parts.append(f"## {name}\n\n{NOTES.get(name, '')}\n\n```\n{tree(plan.split('== Physical Plan ==')[1].strip())}\n```\n")
        sc = scans(plan)
        if sc:
            parts.append("Scans:\n\n" + "\n".join(f"- `{s}`" for s in sc) + "\n")
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
