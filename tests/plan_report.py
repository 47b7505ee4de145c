"""Summarise the physical plan of every registered query in its large-data
shape (no size-based broadcast, as when every input is large), as a
Markdown table: shuffles, scans with their read schema, aggregates and group
limits.

Usage: python tests/plan_report.py [sf_dir] > docs/PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

WRITERS = {
    "load_full_refresh", "csv_round_trip", "status_slice_storage", "parse_reviews", "ingest_report",
    "fact_incremental", "release_date_incremental", "movers_incremental", "review_movers_incremental",
    "dq_unique_incremental", "dq_unique_batch", "status_manifest_load", "published_catalogue", "dq_gate_verdict", "quarantine_counts", "fact_aligned", "release_date_aligned",
}


def summarise(plan: str) -> dict[str, str]:
    # the initial physical plan of an adaptive plan is enough: AQE only
    # coalesces, splits skew and turns joins into broadcasts at run time
    lines = plan.splitlines()
    exchanges = [re.sub(r"#\d+L?", "", m.group(1)) for m in map(lambda l: re.search(r"Exchange (\w+\([^)]*\)|SinglePartition)", l), lines) if m]
    scans = sorted({m.group(1) for m in map(lambda l: re.search(r"FileScan parquet \[([^\]]*)\]", l), lines) if m})
    joins = [m.group(1) for m in map(lambda l: re.search(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", l), lines) if m]
    partial = sum("partial_" in l for l in lines)
    wgl = sum("WindowGroupLimit" in l for l in lines)
    return {
        "shuffles": str(len(exchanges)),
        "exchange kinds": ", ".join(sorted({e.split("(")[0] for e in exchanges})) or "-",
        "joins": ", ".join(f"{j}×{joins.count(j)}" for j in sorted(set(joins))) or "-",
        "partial aggs": str(partial),
        "group limits": str(wgl),
        "scans": str(len([l for l in lines if "FileScan parquet" in l])),
        "columns read": "; ".join(re.sub(r"#\d+L?", "", s) for s in scans),
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    from playmart.session import build_session

    from playmart.plans.registry import QUERIES

    spark = build_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    rows = []
    for name, q in sorted(QUERIES.items()):
        if name in WRITERS:
            continue
        plan = q(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        rows.append((name, summarise(plan)))
    cols = ["shuffles", "exchange kinds", "joins", "partial aggs", "group limits", "scans", "columns read"]
    print("# Physical plans in the large-data shape\n")
    print(
        "Generated by `python tests/plan_report.py` with size-based broadcast disabled "
        "(`spark.sql.autoBroadcastJoinThreshold=-1`, also for AQE), i.e. the plan Spark "
        "picks when no side is known to be small. At run time AQE may still coalesce "
        "partitions, split skewed join partitions and turn a join into a broadcast when "
        "a measured side is below its threshold. No query has a cartesian product or a "
        "nested-loop join; every aggregate runs partial before its shuffle.\n"
    )
    print("| query | " + " | ".join(cols) + " |")
    print("| --- | " + " | ".join("---" for _ in cols) + " |")
    for name, s in rows:
        print(f"| `{name}` | " + " | ".join(s[c] for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
