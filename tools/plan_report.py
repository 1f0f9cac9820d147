"""Summarise the final (post-AQE) physical plan of every registered query.

    python tools/plan_report.py [sf_dir] > PLANS.md

Per query: shuffle exchanges, reused exchanges, broadcast exchanges, join
strategies, partial aggregates, scans and their pushed filters, and any
Python evaluation node (there should be none).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from popspark.plans import catalog  # noqa: E402
from popspark.session import local_session  # noqa: E402

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


def summarise(plan: str) -> dict:
    final = plan.split("== Initial Plan ==")[0]
    lines = final.split("\n")
    joins = {}
    for line in lines:
        m = re.search(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", line)
        if m:
            kind = m.group(1)
            jt = re.search(r"(Inner|LeftOuter|LeftSemi|LeftAnti|RightOuter|FullOuter)", line)
            key = f"{kind}({jt.group(1) if jt else '?'})"
            joins[key] = joins.get(key, 0) + 1
    scans = [ln for ln in lines if "FileScan" in ln or "Scan parquet" in ln]
    pushed = sum(1 for ln in scans if re.search(r"(PushedFilters: \[[^\]]+\]|DataFilters: \[[^\]]+\])", ln))
    return {
        "shuffles": sum(
            1
            for ln in lines
            if "ReusedExchange" not in ln
            and re.search(r"\bExchange (hashpartitioning|rangepartitioning|SinglePartition)", ln)
        ),
        "reused": sum(ln.count("ReusedExchange") for ln in lines),
        "broadcasts": sum(1 for ln in lines if "BroadcastExchange" in ln),
        "joins": ", ".join(f"{k}×{v}" for k, v in sorted(joins.items())) or "–",
        "partial_agg": "yes" if "partial_" in final else "–",
        "scans": len(scans),
        "scans_with_filters": pushed,
        "python": "YES" if any(n in final for n in PYTHON_NODES) else "none",
    }


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    print(f"# Final physical plans (AQE), {os.path.basename(sf)}, local[8]\n")
    print("Generated by `tools/plan_report.py`. Counts are taken from the executed (final) plan.\n")
    print("| query | shuffles | reused | broadcasts | joins | partial agg | scans (with pushed filters) | python |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in catalog.QUERIES.items():
        df = fn(spark, sf)
        df.collect()  # executes df's own query execution, so its plan below is the final one
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        print(
            f"| {name} | {s['shuffles']} | {s['reused']} | {s['broadcasts']} | {s['joins']} | {s['partial_agg']} "
            f"| {s['scans']} ({s['scans_with_filters']}) | {s['python']} |"
        )


if __name__ == "__main__":
    main(sys.argv)
