"""Summarize the physical plans of the headline queries (writes PLANS.md).

    python tools/plan_report.py [--sf /root/testdata/sf0.01]

For each query: exchanges by kind, join strategies, window and aggregate nodes, Python
nodes (there should be none) and, per file scan, the columns read and the pushed filters.
The plan is the final adaptive plan, taken after running the query once.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

HEADLINE = [
    "gap_fill", "series_metrics", "series_metrics_blocked", "harmonize_daily", "daily_metrics",
    "monthly_metrics", "combined_currency", "latest_20", "forward_fill_array", "update_from_join",
    "load_all_series", "filter_date_range", "union_daily_monthly", "stream_append_only",
]


def summarize(plan: str) -> dict:
    return {
        "shuffle exchanges": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|"
                                            r"Exchange SinglePartition|Exchange RoundRobin", plan)),
        "reused exchanges": plan.count("ReusedExchange"),
        "broadcast exchanges": plan.count("BroadcastExchange"),
        "sort-merge joins": plan.count("SortMergeJoin"),
        "broadcast hash joins": plan.count("BroadcastHashJoin"),
        "nested-loop / cartesian": plan.count("BroadcastNestedLoopJoin") + plan.count("CartesianProduct"),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "hash aggregates": plan.count("HashAggregate("),
        "top-k": plan.count("TakeOrderedAndProject"),
        "python nodes": len(re.findall(r"Python|ArrowEval|FlatMapGroupsInPandas", plan)),
    }


def final_plan(plan: str) -> str:
    """The adaptive plan string lists the final plan, then the initial one: keep the first."""
    return plan.split("== Initial Plan ==")[0]


def scans(plan: str) -> list[str]:
    out = []
    for m in re.finditer(r"FileScan (\w+) \[([^\]]*)\][^\n]*", plan):
        line = m.group(0)
        cols = re.sub(r"#\d+L?", "", m.group(2))
        loc = re.search(r"Location: \w+\([^)]*\)\[([^\]]*)\]", line)
        name = os.path.basename(loc.group(1).split(",")[0].rstrip("/")) if loc else "?"
        pushed = re.search(r"PushedFilters: (\[[^\]]*\])", line)
        out.append(f"{m.group(1)} `{name}` reads [{cols}], pushed {pushed.group(1) if pushed else '[]'}")
    return sorted(set(out))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--out", default=os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                                  "PLANS.md"))
    args = ap.parse_args()
    from rateflow.plans.queries import QUERIES
    from rateflow.session import local_session

    spark = local_session()
    lines = ["# Physical plans of the headline queries", "",
             f"Final adaptive plans after one run on `{args.sf}` (`tools/plan_report.py`).", ""]
    for name in HEADLINE:
        df = QUERIES[name](spark, args.sf)
        df.collect()
        plan = final_plan(df._jdf.queryExecution().executedPlan().toString())
        s = summarize(plan)
        lines.append(f"## {name}")
        lines.append("")
        lines.append(", ".join(f"{k}: {v}" for k, v in s.items()))
        lines.append("")
        for sc in scans(plan):
            lines.append(f"- {sc}")
        lines.append("")
    with open(args.out, "w") as fh:
        fh.write("\n".join(lines))
    print("\n".join(lines))


if __name__ == "__main__":
    main()
