"""Summarise the physical plan of every registered query (writes PLANS.md).

Usage: python tools/plan_summary.py [sf_dir] > PLANS.md
For each query: shuffles (with partitioning), join strategies, scans with
their pruned read schema and pushed filters, and Python nodes (expected: none).
The plan is the one chosen before execution (AQE may still re-plan at run
time, e.g. turn a sort-merge join into a broadcast join on real sizes).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from enrichkit.plans import catalog  # noqa: E402
from enrichkit.session import get_session  # noqa: E402

JOINS = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct")


def summarise(plan: str) -> dict[str, list[str]]:
    exchanges = re.findall(r"Exchange (\w+partitioning\([^)]*\)|SinglePartition|RoundRobinPartitioning\(\d+\))[^\n]*?(ENSURE_REQUIREMENTS|REPARTITION_BY_NUM|REPARTITION_BY_COL)?", plan)
    joins = [
        f"{j} {m.group(1)}"
        for j in JOINS
        for m in re.finditer(rf"{j} [^\n]*?(Inner|LeftOuter|RightOuter|FullOuter|LeftSemi|LeftAnti)", plan)
    ]
    scans = []
    for line in plan.splitlines():
        if "FileScan" not in line:
            continue
        loc = re.search(r"Location: \w+\([^)]*\)\[([^\],]*)", line)
        pushed = re.search(r"PushedFilters: (\[[^\]]*\])", line)
        schema = re.search(r"ReadSchema: (struct<.*>)", line)
        name = os.path.basename(loc.group(1).rstrip(".")) if loc else "?"
        name = re.sub(r"-[0-9a-f]{8,}.*", "", name)
        text = f"{name}: {schema.group(1) if schema else '?'}"
        if pushed and pushed.group(1) != "[]":
            text += f"; pushed {pushed.group(1)}"
        scans.append(text)
    python = [n for n in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas") if n in plan]
    return {
        "shuffles": [" ".join(x for x in e if x) for e in exchanges],
        "joins": joins,
        "scans": scans,
        "python": python,
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=8)
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_summary.py` at `{os.path.basename(sf_dir)}`, Spark 4.1.2, ")
    print("8 shuffle partitions, AQE on (plans before run-time re-planning). Queries that")
    print("write intermediate tables show the plan of their final read only.\n")
    for name, fn in catalog.queries().items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        print(f"## {name}\n")
        print(f"* shuffles ({len(s['shuffles'])}): " + ("; ".join(s["shuffles"]) or "none"))
        print("* joins: " + ("; ".join(s["joins"]) or "none"))
        for scan in s["scans"]:
            print(f"* scan {scan}")
        print("* Python nodes: " + (", ".join(s["python"]) or "none") + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
