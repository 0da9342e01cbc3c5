"""Summarise the physical plan of registered queries: shuffles,
broadcasts, join strategies, windows, Python nodes.

usage: python tools/plan_summary.py [sf_dir] [name ...]
"""

from __future__ import annotations

import collections
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans.catalog import QUERIES  # noqa: E402
from tessera.session import get_session  # noqa: E402

NODES = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange RoundRobin",
         "Exchange SinglePartition", "ReusedExchange", "BroadcastExchange", "SortMergeJoin",
         "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct",
         "WindowGroupLimit", "Window", "InMemoryTableScan", "Scan ExistingRDD", "Generate", "Expand", "ObjectHashAggregate",
         "SortAggregate", "HashAggregate", "Scan parquet", "ArrowEvalPython", "BatchEvalPython",
         "MapInPandas", "FlatMapGroupsInPandas", "Subquery"]


def final_only(plan: str) -> str:
    """The final adaptive plans only (every '== Initial Plan ==' block is
    dropped) and without the text of cached sub-plans."""
    out, skip_indent = [], None
    for line in plan.splitlines():
        indent = len(line) - len(line.lstrip(" :+-|"))
        if skip_indent is not None:
            if indent > skip_indent:
                continue
            skip_indent = None
        if "== Initial Plan ==" in line or "InMemoryRelation" in line:
            skip_indent = indent
            continue
        out.append(line)
    return "\n".join(out)


def summarise(plan: str) -> dict:
    c = collections.Counter()
    for line in final_only(plan).splitlines():
        s = line.strip(" +-:*")
        for n in NODES:
            if s.startswith(n):
                c[n] += 1
                break
    return dict(c)


def walk(node, counts=None):
    """Count the operators of the executed plan tree itself: query stages
    are entered, cached-table scans are counted but not entered (their
    data was built by an earlier job)."""
    counts = collections.Counter() if counts is None else counts
    name = node.nodeName()
    counts[name] += 1
    if name.startswith("InMemoryTableScan"):
        return counts
    if "QueryStage" in name:
        return walk(node.plan(), counts)
    if name == "AdaptiveSparkPlan":
        return walk(node.executedPlan(), counts)
    kids = node.children()
    for i in range(kids.size()):
        walk(kids.apply(i), counts)
    return counts


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or sorted(QUERIES)
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("NO_AUTO_BROADCAST"):
        # plan as for large tables: only explicit (size-checked) broadcasts remain
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        df.collect()  # run it, so the final adaptive plan (with reuse) is shown
        root = df._jdf.queryExecution().executedPlan()
        try:  # adaptive plans: the final tree only
            root = root.executedPlan()
        except Exception:
            pass
        plan = root.toString()
        if os.environ.get("SHOW_PLAN"):
            print(plan)
        tree = walk(df._jdf.queryExecution().executedPlan())
        keep = {k: v for k, v in sorted(tree.items())
                if any(t in k for t in ("Exchange", "Join", "Window", "InMemory", "Scan", "Aggregate",
                                        "Generate", "Expand", "Cartesian", "NestedLoop", "Python"))}
        print(f"{name:30s}", keep, flush=True)


if __name__ == "__main__":
    main()
