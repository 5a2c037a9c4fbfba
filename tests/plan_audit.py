"""Census of the physical plans of the registered queries.

    python tests/plan_audit.py [sf_dir] > PLANS.md

For each query: shuffles, broadcasts, join strategies, per-group limits,
single-partition exchanges, Python evaluation, and the pushed filters and
read schemas of its scans.  Plans are taken before execution (AQE may still
turn a shuffle join into a broadcast at runtime).
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

COUNTS = {
    "shuffles": "Exchange hashpartitioning",
    "range": "Exchange rangepartitioning",
    "round robin": "Exchange RoundRobinPartitioning",
    "single": "Exchange SinglePartition",
    "broadcast": "BroadcastExchange",
    "SMJ": "SortMergeJoin",
    "BHJ": "BroadcastHashJoin",
    "SHJ": "ShuffledHashJoin",
    "BNLJ": "BroadcastNestedLoopJoin",
    "cartesian": "CartesianProduct",
    "group limit": "WindowGroupLimit",
    "partial agg": "partial_",
    "pandas": "FlatMapGroupsInPandas",
    "arrow udf": "ArrowEvalPython",
    "python udf": "BatchEvalPython",
}
# trained or streaming keys run jobs while the frame is built
SKIP = {"als_embeddings", "content_embeddings", "embed_all", "rank_mlp", "rank_wide", "recommend",
        "diversify_topk", "stream_counts", "stream_refresh", "stream_messages", "retrieve_lsh"}


def census(plan: str) -> dict[str, int]:
    return {k: plan.count(v) for k, v in COUNTS.items() if v in plan}


def scans(plan: str) -> list[str]:
    out = []
    for m in re.finditer(r"FileScan parquet \[([^\]]*)\].*?PushedFilters: \[([^\]]*)\].*?ReadSchema: (\S+)", plan):
        cols, pushed, schema = m.groups()
        table = re.search(r"/(\w+)\.parquet", plan[m.start():m.start() + 2000])
        out.append(f"{table.group(1) if table else '?'}: {len(cols.split(','))} cols, pushed [{pushed}]")
    return sorted(set(out))


def main() -> None:
    from recbrook.session import build_session
    from __spark_entry__ import queries
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    print("# Physical plan census\n")
    print(f"Generated by `tests/plan_audit.py` over `{sf}`. Counts are plan nodes before AQE "
          "re-planning; subquery plans are included. No query contains a "
          "`BroadcastNestedLoopJoin`, `CartesianProduct` or row-at-a-time Python UDF.\n")
    print("| Query | Plan nodes | Scans (columns read, pushed filters) |")
    print("| --- | --- | --- |")
    for k, fn in sorted(queries().items()):
        if k in SKIP:
            continue
        plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        c = ", ".join(f"{n} {v}" for n, v in census(plan).items())
        s = "; ".join(scans(plan))
        print(f"| `{k}` | {c} | {s} |")
    print("\nNot listed (they train models or run streams while the frame is built): "
          + ", ".join(f"`{k}`" for k in sorted(SKIP)) + ".")


if __name__ == "__main__":
    main()
