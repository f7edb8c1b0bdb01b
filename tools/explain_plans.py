"""Physical-plan facts of the headline queries (exchanges, join strategies,
scan pruning) at one scale factor.  usage: python tools/explain_plans.py [sf_dir]"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tenure.plans.registry import QUERIES  # noqa: E402
from tenure.session import local_session  # noqa: E402

HEADLINE = ["radius_join", "merge_panel", "license_panel", "complaint_panel", "training_dataset",
            "time_varying_panel", "business_level_dataset", "geo_feature", "upsert", "flatten_timelines"]


def facts(plan: str) -> dict:
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    return {
        "shuffles": plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning") + plan.count("Exchange SinglePartition"),
        "broadcasts": plan.count("BroadcastExchange"),
        "sort_merge_joins": plan.count("SortMergeJoin"),
        "broadcast_hash_joins": plan.count("BroadcastHashJoin"),
        "nested_loop_joins": plan.count("NestedLoopJoin"),
        "cartesian": plan.count("CartesianProduct"),
        "python_udf": plan.count("BatchEvalPython") + plan.count("ArrowEvalPython"),
        "scan_columns": sorted({len(s.split(",")) for s in scans}),
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session("8")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the static plan, before runtime re-planning
    print("| query | shuffles | broadcasts | SMJ | BHJ | nested loop | cartesian | Python UDF | columns per scan |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name in HEADLINE:
        df = QUERIES[name](spark, sf)
        f = facts(df._jdf.queryExecution().executedPlan().toString())
        print(f"| `{name}` | {f['shuffles']} | {f['broadcasts']} | {f['sort_merge_joins']} | {f['broadcast_hash_joins']} | "
              f"{f['nested_loop_joins']} | {f['cartesian']} | {f['python_udf']} | {f['scan_columns']} |")


if __name__ == "__main__":
    main()
