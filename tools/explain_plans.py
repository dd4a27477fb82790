"""Summarise the final (post-AQE) physical plans of the headline queries.

usage: python tools/explain_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys
import time
from collections import Counter

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)

HEADLINE = ["base_events", "session_channel_groups", "gclid_campaigns", "daily_sessions",
            "user_last_source", "session_starts_enriched"]


def summary(plan: str) -> dict:
    plan = "\n".join(line for line in plan.splitlines() if "ReusedExchange" not in line)
    strip = lambda s: re.sub(r"#\d+L?", "", s)
    count = lambda items: [f"{n} x {x}" for x, n in sorted(Counter(items).items())]
    scans = re.findall(r"FileScan parquet [^\n]*?Location: [^\n]*?([^/,\]\s]+)\]", plan)
    out = {
        "scans": count(re.sub(r"-[0-9a-f]{12}", "", x) for x in scans),
        "exchanges": count(strip(m) for m in re.findall(r"Exchange (hashpartitioning\([^)]*\)|rangepartitioning\([^)]*\)|SinglePartition)", plan)),
        "windows": sorted({strip(m) for m in re.findall(r"windowspecdefinition\(([^,]*(?:, [^,]*){0,2})", plan)}),
        "joins": sorted({strip(m) for m in re.findall(r"((?:SortMerge|BroadcastHash|ShuffledHash)Join \[[^\]]*\], \[[^\]]*\], \w+)", plan)}),
        "aggregates": len(re.findall(r"HashAggregate\(keys=", plan)) + len(re.findall(r"SortAggregate\(key=", plan)),
        "partition_filters": sorted({strip(m)[:200] for m in re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)}),
        "python": "an Arrow pass (MapInArrow)" if "MapInArrow" in plan else "EvalPython" in plan or "PythonUDF" in plan,
        "single_partition": "SinglePartition" in plan,
    }
    return out


def main():
    from touchpath.plans import queries as Q
    from touchpath.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=16,
                        extra={"spark.driver.memory": "8g", "spark.sql.maxMetadataStringLength": "1000"})
    print("# Physical plans of the headline queries\n")
    print(f"Final adaptive plans (after AQE re-planning) of a full run on `{sf}` (local[8]); attribute ids removed.")
    print("Generated by `tools/explain_plans.py`.\n")
    for name in HEADLINE:
        df = Q.run(spark, name, sf)
        t = time.perf_counter()
        # run the DataFrame's own query execution (a write would plan a new
        # one), so its adaptive plan below is the final, re-optimised one
        df.collect()
        el = time.perf_counter() - t
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan
        plan = plan.split("== Initial Plan ==")[0]
        s = summary(plan)
        print(f"## {name}  ({el:.2f} s)\n")
        print(f"* aggregates: {s['aggregates']}; Python in plan: {s['python']}; single-partition exchange: {s['single_partition']}")
        for key in ("scans", "exchanges", "windows", "joins", "partition_filters"):
            print(f"* {key}:")
            for item in s[key]:
                print(f"  * `{item}`")
        print()


if __name__ == "__main__":
    main()
