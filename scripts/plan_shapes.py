"""Write PLANS.md: the operator tree of each headline query's final adaptive plan (expressions elided), run at
one scale with broadcasts disabled so the shuffle plans a cluster would use are visible.

usage: python scripts/plan_shapes.py [sf_dir] > PLANS.md
"""
from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stridex.config import local_session  # noqa: E402
from stridex.queries import QUERIES  # noqa: E402

SHOW = ["distinct_users", "latest_n_all_users", "features_latest", "gap_sessions", "interval_assign_b",
        "feat_mean", "features_interval", "restrict_users", "features_requested_users"]
KEEP = ("Exchange", "ReusedExchange", "HashAggregate", "SortMergeJoin", "BroadcastHashJoin", "Window",
        "WindowGroupLimit", "FileScan", "Generate", "Expand", "Union", "AQEShuffleRead", "BroadcastExchange",
        "TakeOrderedAndProject")


def shape(plan: str) -> list[str]:
    out = []
    for line in plan.split("== Initial Plan ==")[0].splitlines():
        m = re.match(r"^([\s:+\-|]*)(\*\(\d+\) )?(\w+)(.*)$", line)
        if not m or m.group(3) not in KEEP:
            continue
        indent, op, rest = m.group(1), m.group(3), re.sub(r"#\d+L?", "", m.group(4))
        detail = ""
        if op in ("Exchange",):
            detail = " " + re.sub(r",\s*\d+\).*", ")", rest.strip()).split(", ENSURE")[0]
        elif op == "HashAggregate":
            keys = re.search(r"keys=\[([^\]]*)\]", rest)
            if "functions=[]" in rest:
                mode = "grouping only"
            else:
                mode = "partial" if "partial_" in rest else ("merge" if "merge_" in rest else "final")
            detail = f"(keys=[{keys.group(1) if keys else ''}], {mode})"
        elif op == "FileScan":
            rs = re.search(r"ReadSchema: (struct<[^>]*>)", rest)
            detail = f" {rs.group(1) if rs else ''}"
        elif op in ("SortMergeJoin", "BroadcastHashJoin"):
            detail = " " + " ".join(rest.split()[:6])
        elif op == "WindowGroupLimit":
            detail = " " + rest.strip().split(",")[-1]
        out.append(f"{indent}{op}{detail}"[:160])
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "400")
    print("# Plan shapes\n")
    print(f"Final adaptive plans at `{os.path.basename(sf_dir)}`, broadcasts disabled (the shuffle plans a cluster "
          "uses), operators only. Generated by `scripts/plan_shapes.py`.\n")
    print("What to look for: `FileScan` read schemas pruned to the columns a query needs (user and session steps "
          "read three event columns); a `partial` aggregate under every aggregate exchange; `WindowGroupLimit Partial` "
          "before the newest-N shuffle; the samples shuffled once by key for sessions (no key is "
          "hot here); the stop-anchored range join on (key, bucket `_b`); the feature statistics joined on the "
          "derived key `_gk` (both inputs plain shuffles, so AQE can split a hot group); `feat_mean` without any "
          "join.\n")
    for name in SHOW:
        df = QUERIES[name](spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"## {name}\n\n```")
        print("\n".join(shape(plan)))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
