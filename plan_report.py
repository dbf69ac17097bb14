"""Tabulate the executed (final AQE) physical plan of every SQL-checked query.

Auto-broadcast is switched off, as at full scale where class tables are far
over the broadcast threshold, so the counts show the shuffles a large run
pays.  Broadcasts that remain are the explicit, size-bounded ones.  Writes a
markdown table to stdout.

usage: python plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import re
import sys
from collections import Counter

from ledgerlens.plans.queries import REGISTRY, queries
from ledgerlens.plans.tables import Tables
from ledgerlens.session import get_session

PATTERNS = {
    "hash shuffle": r"Exchange hashpartitioning",
    "range shuffle": r"Exchange rangepartitioning",
    "single-partition": r"Exchange SinglePartition",
    "reused": r"ReusedExchange",
    "bounded broadcast": r"BroadcastExchange",
    "sort-merge join": r"SortMergeJoin",
    "window": r"\bWindow \[",
    "top-k": r"TakeOrderedAndProject",
}


def final_plan(tree: str) -> str:
    """The tree without the "Initial Plan" blocks that adaptive subqueries carry
    beside their final plan."""
    out, skip = [], None
    for line in tree.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if skip is not None:
            if depth >= skip:
                continue
            skip = None
        if "== Initial Plan ==" in line:
            skip = depth
            continue
        out.append(line)
    return "\n".join(out)


def main(argv) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=16)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    queries()
    t = Tables(spark, sf_dir).materialize(
        f"{spark.sparkContext.getCheckpointDir()}/plan-report-tables")
    print(f"# Executed plans ({sf_dir}, auto-broadcast off)\n")
    print("Counts are operators in the final adaptive plan, subqueries included; "
          "`reused` exchanges are read again, not recomputed. Single-partition "
          "exchanges only ever carry global aggregates or tables with one row "
          "per range slice / time step.\n")
    print("| query | " + " | ".join(PATTERNS) + " |")
    print("|---|" + "---|" * len(PATTERNS))
    for name, q in REGISTRY.items():
        if q.oracle is None:
            continue
        df = q.build(t)
        df.collect()                      # executes this DataFrame's own plan (small results)
        plan_node = df._jdf.queryExecution().executedPlan()
        if plan_node.nodeName() == "AdaptiveSparkPlan":
            plan_node = plan_node.executedPlan()
        plan = final_plan(plan_node.treeString())
        c = Counter({k: len(re.findall(p, plan)) for k, p in PATTERNS.items()})
        # a ReusedExchange line also names the exchange it reuses
        c["hash shuffle"] -= len(re.findall(r"ReusedExchange[^\n]*hashpartitioning", plan))
        c["range shuffle"] -= len(re.findall(r"ReusedExchange[^\n]*rangepartitioning", plan))
        print(f"| `{name}` | " + " | ".join(str(c[k]) for k in PATTERNS) + " |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
