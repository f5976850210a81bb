"""Summarise every registered query's physical plan as it would be at scale.

Spark's size-based broadcast is switched off, so only the library's checked
broadcast hints produce broadcast joins (as when every driver table is large).
Prints a markdown table: hash exchanges, broadcast joins, sort-merge joins,
sort aggregates and scans with pushed filters.

Usage: python scripts/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from arrivals.plans.queries import QUERIES  # noqa: E402
from arrivals.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    print("| query | hash exchanges | broadcast joins | sort-merge joins | sort aggregates | scans | scans with pushed filters |")
    print("|---|---|---|---|---|---|---|")
    for name, fn in QUERIES.items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        scans = re.findall(r"FileScan \w+ \[.*", plan) + re.findall(r"Scan ExistingRDD", plan)
        pushed = [s for s in scans if "PushedFilters: [" in s and "PushedFilters: []" not in s]
        print(
            f"| `{name}` | {plan.count('Exchange hashpartitioning')} | {plan.count('BroadcastHashJoin')} | "
            f"{plan.count('SortMergeJoin')} | {plan.count('SortAggregate(') // 2} | {len(scans)} | {len(pushed)} |"
        )
    spark.stop()


if __name__ == "__main__":
    main()
