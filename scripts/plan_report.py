"""Physical-plan review of every registered batch query -> PLANS.md.

For each query the executed (AQE final) plan is summarised: shuffles,
broadcasts chosen at runtime, aggregate kinds, windows, joins, and the
columns each Parquet scan reads. Usage:
    python scripts/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from turnmeter.plans.catalog import QUERIES  # noqa: E402
from turnmeter.session import build_session  # noqa: E402

PATTERNS = {
    "shuffles": r"^\s*[:+\- ]*Exchange hashpartitioning|Exchange SinglePartition|Exchange rangepartitioning",
    "broadcasts": r"BroadcastExchange",
    "hash_aggs": r"\bHashAggregate\(",
    "sort_aggs": r"\bSortAggregate\(",
    "windows": r"\bWindow \[",
    "bhj": r"BroadcastHashJoin",
    "smj": r"SortMergeJoin",
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 16)
    print(f"# Physical plans (AQE final plans at {os.path.basename(sf_dir)})\n")
    print("Counts are operators in the executed plan; `scan columns` lists what each Parquet scan reads.\n")
    print("| query | shuffles | broadcasts | hash agg | sort agg | windows | BHJ | SMJ | scan columns |")
    print("|---|---|---|---|---|---|---|---|---|")
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts = {k: len(re.findall(v, plan, flags=re.M)) for k, v in PATTERNS.items()}
        scans = sorted(set(re.findall(r"FileScan parquet \[([^\]]*)\]", plan)))
        cols = "; ".join(",".join(c.split("#")[0] for c in s.split(",")) for s in scans)
        print(f"| {name} | {counts['shuffles']} | {counts['broadcasts']} | {counts['hash_aggs']} | "
              f"{counts['sort_aggs']} | {counts['windows']} | {counts['bhj']} | {counts['smj']} | {cols} |")
    spark.stop()


if __name__ == "__main__":
    main()
