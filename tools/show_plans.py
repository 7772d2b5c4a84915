"""Print the final (adaptive) physical plans of the main operators after running them.

Usage: python tools/show_plans.py [sf_dir] [name ...]
Shows for each: exchanges (shuffles), join strategies, scans with their read schema and
pushed filters — the things to check when asking "would this hold at 1000x".
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakepact.session import local_session  # noqa: E402
from lakepact.suite.queries import QUERIES  # noqa: E402

DEFAULT = ["q_check_unique_composite", "q_sql_rule_fd", "q_gate_report", "q_duplicate_first_seen",
           "q_key_position", "q_schema_drift", "q_contract_diff", "q_dictionary_lint", "q_norm_text"]
KEEP = re.compile(r"(Exchange|BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastExchange|"
                  r"HashAggregate|Window|Scan parquet|ReadSchema|PushedFilters|AQEShuffleRead|Generate)")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or DEFAULT
    spark = local_session(8, 8)
    for n in names:
        df = QUERIES[n](spark, sf)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = [ln for ln in plan.splitlines() if KEEP.search(ln)]
        shuffles = sum("Exchange" in ln and "Broadcast" not in ln for ln in lines)
        print(f"==== {n}: {shuffles} shuffle exchange(s)")
        for ln in lines:
            print("   ", ln[:220])


if __name__ == "__main__":
    main()
