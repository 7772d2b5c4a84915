"""Headline timings: prints ONE JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3).
Each query is run once to warm up, then BENCH_RUNS times; the median is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from lakepact.operators.checks import check_report  # noqa: E402
from lakepact.plans.apply import apply_contract  # noqa: E402
from lakepact.session import local_session, scratch_path  # noqa: E402
from lakepact.sources.text import as_text  # noqa: E402
from lakepact.suite import contracts as C  # noqa: E402
from lakepact.suite.queries import QUERIES  # noqa: E402

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

# Ten row predicates over lineitem (the baseline's "ten filter counts").
TEN = [
    "l_quantity > 25", "l_discount > 0.05", "l_tax = 0", "l_returnflag = 'R'", "l_linestatus = 'O'",
    "l_extendedprice > 50000", "l_tax < l_discount", "l_shipdate < '1997-01-01'", "l_linenumber > 4",
    "l_suppkey < 50",
]


def main() -> None:
    spark = local_session(CPUS, int(CPUS) * 2, app="lakepact-bench")
    li = lambda: spark.read.parquet(f"{SF}/lineitem.parquet")

    # A CSV delivery of lineitem, written once (not timed), as a delivery of that size
    # arrives: several files (each file is one split of a multi-line CSV read).
    delivery = scratch_path(spark, "bench", "lineitem_csv")
    as_text(li()).repartition(int(CPUS)).write.option("header", True).csv(delivery)
    spark.conf.set("lakepact.lake.root", scratch_path(spark, "bench", "lake"))

    def ten_separate():
        df = li()
        return [df.where(p).count() for p in TEN]

    def ten_fused():
        df = li()
        return df.agg(*[F.count_if(F.expr(p)) for p in TEN]).collect()

    def lineitem_report():
        c = C.lineitem()
        return check_report(li(), c).collect()

    def load_orders_like_lineitem():
        # W1 on the lineitem delivery: read text, type, stage + fused checks, key and SQL
        # checks on the staged copy, gate (it fails on the repeated key, so nothing is
        # published), no extra rows through the driver.
        c = C.lineitem(f"b{uuid.uuid4().hex[:8]}")
        try:
            apply_contract(spark, c, C.ENV, delivery, post_check=False)
        except Exception as e:  # noqa: BLE001 - the gate is expected to refuse this delivery
            if type(e).__name__ != "GateFailed":
                raise

    def load_orders():
        c = C.orders(f"b{uuid.uuid4().hex[:8]}")
        return apply_contract(spark, c, C.ENV, as_text(spark.read.parquet(f"{SF}/orders.parquet")))

    cases = {
        "ten_counts_separate": ten_separate,
        "ten_counts_fused": ten_fused,
        "lineitem_check_report": lineitem_report,
        "load_lineitem_gate": load_orders_like_lineitem,
        "load_orders_publish": load_orders,
    }
    for q in ["q_check_unique_composite", "q_gate_report", "q_sql_rule_fd", "q_schema_drift",
              "q_contract_diff", "q_norm_text", "q_duplicate_first_seen", "q_key_position",
              "q_dictionary_lint", "q_dictionary_contracts"]:
        cases[q] = (lambda q=q: QUERIES[q](spark, SF).collect())

    times: dict[str, float] = {}
    for name, fn in cases.items():
        fn()
        runs = []
        for _ in range(RUNS):
            t0 = time.perf_counter()
            fn()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)

    print(json.dumps({
        "metric": "sum_of_median_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF).replace("sf", ""),
        "cpus": CPUS,
        "runs": RUNS,
    }))


if __name__ == "__main__":
    main()
