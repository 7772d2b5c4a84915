"""Task-level skew report from Spark's event log (no UI): runs the skew-sensitive operators
on 6M rows where one key holds a third of them, then prints, per stage, the task count and
the share of the stage's records handled by its largest task.

Usage: python tools/task_skew.py
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession, functions as F  # noqa: E402

N = 6_000_000


def main() -> None:
    log_dir = tempfile.mkdtemp(prefix="lakepact-eventlog-")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .config("spark.eventLog.compress", "false")
        .config("spark.sql.shuffle.partitions", "64")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from lakepact.operators import checks as K
    from lakepact.operators.windows import later_repeats, ordered_join, running_count
    from lakepact.session import scratch_path

    rows = spark.range(N).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT"))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 200000).cast("string"))).alias("grp"),
        (F.col("id") % 1000).cast("string").alias("v"),
    )
    path = scratch_path(spark, "task_skew")
    rows.repartition(16).write.parquet(path)
    d = spark.read.parquet(path)
    jobs = {
        "key check (grp, v)": lambda: K.duplicate_keys(d, ["grp", "v"]).collect(),
        "key check (grp)": lambda: K.duplicate_keys(d, ["grp"], "exact").collect(),
        "first-seen repeats": lambda: later_repeats(d, ["grp"], "id").agg(F.count("*")).collect(),
        "running count": lambda: running_count(d, ["grp"], "id", (F.col("id") % 2 == 0).cast("int"),
                                               "p").agg(F.max("p")).collect(),
        "ordered join": lambda: ordered_join(d, ["grp"], "id", "v", ",", "s").agg(F.max(F.length("s"))).collect(),
        "count distinct": lambda: d.groupBy("grp").agg(F.count_distinct("v")).count(),
    }
    marks = []
    for name, fn in jobs.items():
        spark.sparkContext.setJobGroup(name, name)
        fn()
        marks.append(name)
    spark.stop()

    # Spark 4 writes a rolling log: a folder of event files (older Sparks: one file)
    files = sorted(f for f in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
                   if os.path.isfile(f) and "appstatus" not in os.path.basename(f))
    stage_group: dict[int, str] = {}
    tasks: dict[int, list[tuple[int, int]]] = {}
    for f in files:
        for line in open(f, encoding="utf-8"):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in ev.get("Stage IDs", []):
                    stage_group[sid] = group
            elif kind == "SparkListenerTaskEnd":
                info, metrics = ev["Task Info"], ev.get("Task Metrics") or {}
                recs = (metrics.get("Input Metrics", {}).get("Records Read", 0)
                        + metrics.get("Shuffle Read Metrics", {}).get("Total Records Read", 0))
                dur = info["Finish Time"] - info["Launch Time"]
                tasks.setdefault(ev["Stage ID"], []).append((recs, dur))
    print(f"{'job':24s} {'stage':>5s} {'tasks':>5s} {'records':>10s} {'largest task':>12s} {'max/median ms':>14s}")
    for sid in sorted(tasks):
        group = stage_group.get(sid)
        if group not in marks:
            continue
        recs = [r for r, _ in tasks[sid]]
        durs = [t for _, t in tasks[sid]]
        total = sum(recs)
        if total == 0:
            continue
        share = max(recs) / total
        print(f"{group:24s} {sid:5d} {len(recs):5d} {total:10d} {share:11.1%} "
              f"{max(durs):7d}/{int(statistics.median(durs)):<6d}")


if __name__ == "__main__":
    main()
