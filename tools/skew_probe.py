"""Skew probe: one key holds a third of 6M rows; compare with uniform keys (local run)."""
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from lakepact.session import local_session, scratch_path
from lakepact.operators import checks as K
from lakepact.operators.windows import later_repeats, running_count
from pyspark.sql import functions as F
spark = local_session(8, 64)
n = 6_000_000
base = spark.range(n).select(
    F.col("id"),
    F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("k"), (F.col("id") % 200000).cast("string"))).alias("grp"),
    (F.col("id") % 1000).cast("string").alias("v"))
uniform = spark.range(n).select(F.col("id"), F.concat(F.lit("k"), (F.col("id") % 200000).cast("string")).alias("grp"),
                               (F.col("id") % 1000).cast("string").alias("v"))
for label, df in [("skewed", base), ("uniform", uniform)]:
    path = scratch_path(spark, "skew", label)
    df.write.parquet(path)
    d = spark.read.parquet(path)
    for name, fn in [
        ("duplicate_keys(grp,v)", lambda: K.duplicate_keys(d, ["grp", "v"]).collect()),
        ("later_repeats(grp)", lambda: later_repeats(d, ["grp"], "id").agg(F.count("*")).collect()),
        ("running_count(grp)", lambda: running_count(d, ["grp"], "id", (F.col("id") % 2 == 0).cast("int"), "p").agg(F.max("p")).collect()),
        ("fd count distinct", lambda: d.groupBy("grp").agg(F.count_distinct("v").alias("c")).where("c > 1").count()),
    ]:
        t0 = time.perf_counter(); r = fn(); print(f"{label:8s} {name:24s} {time.perf_counter()-t0:6.2f}s {str(r)[:80]}")
