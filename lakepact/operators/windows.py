"""Skew-tolerant replacements for per-group window scans.

A window partitioned by a group key sorts each whole group in one task; when one group
holds a third of all rows that task holds a third of the data. The two helpers below give
the same answers with only bounded groups in any single task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

# Rows per block of the two-level prefix sum (by the order column's value range).
BLOCK = 1 << 20


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on equal keys in which NULL equals NULL (as in a group), keys kept once."""
    r = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = [F.col(f"`{k}`").eqNullSafe(F.col(f"`__r_{k}`")) for k in keys]
    return left.join(r, on).drop(*[f"__r_{k}" for k in keys])


def key_digests(df: DataFrame, keys: Sequence[str]) -> dict[str, Column]:
    """The keys as they are shuffled: a string or binary key as its SHA-256 digest (32 bytes,
    however long the text; NULL stays NULL), any other key as it is."""
    wide = (T.StringType, T.BinaryType)
    return {
        f"__k{i}": F.unhex(F.sha2(F.col(f"`{k}`"), 256)) if isinstance(df.schema[k].dataType, wide) else F.col(f"`{k}`")
        for i, k in enumerate(keys)
    }


def later_repeats(df: DataFrame, keys: Sequence[str], order: str, first_name: str = "first_seen") -> DataFrame:
    """Rows whose key already occurred at a smaller ``order``, with that first ``order``.

    Same result as ``min(order) OVER (PARTITION BY keys)`` + ``order > first``, planned as a
    partial aggregate (a hot key collapses map-side) joined back on the key. Only keys that
    repeat reach the join; a hot key on the row side is split by AQE's skew-join handling.
    Texts are grouped and joined by digest: a whole text is shuffled only where the caller
    keeps that column.
    """
    by = key_digests(df, keys)
    firsts = (
        df.select(*[c.alias(n) for n, c in by.items()], F.col(order).alias(first_name))
        .groupBy(*by)
        .agg(F.min(first_name).alias(first_name), F.count(F.lit(1)).alias("__n"))
        .where(F.col("__n") > 1)
        .drop("__n")
    )
    return null_safe_join(df.withColumns(by), firsts, list(by)).where(F.col(order) > F.col(first_name)).drop(*by)


def running_count(df: DataFrame, group: Sequence[str], order: str, flag: Column, out: str,
                  block: int = BLOCK) -> DataFrame:
    """``sum(flag) OVER (PARTITION BY group ORDER BY order ROWS UNBOUNDED PRECEDING)``
    as a two-level prefix sum.

    Rows are cut into blocks of the order column's range; a window runs inside each
    (group, block) and a second, much smaller window over the per-block totals gives each
    block its offset. ``order`` must be unique within a group (it is a row number).
    """
    g = list(group)
    b = F.floor(F.col(order) / F.lit(block)).cast("long")
    marked = df.withColumn("__blk", b).withColumn("__f", flag.cast("long"))
    totals = marked.groupBy(*g, "__blk").agg(F.sum("__f").alias("__t"))
    before = Window.partitionBy(*g).orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("__off", F.coalesce(F.sum("__t").over(before), F.lit(0))).drop("__t")
    inside = Window.partitionBy(*g, "__blk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    within = marked.withColumn("__run", F.sum("__f").over(inside))
    return (
        null_safe_join(within, offsets, [*g, "__blk"])
        .withColumn(out, F.col("__off") + F.col("__run"))
        .drop("__blk", "__f", "__run", "__off")
    )


def ordered_join(df: DataFrame, group: Sequence[str], order: str, value: str, sep: str, out: str,
                 block: int = BLOCK) -> DataFrame:
    """Per group, the values joined with ``sep`` in ``order`` order (NULL values skipped).

    Two levels, like ``running_count``: values are first joined inside (group, block of the
    order range) by many tasks, then the per-block strings are joined in block order. A
    hot group's rows are spread over its blocks; only the final string, which is the
    result itself, is assembled per group.
    """
    g = list(group)
    blk = F.floor(F.col(order) / F.lit(block)).cast("long")
    parts = (
        df.where(F.col(value).isNotNull())
        .withColumn("__blk", blk)
        .groupBy(*g, "__blk")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, value))),
                                      lambda s: s[value]), sep).alias("__part"))
    )
    return parts.groupBy(*g).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__blk", "__part"))),
                                 lambda s: s["__part"]), sep).alias(out)
    )
