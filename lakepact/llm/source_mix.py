"""Mixing sources to target weights by hash-threshold histograms (DataFrame operations only).

Every document gets a size (words) and a 60-bit hash. A source with target T and size S takes
``floor(T / S)`` whole copies and a remainder of T - copies * S words. The remainder is the
longest prefix of the source's documents in hash order that fits. It is found without sorting:
words are summed by source and hash bucket (4096 per level), the boundary bucket is the first in
which the running sum passes the remainder, and only that bucket is cut again by the next twelve
bits of the hash, five times in all. The result is one threshold per source; taking is a filter
``hash < threshold``. Thresholds of a larger weight include those of a smaller one (nested).

Targets: each source gets a share by weight of all words, stops at ``max_repeats`` times its own
size, and the excess is shared anew by weight until none is above. That is one water level L with
target = min(max_repeats * S, weight * L), found from running sums over the sources, which are
sorted in ranges, so that any number of them is dealt over tasks.

Defined cases: null or blank text has size 0 and takes 0 words; a null source is a source (the
last in order); documents that share both id and text share a hash and are taken together or
not at all, so a group of such rows at the boundary is left out whole; no words at all: targets
are 0; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakepact.llm.common import broadcast_below, cut

WORD = r"[^\x20\x09-\x0D]+"
LEVEL_BITS, LEVELS = 12, 5
WEIGHTS = (5, 2, 1)
# Sources whose thresholds are sent to every executor: 100,000 rows of a name and a few numbers.
BROADCAST_SOURCES = 100_000


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def hash_of(doc_id: Column, text: Column) -> Column:
    """60 bits of an md5 over id and text, as a long."""
    key = F.concat_ws("\x1f", F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint")


def sums_before(df: DataFrame, order: list[Column], sums: dict[str, str]) -> DataFrame:
    """``df`` with the sums of columns over all rows before, in a total order: ``sums`` is {new: column}.

    Ranges of the order are sorted in their own tasks; only one row per range is added up in a
    single task. The rows must differ in ``order``.
    """
    ranges = cut(df.repartitionByRange(*order).withColumn("range_", F.spark_partition_id()))
    whole = W.orderBy("range_").rowsBetween(W.unboundedPreceding, -1)
    start = ranges.groupBy("range_").agg(*[F.sum(c).alias(f"{new}_in_") for new, c in sums.items()]).select(
        "range_", *[F.coalesce(F.sum(f"{new}_in_").over(whole), F.lit(0)).alias(f"{new}_at_") for new in sums]
    )
    inside = W.partitionBy("range_").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return ranges.join(F.broadcast(start), "range_").select(  # one row per range
        *df.columns,
        *[(F.col(f"{new}_at_") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(new) for new, c in sums.items()],
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = 3) -> DataFrame:
    """(source, source_size, target) from ``sizes(source, source_size)``, one row per source."""
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    s = sums_before(sizes.withColumn("one", F.lit(1)), [F.col("source").asc_nulls_last()], {"rank": "one"})
    s = s.withColumn("w", pick).withColumn("cap", (F.col("source_size") * max_repeats).cast("double"))
    # Sources fill up in the order of cap / weight. With the first k full, the level of the rest is
    # (total - their caps) / (weights of the rest). It is right for the first source that it does
    # not fill, and only falls from there on.
    fill = [(F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last()]
    s = sums_before(s, fill, {"cap_before": "cap", "w_before": "w"})
    total, w_all = s.agg(F.sum("source_size"), F.sum("w")).first()
    rest = (F.lit(total) - F.col("cap_before")) / (F.lit(w_all) - F.col("w_before"))
    level = s.agg(F.max(F.when(F.col("w") * rest <= F.col("cap"), rest))).first()[0]
    return s.select("source", "source_size", F.least("cap", F.col("w") * F.lit(level).cast("double")).alias("target"))


def thresholds(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """(source, copies, threshold): documents with hash below the threshold are taken once more.

    ``rows(source, size, hash)``, ``plan(source, source_size, target)``.
    """
    state = plan.where("source_size > 0").select(
        "source",
        F.floor(F.col("target") / F.col("source_size")).cast("bigint").alias("copies"),
        "target", "source_size",
    ).withColumn(
        "room", F.floor(F.col("target") - F.col("copies") * F.col("source_size")).cast("bigint")
    ).select("source", "copies", "room", F.lit(0).cast("bigint").alias("base"))
    state = cut(state)
    for level in range(LEVELS):
        shift = LEVEL_BITS * (LEVELS - 1 - level)
        here = broadcast_below(state.select(F.col("source").alias("s_"), "base"), BROADCAST_SOURCES)
        own = F.col("source").eqNullSafe(F.col("s_"))
        if level:  # only the boundary bucket of the level before
            own = own & (F.shiftright("hash", shift + LEVEL_BITS) == F.shiftright("base", shift + LEVEL_BITS))
        bars = rows.join(here, own).groupBy(
            F.col("s_"), F.shiftright("hash", shift).alias("bucket")
        ).agg(F.sum("size").alias("words"))
        run = W.partitionBy("s_").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
        bars = bars.withColumn("upto", F.sum("words").over(run)).alias("b")
        over = bars.join(
            broadcast_below(state.select(F.col("source").alias("s2_"), "room"), BROADCAST_SOURCES),
            F.col("s_").eqNullSafe(F.col("s2_")) & (F.col("upto") > F.col("room")),
        ).groupBy("s_").agg(F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("under"))).alias("edge"))
        edge = over.select("s_", F.col("edge.bucket").alias("bucket"), F.col("edge.under").alias("under"))
        state = cut(
            state.join(edge, F.col("source").eqNullSafe(F.col("s_")), "left").select(
                "source", "copies",
                # A source that never passes its room has no boundary: it can only be one whose
                # remainder holds every word, which floor() rules out unless sizes are zero.
                (F.col("room") - F.coalesce("under", F.lit(0))).alias("room"),
                F.coalesce(F.shiftleft("bucket", shift), F.lit(1 << (LEVEL_BITS * LEVELS))).alias("base"),
            )
        )
    return state.select("source", "copies", F.col("base").alias("threshold"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = 3) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies, taken."""
    rows = cut(docs.select(
        "doc_id", F.col("source").cast("string").alias("source"),
        size_of(F.col("text")).alias("size"), hash_of(F.col("doc_id"), F.col("text")).alias("hash"),
    ))
    plan = cut(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_repeats))
    cuts = thresholds(rows.select("source", "size", "hash"), plan)
    per = cut(plan.select(F.col("source").alias("s_"), "source_size", "target").join(
        cuts.select(F.col("source").alias("s3_"), "copies", "threshold"),
        F.col("s_").eqNullSafe(F.col("s3_")), "left",
    ).drop("s3_"))
    times = F.coalesce("copies", F.lit(0)) + F.coalesce((F.col("hash") < F.col("threshold")).cast("bigint"), F.lit(0))
    return rows.join(
        broadcast_below(per, BROADCAST_SOURCES), F.col("source").eqNullSafe(F.col("s_"))
    ).select(
        "doc_id", "size", "source_size", "target", times.cast("bigint").alias("copies"),
        (F.col("size") * times).cast("bigint").alias("taken"), "hash",
    )


def take(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = 3) -> DataFrame:
    """The documents table after mixing: every document as often as the mix takes it.

    Documents without a word add nothing to any target and are not taken.
    """
    names = docs.columns
    rows = cut(docs.select(
        F.col("source").cast("string").alias("source"),
        size_of(F.col("text")).alias("size"), hash_of(F.col("doc_id"), F.col("text")).alias("hash"),
    ))
    plan = cut(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_repeats))
    cuts = cut(thresholds(rows, plan).select(F.col("source").alias("mix_source_"), "copies", "threshold")
               .withColumnsRenamed({"copies": "mix_copies_", "threshold": "mix_threshold_"}))
    marked = docs.withColumn("mix_hash_", hash_of(F.col("doc_id"), F.col("text")))
    times = F.col("mix_copies_") + (F.col("mix_hash_") < F.col("mix_threshold_")).cast("bigint")
    sized = F.col("text").rlike(WORD)
    return (
        marked.where(sized).join(
            broadcast_below(cuts, BROADCAST_SOURCES), F.col("source").cast("string").eqNullSafe(F.col("mix_source_"))
        )
        .where(times > 0)
        .withColumn("mix_turn_", F.explode(F.sequence(F.lit(1).cast("bigint"), times)))
        .select(*names)
    )
