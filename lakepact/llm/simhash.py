"""SimHash near-duplicates with a pigeonring candidate filter.

A fingerprint is the bitwise majority of the XXH64 hashes of a text's word shingles. Two
fingerprints link when they differ in at most ``max_bits`` bits.

Pigeonring: the 64 bits are cut into a ring of ``max_bits + 1`` segments. If the whole distance
is at most ``max_bits``, some segment starts a chain in which the first ``l`` consecutive
segments differ in at most ``floor(l * max_bits / segments)`` bits, for every ``l``. With two
bits over three segments the budgets are 0, 1, 2: the chain's first segment is equal, the next
differs in one bit at most. Both conditions are put into one equality key (one side emits the
second segment and all its one-bit changes, the other side its own value), so candidates share
41 bits or more and a common first segment alone never gathers a large group. The full Hamming
check decides, and the true links of one fingerprint are bounded by the number of fingerprints
within ``max_bits`` bits, so no group emits all its pairs.

Exact copies collapse to one distinct fingerprint before any pairing.

Defined cases: a null or blank text has fingerprint zero and links like any other; a text of
fewer words than a shingle hashes its whole word sequence; repeated rows each keep their row;
a null doc_id takes part and never is a component's smallest id (all-null component: null);
an empty table gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakepact.llm.common import components, cut, map_batches, slices, text_bytes

BITS = 64


def fingerprint(text: bytes, words: int = 3, seed: int = 42) -> int:
    """Majority fingerprint (unsigned) of the word shingles of one UTF-8 text."""
    toks = text.lower().split()  # bytes: lowers A-Z only, splits at ASCII white space only
    if not toks:
        return 0
    n = max(1, len(toks) - words + 1)
    joined = b" ".join(toks)
    ends = np.cumsum(np.fromiter(map(len, toks), np.int64, len(toks)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    ends = ends[min(words, len(toks)) - 1:].tolist()
    h = xxhash.xxh64_intdigest
    total = np.zeros(BITS, np.int64)
    for at in range(0, n, 4096):  # bounded memory for very long texts
        hashes = np.array([h(joined[s:e], seed) for s, e in zip(starts[at:at + 4096], ends[at:at + 4096])], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    on = np.packbits(total * 2 > n, bitorder="little")
    return int(on.view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, text_key, fp): the fingerprint as a signed long, one row per input row."""

    def run(batches):
        for b in slices(batches):
            fp = np.array([fingerprint(t, words, seed) for t in text_bytes(b.column(2))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(fp.view(np.int64))], ["doc_id", "text_key", "fp"]
            )

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_key"),
        F.col("text").cast("string").alias("text"),
    )
    return map_batches(rows, run, "doc_id bigint, text_key bigint, fp bigint")


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(shift, width) of the ring's max_bits + 1 segments."""
    m = max_bits + 1
    edges = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _part(col: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(col, shift).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))


def links(distinct: DataFrame, max_bits: int = 2) -> DataFrame:
    """All pairs (u, v), u < v, of ``distinct(fp)`` that differ in 1 to ``max_bits`` bits."""
    if max_bits < 1:
        return distinct.select(F.col("fp").alias("u"), F.col("fp").alias("v")).where("false")
    ring = segments(max_bits)
    budget2 = 2 * max_bits // len(ring)  # second step of the chain; the first step's is 0
    exact, near = [], []
    for i, (s, w) in enumerate(ring):
        s2, w2 = ring[(i + 1) % len(ring)]
        mine, following = _part(F.col("fp"), s, w), _part(F.col("fp"), s2, w2)
        key = lambda nxt: F.struct(F.lit(i).alias("i"), mine.alias("a"), nxt.alias("b"))  # noqa: E731, B023
        exact.append(key(following))
        near.append(key(following))
        if budget2 >= 1:  # budget2 is 1 for every max_bits >= 1
            near += [key(following.bitwiseXOR(F.lit(1 << x).cast("bigint"))) for x in range(w2)]
    left = distinct.select(F.col("fp").alias("u"), F.explode(F.array(*near)).alias("k"))
    right = distinct.select(F.col("fp").alias("v"), F.explode(F.array(*exact)).alias("k"))
    flat = lambda d, c: d.select(c, F.col("k.i").alias("i"), F.col("k.a").alias("a"), F.col("k.b").alias("b"))
    differ = F.col("u").bitwiseXOR(F.col("v"))
    # The chain's later steps, then the full check.
    chain = F.lit(True)
    for i in range(len(ring)):
        for steps in range(3, len(ring)):
            bits = sum(
                (F.bit_count(_part(differ, *ring[(i + j) % len(ring)])) for j in range(1, steps)), F.lit(0)
            )
            chain = chain & ((F.col("i") != i) | (bits <= steps * max_bits // len(ring)))
    return (
        flat(left, "u").join(flat(right, "v"), ["i", "a", "b"])
        .where((F.col("u") != F.col("v")) & chain & (F.bit_count(differ) <= max_bits))
        .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        .distinct()
    )


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 2, seed: int = 42) -> DataFrame:
    """One row per input row: doc_id, text_key, fingerprint (16 hex digits), component_id."""
    rows = cut(fingerprints(docs, words, seed))
    classes = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    found = components(links(classes.select("fp"), max_bits))
    # A fingerprint without a link is its own component.
    rooted = (
        classes.join(found.withColumnRenamed("id", "fp"), "fp", "left")
        .withColumn("root", F.coalesce("root", "fp"))
    )
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    names = cut(rooted.join(lowest, "root").select("fp", "component_id"))
    return rows.join(names, "fp").select(
        "doc_id", "text_key",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def keep_one(docs: DataFrame, words: int = 3, max_bits: int = 2, seed: int = 42) -> DataFrame:
    """The documents table with one document of each group: the one with the smallest doc_id.

    Rows with a null doc_id stay only if their whole group has none (the smallest text hash).
    Of rows that repeat the same doc_id and text, one stays.
    """
    found = near_duplicates(docs, words, max_bits, seed)
    # A group is named by its smallest doc_id; groups of null ids by their fingerprint.
    group = F.coalesce(F.col("component_id").cast("string"), F.col("fingerprint"))
    names = docs.columns
    key, text, turn = _free_names(names, "keep_id_", "keep_key_", "keep_n_")
    chosen = (
        found.groupBy(group.alias("g"))
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_key")).alias("s"))
        .select(
            F.coalesce(F.col("s.doc_id").cast("string"), F.lit("")).alias(key),
            F.col("s.text_key").alias(text),
        )
    )
    marked = docs.withColumn(key, F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).withColumn(
        text, F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    )
    one = W.partitionBy(key, text).orderBy(key)
    kept = marked.join(cut(chosen), [key, text], "left_semi")
    return kept.withColumn(turn, F.row_number().over(one)).where(F.col(turn) == 1).select(*names)


def _free_names(taken: list[str], *wanted: str) -> list[str]:
    """Column names that the table does not have, in any case."""
    used = {c.lower() for c in taken}
    out = []
    for name in wanted:
        while name in used:
            name += "_"
        out.append(name)
    return out
