"""S1 for large files with quoted line breaks: one file read by many tasks.

Spark's multi-line CSV reader takes a file as one task. Here Spark's text reader cuts files into
its usual byte ranges (blocks) and hands out physical lines. Whether a line begins a record depends
on the quotes before it: after an even number of quote characters a line break ends a record, after
an odd number it is part of a cell (an escaped quote is two characters and changes nothing).

1. One aggregate counts, per block, the lines with an odd number of quotes. The prefix sums of these
   counts over a file's blocks say which blocks begin inside a cell, and which block owns the
   record that is open there. This table has one row per block, whatever the blocks hold.
2. Each block is then cut into whole records by its own task: lines are joined only where a record
   has several. The pieces at a block's two ends, at most two per block, are read by a second scan that
   keeps nothing else, and are put together by a grouping on the record's block.
3. ``from_csv`` parses each record with the options of the plain reader.

So the text is scanned three times at most and never shuffled, but for the pieces.

Refused, since parity would say something else than the plain reader: a file whose quotes do not
pair up, a quote in the middle of an unquoted cell, a heading with empty or repeated names, an encoding other than
UTF-8. Use ``multi_line=True`` alone for such files.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BLOCK = ["file", "start", "length"]


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Physical lines of the files with their block, in the blocks' order; ``odd`` is 1 where the line's
    quotes do not pair up."""
    text = spark.read.option("lineSep", "\n").text(path)
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"), (quotes % 2).cast("int").alias("odd"), "value")


def block_table(lines: DataFrame) -> dict[tuple, tuple[bool, int]]:
    """Per block: whether it begins inside a quoted cell, and the start of the block in which the record
    open there began (-1 where none is). One entry per block of the delivery."""
    files = defaultdict(list)
    for r in lines.groupBy(*BLOCK).agg(F.sum("odd").alias("odd")).toLocalIterator():
        files[r["file"]].append((r["start"], r["length"], r["odd"]))
    table = {}
    for file, blocks in files.items():
        inside, owner = False, -1
        for start, length, odd in sorted(blocks):
            table[file, start, length] = (inside, owner if inside else -1)
            # A record is left open that began here, unless the whole block lies inside one cell.
            if inside != (odd % 2 == 1) and not (inside and odd == 0):
                owner = start
            inside = inside != (odd % 2 == 1)
        if inside:
            raise ValueError(f"{file}: the quotes of this file do not pair up")
    return table


def _cutter(sent, pieces: bool):
    """Records of each block: the whole ones, or (``pieces``) what stands at its two ends. Rows
    (file, owner, start, first, record): ``first`` marks the record that begins its file."""

    def run(batches):
        key, inside, owner, begun, held, first = None, False, -1, False, [], False
        out: list[tuple] = []

        def close_block():
            # What is still held is open at the block's end: it is owned by the block it began in.
            if key is not None and held and pieces:
                out.append((key[0], key[1] if begun else owner, key[1], begun and first, "\n".join(held)))

        def flush():
            cols = list(zip(*out)) if out else [[]] * 5
            out.clear()
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                              ["file", "owner", "start", "first", "record"])

        for b in batches:
            # Runs of lines of one block.
            keys = list(zip(*(b.column(i).to_pylist() for i in range(3))))
            odd = b.column(3).to_numpy()
            value = b.column(4).to_pylist()
            at = 0
            while at < len(keys):
                stop = at + 1
                if keys[-1] == keys[at]:
                    stop = len(keys)
                else:
                    while stop < len(keys) and keys[stop] == keys[at]:
                        stop += 1
                if keys[at] != key:
                    close_block()
                    key = keys[at]
                    if key not in sent.value:
                        raise RuntimeError(f"{key[0]}: cut otherwise than when its quotes were counted; "
                                           "set spark.sql.files.minPartitionNum for this read")
                    inside, owner = sent.value[key]
                    begun, held, first = False, [], key[1] == 0
                part = odd[at:stop]
                total = int(inside) + np.cumsum(part)
                starts = np.flatnonzero((total - part) % 2 == 0).tolist()
                inside = bool(total[-1] % 2)
                lines = value[at:stop]
                cuts = [*starts, len(lines)]
                held += lines[:cuts[0]]
                for s, e in zip(cuts, cuts[1:]):
                    # The record before ends where this one starts.
                    if held:
                        whole = "\n".join(held) if len(held) > 1 else held[0]
                        if begun and not pieces:
                            out.append((key[0], -1, key[1], first, whole))
                        elif not begun and pieces:
                            out.append((key[0], owner, key[1], False, whole))
                        # Blank lines before the heading are not the heading.
                        first = first and begun and whole.strip("﻿\r") == ""
                    begun, held = True, lines[s:e]
                at = stop
                if not inside and held:
                    # Nothing is open: the last record is whole.
                    whole = "\n".join(held)
                    if begun and not pieces:
                        out.append((key[0], -1, key[1], first, whole))
                    elif not begun and pieces:
                        out.append((key[0], owner, key[1], False, whole))
                    first = first and begun and whole.strip("﻿\r") == ""
                    held, begun = [], True
            yield flush()
        close_block()
        yield flush()

    return run


def _stray_quote(record: Column, sep: str) -> Column:
    """Whether a quote stands elsewhere than at the ends of a cell (or doubled inside one): what lies
    between quoted stretches must be nothing (a doubled quote) or begin and end with the separator."""
    parts = F.split(record, '"')
    last = F.size(parts) - 1

    def wrong(x: Column, i: Column) -> Column:
        outside = (i % 2 == 0) & (x != "")
        return outside & (((i > 0) & ~x.startswith(sep)) | ((i < last) & ~x.endswith(sep)))

    return record.contains('"') & F.exists(F.transform(parts, lambda x, i: wrong(x, i)), lambda w: w)


def read_quoted_splits(
    spark: SparkSession,
    path: str | list[str],
    heading: list[str],
    options: dict[str, str],
    corrupt: str | None = None,
) -> DataFrame:
    """The delivery's rows as strings, as the multi-line CSV reader gives them, each file in as
    many tasks as it has blocks. ``options`` are the CSV reader's own."""
    sep = options["sep"]
    lines = _lines(spark, path)
    table = block_table(lines)
    sent = spark.sparkContext.broadcast(table)
    schema = "file string, owner bigint, start bigint, first boolean, record string"
    records = lines.mapInArrow(_cutter(sent, False), schema).select("first", "record")
    split = sorted({file for (file, *_), (inside, _o) in table.items() if inside})
    if split:
        ends = lines.where(F.col("file").isin(split)).mapInArrow(_cutter(sent, True), schema)
        joined = ends.groupBy("file", "owner").agg(
            F.bool_or("first").alias("first"), F.sort_array(F.collect_list(F.struct("start", "record"))).alias("p"))
        records = records.unionByName(joined.select("first", F.array_join("p.record", "\n").alias("record")))
    clean = F.regexp_replace("record", "\r\\z", "")
    records = records.select("first", F.when(F.col("first"), F.ltrim(clean, F.lit("﻿"))).otherwise(clean).alias("record"))
    records = records.where("record <> ''")
    stray = F.raise_error(F.lit("a quote inside an unquoted cell: read this delivery without split_quoted"))
    whole = F.when(_stray_quote(F.col("record"), sep), stray).otherwise(F.col("record"))
    fields = ", ".join(f"`{c.replace('`', '``')}` string" for c in [*heading, *([corrupt] if corrupt else [])])
    parse = dict(options, **({"columnNameOfCorruptRecord": corrupt} if corrupt else {}))
    row = records.select("first", F.from_csv(whole, F.lit(fields), parse).alias("r"))
    # Files of one delivery share one heading; the heading itself is no row. (Spark renames empty and
    # repeated names, so that such a heading is never the same.)
    same = F.lit(True)
    for c in heading:
        same = same & F.col("r").getField(c).eqNullSafe(F.lit(c))
    other = F.raise_error(F.lit("a file of this delivery has another heading, or one with empty or repeated names")).cast("boolean")
    return row.where(F.when(F.col("first"), F.when(same, F.lit(False)).otherwise(other)).otherwise(F.lit(True))).select("r.*")
