"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows, and bytes of their columns, handed to numpy at once: bounds the memory of a Python worker.
SLICE_ROWS, SLICE_BYTES = 256, 8 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def id_bucket(col: str, m: int) -> Column:
    """crc32 of the id as text, modulo ``m``; a null id counts as bucket ``m`` (no fold)."""
    return F.coalesce(F.crc32(F.col(col).cast("string")) % F.lit(m), F.lit(m).cast("bigint"))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A temporary folder is made only for a local master with nothing set (tests); on a cluster
    an unset folder is an error, since executors could not see a local one.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if root is None and current.isDefined():
        return current.get()
    if root is None:
        if not sc.master.startswith(("local[", "local")) or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="lakepact-ckpt-")
    if not current.isDefined():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage in the shared folder (survives lost executors)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def map_batches(
    df: DataFrame,
    fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    return df.mapInArrow(fn, schema)


def slices(
    batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS, most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Pieces of at most ``rows`` rows and ``most`` bytes; a single row of any size is one piece."""

    def parts(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if b.num_rows > 1 and b.nbytes > most:
            half = b.num_rows // 2
            yield from parts(b.slice(0, half))
            yield from parts(b.slice(half))
        else:
            yield b

    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield from parts(b.slice(at, rows))


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, null as empty."""
    return [x if x is not None else b"" for x in column.cast(pa.binary()).to_pylist()]


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(u, v)``: rows (id, root), root the smallest id reachable.

    Alternating large-star / small-star rounds (every round is two keyed aggregates joined
    back, so a hub is never gathered into one task), each cut in the shared folder; stops when
    a round changes nothing. Only nodes with an edge are returned. Self loops and repeated
    edges are allowed; null ends are ignored.
    """
    e = cut(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .where("u is not null and v is not null")
        .distinct()
    )
    if e.isEmpty():
        return e.select(F.col("u").alias("id"), F.col("v").alias("root"))

    def star(both: DataFrame, keep: Column) -> DataFrame:
        # m(u): the smallest of u and its neighbours; every kept neighbour is hung under m(u).
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        return both.join(low, "u").where(keep).select(
            F.col("v").alias("u"), F.least("u", "m").alias("v")
        )

    mark = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = star(both, F.col("v") > F.col("u")).where("u <> v").distinct()
        # small star: u keeps its smaller neighbours (edges already point from large to small)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (
            joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        e = cut(small)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == tuple(now):
            break
        mark = tuple(now)
    roots = e.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("root"))
    return e.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(roots)


def broadcast_below(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast only when ``df`` was counted to hold at most ``rows`` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df

