"""Landing text deliveries (header CSV) read as strings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..contract import Contract
from .quoted import read_quoted_splits


def read_landing_text(
    spark: SparkSession,
    path: str | list[str],
    delimiter: str = ",",
    *,
    encoding: str = "UTF-8",
    mode: str = "FAILFAST",
    multi_line: bool = True,
    malformed_column: str | None = None,
    split_quoted: bool = False,
) -> DataFrame:
    """Read a header CSV delivery with every column as a string.

    No type inference and no user schema (a schema on a header file would bind by
    position). Empty cells and ``""`` become NULL; ``NA``, ``null`` and blanks stay text.
    ``multi_line`` keeps quoted line breaks inside one value; it makes each *file* one
    split, so large deliveries should arrive as many files (or pass ``multi_line=False``
    when the producer guarantees no quoted line breaks, which makes files splittable).
    ``split_quoted`` gives the same rows as ``multi_line`` but cuts each file into many tasks, at
    record boundaries found by counting quotes (``sources/quoted.py`` says what it refuses).
    Files of one delivery must share one heading: Spark binds cells by position, so a file
    whose columns stand in another order is refused rather than read crosswise.
    A row whose number of cells differs from the heading is refused (``mode='FAILFAST'``);
    ``mode='PERMISSIVE'`` cuts surplus cells without trace and is only for callers who want that.
    ``malformed_column`` reads on past such rows but adds a column holding the raw line of
    every row whose number of cells differs from the header (NULL otherwise), so ragged
    rows can be counted in the same pass instead of being cut silently.
    """
    cells = {"sep": delimiter, "quote": '"', "escape": '"', "mode": "PERMISSIVE" if malformed_column else mode}

    def reader():
        return (
            spark.read.format("csv")
            .options(**cells)
            .option("header", True)
            .option("inferSchema", False)
            .option("multiLine", multi_line or split_quoted)
            .option("encoding", encoding)
            .option("enforceSchema", False)
        )

    if split_quoted:
        if encoding.upper().replace("-", "") != "UTF8":
            raise ValueError("split_quoted reads UTF-8 only")
        if cells["mode"].upper() not in ("FAILFAST", "PERMISSIVE"):
            raise ValueError("split_quoted reads in mode FAILFAST or PERMISSIVE")
        return read_quoted_splits(spark, path, reader().load(path).columns, cells, malformed_column)
    if malformed_column is None:
        return reader().load(path)
    # The header's own names, in order, as an explicit all-string schema plus the flag
    # column: binding by position is exact because the schema is the header itself.
    heading = reader().load(path).columns
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in [*heading, malformed_column])
    return reader().option("columnNameOfCorruptRecord", malformed_column).schema(schema).load(path)


def read_contract_source(spark: SparkSession, contract: Contract, server: str = "local", **kw) -> DataFrame:
    """Read the file source a contract declares for ``server`` (format, delimiter, path)."""
    s = next((s for s in contract.servers if s.server == server), None)
    if s is None or not s.path:
        raise ValueError(f"contract {contract.id} declares no file server {server!r}")
    if (s.format or "csv").lower() != "csv":
        return spark.read.format(s.format).load(s.path)
    return read_landing_text(spark, s.path, s.delimiter or ",", **kw)


def as_text(df: DataFrame) -> DataFrame:
    """Every column cast to string: a text copy of a typed frame (used to build deliveries)."""
    from pyspark.sql import functions as F

    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])
