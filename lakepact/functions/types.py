"""Type names as Spark expressions, for inventories held in tables (many contracts)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def spark_type_name(c: Column) -> Column:
    """Declared physical type text → Spark's ``simpleString`` (``INTEGER`` → ``int``,
    ``VARCHAR(5)`` → ``string``, ``NUMERIC(9)`` → ``decimal(9,0)``).

    The same mapping as ``contract.parse_type`` but evaluated column-wise, so a catalogue
    of field definitions is normalised by the executors, not the driver.
    """
    t = F.lower(F.regexp_replace(c, r"\s+", ""))
    return (
        F.when(t.isin("string", "text") | t.rlike(r"^(varchar|char|character)\(\d+\)$"), F.lit("string"))
        .when(t.isin("int", "integer"), F.lit("int"))
        .when(t.isin("bigint", "long"), F.lit("bigint"))
        .when(t.isin("smallint", "short"), F.lit("smallint"))
        .when(t.isin("tinyint", "byte"), F.lit("tinyint"))
        .when(t.isin("boolean", "bool"), F.lit("boolean"))
        .when(t.isin("float", "real"), F.lit("float"))
        .when(t.isin("timestamp", "timestamp_ltz"), F.lit("timestamp"))
        .when(t.isin("decimal", "numeric", "dec"), F.lit("decimal(10,0)"))
        .when(
            t.rlike(r"^(decimal|numeric|dec)\(\d+\)$"),
            F.concat(F.lit("decimal("), F.regexp_extract(t, r"\((\d+)\)", 1), F.lit(",0)")),
        )
        .when(
            t.rlike(r"^(decimal|numeric|dec)\(\d+,\d+\)$"),
            F.regexp_replace(t, r"^(numeric|dec)\(", "decimal("),
        )
        .otherwise(t)
    )
