"""Catalog-facing sources: read a target (S3), scope a model view (S4), namespaces (S6),
table probe (E1) and column inventories (E2)."""

from __future__ import annotations

import threading
from contextlib import contextmanager
from typing import Iterator

from pyspark.sql import DataFrame, SparkSession, types as T

from ..contract import normalise_type_text


def read_target(spark: SparkSession, name: str) -> DataFrame:
    """S3: scan of the physical table."""
    return spark.table(name)


_VIEW_LOCKS: dict[tuple[int, str], threading.Lock] = {}
_VIEW_LOCKS_GUARD = threading.Lock()


def _view_lock(spark: SparkSession, name: str) -> threading.Lock:
    with _VIEW_LOCKS_GUARD:
        return _VIEW_LOCKS.setdefault((id(spark), name.lower()), threading.Lock())


@contextmanager
def as_relation(df: DataFrame, name: str) -> Iterator[str]:
    """Expose ``df`` under ``name`` so SQL rules that name the model resolve.

    The view is always dropped on exit; left behind it would hide a table of the same name.
    DataFrames made from ``spark.sql`` inside the block are analysed eagerly, so they stay
    valid after the view is gone. Concurrent checks on one session that use the same model
    name take turns for that short analysis window.
    """
    spark = df.sparkSession
    with _view_lock(spark, name):
        df.createOrReplaceTempView(name)
        try:
            yield name
        finally:
            spark.catalog.dropTempView(name)


def ensure_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    """Create the schema when absent (at ``location`` when given)."""
    where = "" if location is None else " LOCATION '" + location.replace("'", "\\'") + "'"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {namespace}{where}")


def table_exists(spark: SparkSession, name: str) -> bool:
    """Table probe."""
    return spark.catalog.tableExists(name.replace("`", ""))


def schema_of(spark: SparkSession, name: str) -> dict[str, T.DataType]:
    """Column name → Spark type of a table, in table order."""
    return {f.name: f.dataType for f in spark.table(name).schema}


def table_columns_frame(spark: SparkSession, tables: dict[str, T.StructType]) -> DataFrame:
    """E2 for many tables: rows ``(table, column, type)`` from schemas.

    The inventory is bounded by the catalogue's column count (metadata, not data).
    """
    rows = [
        (t, f.name, normalise_type_text(f.dataType.simpleString()))
        for t, schema in tables.items()
        for f in schema
    ]
    return spark.createDataFrame(rows, "table string, column string, type string")


def table_location(spark: SparkSession, name: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    for r in rows:
        if r.col_name == "Location":
            return r.data_type
    return None
