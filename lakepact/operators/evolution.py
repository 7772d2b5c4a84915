"""Schema drift between tables and contracts, and additive evolution.

The rule (one place, column-wise): a table may only *gain nullable columns*.

* table column the contract lacks          → ``extra_column``   (incompatible)
* both sides, types differ                 → ``type_mismatch``  (incompatible)
* contract column the table lacks, required→ ``new_required``   (incompatible)
* contract column the table lacks, optional→ ``new_optional``   (added by ALTER)

Re-aimed from one table at a time on the driver to one grouping of the column
inventories of *all* tables, so a whole catalogue is checked by one Spark job. A single
load uses the same function on its one table.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..contract import Contract, ContractError, normalise_type_text
from ..functions.types import spark_type_name
from .checks import sql_str

CONTRACT_FIELDS_DDL = (
    "contract string, field string, position int, logical_type string, "
    "physical_type string, required boolean, key_position int"
)


class EvolutionRefused(ContractError):
    """The table cannot follow the contract without an incompatible change."""

    def __init__(self, table: str, problems: list[str]):
        self.table, self.problems = table, problems
        super().__init__(
            f"table {table} cannot be aligned with its contract without an incompatible "
            "change:\n- " + "\n- ".join(problems)
        )


def contract_fields_frame(spark: SparkSession, contracts: Iterable[Contract]) -> DataFrame:
    """``contract_fields`` rows of parsed contracts (metadata; bounded by their fields)."""
    rows = [
        (c.id, f.name, i + 1, f.logical_type, f.physical_type, f.required, f.primary_key_position)
        for c in contracts
        for i, f in enumerate(c.fields)
    ]
    return spark.createDataFrame(rows, CONTRACT_FIELDS_DDL)


def table_columns_of(spark: SparkSession, table_id: str, name: str) -> DataFrame:
    """E2 for one table: ``(table, column, type)`` from its schema."""
    rows = [(table_id, f.name, normalise_type_text(f.dataType.simpleString()))
            for f in spark.table(name).schema]
    return spark.createDataFrame(rows, "table string, column string, type string")


def schema_drift(table_columns: DataFrame, contract_fields: DataFrame) -> DataFrame:
    """E3–E5 for every table that has both an inventory and a contract.

    ``table_columns(table, column, type)``; ``contract_fields(contract, field, …)`` where the
    contract id names the table. Output: ``table, column, table_type, contract_type,
    required, change, compatible``.
    """
    none = F.lit(None)
    tc = table_columns.select(
        F.col("table"), F.col("column"), spark_type_name(F.col("type")).alias("table_type"),
        none.cast("string").alias("contract_type"), none.cast("boolean").alias("required"), F.lit(0).alias("__side"),
    )
    cf = contract_fields.select(
        F.col("contract").alias("table"), F.col("field").alias("column"), none.cast("string").alias("table_type"),
        spark_type_name(F.col("physical_type")).alias("contract_type"), F.col("required"), F.lit(1).alias("__side"),
    )
    # Both inventories tagged and grouped once per column, then once per table.
    columns = tc.unionByName(cf).groupBy("table", "column").agg(
        F.max("table_type").alias("table_type"), F.max("contract_type").alias("contract_type"),
        F.bool_or("required").alias("required"), F.min("__side").alias("__lo"), F.max("__side").alias("__hi"),
    )
    # Only tables present on both sides are compared; a table without columns is created,
    # a table without a contract is not ours.
    both = columns.groupBy("table").agg(F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi")).where("__lo < __hi")
    j = columns.join(both.select("table"), "table", "left_semi")
    change = (
        F.when(F.col("contract_type").isNull(), F.lit("extra_column"))
        .when(F.col("table_type").isNull() & F.col("required"), F.lit("new_required"))
        .when(F.col("table_type").isNull(), F.lit("new_optional"))
        .when(F.col("table_type") != F.col("contract_type"), F.lit("type_mismatch"))
        .otherwise(F.lit("unchanged"))
    )
    return (
        j.withColumn("change", change)
        .withColumn("compatible", F.col("change").isin("unchanged", "new_optional"))
        .select("table", "column", "table_type", "contract_type",
                F.coalesce(F.col("required"), F.lit(False)).alias("required"),
                "change", "compatible")
    )


def drift_verdict(drift: DataFrame) -> DataFrame:
    """E6 per table: compatible only if every column is; counts of problems and additions."""
    return drift.groupBy("table").agg(
        F.bool_and("compatible").alias("compatible"),
        F.count_if(~F.col("compatible")).alias("problems"),
        F.count_if(F.col("change") == "new_optional").alias("columns_to_add"),
    )


PROBLEMS = {
    "extra_column": "{column}: not declared by the contract (table type {table_type})",
    "type_mismatch": "{column}: {table_type} in the table, {contract_type} in the contract",
    "new_required": "{column}: required by the contract, absent from the table",
}


def problem_text(row) -> str:
    return PROBLEMS.get(row["change"], "{column}: {change}").format(**row.asDict())


def add_optional_columns(spark: SparkSession, name: str, contract: Contract, table_id: str | None = None) -> list[str]:
    """E3–E7 for one existing table: refuse all-or-nothing, else one ALTER adding every new
    nullable column (with its comment). Returns the actions taken."""
    table_id = table_id or contract.id
    drift = schema_drift(
        table_columns_of(spark, table_id, name),
        contract_fields_frame(spark, [contract]).withColumn("contract", F.lit(table_id)),
    )
    rows = drift.collect()  # one row per column of one table
    problems = [problem_text(r) for r in rows if not r["compatible"]]
    if problems:
        raise EvolutionRefused(name, problems)
    new = [contract.field(r["column"]) for r in rows if r["change"] == "new_optional"]
    new.sort(key=lambda f: contract.names.index(f.name))
    if not new:
        return ["existing table, structure unchanged"]
    cols = ", ".join(
        f"`{f.name}` {f.data_type.simpleString()} COMMENT {sql_str(f.description or '')}" for f in new
    )
    spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({cols})")
    return [f"column added: {f.name} {f.physical_type}" for f in new]
