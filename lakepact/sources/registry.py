"""A registry of contract documents (YAML files) read as a Spark job.

Each file is parsed inside a task (one small document per row, YAML → rows in Python), so
thousands of contracts become one ``contract_fields`` table without passing through the
driver. Two registries (e.g. two branches checked out side by side) are then compared with
``operators.diff`` (D1–D5).
"""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.evolution import CONTRACT_FIELDS_DDL

REGISTRY_DDL = CONTRACT_FIELDS_DDL + ", path string"


def _fields_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import yaml

    for pdf in batches:
        out = []
        for path, text in zip(pdf["path"], pdf["value"]):
            doc = yaml.safe_load(text) or {}
            models = doc.get("schema") or []
            props = models[0].get("properties") or [] if models else []
            for i, p in enumerate(props):
                pk = p.get("primaryKeyPosition") if p.get("primaryKey") else None
                if p.get("primaryKey") and pk is None:
                    pk = 1
                out.append((str(doc.get("id")), str(p.get("name")), i + 1, p.get("logicalType"),
                            p.get("physicalType"), bool(p.get("required", False)),
                            int(pk) if pk is not None else None, path))
        yield pd.DataFrame(out, columns=["contract", "field", "position", "logical_type", "physical_type",
                                         "required", "key_position", "path"])


def read_contract_registry(spark: SparkSession, path: str) -> DataFrame:
    """``contract_fields`` rows (plus the file path) of every contract file under ``path``
    (a folder or glob of ``*.yaml`` documents)."""
    files = spark.read.text(path, wholetext=True).select(
        F.col("value"), F.input_file_name().alias("path")
    )
    return files.mapInPandas(_fields_of, REGISTRY_DDL)
