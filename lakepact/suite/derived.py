"""Inputs the registered queries derive from the driver tables: data-dictionary documents,
column inventories and contract-registry snapshots.

Each derivation is written once in the SQL subset Spark and DuckDB share, so the Spark
query (``spark.sql(text, part=df)``) and its DuckDB oracle start from identical rows.
Every part row becomes one field definition / one table / one contract, so the inputs
grow with the scale factor; nation rows give one table definition per document.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# -- data dictionary: documents of up to 80 fields, one brand and 2,000 part keys each -----

_B = "CAST(substr(p_brand, 7) AS INT)"
_BLOCK = "CAST(p_partkey - p_partkey % 2000 AS STRING)"

FIELD_DEFS_SQL = f"""
SELECT
  p_brand || '/' || {_BLOCK} AS document,
  CAST(p_partkey AS INT) + 10 AS row,
  CAST(p_partkey AS STRING) AS id,
  CASE WHEN p_type = 'STANDARD' THEN '(Campo técnico)' ELSE 'Sistema ' || lower(p_type) END AS fuente,
  CASE WHEN {_B} > 12 AND p_size = 7 THEN 'tal vez' ELSE 'NO' END AS trazabilidad,
  upper(replace(p_name, ' ', '_')) AS nombre_fuente,
  CASE WHEN {_B} > 12 AND p_size > 45 THEN p_name
       WHEN {_B} > 12 THEN lower(replace(p_name, ' ', '_'))
       ELSE lower(replace(p_name, ' ', '_')) || '_' || CAST(p_partkey AS STRING) END AS nombre_modelado,
  'Texto_Alfanumérico' AS tipo_formato,
  'Varchar' AS formato_input,
  CASE p_type WHEN 'ECONOMY' THEN 'Varchar' WHEN 'LARGE' THEN 'Decimal' WHEN 'MEDIUM' THEN 'Date'
              WHEN 'PROMO' THEN 'Time Stamp' WHEN 'SMALL' THEN ' Boolean'
              ELSE CASE WHEN {_B} > 12 THEN 'Numerico' ELSE 'String' END END AS formato_landing,
  CASE WHEN {_B} > 12 AND p_size < 3 THEN NULL ELSE 'Campo ' || p_name END AS definicion,
  CAST(p_size AS STRING) AS longitud_fuente,
  CASE WHEN p_type = 'LARGE' THEN
         CASE WHEN {_B} > 12 AND p_size > 40 THEN 'doce'
              WHEN p_size > 25 THEN CAST(p_size AS STRING) || '.2'
              ELSE CAST(p_size AS STRING) || ', 2' END
       WHEN p_type = 'ECONOMY' THEN CAST(p_size AS STRING)
       ELSE 'No aplica' END AS longitud_landing,
  CASE WHEN p_type = 'PROMO' THEN 'no aplica'
       ELSE replace(p_name, ' ', ';') || '; ' || split_part(p_name, ' ', 1) || ';;' || p_type END AS ejemplos,
  CASE WHEN p_type = 'SMALL' THEN 'SI, NO'
       WHEN p_type = 'ECONOMY' THEN 'A;B' || chr(10) || 'C, ' || p_brand
       ELSE 'N/A' END AS catalogo,
  CASE WHEN p_retailprice > 990 THEN 'SI' WHEN p_size < 10 THEN 'no'
       WHEN {_B} > 12 AND p_size > 48 THEN 'quizas' ELSE 'No' END AS descartado,
  CASE WHEN p_size <= 2 THEN 'Sí' ELSE 'NO' END AS pk,
  'NO' AS llave_tecnica,
  CASE WHEN p_retailprice < 905 THEN 'SI' ELSE 'NO' END AS dac,
  CASE WHEN p_size = 20 THEN ' ' ELSE 'NO' END AS vacios,
  CASE WHEN p_size > 25 THEN 'SI' ELSE 'NO' END AS nulos,
  CASE WHEN p_size > 30 THEN 'EDC' WHEN {_B} > 12 AND p_size < 5 THEN 'edc' ELSE 'EDNC' END AS criticidad,
  CASE WHEN p_size > 30 THEN 'Uso regulatorio' ELSE 'N/A' END AS sustento_criticidad,
  CASE WHEN {_B} IN (1, 2) THEN 'Público' WHEN {_B} > 12 AND p_size > 44 THEN 'Secreto'
       ELSE 'Uso interno' END AS clasificacion
FROM {{part}}
"""

# One table row per document of fields, and one of a document without fields per nation.
TABLE_DEFS_SQL = f"""
SELECT
  'Brand#' || CAST(n_nationkey + 1 AS STRING) || block AS document,
  8 AS row,
  'broad/demo/' || lower(n_name) AS ruta_broad,
  'broad' AS contenedor_broad,
  CASE n_regionkey WHEN 0 THEN 'Canales de Venta' WHEN 1 THEN 'Siniestros' WHEN 2 THEN 'Póliza'
                   WHEN 3 THEN 'Finanzas' ELSE 'Canales' END AS dominio,
  CASE WHEN n_nationkey < 2 THEN 'Raw' ELSE 'Landing' END AS capa,
  CASE WHEN n_nationkey > 22 THEN NULL ELSE 'demo' END AS empresa,
  CASE n_regionkey WHEN 1 THEN 'dataentry_ext' WHEN 2 THEN 'dataentry_usr' ELSE 'dataentry_int' END AS schema_landing,
  n_name AS tabla_fuente,
  CASE WHEN n_regionkey = 3 THEN n_name ELSE lower(n_name) || replace(block, '/', '_') END AS tabla_landing,
  CAST(n_nationkey * 10 AS STRING) AS registros,
  'NO' AS historia,
  'landing/demo/' || lower(n_name) AS ruta_landing,
  'Tabla ' || n_name AS descripcion,
  'MAESTRA' AS tipo_fuente,
  CASE WHEN n_regionkey = 2 THEN 'Total' ELSE 'Full' END AS tipo_carga,
  'A DEMANDA' AS frecuencia,
  'NO' AS dac,
  'PO ' || n_name AS product_owner,
  'DATOS' AS squad,
  CASE WHEN n_nationkey > 20 THEN '2' ELSE '3' END AS template_version
FROM {{nation}} n JOIN (
  SELECT DISTINCT p_brand AS brand, '/' || {_BLOCK} AS block FROM {{part}}
  UNION ALL SELECT 'Brand#' || CAST(n_nationkey + 1 AS STRING), '' FROM {{nation}}
) d ON d.brand = 'Brand#' || CAST(n.n_nationkey + 1 AS STRING)
"""

# Business rules added to some documents (and to one that no table row names).
EXTRA_RULES_SQL = f"""
SELECT DISTINCT p_brand || '/' || {_BLOCK} AS document, 'one_type_per_size' AS check_name, 'sql' AS kind,
       CAST(NULL AS STRING) AS field, 'p_size -> p_type' AS argument
FROM {{part}} WHERE p_type = 'LARGE'
UNION ALL SELECT 'unknown', 'never_used', 'sql', CAST(NULL AS STRING), CAST(n_name AS STRING) FROM {{nation}}
"""

# Who corrects which cell (test values of the template's role row).
CELL_ROLES = [
    ("table", "tabla_landing", "Data Modeler"), ("table", "schema_landing", "Data Modeler"),
    ("table", "dominio", "Data Steward"), ("table", "capa", "Data Steward"),
    ("table", "empresa", "Data Steward"), ("table", "tabla_fuente", "Data Steward"),
    ("table", "tipo_fuente", "Data Steward"), ("table", "tipo_carga", "Data Steward"),
    ("table", "frecuencia", "Data Steward"), ("table", "descripcion", "Data Governance"),
    ("fields", "nombre_modelado", "Data Modeler"), ("fields", "formato_landing", "Data Modeler"),
    ("fields", "longitud_landing", "Data Modeler"), ("fields", "definicion", "Data Governance"),
    ("fields", "clasificacion", "Data Governance"), ("fields", "nombre_fuente", "Data Steward"),
    ("fields", "descartado", "Data Steward"), ("fields", "pk", "Data Steward"),
    ("fields", "dac", "Data Steward"), ("fields", "nulos", "Data Steward"),
]

# -- column inventories vs contracts: one table per part --------------------------------
# ``{rows:n}`` makes n rows of each part row, numbered k = 1..n, without a second scan.

TABLE_COLUMNS_SQL = """
SELECT 't' || CAST(p_partkey AS STRING) AS table_id,
       CASE k WHEN 1 THEN 'id' WHEN 2 THEN 'name' WHEN 3 THEN 'size' ELSE 'legacy_code' END AS column_name,
       CASE WHEN k = 1 OR (k = 3 AND p_size > 40) THEN 'bigint' WHEN k = 3 THEN 'int' ELSE 'string' END AS type_name
FROM (SELECT p_partkey, p_size, p_type, {rows:4} AS k FROM {part}) p
WHERE k < 4 OR p_type = 'PROMO'
"""

DRIFT_FIELDS_SQL = """
SELECT 't' || CAST(p_partkey AS STRING) AS contract,
       CASE k WHEN 1 THEN 'id' WHEN 2 THEN 'name' WHEN 3 THEN 'size' ELSE 'price' END AS field,
       CAST(k AS INT) AS position,
       CASE k WHEN 1 THEN 'BIGINT' WHEN 2 THEN 'VARCHAR(55)' WHEN 3 THEN 'INTEGER' ELSE 'DECIMAL(12,2)' END AS physical_type,
       CASE k WHEN 1 THEN true WHEN 2 THEN true WHEN 3 THEN false ELSE p_brand = 'Brand#1' END AS required
FROM (SELECT p_partkey, p_size, p_brand, {rows:4} AS k FROM {part}) p
WHERE k < 4 OR p_size > 10
"""

# -- registry snapshots: one contract per part ------------------------------------------

_SNAPSHOT_SQL = """
SELECT 'c' || CAST(p_partkey AS STRING) AS contract,
       CASE k WHEN 1 THEN 'id' WHEN 2 THEN 'name' WHEN 3 THEN 'size' ELSE 'note' END AS field,
       CAST(CASE WHEN k = 2 THEN NAME_POSITION ELSE k END AS INT) AS position,
       CASE WHEN k = 1 OR k = 3 THEN 'number' ELSE 'string' END AS logical_type,
       CASE k WHEN 1 THEN 'BIGINT' WHEN 3 THEN 'INT' ELSE 'STRING' END AS physical_type,
       k < 3 AS required,
       CASE WHEN k = 1 THEN 1 END AS key_position
FROM (SELECT p_partkey, p_size, p_brand, {rows:4} AS k FROM {part}) p
WHERE k < 4 OR p_size < 10
"""

OLD_SNAPSHOT_SQL = _SNAPSHOT_SQL.replace("NAME_POSITION", "2")

NEW_SNAPSHOT_SQL = """
SELECT CASE WHEN k = 5 THEN 'n' ELSE 'c' END || CAST(p_partkey AS STRING) AS contract,
       CASE k WHEN 2 THEN 'name' WHEN 3 THEN 'size' WHEN 4 THEN 'price' ELSE 'id' END AS field,
       CASE k WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 4 THEN 5 ELSE 1 END AS position,
       CASE WHEN k = 2 THEN 'string' ELSE 'number' END AS logical_type,
       CASE k WHEN 2 THEN CASE WHEN p_type = 'PROMO' THEN 'INT' ELSE 'VARCHAR(40)' END
              WHEN 3 THEN 'INTEGER' WHEN 4 THEN 'DECIMAL(12,2)' ELSE 'BIGINT' END AS physical_type,
       CASE k WHEN 3 THEN p_type = 'SMALL' WHEN 4 THEN p_brand = 'Brand#2' ELSE true END AS required,
       CASE WHEN k = 1 OR k = 5 THEN 1 END AS key_position
FROM (SELECT p_partkey, p_size, p_brand, p_type, {rows:5} AS k FROM {part}) p
WHERE (k < 5 AND p_size <> 1) OR (k = 5 AND p_size = 50)
"""

REGENERATED_SNAPSHOT_SQL = _SNAPSHOT_SQL.replace("NAME_POSITION", "CASE WHEN p_brand = 'Brand#3' THEN 5 ELSE 2 END")

_ROWS = re.compile(r"\{rows:(\d+)\}")


def for_duckdb(sql: str) -> str:
    sql = _ROWS.sub(r"unnest(generate_series(1, \1))", sql)
    return sql.replace("{part}", "part").replace("{nation}", "nation")


def spark_derive(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """Run a derivation over DataFrames bound as SQL parameters (no global views)."""
    return spark.sql(_ROWS.sub(r"explode(sequence(1, \1))", sql), **frames)
