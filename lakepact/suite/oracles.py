"""DuckDB SQL oracles for the registered queries (same column names, same values).

Written independently of the Spark code: each check's metric is stated as plain SQL over
the driver tables. Long reports are assembled from (check, kind, field, metric, bound)
tuples to keep them readable.
"""

from __future__ import annotations

from . import derived as X

# ---- helpers ------------------------------------------------------------------------------


def _q(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def _result(metric: str, op: str, v: str) -> str:
    return f"CASE WHEN ({metric}) {op} {v} THEN 'passed' ELSE 'failed' END"


def report_rows(contract: str, src: str, checks: list[tuple]) -> str:
    """checks: (check, kind, field, metric_sql, op, bound). metric_sql is evaluated over src
    (an aggregate, a literal or a scalar subquery) and yields exactly one row per check."""
    parts = []
    for check, kind, field, metric, op, bound in checks:
        parts.append(
            f"SELECT {_q(contract)} AS contract, {_q(check)} AS \"check\", {_q(kind)} AS kind, "
            f"CAST({_q(field)} AS VARCHAR) AS field, CAST(m AS BIGINT) AS metric, "
            f"{_result('m', op, bound)} AS result FROM (SELECT max(m) AS m FROM (SELECT ({metric}) AS m FROM {src}))"
        )
    return "\nUNION ALL ".join(parts)


def schema_checks(fields: list[str], bad_type: set[str] = frozenset(), missing: set[str] = frozenset()):
    out = []
    for f in fields:
        out.append((f"{f}:present", "present", f, "1" if f in missing else "0", "=", "0"))
        out.append((f"{f}:type", "type", f, "1" if (f in bad_type or f in missing) else "0", "=", "0"))
    return out


def required_checks(fields: list[str]):
    return [(f"{f}:required", "required", f, f"count(*) - count({f})", "=", "0") for f in fields]


def norm(x: str) -> str:
    return (f"trim(regexp_replace(lower(replace(replace(replace(strip_accents({x}), '¿', ''), '?', ''), "
            f"chr(10), ' ')), '\\s+', ' ', 'g'))")


def norm0(x: str) -> str:
    return f"coalesce({norm(x)}, '')"


def clean(x: str) -> str:
    t = f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
    return f"CASE WHEN {t} = '' THEN NULL ELSE {t} END"


def yesno(x: str) -> str:
    return f"CASE WHEN upper({norm0(x)}) IN ('SI', 'NO') THEN upper({norm0(x)}) END"


def not_applicable(x: str) -> str:
    return f"({norm0(x)} IN ('', 'no aplica', 'n/a', 'na', '-'))"


def type_name(x: str) -> str:
    t = f"lower(regexp_replace({x}, '\\s+', '', 'g'))"
    return (f"CASE WHEN {t} IN ('string', 'text') OR regexp_matches({t}, '^(varchar|char|character)\\(\\d+\\)$') THEN 'string' "
            f"WHEN {t} IN ('int', 'integer') THEN 'int' WHEN {t} IN ('bigint', 'long') THEN 'bigint' "
            f"WHEN {t} IN ('smallint', 'short') THEN 'smallint' WHEN {t} IN ('tinyint', 'byte') THEN 'tinyint' "
            f"WHEN {t} IN ('boolean', 'bool') THEN 'boolean' WHEN {t} IN ('float', 'real') THEN 'float' "
            f"WHEN {t} IN ('timestamp', 'timestamp_ltz') THEN 'timestamp' "
            f"WHEN {t} IN ('decimal', 'numeric', 'dec') THEN 'decimal(10,0)' "
            f"WHEN regexp_matches({t}, '^(decimal|numeric|dec)\\(\\d+,\\d+\\)$') "
            f"THEN regexp_replace({t}, '^(numeric|dec)\\(', 'decimal(') ELSE {t} END")


def dup_groups(table: str, keys: str) -> str:
    return f"(SELECT count(*) FROM (SELECT {keys} FROM {table} GROUP BY {keys} HAVING count(*) > 1))"


# ---- typed copies of the driver tables (as the contracts type them) -------------------

ORDERS_TYPED = ("(SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, "
                "CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders)")
LINEITEM_TYPED = ("(SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS DECIMAL(12,2)) AS l_quantity, "
                  "CAST(l_extendedprice AS DECIMAL(12,2)) AS l_extendedprice, CAST(l_discount AS DECIMAL(4,2)) AS l_discount, "
                  "CAST(l_tax AS DECIMAL(4,2)) AS l_tax, l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate "
                  "FROM lineitem)")

ORDERS_FIELDS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
LINEITEM_FIELDS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                   "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _orders_report(src: str = ORDERS_TYPED) -> str:
    checks = schema_checks(ORDERS_FIELDS) + required_checks(ORDERS_FIELDS) + [
        ("orderstatus_catalogo", "valid_values", "o_orderstatus",
         "count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O', 'P'))", "=", "0"),
        ("o_totalprice:exclusive_minimum", "exclusive_minimum", "o_totalprice",
         "count(*) FILTER (WHERE o_totalprice < 0)", "=", "0"),
        ("o_totalprice:exclusive_minimum_equal", "exclusive_minimum_equal", "o_totalprice",
         "count(*) FILTER (WHERE o_totalprice = 0)", "=", "0"),
        ("o_orderpriority:pattern", "pattern", "o_orderpriority",
         "count(*) FILTER (WHERE NOT regexp_matches(o_orderpriority, '^[1-5]-[A-Z ]+$'))", "=", "0"),
        ("o_orderkey:unique", "unique", "o_orderkey", dup_groups("orders", "o_orderkey"), "=", "0"),
        ("not_empty", "row_count", None, "count(*)", ">", "0"),
        ("no_future_orders", "sql", None, "count(*) FILTER (WHERE o_orderdate > DATE '2030-01-01')", "=", "0"),
    ]
    return report_rows("orders", src, checks)


def _lineitem_report(src: str = LINEITEM_TYPED) -> str:
    checks = schema_checks(LINEITEM_FIELDS) + required_checks(LINEITEM_FIELDS) + [
        ("l_quantity:exclusive_minimum", "exclusive_minimum", "l_quantity", "count(*) FILTER (WHERE l_quantity < 0)", "=", "0"),
        ("l_quantity:exclusive_minimum_equal", "exclusive_minimum_equal", "l_quantity", "count(*) FILTER (WHERE l_quantity = 0)", "=", "0"),
        ("l_extendedprice:minimum", "minimum", "l_extendedprice", "count(*) FILTER (WHERE l_extendedprice < 0)", "=", "0"),
        ("l_discount:minimum", "minimum", "l_discount", "count(*) FILTER (WHERE l_discount < 0)", "=", "0"),
        ("l_discount:maximum", "maximum", "l_discount", "count(*) FILTER (WHERE l_discount > 0.1)", "=", "0"),
        ("l_tax:maximum", "maximum", "l_tax", "count(*) FILTER (WHERE l_tax > 0.08)", "=", "0"),
        ("returnflag_catalogo", "valid_values", "l_returnflag", "count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N', 'R'))", "=", "0"),
        ("linestatus_catalogo", "valid_values", "l_linestatus", "count(*) FILTER (WHERE l_linestatus NOT IN ('F', 'O'))", "=", "0"),
        ("l_orderkey+l_linenumber:unique", "unique", "l_orderkey+l_linenumber",
         dup_groups("lineitem", "l_orderkey, l_linenumber"), "=", "0"),
        ("not_empty", "row_count", None, "count(*)", ">", "0"),
        ("tax_not_above_discount", "sql", None, "count(*) FILTER (WHERE l_tax > l_discount)", "=", "0"),
        ("one_flag_per_order", "sql", None,
         "(SELECT count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_returnflag) > 1))",
         "=", "0"),
    ]
    return report_rows("lineitem", src, checks)


def _supplier_report() -> str:
    f = ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]
    checks = schema_checks(f) + required_checks(f) + [
        ("s_suppkey:unique", "unique", "s_suppkey", dup_groups("supplier", "s_suppkey"), "=", "0"),
        ("not_empty", "row_count", None, "count(*)", ">", "0"),
    ]
    return report_rows("supplier", "supplier", checks)


# ---- data dictionary CTEs ---------------------------------------------------------------

FLAGS = ["descartado", "pk", "dac", "nulos", "vacios", "llave_tecnica", "trazabilidad"]
FIELD_CELLS = ["id", "fuente", "trazabilidad", "nombre_fuente", "nombre_modelado", "tipo_formato",
               "formato_input", "formato_landing", "definicion", "longitud_fuente", "longitud_landing",
               "ejemplos", "catalogo", "descartado", "pk", "llave_tecnica", "dac", "vacios", "nulos",
               "criticidad", "sustento_criticidad", "clasificacion"]
TABLE_CELLS = ["ruta_broad", "contenedor_broad", "dominio", "capa", "empresa", "schema_landing",
               "tabla_fuente", "tabla_landing", "registros", "historia", "ruta_landing", "descripcion",
               "tipo_fuente", "tipo_carga", "frecuencia", "dac", "product_owner", "squad"]
IDENT = "'^[a-z][a-z0-9_]*$'"
DEC = "'^\\s*(\\d+)\\s*[,.;]\\s*(\\d+)\\s*$'"
TYPES = ("(VALUES ('string', 'string', 'STRING'), ('varchar', 'string', 'STRING'), ('char', 'string', 'STRING'), "
         "('decimal', 'number', NULL), ('date', 'date', 'DATE'), ('time_stamp', 'timestamp', 'TIMESTAMP'), "
         "('timestamp', 'timestamp', 'TIMESTAMP'), ('boolean', 'boolean', 'BOOLEAN'), ('bit', 'boolean', 'BOOLEAN'), "
         "('time', 'string', 'STRING')) AS tm(fmt, logical_type, physical_type)")


def _dict_ctes() -> str:
    fd_cols = []
    for c in FIELD_CELLS:
        if c in FLAGS:
            fd_cols.append(f"{yesno(clean(c))} AS {c}, {clean(c)} AS {c}__raw")
        else:
            fd_cols.append(f"{clean(c)} AS {c}")
    td_cols = [f"{clean(c)} AS {c}" for c in TABLE_CELLS]
    roles = ", ".join(f"({_q(s)}, {_q(c)}, {_q(r)})" for s, c, r in X.CELL_ROLES)
    return f"""
fd_raw AS ({X.for_duckdb(X.FIELD_DEFS_SQL)}),
td_raw AS ({X.for_duckdb(X.TABLE_DEFS_SQL)}),
fd0 AS (SELECT document, "row", {', '.join(fd_cols)} FROM fd_raw),
fd AS (SELECT *, coalesce(descartado, '') <> 'SI' AS active FROM fd0),
td AS (SELECT document, "row", template_version, {', '.join(td_cols)} FROM td_raw),
roles AS (SELECT * FROM (VALUES {roles}) AS r(sheet, cell, role)),
fa AS (SELECT *, replace({norm0('formato_landing')}, ' ', '_') AS fmt FROM fd WHERE active)
"""


def _issue_sql() -> str:
    def iss(src, sheet, row, cell, rule, where, sev="error"):
        return (f"SELECT document, '{sheet}' AS sheet, CAST({row} AS INTEGER) AS \"row\", '{cell}' AS cell, "
                f"'{rule}' AS rule, '{sev}' AS severity FROM {src} WHERE {where}")

    parts = [iss("fd", "fields", '"row"', c, "yes_no", f"{c}__raw IS NOT NULL AND {c} IS NULL") for c in FLAGS]
    for c in ["dominio", "capa", "empresa", "schema_landing", "tabla_fuente", "tabla_landing", "descripcion",
              "tipo_fuente", "tipo_carga", "frecuencia"]:
        parts.append(iss("td", "table", '"row"', c, "mandatory", f"{c} IS NULL"))
    for c in ["nombre_fuente", "nombre_modelado", "formato_landing", "definicion", "descartado", "pk", "dac",
              "nulos", "clasificacion"]:
        parts.append(iss("fd", "fields", '"row"', c, "mandatory", f"active AND {c} IS NULL"))
    parts.append(iss("td", "table", '"row"', "tabla_landing", "identifier",
                     f"tabla_landing IS NOT NULL AND NOT regexp_matches(tabla_landing, {IDENT})"))
    parts.append(iss("fa", "fields", '"row"', "nombre_modelado", "identifier",
                     f"nombre_modelado IS NOT NULL AND NOT regexp_matches(nombre_modelado, {IDENT})"))
    parts.append(
        "SELECT document, 'fields' AS sheet, CAST(\"row\" AS INTEGER) AS \"row\", 'nombre_modelado' AS cell, "
        "'repeated_name' AS rule, 'error' AS severity FROM (SELECT document, \"row\", "
        "min(\"row\") OVER (PARTITION BY document, nombre_modelado) AS first_row FROM fa "
        f"WHERE regexp_matches(nombre_modelado, {IDENT})) WHERE \"row\" > first_row")
    parts.append(iss("fa", "fields", '"row"', "formato_landing", "unknown_format",
                     "formato_landing IS NOT NULL AND fmt NOT IN (SELECT fmt FROM " + TYPES + ")"))
    parts.append(iss("fa", "fields", '"row"', "longitud_landing", "decimal_length",
                     f"formato_landing IS NOT NULL AND fmt = 'decimal' AND NOT regexp_matches(coalesce(longitud_landing, ''), {DEC})"))
    lists = {
        "dominio": ["Atenciones Médicas", "Canales de Venta", "Cliente Cuenta Persona Jurídica",
                    "Cliente Cuenta Persona Natural", "Cobranzas", "Data & Analytics", "Empresas Prestadoras",
                    "Finanzas", "Médicos", "Póliza", "Producto Empresa", "Producto Persona", "Siniestros"],
        "empresa": ["demo", "corp"],
        "schema_landing": ["dataentry_int", "dataentry_ext", "dataentry_usr"],
        "tipo_fuente": ["DESCRIPTIVA", "MAESTRA", "HISTORICA", "DATA ENTRY"],
        "tipo_carga": ["Full", "Incremental"],
        "frecuencia": ["DIARIA (L - V) Feriados", "DIARIA (L - V) Sin Feriados", "DIARIA (L - D) Feriados",
                       "DIARIA (L - D) Sin Feriados", "SEMANAL", "MENSUAL", "A DEMANDA"],
    }
    for c, vals in lists.items():
        parts.append(iss("td", "table", '"row"', c, "allowed_values",
                         f"{c} IS NOT NULL AND {c} NOT IN ({', '.join(_q(v) for v in vals)})"))
    parts.append(iss("td", "table", '"row"', "capa", "layer", "capa IS NOT NULL AND upper(capa) <> 'LANDING'"))
    parts.append(iss("fa", "fields", '"row"', "clasificacion", "classification",
                     f"clasificacion IS NOT NULL AND {norm('clasificacion')} NOT IN ('publico', 'uso interno', 'restringido')"))
    parts.append(iss("fa", "fields", '"row"', "criticidad", "criticality",
                     "criticidad IS NOT NULL AND criticidad NOT IN ('EDC', 'EDNC')"))
    parts.append(iss("fa", "fields", '"row"', "clasificacion", "sensitive_public",
                     f"dac = 'SI' AND {norm('clasificacion')} = 'publico'", "warning"))
    parts.append("SELECT document, 'fields' AS sheet, CAST(NULL AS INTEGER) AS \"row\", 'pk' AS cell, 'no_key' AS rule, "
                 "'warning' AS severity FROM fa GROUP BY document HAVING NOT bool_or(coalesce(pk = 'SI', false))")
    parts.append("SELECT document, 'fields' AS sheet, CAST(NULL AS INTEGER) AS \"row\", 'id' AS cell, 'no_fields' AS rule, "
                 "'error' AS severity FROM td WHERE document NOT IN (SELECT document FROM fd)")
    parts.append(iss("td", "table", "NULL", "template_version", "template_version",
                     "template_version IS NOT NULL AND template_version NOT IN ('3')", "warning"))
    return "\nUNION ALL ".join(parts)


def _dict(select: str) -> str:
    return (f"WITH {_dict_ctes()}, issues AS ({_issue_sql()}), "
            f"bad AS (SELECT DISTINCT document FROM issues WHERE severity = 'error')\n{select}")


def _key_positions() -> str:
    return ("SELECT *, CASE WHEN pk = 'SI' THEN sum(CASE WHEN pk = 'SI' THEN 1 ELSE 0 END) OVER "
            "(PARTITION BY document ORDER BY \"row\" ROWS UNBOUNDED PRECEDING) END AS key_position FROM fa")


def _typed_fields() -> str:
    return (f"SELECT fa.*, tm.logical_type, CASE WHEN fa.fmt = 'decimal' THEN CASE WHEN regexp_matches(coalesce(longitud_landing, ''), {DEC}) "
            f"THEN 'DECIMAL(' || CAST(CAST(regexp_extract(longitud_landing, {DEC}, 1) AS INTEGER) AS VARCHAR) || ',' || "
            f"CAST(CAST(regexp_extract(longitud_landing, {DEC}, 2) AS INTEGER) AS VARCHAR) || ')' END ELSE tm.physical_type END AS physical_type, "
            "CASE WHEN tm.logical_type = 'string' AND regexp_matches(longitud_landing, '^[0-9]+$') THEN CAST(longitud_landing AS INTEGER) END AS max_length "
            f"FROM fa LEFT JOIN {TYPES} ON fa.fmt = tm.fmt")


def _split_values(c: str) -> str:
    return f"list_filter(list_transform(regexp_split_to_array({c}, '[;,\\n]'), lambda x: trim(x)), lambda x: x <> '')"


def _split_examples(c: str) -> str:
    parts = f"list_filter(list_transform(string_split({c}, ';'), lambda x: trim(x)), lambda x: x <> '')"
    return f"list_filter({parts}, lambda x, i: list_position({parts}, x) = i)[1:4]"


# ---- the oracles ----------------------------------------------------------------------------


def oracle_sql() -> dict[str, str]:
    roles_join = "LEFT JOIN roles USING (sheet, cell)"
    o: dict[str, str] = {}
    o["q_text_scan"] = (
        "SELECT c_mktsegment, count(*) AS n_rows, count(c_acctbal) AS n_acctbal, "
        "CAST(sum(CAST(c_acctbal AS DECIMAL(12,2))) * 100 AS BIGINT) AS sum_acctbal_cents, "
        "CAST(sum(c_nationkey) AS BIGINT) AS sum_nationkey, count(DISTINCT c_name) AS n_names "
        "FROM customer GROUP BY c_mktsegment")
    o["q_quoted_splits"] = (
        "SELECT page_id, url, md5('<p class=\"a\">' || chr(10) || coalesce(html, '') || chr(10) || '\"end\",' || chr(10)) "
        "AS body_md5 FROM pages")
    o["q_table_count"] = "SELECT 'region' AS table_name, count(*) AS row_count FROM region"
    o["q_typed_projection"] = (
        "SELECT count(*) AS n_rows, count(o_orderkey) AS n_orderkey, count(o_totalprice) AS n_totalprice, "
        "count(o_orderdate) AS n_orderdate, CAST(0 AS BIGINT) AS n_priority, "
        "CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) * 100 AS BIGINT) AS sum_totalprice_cents, "
        "min(CAST(o_orderdate AS DATE)) AS min_orderdate, max(CAST(o_orderdate AS DATE)) AS max_orderdate, "
        "CAST(sum(o_orderkey) AS BIGINT) AS sum_orderkey FROM orders")
    o["q_null_fill"] = ("SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_comment_values, count(n_name) AS n_name_values, "
                        "CAST(sum(n_regionkey) AS BIGINT) AS sum_regionkey FROM nation")
    o["q_align_by_name"] = ("SELECT s_suppkey, s_name, s_nationkey, CAST(s_acctbal AS DECIMAL(12,2)) AS s_acctbal "
                            "FROM supplier")
    rows_check = [("not_empty", "row_count", None, "count(*)", ">", "0")]
    headings = [c if c[0] != "o_orderpriority:present" else (*c[:3], "1", *c[4:]) for c in schema_checks(ORDERS_FIELDS)]
    stored = schema_checks(ORDERS_FIELDS + ["o_comment"], bad_type={"o_totalprice", "o_orderdate", "o_orderpriority"},
                           missing={"o_comment"})
    o["q_check_presence_type"] = (
        f"SELECT *, 'delivery' AS source FROM ({report_rows('orders', 'orders', headings + rows_check)}) "
        f"UNION ALL SELECT *, 'table' AS source FROM ({report_rows('orders', 'orders', stored + rows_check)})")
    ev = "(SELECT event_id, ts, user_id, nullif(event_type, 'error') AS event_type, value, props FROM events)"
    o["q_check_required"] = report_rows(
        "events", ev, required_checks(["event_id", "ts", "user_id", "event_type", "value", "props"]))
    o["q_check_unique_single"] = report_rows(
        "orders", "(SELECT 1)", [("o_orderkey:unique", "unique", "o_orderkey", dup_groups("orders", "o_orderkey"), "=", "0")])
    o["q_check_unique_composite"] = (
        "SELECT r.*, CAST((SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM lineitem "
        "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) AS BIGINT) AS dup_rows FROM ("
        + report_rows("lineitem", "(SELECT 1)", [("l_orderkey+l_linenumber:unique", "unique", "l_orderkey+l_linenumber",
                                                    dup_groups("lineitem", "l_orderkey, l_linenumber"), "=", "0")]) + ") r")
    o["q_check_unique_many"] = report_rows("lineitem", "(SELECT 1)", [
        (f"{'+'.join(names)}:unique", "unique", "+".join(names), dup_groups(
            "(SELECT *, l_returnflag || '/' || l_linestatus || '/' || CAST(l_shipdate AS VARCHAR) AS l_comment_free FROM lineitem)",
            ", ".join(names)), "=", "0")
        for names in (["l_orderkey"], ["l_comment_free"], ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey"],
                      ["l_partkey", "l_suppkey", "l_quantity"])])
    o["q_check_valid_values"] = report_rows("events", "events", [
        ("event_type_catalogo", "valid_values", "event_type",
         "count(*) FILTER (WHERE event_type NOT IN ('click', 'view', 'signup'))", "=", "0")])
    o["q_check_valid_values_long"] = report_rows("orders", "orders", [
        ("known_customer", "valid_values", "o_custkey",
         "count(*) FILTER (WHERE o_custkey IS NOT NULL AND (o_custkey < 0 OR o_custkey >= 12000))", "=", "0")])
    ev = "(SELECT event_id, nullif(event_type, 'view') AS event_type, user_id FROM events)"
    o["q_library_metrics"] = (
        f"SELECT 'event_id:unique' AS \"check\", 'unique' AS kind, CAST(m AS BIGINT) AS metric, '= 0' AS bound, "
        f"CASE WHEN m = 0 THEN 'passed' ELSE 'failed' END AS result FROM (SELECT {dup_groups('events', 'event_id')} AS m) "
        f"UNION ALL SELECT 'few_untyped', 'required', m, '< 100', CASE WHEN m < 100 THEN 'passed' ELSE 'failed' END "
        f"FROM (SELECT count(*) - count(event_type) AS m FROM {ev}) "
        f"UNION ALL SELECT 'errors_as_missing', 'missing_values', m, 'between 1000 and 5000', "
        f"CASE WHEN m BETWEEN 1000 AND 5000 THEN 'passed' ELSE 'failed' END "
        f"FROM (SELECT count(*) FILTER (WHERE event_type IS NULL OR event_type IN ('error', 'n/a')) AS m FROM {ev}) "
        f"UNION ALL SELECT 'one_event_type_per_user', 'unique', m, '= 0', CASE WHEN m = 0 THEN 'passed' ELSE 'failed' END "
        f"FROM (SELECT count(*) AS m FROM (SELECT user_id, event_type FROM {ev} GROUP BY user_id, event_type HAVING count(*) > 1)) "
        f"UNION ALL SELECT 'enough_rows', 'row_count', m, '>= 100', CASE WHEN m >= 100 THEN 'passed' ELSE 'failed' END "
        f"FROM (SELECT count(*) AS m FROM events)")
    o["q_check_pattern"] = report_rows("part", "part", [
        ("p_brand:pattern", "pattern", "p_brand", "count(*) FILTER (WHERE NOT regexp_matches(p_brand, '^Brand#[0-9]$'))", "=", "0")])
    o["q_check_length"] = report_rows("part", "part", [
        ("p_name:min_length", "min_length", "p_name", "count(*) FILTER (WHERE length(p_name) < 9)", "=", "0"),
        ("p_name:max_length", "max_length", "p_name", "count(*) FILTER (WHERE length(p_name) > 11)", "=", "0")])
    o["q_check_exclusive_min"] = report_rows("customer", "customer", [
        ("c_acctbal:exclusive_minimum", "exclusive_minimum", "c_acctbal", "count(*) FILTER (WHERE c_acctbal < 0)", "=", "0"),
        ("c_acctbal:exclusive_minimum_equal", "exclusive_minimum_equal", "c_acctbal",
         "count(*) FILTER (WHERE c_acctbal = 0)", "=", "0")])
    tables = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
              "embeddings", "pages", "benchmark", "labels", "conversations"]
    o["q_check_row_count"] = "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, CASE WHEN count(*) > 0 THEN 'passed' ELSE 'failed' END AS result FROM {t}"
        for t in tables)
    o["q_sql_rule_filter"] = report_rows("lineitem", "lineitem", [
        ("no_zero_tax", "sql", None, "count(*) FILTER (WHERE l_tax = 0)", "=", "0")])
    o["q_sql_rule_fd"] = report_rows("part", "(SELECT 1)", [
        ("one_type_per_brand", "sql", None,
         "(SELECT count(*) FROM (SELECT p_brand FROM part GROUP BY p_brand HAVING count(DISTINCT p_type) > 1))", "=", "0")])
    o["q_sql_rule_two_columns"] = report_rows("lineitem", "lineitem", [
        ("tax_below_discount", "sql", None, "count(*) FILTER (WHERE l_tax IS NOT NULL AND l_tax < l_discount)", "=", "0")])
    gate = f"{_orders_report()}\nUNION ALL {_lineitem_report()}"
    o["q_gate_report"] = (
        "SELECT *, CASE WHEN kind IN ('present', 'required', 'row_count') THEN 'completeness' "
        "WHEN kind = 'unique' THEN 'uniqueness' WHEN kind IN ('type', 'pattern', 'valid_values') THEN 'conformity' "
        "WHEN kind <> 'sql' THEN 'accuracy' WHEN \"check\" = 'no_future_orders' THEN 'timeliness' END AS dimension, "
        "CASE WHEN \"check\" = 'no_future_orders' THEN 'warning' ELSE 'error' END AS severity, "
        "CASE WHEN kind = 'row_count' THEN '> 0' ELSE '= 0' END AS bound, "
        "CASE \"check\" WHEN 'not_empty' THEN 'a delivery has rows' "
        f"WHEN 'no_future_orders' THEN 'no order is dated ahead' END AS description FROM ({gate})")
    o["q_gate_verdict"] = (f"SELECT contract, bool_and(result = 'passed') AS passed, count(*) AS checks, "
                           f"count(*) FILTER (WHERE result <> 'passed') AS failed FROM ({gate}) GROUP BY contract")
    custom = report_rows("supplier_custom", "supplier", schema_checks(["s_suppkey", "s_acctbal"]) +
                         required_checks(["s_suppkey", "s_acctbal"]) + [
        ("s_suppkey:unique", "unique", "s_suppkey", dup_groups("supplier", "s_suppkey"), "=", "0"),
        ("not_empty", "row_count", None, "count(*)", ">", "0")])
    custom_counts = "count(*) + 1 AS checks, count(*) FILTER (WHERE result <> 'passed') AS failed, CAST(1 AS BIGINT) AS not_run"
    o["q_custom_rule"] = (
        f"SELECT false AS not_run_blocks, bool_and(result = 'passed') AS passed, {custom_counts} FROM ({custom}) "
        f"UNION ALL SELECT true AS not_run_blocks, false AS passed, {custom_counts} FROM ({custom})")
    o["q_gate_failing"] = f"SELECT * FROM ({_lineitem_report()}) WHERE result <> 'passed'"
    o["q_flagship_load"] = _orders_report()
    o["q_landing_stream"] = _orders_report()
    o["q_malformed_rows"] = (
        "SELECT 'delivery:malformed_rows' AS \"check\", count(*) FILTER (WHERE o_orderpriority LIKE '1-%') AS metric, "
        "CASE WHEN count(*) FILTER (WHERE o_orderpriority LIKE '1-%') = 0 THEN 'passed' ELSE 'failed' END AS result FROM orders "
        "UNION ALL SELECT 'not_empty', count(*), CASE WHEN count(*) > 0 THEN 'passed' ELSE 'failed' END FROM orders")
    o["q_publish_roundtrip"] = o["q_align_by_name"]
    o["q_post_load"] = _supplier_report()
    o["q_publish_overwrite"] = o["q_align_by_name"]
    o["q_gate_refusal"] = ("SELECT 'o_orderkey:unique' AS \"check\", count(DISTINCT o_orderkey) AS metric, "
                           "count(*) AS current_rows, count(*) AS rows_after FROM orders")
    loss = [("o_orderkey", "TRY_CAST(CAST(o_orderkey AS VARCHAR) AS BIGINT) IS NULL"),
            ("o_custkey", "TRY_CAST(CAST(o_custkey AS VARCHAR) AS BIGINT) IS NULL"),
            ("o_orderstatus", "false"),
            ("o_totalprice", "TRY_CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(12,2)) IS NULL"),
            ("o_orderdate", "CAST(o_orderdate AS DATE) IS NULL"),
            ("o_orderpriority", "TRY_CAST(o_orderpriority AS INTEGER) IS NULL")]
    o["q_cast_loss"] = "\nUNION ALL ".join(
        f"SELECT '{f}' AS field, count(*) FILTER (WHERE {cond}) AS metric, 'passed' AS result FROM orders"
        for f, cond in loss)

    drift = f"""
WITH tc AS (SELECT table_id AS tbl, column_name AS col, {type_name('type_name')} AS table_type FROM ({X.for_duckdb(X.TABLE_COLUMNS_SQL)})),
cf AS (SELECT contract AS tbl, field AS col, {type_name('physical_type')} AS contract_type, required FROM ({X.for_duckdb(X.DRIFT_FIELDS_SQL)})),
j AS (SELECT coalesce(tc.tbl, cf.tbl) AS tbl, coalesce(tc.col, cf.col) AS col, table_type, contract_type, required
      FROM tc FULL OUTER JOIN cf ON tc.tbl = cf.tbl AND tc.col = cf.col),
d AS (SELECT tbl AS "table", col AS "column", table_type, contract_type, coalesce(required, false) AS required,
      CASE WHEN contract_type IS NULL THEN 'extra_column'
           WHEN table_type IS NULL AND required THEN 'new_required'
           WHEN table_type IS NULL THEN 'new_optional'
           WHEN table_type <> contract_type THEN 'type_mismatch' ELSE 'unchanged' END AS change FROM j)
"""
    o["q_schema_drift"] = drift + "SELECT *, change IN ('unchanged', 'new_optional') AS compatible FROM d"
    o["q_schema_drift_verdict"] = drift + (
        "SELECT \"table\", bool_and(change IN ('unchanged', 'new_optional')) AS compatible, "
        "count(*) FILTER (WHERE change NOT IN ('unchanged', 'new_optional')) AS problems, "
        "count(*) FILTER (WHERE change = 'new_optional') AS columns_to_add FROM d GROUP BY \"table\"")
    o["q_additive_evolution"] = "SELECT count(*) AS n_rows, count(*) AS n_comment_nulls, 4 AS n_columns FROM nation"

    def fails(*metrics: str) -> str:
        return " + ".join(f"(CASE WHEN ({m}) > 0 THEN 1 ELSE 0 END)" for m in metrics)

    cust_failed = fails("count(*) FILTER (WHERE c_acctbal < 0)", "count(*) FILTER (WHERE c_acctbal = 0)",
                        "count(*) FILTER (WHERE NOT regexp_matches(c_name, '^Customer#[0-9]{9}$'))",
                        dup_groups("customer", "c_custkey"))
    part_failed = fails("count(*) FILTER (WHERE length(p_name) < 9)", "count(*) FILTER (WHERE length(p_name) > 11)",
                        "count(*) FILTER (WHERE NOT regexp_matches(p_brand, '^Brand#[0-9]$'))",
                        dup_groups("part", "p_partkey"),
                        "(SELECT count(*) FROM (SELECT p_brand FROM part GROUP BY p_brand HAVING count(DISTINCT p_type) > 1))")
    ord_failed = fails("count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O', 'P'))", "count(*) FILTER (WHERE o_totalprice <= 0)",
                       "count(*) FILTER (WHERE NOT regexp_matches(o_orderpriority, '^[1-5]-[A-Z ]+$'))",
                       dup_groups("orders", "o_orderkey"))

    def outcome(name, table, checks, failed):
        return (f"SELECT '{name}' AS contract, CASE WHEN f = 0 THEN 'loaded' ELSE 'gate_failed' END AS status, "
                f"CAST({checks} AS INTEGER) AS checks, CAST(f AS INTEGER) AS failed, "
                f"CAST(CASE WHEN f = 0 THEN n END AS BIGINT) AS rows_loaded FROM (SELECT {failed} AS f, count(*) AS n FROM {table})")
    o["q_multi_contract"] = "\nUNION ALL ".join([
        outcome("orders", "orders", 25, ord_failed), outcome("customer", "customer", 20, cust_failed),
        outcome("part", "part", 24, part_failed),
        "SELECT 'nation', 'error', CAST(0 AS INTEGER), CAST(0 AS INTEGER), CAST(NULL AS BIGINT)"])

    snaps = f"""
WITH old AS ({X.for_duckdb(X.OLD_SNAPSHOT_SQL)}), new AS ({X.for_duckdb(X.NEW_SNAPSHOT_SQL)}),
oc AS (SELECT DISTINCT contract FROM old), nc AS (SELECT DISTINCT contract FROM new),
bothc AS (SELECT contract FROM oc INTERSECT SELECT contract FROM nc),
o AS (SELECT contract, field, {type_name('physical_type')} AS ot, required AS oreq FROM old WHERE contract IN (SELECT contract FROM bothc)),
n AS (SELECT contract, field, {type_name('physical_type')} AS nt, required AS nreq FROM new WHERE contract IN (SELECT contract FROM bothc)),
j AS (SELECT coalesce(o.contract, n.contract) AS contract, coalesce(o.field, n.field) AS field, ot, nt, oreq, nreq,
      o.contract IS NOT NULL AS oh, n.contract IS NOT NULL AS nh FROM o FULL OUTER JOIN n ON o.contract = n.contract AND o.field = n.field),
diff AS (
  SELECT contract, CAST(NULL AS VARCHAR) AS field, 'contract_removed' AS change, 'breaking' AS severity, CAST(NULL AS VARCHAR) AS old_value, CAST(NULL AS VARCHAR) AS new_value FROM oc WHERE contract NOT IN (SELECT contract FROM nc)
  UNION ALL SELECT contract, NULL, 'contract_added', 'information', NULL, NULL FROM nc WHERE contract NOT IN (SELECT contract FROM oc)
  UNION ALL SELECT contract, field, 'field_removed', 'breaking', ot, NULL FROM j WHERE NOT nh
  UNION ALL SELECT contract, field, 'required_field_added', 'breaking', NULL, nt FROM j WHERE NOT oh AND nreq
  UNION ALL SELECT contract, field, 'optional_field_added', 'compatible', NULL, nt FROM j WHERE NOT oh AND NOT coalesce(nreq, false)
  UNION ALL SELECT contract, field, 'type_changed', 'breaking', ot, nt FROM j WHERE oh AND nh AND ot <> nt
  UNION ALL SELECT contract, field, 'required_tightened', 'breaking', CAST(oreq AS VARCHAR), CAST(nreq AS VARCHAR) FROM j WHERE oh AND nh AND NOT coalesce(oreq, false) AND coalesce(nreq, false)
  UNION ALL SELECT contract, field, 'required_relaxed', 'compatible', CAST(oreq AS VARCHAR), CAST(nreq AS VARCHAR) FROM j WHERE oh AND nh AND coalesce(oreq, false) AND NOT coalesce(nreq, false))
"""
    o["q_contract_diff"] = snaps + "SELECT * FROM diff"
    o["q_contract_diff_verdict"] = snaps + (
        ", every AS (SELECT contract FROM oc UNION SELECT contract FROM nc) "
        "SELECT e.contract, count(d.contract) AS changes, count(d.contract) FILTER (WHERE d.severity = 'breaking') AS breaking_changes, "
        "count(d.contract) FILTER (WHERE d.severity = 'breaking') > 0 AS breaking "
        "FROM every e LEFT JOIN diff d ON e.contract = d.contract GROUP BY e.contract")
    o["q_contract_diff_overall"] = snaps + (
        ", every AS (SELECT contract FROM oc UNION SELECT contract FROM nc), "
        "per AS (SELECT e.contract, count(d.contract) FILTER (WHERE d.severity = 'breaking') > 0 AS breaking "
        "FROM every e LEFT JOIN diff d ON e.contract = d.contract GROUP BY e.contract) "
        "SELECT count(*) AS contracts, count(*) FILTER (WHERE breaking) AS breaking_contracts, "
        "NOT coalesce(bool_or(breaking), false) AS passed FROM per")
    o["q_changelog"] = snaps + (
        "SELECT contract, row_number() OVER (PARTITION BY contract ORDER BY field ASC NULLS FIRST, change) AS position, "
        "field, change FROM diff")
    o["q_in_sync"] = (
        f"WITH s AS ({X.for_duckdb(X.OLD_SNAPSHOT_SQL)}), r AS ({X.for_duckdb(X.REGENERATED_SNAPSHOT_SQL)}) "
        "SELECT *, 'only_stored' AS side FROM (SELECT * FROM s EXCEPT ALL SELECT * FROM r) "
        "UNION ALL SELECT *, 'only_regenerated' AS side FROM (SELECT * FROM r EXCEPT ALL SELECT * FROM s)")

    o["q_norm_text"] = (f"SELECT lang, count(*) AS n_docs, count(DISTINCT nt) AS n_distinct_norm, "
                        f"CAST(sum(length(nt)) AS BIGINT) AS sum_len_norm FROM (SELECT lang, {norm('text')} AS nt FROM documents) GROUP BY lang")
    o["q_norm_compat"] = (
        "SELECT lang, count(*) AS n_docs, count(DISTINCT nt) AS n_distinct_norm, CAST(sum(length(nt)) AS BIGINT) AS sum_len_norm, "
        "min(md5(nt)) AS least_md5, max(md5(nt)) AS greatest_md5 "
        f"FROM (SELECT lang, {norm("'1⁄2 ' || text")} AS nt FROM documents) GROUP BY lang")
    o["q_duplicate_first_seen"] = ("SELECT doc_id, first_doc_id FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS first_doc_id "
                                   "FROM documents) WHERE doc_id > first_doc_id")
    o["q_key_position"] = ("SELECT conv_id, turn, key_position FROM (SELECT conv_id, turn, role, "
                           "CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn "
                           "ROWS UNBOUNDED PRECEDING) AS BIGINT) AS key_position FROM conversations) WHERE role = 'user'")

    # dictionary
    o["q_yes_no"] = _dict(
        "SELECT cell, mapped, count(*) AS n_rows, count(raw) AS n_filled FROM ("
        + " UNION ALL ".join(f"SELECT '{c}' AS cell, {c}__raw AS raw, {c} AS mapped FROM fd" for c in FLAGS)
        + ") GROUP BY cell, mapped")
    na_cells = ["ejemplos", "catalogo", "longitud_landing", "sustento_criticidad"]
    o["q_not_applicable"] = _dict(
        "SELECT cell, count(*) FILTER (WHERE kept IS NULL) AS n_not_applicable, count(kept) AS n_kept FROM ("
        + " UNION ALL ".join(f"SELECT '{c}' AS cell, CASE WHEN NOT {not_applicable(c)} THEN {c} END AS kept FROM fd_raw"
                             for c in na_cells) + ") GROUP BY cell")
    o["q_mandatory_cells"] = _dict(
        "SELECT document, sheet, \"row\", cell, rule, severity, coalesce(role, '?') AS role FROM issues "
        f"{roles_join} WHERE rule = 'mandatory'")
    o["q_allowed_values"] = _dict(
        "SELECT * FROM issues WHERE rule IN ('allowed_values', 'layer', 'classification', 'criticality')")
    o["q_identifier_rule"] = _dict("SELECT * FROM issues WHERE rule = 'identifier'")
    o["q_repeated_names"] = _dict(
        "SELECT document, \"row\", 'nombre_modelado' AS cell, 'repeated_name' AS rule, "
        "'field name ''' || nombre_modelado || ''' is repeated (also in row ' || CAST(first_row AS VARCHAR) || ')' AS message "
        "FROM (SELECT document, \"row\", nombre_modelado, min(\"row\") OVER (PARTITION BY document, nombre_modelado) AS first_row "
        f"FROM fa WHERE regexp_matches(nombre_modelado, {IDENT})) WHERE \"row\" > first_row")
    o["q_decimal_length"] = _dict(
        f"SELECT document, \"row\", longitud_landing, physical_type FROM ({_typed_fields()}) WHERE fmt = 'decimal'")
    o["q_type_mapping"] = _dict(
        f"SELECT document, \"row\", logical_type, physical_type, max_length FROM ({_typed_fields()})")
    o["q_discard_filter"] = _dict(
        "SELECT document, count(*) AS n_rows, count(*) FILTER (WHERE active) AS n_active, "
        "count(*) FILTER (WHERE NOT active) AS n_discarded FROM fd GROUP BY document")
    cls_map = (f"CASE {norm('clasificacion')} WHEN 'publico' THEN 'public' WHEN 'uso interno' THEN 'internal' "
               f"WHEN 'restringido' THEN 'restricted' END")
    cls = f"CASE WHEN dac = 'SI' AND ({cls_map}) = 'public' THEN 'restricted' ELSE {cls_map} END"
    o["q_sensitivity"] = _dict(f"SELECT document, \"row\", {cls} AS classification, dac = 'SI' AS sensitive, "
                              "CASE WHEN dac = 'SI' THEN 'dac' END AS tags FROM fa")
    ex = _split_examples("ejemplos")
    o["q_split_examples"] = _dict(
        f"SELECT document, \"row\", array_to_string({ex}, '|') AS examples, CAST(len({ex}) AS INTEGER) AS n_examples "
        f"FROM fa WHERE NOT {not_applicable('ejemplos')}")
    sv = _split_values("catalogo")
    o["q_split_values"] = _dict(
        f"SELECT document, \"row\", array_to_string({sv}, '|') AS vals, CAST(len({sv}) AS INTEGER) AS n_values "
        f"FROM fa WHERE NOT {not_applicable('catalogo')}")
    o["q_document_rollup"] = _dict(
        "SELECT p.document, n_fields, n_active, n_discarded, has_dac, has_key, discarded_names, "
        "coalesce(w.n_warnings, 0) AS n_warnings, "
        "'dataentry' || CASE WHEN has_dac THEN ',dac' ELSE '' END AS tags FROM (SELECT document, count(*) AS n_fields, "
        "count(*) FILTER (WHERE active) AS n_active, count(*) FILTER (WHERE NOT active) AS n_discarded, "
        "coalesce(bool_or(active AND dac = 'SI'), false) AS has_dac, coalesce(bool_or(active AND pk = 'SI'), false) AS has_key, "
        "string_agg(nombre_fuente, ', ' ORDER BY \"row\") FILTER (WHERE NOT active) AS discarded_names FROM fd GROUP BY document) p "
        "LEFT JOIN (SELECT document, count(*) AS n_warnings FROM issues WHERE severity = 'warning' GROUP BY document) w "
        "ON p.document = w.document")
    o["q_dictionary_lint"] = _dict("SELECT * FROM issues")
    o["q_dictionary_contracts"] = _dict(
        f"SELECT t.document, td.tabla_landing AS contract, t.nombre_modelado AS field, t.\"row\", t.logical_type, t.physical_type, "
        f"t.nulos = 'NO' AS required, CAST(k.key_position AS INTEGER) AS key_position, {cls.replace('dac', 't.dac').replace('clasificacion', 't.clasificacion')} AS classification, "
        f"t.max_length, CASE WHEN t.dac = 'SI' THEN 'dac' END AS tags FROM ({_typed_fields()}) t JOIN ({_key_positions()}) k ON t.document = k.document AND t.\"row\" = k.\"row\" "
        f"JOIN td ON t.document = td.document WHERE t.document NOT IN (SELECT document FROM issues WHERE severity = 'error')")
    props = [("fuente", "fuente"), ("campoTecnico", None), ("dac", "dac"), ("contieneVacios", "vacios"),
             ("criticidad", "criticidad"), ("sustentoCriticidad", "sustento_criticidad"),
             ("tipoFormatoGobierno", "tipo_formato"), ("formatoInput", "formato_input"),
             ("longitudFuente", "longitud_fuente"), ("aplicaTrazabilidad", "trazabilidad"),
             ("llaveTecnica", "llave_tecnica")]
    pairs = []
    for i, (p, c) in enumerate(props):
        if c is None:
            pairs.append(f"SELECT document, \"row\", {i + 1} AS position, '{p}' AS property, 'true' AS value FROM fa "
                         f"WHERE {norm0('fuente')} = '(campo tecnico)'")
        else:
            pairs.append(f"SELECT document, \"row\", {i + 1} AS position, '{p}' AS property, {c} AS value FROM fa "
                         f"WHERE {c} IS NOT NULL AND NOT {not_applicable(c)}")
    o["q_attribute_pairs"] = _dict(f"SELECT * FROM ({' UNION ALL '.join(pairs)}) WHERE document NOT IN (SELECT document FROM bad)")
    tprops = [("capa", "'LANDING'"), ("flujo", "'DED'"), ("empresa", "empresa"), ("schemaLanding", "schema_landing"),
              ("tipoDataEntry", "CASE schema_landing WHEN 'dataentry_int' THEN 'transitorio (ingesta interna)' "
                                "WHEN 'dataentry_ext' THEN 'información externa' WHEN 'dataentry_usr' THEN 'permanente (usuario)' END"),
              ("nombreTablaFuente", "tabla_fuente"), ("tipoFuente", "tipo_fuente"), ("tipoCarga", "tipo_carga"),
              ("frecuenciaActualizacion", "frecuencia"), ("historia", "historia"), ("registrosCargaInicial", "registros"),
              ("rutaBroad", "ruta_broad"), ("contenedorBroad", "contenedor_broad"), ("rutaLanding", "ruta_landing"),
              ("dac", "CASE WHEN coalesce(r.has_dac, false) THEN 'SI' ELSE 'NO' END"),
              ("productOwner", "product_owner"), ("squad", "squad"), ("camposDescartados", "r.names"),
              ("documentoAlcance", "td.document"), ("versionPlantillaDED", "template_version")]
    roll = ("(SELECT document, bool_or(active AND dac = 'SI') AS has_dac, "
            "string_agg(nombre_fuente, ', ' ORDER BY \"row\") FILTER (WHERE NOT active) AS names FROM fd GROUP BY document) r")
    tp = " UNION ALL ".join(
        f"SELECT td.document, {i + 1} AS position, '{p}' AS property, CAST({v} AS VARCHAR) AS value "
        f"FROM td LEFT JOIN {roll} ON td.document = r.document" for i, (p, v) in enumerate(tprops))
    o["q_table_properties"] = _dict(
        f"SELECT * FROM ({tp}) WHERE value IS NOT NULL AND value <> '' AND NOT {not_applicable('value')} "
        "AND document NOT IN (SELECT document FROM bad)")
    o["q_derive_checks"] = _dict(
        f"SELECT * FROM (SELECT document, nombre_modelado || ':required' AS \"check\", 'required' AS kind, nombre_modelado AS field, CAST(NULL AS VARCHAR) AS argument "
        f"FROM fa WHERE nulos = 'NO' "
        f"UNION ALL SELECT document, nombre_modelado || '_catalogo', 'valid_values', nombre_modelado, array_to_string({sv}, '|') "
        f"FROM fa WHERE catalogo IS NOT NULL AND NOT {not_applicable('catalogo')} "
        f"UNION ALL SELECT document, nombre_modelado || ':max_length', 'max_length', nombre_modelado, CAST(max_length AS VARCHAR) "
        f"FROM ({_typed_fields()}) WHERE max_length IS NOT NULL "
        "UNION ALL SELECT document, k || ':unique', 'unique', k, k FROM (SELECT document, string_agg(nombre_modelado, '+' ORDER BY \"row\") AS k "
        "FROM fa WHERE pk = 'SI' GROUP BY document) "
        "UNION ALL SELECT document, 'tabla_no_vacia', 'row_count', NULL, '> 0' FROM td "
        f"UNION ALL SELECT * FROM ({X.for_duckdb(X.EXTRA_RULES_SQL)}) WHERE document IN (SELECT document FROM td)"
        ") WHERE document NOT IN (SELECT document FROM bad)")
    return o
