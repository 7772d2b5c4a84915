"""Lint a catalogue of data-dictionary documents as one Spark job.

Re-aimed from a single spreadsheet checked row by row: ``table_defs`` holds one row per
document (its table cells), ``field_defs`` one row per field of every document, all cells
as text with fixed column names. Every rule is a column expression or a set operation, so
a catalogue of any size is linted in a few shuffles. Rules report together (collect-all);
a document with any error produces no contract rows.

Issue rows: ``document, sheet, row, cell, rule, severity, message, role``.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import rules as R
from ..functions.text import (
    clean_text, is_not_applicable, norm_or_empty, normalise_text, split_examples,
    split_values, yes_no,
)
from ..operators.windows import later_repeats, ordered_join, running_count
from ..session import materialize

ISSUE_COLUMNS = ["document", "sheet", "row", "cell", "rule", "severity", "message", "role"]
TABLE_SHEET, FIELD_SHEET = "table", "fields"


# --------------------------------------------------------------------------------------
# Preparation
# --------------------------------------------------------------------------------------


def is_prepared(df: DataFrame) -> bool:
    return "__prepared" in df.columns


def prepare_tables(table_defs: DataFrame) -> DataFrame:
    """Cells trimmed, blank → NULL."""
    if is_prepared(table_defs):
        return table_defs
    extra = [c for c in table_defs.columns if c not in R.TABLE_CELLS]
    return table_defs.select(*extra, *[clean_text(F.col(c)).alias(c) for c in R.TABLE_CELLS],
                             F.lit(True).alias("__prepared"))


def prepare_fields(field_defs: DataFrame) -> DataFrame:
    """Cells trimmed; yes/no cells mapped (M2: ``<cell>`` holds SI/NO or NULL, the raw
    text kept as ``<cell>__raw``); ``active`` = not discarded (M12)."""
    if is_prepared(field_defs):
        return field_defs
    extra = [c for c in field_defs.columns if c not in R.FIELD_CELLS]
    cols = [*extra]
    for c in R.FIELD_CELLS:
        t = clean_text(F.col(c))
        if c in R.FIELD_FLAGS:
            cols += [yes_no(t).alias(c), t.alias(f"{c}__raw")]
        else:
            cols.append(t.alias(c))
    fd = field_defs.select(*cols, F.lit(True).alias("__prepared"))
    return fd.withColumn("active", F.coalesce(F.col("descartado"), F.lit("")) != "SI")


def prepare(table_defs: DataFrame, field_defs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both inputs prepared. Nothing is written: the row rules share one scan, and the few keyed
    rules read only the columns they need."""
    return prepare_tables(table_defs), prepare_fields(field_defs)


def active_fields(field_defs: DataFrame) -> DataFrame:
    """Rows not marked discarded (prepared input)."""
    return field_defs.where(F.col("active"))


def landing_format(c: Column) -> Column:
    """Landing format cell normalised, blanks as ``_`` (``Time Stamp`` → ``time_stamp``)."""
    return F.replace(norm_or_empty(c), F.lit(" "), F.lit("_"))


def _found(cond: Column, cell: str, rule: str, message: Column | str, severity: str = "error") -> Column:
    """An issue of one row when ``cond`` holds, else NULL."""
    text = F.lit(message) if isinstance(message, str) else message
    return F.when(cond, F.struct(F.lit(cell).alias("cell"), F.lit(rule).alias("rule"),
                                 F.lit(severity).alias("severity"), text.alias("message")))


def _quoted(before: str, c: Column, after: str) -> Column:
    return F.concat(F.lit(before), F.coalesce(c, F.lit("")), F.lit(after))


def _issues_of(df: DataFrame, sheet: str, found: list[Column], row: Column | None = None) -> DataFrame:
    """Issue rows of ``df``'s rows: every rule is looked at in the same pass over each row."""
    return df.select(
        "document", F.lit(sheet).alias("sheet"),
        (F.col("row") if row is None else row).cast("int").alias("row"),
        F.inline(F.filter(F.array(*found), lambda x: x.isNotNull())),
    )


def _union(parts: Iterable[DataFrame]) -> DataFrame:
    parts = list(parts)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def with_roles(issues: DataFrame, cell_roles: DataFrame | None) -> DataFrame:
    """Attach the role responsible for a cell (``?`` when unknown). The role table comes from
    the caller, so no broadcast is forced: AQE broadcasts it when its measured size is small."""
    if cell_roles is None:
        return issues.withColumn("role", F.lit("?"))
    roles = cell_roles.select("sheet", "cell", "role")
    return (
        issues.join(roles, ["sheet", "cell"], "left")
        .withColumn("role", F.coalesce(F.col("role"), F.lit("?")))
        .select(*ISSUE_COLUMNS)
    )


# --------------------------------------------------------------------------------------
# Rules
# --------------------------------------------------------------------------------------


def field_issues(fd: DataFrame) -> DataFrame:
    """Every rule that looks at one field row: M2 (all rows); M5, M7, M9, M10, M11 and the M13
    warning (active rows)."""
    on = F.col("active")
    name, fmt, cls, crit = (F.col(c) for c in ("nombre_modelado", "formato_landing", "clasificacion", "criticidad"))
    known_fmt = landing_format(fmt)
    length = F.coalesce(F.col("longitud_landing"), F.lit(""))
    norm_cls = normalise_text(cls)
    found = [
        _found(F.col(f"{c}__raw").isNotNull() & F.col(c).isNull(), c, "yes_no",
               _quoted("must be SI or NO (value: '", F.col(f"{c}__raw"), "')"))
        for c in R.FIELD_FLAGS
    ]
    found += [_found(on & F.col(c).isNull(), c, "mandatory", "missing value") for c in R.FIELD_MANDATORY]
    found += [
        _found(on & name.isNotNull() & ~name.rlike(R.IDENTIFIER), "nombre_modelado", "identifier",
               _quoted("field name '", name, "' must be lower snake_case")),
        _found(on & fmt.isNotNull() & ~known_fmt.isin([f for f, _, _ in R.TYPE_MAP]), "formato_landing",
               "unknown_format", _quoted("'", fmt, "' is not a valid type")),
        _found(on & fmt.isNotNull() & (known_fmt == "decimal") & ~length.rlike(R.DECIMAL_LENGTH), "longitud_landing",
               "decimal_length", _quoted("a Decimal needs its length as 'p,s' (value: '", length, "')")),
        _found(on & cls.isNotNull() & ~norm_cls.isin(list(R.CLASSIFICATIONS)), "clasificacion", "classification",
               _quoted("'", cls, "' is not in the list")),
        _found(on & crit.isNotNull() & ~crit.isin(R.CRITICALITIES), "criticidad", "criticality",
               _quoted("'", crit, "' must be EDC or EDNC")),
        _found(on & (F.col("dac") == "SI") & (norm_cls == "publico"), "clasificacion", "sensitive_public",
               "marked sensitive but classified public", "warning"),
    ]
    return _issues_of(fd, FIELD_SHEET, found)


def table_issues(td: DataFrame) -> DataFrame:
    """Every rule that looks at one table row: M5, M6, M7, M11 (layer)."""
    name, layer = F.col("tabla_landing"), F.col("capa")
    found = [_found(F.col(c).isNull(), c, "mandatory", "missing value") for c in R.TABLE_MANDATORY]
    found += [
        _found(F.col(c).isNotNull() & ~F.col(c).isin(values), c, "allowed_values",
               _quoted("'", F.col(c), "' is not in the list"))
        for c, values in R.TABLE_LISTS
    ]
    found += [
        _found(name.isNotNull() & ~name.rlike(R.IDENTIFIER), "tabla_landing", "identifier",
               _quoted("table name '", name, "' must be lower snake_case")),
        _found(layer.isNotNull() & (F.upper(layer) != R.REQUIRED_LAYER), "capa", "layer",
               _quoted("layer must be LANDING (value: '", layer, "')")),
    ]
    return _issues_of(td, TABLE_SHEET, found)


def duplicate_name_issues(fd: DataFrame) -> DataFrame:
    """M8: a later active row with a valid name already used in its document; reports the
    first row. Skew-safe: aggregate + join, not a window over the whole document."""
    named = active_fields(fd).where(F.col("nombre_modelado").rlike(R.IDENTIFIER)).select(
        "document", "row", "nombre_modelado"
    )
    rep = later_repeats(named, ["document", "nombre_modelado"], "row", "first_row")
    msg = F.concat(F.lit("field name '"), F.col("nombre_modelado"),
                   F.lit("' is repeated (also in row "), F.col("first_row").cast("string"), F.lit(")"))
    return _issues_of(rep, FIELD_SHEET, [_found(F.lit(True), "nombre_modelado", "repeated_name", msg)])


def type_map_frame(spark: SparkSession) -> DataFrame:
    """The 10-row landing-format map (fixed; broadcast wherever it is joined)."""
    return spark.createDataFrame(R.TYPE_MAP, "format string, logical_type string, physical_type string")


def classification(fd: DataFrame, strict: bool = False) -> Column:
    """Mapped classification, raised from public to restricted for sensitive fields.

    ``strict`` raises every sensitive field that is not restricted (``internal`` too), as
    the scope documentation promises; the default follows the converter, which only
    raises ``public``."""
    mapping = F.create_map(*[F.lit(x) for kv in R.CLASSIFICATIONS.items() for x in kv])
    base = mapping[normalise_text(F.col("clasificacion"))]
    raise_it = (base != "restricted") if strict else (base == "public")
    return F.when((F.col("dac") == "SI") & raise_it, F.lit("restricted")).otherwise(base)


def version_issues(td: DataFrame) -> DataFrame:
    """Template version not tested (a warning about the document, not about a row)."""
    if "template_version" not in td.columns:
        td = td.withColumn("template_version", F.lit(None).cast("string"))
    v = F.col("template_version")
    return _issues_of(td, TABLE_SHEET, [
        _found(v.isNotNull() & ~v.isin(R.SUPPORTED_TEMPLATE_VERSIONS), "template_version", "template_version",
               _quoted("template version ", v, " not tested"), "warning")], row=F.lit(None))


def document_issues(td: DataFrame, fd: DataFrame) -> DataFrame:
    """M18 no key among a document's active fields (warning); M19 a document without field rows."""
    rows = fd.select("document", F.lit(1).alias("field"), F.col("active").cast("int").alias("live"),
                     (F.col("active") & F.coalesce(F.col("pk") == "SI", F.lit(False))).cast("int").alias("key"))
    zero = F.lit(0)
    every = rows.unionByName(td.select("document", zero.alias("field"), zero.alias("live"), zero.alias("key")))
    per = every.groupBy("document").agg(*[F.max(c).alias(c) for c in ("field", "live", "key")])
    return _issues_of(per, FIELD_SHEET, [
        _found((F.col("live") == 1) & (F.col("key") == 0), "pk", "no_key",
               "no field is a primary key: duplicates will not be checked", "warning"),
        _found(F.col("field") == 0, "id", "no_fields", "the document has no fields"),
    ], row=F.lit(None))


def lint(table_defs: DataFrame, field_defs: DataFrame, cell_roles: DataFrame | None = None) -> DataFrame:
    """Every rule reports (errors and warnings together), one row per issue. The field rows
    are scanned once for all row rules, and by narrow scans for repeats (M8) and documents."""
    td, fd = prepare_tables(table_defs), prepare_fields(field_defs)
    issues = _union([field_issues(fd), table_issues(td), duplicate_name_issues(fd), version_issues(td),
                     document_issues(td, fd)])
    return with_roles(issues, cell_roles)


# --------------------------------------------------------------------------------------
# Producing contract rows
# --------------------------------------------------------------------------------------


def key_positions(fd: DataFrame) -> DataFrame:
    """Running number of key fields in row order among active rows; NULL for non-key."""
    a = active_fields(fd)
    pos = running_count(a, ["document"], "row", (F.col("pk") == "SI").cast("int"), "__pos")
    return pos.withColumn("key_position", F.when(F.col("pk") == "SI", F.col("__pos"))).drop("__pos")


def field_types(fd: DataFrame) -> DataFrame:
    """M10 + M9 on active rows: logical and physical type (DECIMAL(p,s) from the length)."""
    spark = fd.sparkSession
    a = active_fields(fd).withColumn("__fmt", landing_format(F.col("formato_landing")))
    tm = F.broadcast(type_map_frame(spark).withColumnRenamed("format", "__fmt"))
    m = a.join(tm, "__fmt", "left")
    p = F.regexp_extract(F.col("longitud_landing"), R.DECIMAL_LENGTH, 1)
    s = F.regexp_extract(F.col("longitud_landing"), R.DECIMAL_LENGTH, 2)
    dec_ok = F.coalesce(F.col("longitud_landing"), F.lit("")).rlike(R.DECIMAL_LENGTH)
    physical = F.when(
        F.col("__fmt") == "decimal",
        F.when(dec_ok, F.concat(F.lit("DECIMAL("), p.cast("int").cast("string"), F.lit(","),
                                s.cast("int").cast("string"), F.lit(")"))),
    ).otherwise(F.col("physical_type"))
    max_len = F.when(
        (F.col("logical_type") == "string") & F.col("longitud_landing").rlike(r"^[0-9]+$"),
        F.col("longitud_landing").cast("int"),
    )
    return m.withColumn("physical_type", physical).withColumn("max_length", max_len).drop("__fmt")


def documents_with_errors(issues: DataFrame) -> DataFrame:
    return issues.where(F.col("severity") == "error").select("document").distinct()


def without_errors(rows: DataFrame, table_defs: DataFrame, field_defs: DataFrame,
                   issues: DataFrame | None = None) -> DataFrame:
    """The rows whose document has no error; such a document produces nothing at all."""
    issues = issues if issues is not None else lint(table_defs, field_defs)
    return rows.join(documents_with_errors(issues), "document", "left_anti")


def contract_fields(table_defs: DataFrame, field_defs: DataFrame, issues: DataFrame | None = None) -> DataFrame:
    """M19 + M10/M13/M14: ``contract_fields`` rows of the documents without errors
    (contract = landing table name; ``tags`` marks sensitive fields)."""
    td, fd = prepare_tables(table_defs), prepare_fields(field_defs)
    typed = field_types(key_positions(fd).drop("active").withColumn("active", F.lit(True)))
    rows = typed.join(td.select("document", F.col("tabla_landing").alias("contract")), "document")
    rows = without_errors(rows, td, fd, issues)
    return rows.select(
        "document", "contract", F.col("nombre_modelado").alias("field"), F.col("row"),
        "logical_type", "physical_type", (F.col("nulos") == "NO").alias("required"),
        F.col("key_position").cast("int").alias("key_position"),
        classification(rows).alias("classification"), "max_length", field_tags().alias("tags"),
    )


def field_tags() -> Column:
    """The tag of a sensitive field, else NULL."""
    return F.when(F.col("dac") == "SI", F.lit(R.SENSITIVE_TAG))


def attribute_pairs(table_defs: DataFrame, field_defs: DataFrame, issues: DataFrame | None = None) -> DataFrame:
    """(property, value) of the applicable custom cells of active fields, in template
    order, plus ``campoTecnico`` for technical fields (documents without errors)."""
    td, fd = prepare_tables(table_defs), prepare_fields(field_defs)
    a = without_errors(active_fields(fd), td, fd, issues)
    structs = []
    for i, (prop, cell) in enumerate(R.FIELD_ATTRIBUTES):
        if cell is None:
            value = F.when(norm_or_empty(F.col("fuente")) == R.TECHNICAL_SOURCE, F.lit("true"))
        else:
            value = F.when(F.col(cell).isNotNull() & ~is_not_applicable(F.col(cell)), F.col(cell))
        structs.append(F.struct(F.lit(i + 1).alias("position"), F.lit(prop).alias("property"),
                                value.alias("value")))
    return (
        a.select("document", "row", F.col("nombre_modelado").alias("field"), F.inline(F.array(*structs)))
        .where(F.col("value").isNotNull())
    )


def derive_checks(table_defs: DataFrame, field_defs: DataFrame, extra_rules: DataFrame | None = None,
                  issues: DataFrame | None = None) -> DataFrame:
    """Check rows a document's contract will carry: required (nulls not allowed),
    allowed values (catalogue cell), maximum length (numeric string length), the key, the
    table's non-empty rule, and after it the business rules that ``extra_rules(document, check,
    kind, field, argument)`` adds to a document. Documents with errors carry none.

    The prepared rows and the documents with errors are written once under the shared folder: the plan reads
    the rows a dozen times, and would hold the preparation of every cell as often, on the driver."""
    td = materialize(prepare_tables(table_defs), "dictionary")
    fd = materialize(prepare_fields(field_defs), "dictionary")
    name = F.col("nombre_modelado")

    def check(cond: Column, title: Column, kind: str, argument: Column) -> Column:
        return F.when(cond, F.struct(title.alias("check"), F.lit(kind).alias("kind"), name.alias("field"),
                                     argument.cast("string").alias("argument")))

    values = split_values(F.col("catalogo"))
    of_fields = field_types(fd).select("document", F.inline(F.filter(F.array(
        check(F.col("nulos") == "NO", F.concat(name, F.lit(":required")), "required", F.lit(None)),
        check(F.col("catalogo").isNotNull() & values.isNotNull(), F.concat(name, F.lit("_catalogo")), "valid_values",
              F.array_join(values, "|")),
        check(F.col("max_length").isNotNull(), F.concat(name, F.lit(":max_length")), "max_length", F.col("max_length")),
    ), lambda x: x.isNotNull())))
    keys = ordered_join(key_positions(fd).where(F.col("key_position").isNotNull()),
                        ["document"], "key_position", "nombre_modelado", "+", "argument")
    keys = keys.select("document", F.concat(F.col("argument"), F.lit(":unique")).alias("check"),
                       F.lit("unique").alias("kind"), F.col("argument").alias("field"), "argument")
    rows = td.select("document", F.lit(R.NOT_EMPTY_RULE).alias("check"), F.lit("row_count").alias("kind"),
                     F.lit(None).cast("string").alias("field"), F.lit("> 0").alias("argument"))
    parts = [of_fields, keys, rows]
    if extra_rules is not None:
        extra = extra_rules.select("document", "check", "kind", "field", "argument")
        parts.append(extra.join(td.select("document").distinct(), "document", "left_semi"))
    failed = materialize(documents_with_errors(issues if issues is not None else lint(td, fd)), "dictionary")
    return _union(parts).join(failed, "document", "left_anti")


def document_rollup(table_defs: DataFrame, field_defs: DataFrame) -> DataFrame:
    """Per document: counts, any sensitive field, discarded source names in row
    order, whether a key exists, the number of warnings and the table's tags."""
    td, fd = prepare_tables(table_defs), prepare_fields(field_defs)
    live_public = F.col("active") & (F.col("dac") == "SI") & (normalise_text(F.col("clasificacion")) == "publico")
    per = fd.groupBy("document").agg(
        F.count(F.lit(1)).alias("n_fields"),
        F.count_if(F.col("active")).alias("n_active"),
        F.count_if(~F.col("active")).alias("n_discarded"),
        F.coalesce(F.bool_or(F.col("active") & (F.col("dac") == "SI")), F.lit(False)).alias("has_dac"),
        F.coalesce(F.bool_or(F.col("active") & (F.col("pk") == "SI")), F.lit(False)).alias("has_key"),
        F.count_if(live_public).alias("__public"),
    )
    # the discarded source names of a document, in row order: one value per document
    names = ordered_join(fd.where(~F.col("active")), ["document"], "row", "nombre_fuente", ", ",
                         "discarded_names")
    untested = version_issues(td).groupBy("document").agg(F.count(F.lit(1)).alias("__untested"))
    no_key = ((F.col("n_active") > 0) & ~F.col("has_key")).cast("bigint")
    return (
        per.join(names, "document", "left").join(untested, "document", "left")
        .withColumn("n_warnings", F.col("__public") + no_key + F.coalesce(F.col("__untested"), F.lit(0)))
        .withColumn("tags", F.concat(F.lit(R.TABLE_TAG), F.when(F.col("has_dac"), F.lit("," + R.SENSITIVE_TAG)).otherwise(F.lit(""))))
        .drop("__public", "__untested")
    )


def table_properties(table_defs: DataFrame, field_defs: DataFrame, issues: DataFrame | None = None) -> DataFrame:
    """M17/M20 at table level: the custom properties a document's contract carries, in
    template order, leaving out empty and not-applicable values (documents without errors)."""
    td, fd = prepare_tables(table_defs), prepare_fields(field_defs)
    roll = document_rollup(td, fd).select("document", "has_dac", "discarded_names")
    kinds = F.create_map(*[F.lit(x) for kv in R.LANDING_SCHEMAS.items() for x in kv])
    t = without_errors(td, td, fd, issues).join(roll, "document", "left")
    structs = []
    for i, (prop, src) in enumerate(R.TABLE_PROPERTIES):
        if src.startswith("="):
            v = F.lit(src[1:])
        elif src == "schema_kind":
            v = kinds[F.col("schema_landing")]
        elif src == "any_dac":
            v = F.when(F.coalesce(F.col("has_dac"), F.lit(False)), F.lit("SI")).otherwise(F.lit("NO"))
        elif src in t.columns:
            v = F.col(src)
        else:
            v = F.lit(None).cast("string")
        structs.append(F.struct(F.lit(i + 1).alias("position"), F.lit(prop).alias("property"),
                                v.cast("string").alias("value")))
    out = t.select("document", F.inline(F.array(*structs)))
    return out.where(F.col("value").isNotNull() & (F.col("value") != "") & ~is_not_applicable(F.col("value")))


def split_cells(fd: DataFrame) -> DataFrame:
    """M15/M16 on active rows: examples (first 4 distinct) and allowed values lists."""
    a = active_fields(fd)
    return a.select("document", "row", split_examples(F.col("ejemplos")).alias("examples"),
                    split_values(F.col("catalogo")).alias("values"))
