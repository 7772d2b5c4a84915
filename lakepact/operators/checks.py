"""The checks a contract declares, compiled into as few Spark passes as possible.

Plans:

* ``schema``  – K1 presence, K2 type: decided from the frame's schema on the driver.
* ``fused``   – every per-row predicate (K3, K6–K11, K13) and the row count (K10) becomes
  one aggregate expression. All of them run as ONE aggregate (one scan, partial
  aggregation per task, a single-row exchange), or as ``observe`` metrics of the staging
  write, so they cost no extra scan at all.
* ``unique``  – K4/K5 key checks: ``groupBy(key).count()`` with map-side partial
  aggregation (a hot key collapses to one row per task before the shuffle), then a global
  count of the repeated groups. NULL keys group together. Keys wider than 16 bytes shuffle
  a 64-bit hash first; only rows whose hash repeats are counted exactly by key. Several key
  checks share one scan and one exchange of (key, check) rows: fixed-width cells as they are, a digest of the others.
* ``sql``     – SQL rules that are not a plain filtered count (K12 and anything else): run
  by Spark SQL over the model's name (S4), one scalar each. A functional dependency asks
  whether a key's least and greatest value differ instead of counting distinct values.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from typing import Any, Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.errors import PySparkException

from ..contract import ZERO, Bound, Contract, ContractError, Field, Rule, normalise_type_text
from ..sources.catalog import as_relation

# The result of a declared rule that this engine cannot run.
NOT_RUN = "not_run"

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("contract", T.StringType()),
        T.StructField("check", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("field", T.StringType()),
        T.StructField("dimension", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("metric", T.LongType()),
        T.StructField("bound", T.StringType()),
        T.StructField("result", T.StringType()),
        T.StructField("detail", T.StringType()),
        T.StructField("description", T.StringType()),
    ]
)


def qcol(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


@dataclass(frozen=True)
class CheckSpec:
    idx: int
    name: str
    kind: str
    field: str | None
    plan: str
    bound: Bound = ZERO
    dimension: str | None = None
    severity: str = "error"
    unit: str = "rows"
    # fused: the aggregate as SQL text over the checked frame
    sql: str | None = None
    # unique
    keys: tuple[str, ...] = ()
    # sql
    query: str | None = None
    # schema
    expected_type: str | None = None
    description: str | None = None

    @property
    def alias(self) -> str:
        return f"m{self.idx}"


# --------------------------------------------------------------------------------------
# Compilation: contract → specs
# --------------------------------------------------------------------------------------

_SIMPLE_COUNT = re.compile(
    r"^\s*select\s+count\s*\(\s*\*\s*\)\s+from\s+`?([A-Za-z_][\w.]*)`?\s+where\s+(.+?)\s*;?\s*$",
    re.IGNORECASE | re.DOTALL,
)
_NOT_A_ROW_PREDICATE = re.compile(
    r"\b(select|group\s+by|having|order\s+by|limit|union|join|over|window)\b", re.IGNORECASE
)


def fusable_predicate(query: str, model: str) -> str | None:
    """``SELECT COUNT(*) FROM <model> WHERE <p>`` → ``p`` when p is a plain row predicate."""
    m = _SIMPLE_COUNT.match(query or "")
    if not m or m.group(1).split(".")[-1] != model:
        return None
    pred = m.group(2)
    if _NOT_A_ROW_PREDICATE.search(pred):
        return None
    return pred


_NAME = r"`?[A-Za-z_]\w*`?"
_NAMES = rf"{_NAME}(?:\s*,\s*{_NAME})*"
_DEPENDENCY = re.compile(
    rf"^\s*select\s+count\s*\(\s*(?:\*|1)\s*\)\s+from\s*\(\s*select\s+(?P<shown>{_NAMES}|1)\s+from\s+"
    rf"`?(?P<model>[A-Za-z_][\w.]*)`?(?:\s+where\s+(?P<where>.+?))?\s+group\s+by\s+(?P<keys>{_NAMES})\s+having\s+"
    rf"count\s*\(\s*distinct\s+(?P<value>{_NAME})\s*\)\s*(?P<test>>\s*1|>=\s*2|<>\s*1|!=\s*1)\s*\)"
    rf"(?:\s+(?:as\s+)?{_NAME})?\s*;?\s*$",
    re.IGNORECASE | re.DOTALL,
)


def dependency_query(query: str, model: str, schema: T.StructType) -> str | None:
    """A functional-dependency rule (``SELECT COUNT(*) FROM (SELECT k FROM model GROUP BY k HAVING
    COUNT(DISTINCT v) > 1)``) as a grouping whose partial result is two values per key: a key has
    several values exactly if its least and greatest differ. NULLs count in neither form. None
    where the rule has another shape or ``v`` has no order. (``<> 1`` also counts keys without a value.)"""
    m = _DEPENDENCY.match(query or "")
    if not m or m["model"].split(".")[-1] != model or _NOT_A_ROW_PREDICATE.search(m["where"] or ""):
        return None
    plain = lambda text: [n.strip().strip("`").lower() for n in text.split(",")]
    columns = {f.name.lower(): f.dataType for f in schema}
    keys, value = plain(m["keys"]), plain(m["value"])[0]
    shown = [] if m["shown"] == "1" else plain(m["shown"])
    if not set(shown) <= set(keys) or not {*keys, value} <= set(columns) or isinstance(
            columns[value], (T.MapType, T.StructType, T.ArrayType, T.VariantType)):
        return None
    least, most = f"min({m['value']})", f"max({m['value']})"
    having = f"{least} <> {most}" + ("" if m["test"].startswith(">") else f" OR {least} IS NULL")
    where = f" WHERE {m['where']}" if m["where"] else ""
    return f"SELECT COUNT(*) FROM (SELECT 1 FROM `{model}`{where} GROUP BY {m['keys']} HAVING {having})"


def _bind_placeholders(query: str | None, model: str, field: str | None) -> str | None:
    """``{model}``/``{table}`` → the model name, ``{field}``/``{column}``/``{property}`` → the
    field a rule is declared on (quality queries written once for many contracts)."""
    if query is None:
        return None
    out = query.replace("{model}", model).replace("{table}", model)
    if field is not None:
        for key in ("{field}", "{column}", "{property}"):
            out = out.replace(key, f"`{field}`")
    return out


class _Builder:
    def __init__(self, contract: Contract):
        self.contract = contract
        self.specs: list[CheckSpec] = []

    def add(self, **kw) -> None:
        self.specs.append(CheckSpec(idx=len(self.specs), **kw))

    def add_rule(self, rule: Rule, field: Field | None) -> None:
        """The checks of a declared rule, each with its description."""
        first = len(self.specs)
        _rule_checks(self, rule, field)
        self.specs[first:] = [replace(s, description=rule.description) for s in self.specs[first:]]


def sql_str(text: str) -> str:
    """A Spark SQL string literal (backslash escapes on)."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def qname(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(v: Any, dt: T.DataType) -> str:
    text = ("true" if v else "false") if isinstance(v, bool) else str(v)
    return f"CAST({sql_str(text)} AS {dt.simpleString()})"


# Every per-row check is stated as SQL aggregate text: the whole set is parsed by the JVM
# in one go instead of being assembled from thousands of small Column calls.


def _field_checks(b: _Builder, f: Field, include_schema: bool) -> None:
    name, dt = f.name, f.data_type
    q = qname(name)
    if include_schema:
        b.add(name=f"{name}:present", kind="present", field=name, plan="schema",
              dimension="completeness", unit="missing")
        b.add(name=f"{name}:type", kind="type", field=name, plan="schema",
              dimension="conformity", unit="mismatch",
              expected_type=normalise_type_text(dt.simpleString()))
    if f.required:
        b.add(name=f"{name}:required", kind="required", field=name, plan="fused",
              dimension="completeness", unit="rows are NULL", sql=f"count_if({q} IS NULL)")
    if f.unique and not f.is_key:
        b.add(name=f"{name}:unique", kind="unique", field=name, plan="unique",
              dimension="uniqueness", keys=(name,))

    opts = f.options
    if "pattern" in opts:
        b.add(name=f"{name}:pattern", kind="pattern", field=name, plan="fused",
              dimension="conformity", unit="rows do not match",
              sql=f"count_if(NOT (CAST({q} AS STRING) RLIKE {sql_str(str(opts['pattern']))}))")
    if "minLength" in opts:
        n = int(opts["minLength"])
        b.add(name=f"{name}:min_length", kind="min_length", field=name, plan="fused",
              dimension="conformity", unit=f"rows shorter than {n}",
              sql=f"count_if(length(CAST({q} AS STRING)) < {n})")
    if "maxLength" in opts:
        n = int(opts["maxLength"])
        b.add(name=f"{name}:max_length", kind="max_length", field=name, plan="fused",
              dimension="conformity", unit=f"rows longer than {n}",
              sql=f"count_if(length(CAST({q} AS STRING)) > {n})")
    for key, kind, op in (("minimum", "minimum", "<"), ("maximum", "maximum", ">")):
        if key in opts:
            v = opts[key]
            b.add(name=f"{name}:{kind}", kind=kind, field=name, plan="fused",
                  dimension="accuracy", unit=f"rows {op} {v}",
                  sql=f"count_if({q} {op} {_lit(v, dt)})")
    # An exclusive bound is two checks: beyond the bound, and equal to it.
    for key, kind, op in (("exclusiveMinimum", "exclusive_minimum", "<"),
                          ("exclusiveMaximum", "exclusive_maximum", ">")):
        if key in opts:
            v = opts[key]
            b.add(name=f"{name}:{kind}", kind=kind, field=name, plan="fused",
                  dimension="accuracy", unit=f"rows {op} {v}",
                  sql=f"count_if({q} {op} {_lit(v, dt)})")
            b.add(name=f"{name}:{kind}_equal", kind=f"{kind}_equal", field=name, plan="fused",
                  dimension="accuracy", unit=f"rows = {v}",
                  sql=f"count_if({q} = {_lit(v, dt)})")

    for r in f.rules:
        b.add_rule(r, f)


def _valid_values_spec(b: _Builder, r: Rule, f: Field, values: Sequence[Any]) -> None:
    name, dt = r.name or f"{f.name}:valid_values", f.data_type
    common = dict(name=name, kind="valid_values", field=f.name, bound=r.bound or ZERO,
                  dimension=r.dimension or "conformity", severity=r.severity,
                  unit="rows outside the list")
    # One plan whatever the list's length: Spark looks a long list of constants up in a hash set.
    # The list is part of the contract document, so it does not grow with the data.
    lits = ", ".join(_lit(v, dt) for v in values)
    # NULL IN (...) is NULL: a NULL cell is not counted here (only `required` reports it).
    b.add(plan="fused", sql=f"count_if(NOT ({qname(f.name)} IN ({lits})))", **common)


def _rule_checks(b: _Builder, r: Rule, f: Field | None) -> None:
    metric = (r.metric or "").lower()
    args = r.arguments
    if r.type == "text":
        return  # a description, not a rule
    if r.type == "custom":  # another engine's rule: reported as not run, never passed over
        b.add(name=r.name or f"custom_{len(b.specs)}", kind="not_run", field=f.name if f else None,
              plan="schema", dimension=r.dimension, severity="info", unit="rule of another engine")
        return
    if r.type == "sql":
        query = _bind_placeholders(r.query, b.contract.model, f.name if f else None)
        pred = fusable_predicate(query, b.contract.model)
        common = dict(name=r.name or f"sql_{len(b.specs)}", kind="sql",
                      field=f.name if f else None, bound=r.bound or ZERO,
                      dimension=r.dimension, severity=r.severity, unit="rows", query=query)
        if pred is not None:
            b.add(plan="fused", sql=f"count_if({pred})", **common)
        else:
            b.add(plan="sql", **common)
        return
    if metric == "rowcount":
        b.add(name=r.name or "row_count", kind="row_count", field=None, plan="fused",
              bound=r.bound or Bound(">", 0.0), dimension=r.dimension or "completeness",
              severity=r.severity, unit="rows", sql="count(1)")
        return
    if f is None:
        if metric in ("duplicatevalues", "duplicates") and args.get("properties"):
            keys = tuple(args["properties"])
            b.add(name=r.name or f"{'+'.join(keys)}:unique", kind="unique", field="+".join(keys),
                  plan="unique", keys=keys, bound=r.bound or ZERO,
                  dimension=r.dimension or "uniqueness", severity=r.severity)
            return
        raise ValueError(f"table rule {r.name!r} of kind {metric!r} is not supported")
    c, q = f.name, qname(f.name)
    if metric == "invalidvalues":
        if "validValues" in args:
            _valid_values_spec(b, r, f, list(args["validValues"]))
        if "pattern" in args:
            b.add(name=r.name or f"{c}:pattern", kind="pattern", field=c, plan="fused",
                  bound=r.bound or ZERO, dimension=r.dimension or "conformity",
                  severity=r.severity, unit="rows do not match",
                  sql=f"count_if(NOT (CAST({q} AS STRING) RLIKE {sql_str(str(args['pattern']))}))")
        return
    if metric == "nullvalues":
        b.add(name=r.name or f"{c}:null_values", kind="required", field=c, plan="fused",
              bound=r.bound or ZERO, dimension=r.dimension or "completeness",
              severity=r.severity, unit="rows are NULL", sql=f"count_if({q} IS NULL)")
        return
    if metric == "missingvalues":
        missing = [v for v in args.get("missingValues", []) if v is not None]
        extra = f" OR {q} IN ({', '.join(_lit(v, f.data_type) for v in missing)})" if missing else ""
        b.add(name=r.name or f"{c}:missing_values", kind="missing_values", field=c,
              plan="fused", bound=r.bound or ZERO, dimension=r.dimension or "completeness",
              severity=r.severity, unit="rows missing", sql=f"count_if({q} IS NULL{extra})")
        return
    if metric in ("duplicatevalues", "duplicates"):
        b.add(name=r.name or f"{c}:unique", kind="unique", field=c, plan="unique", keys=(c,),
              bound=r.bound or ZERO, dimension=r.dimension or "uniqueness", severity=r.severity)
        return
    raise ValueError(f"rule {r.name!r} of kind {metric!r} on {c} is not supported")


def compile_checks(contract: Contract, include_schema: bool = True) -> list[CheckSpec]:
    """Expand a contract into one spec per check, in a stable order."""
    b = _Builder(contract)
    for f in contract.fields:
        _field_checks(b, f, include_schema)
    if contract.key:
        keys = tuple(contract.key)
        b.add(name=f"{'+'.join(keys)}:unique", kind="unique", field="+".join(keys),
              plan="unique", keys=keys, dimension="uniqueness")
    for r in contract.rules:
        b.add_rule(r, None)
    return b.specs


# --------------------------------------------------------------------------------------
# Evaluation: specs × frame → report
# --------------------------------------------------------------------------------------


def _passes_sql(bound: Bound, m: str) -> str:
    if bound.parts:
        return " AND ".join(f"({_passes_sql(p, m)})" for p in bound.parts)
    lo, hi = repr(float(bound.lo)), repr(float(bound.hi)) if bound.hi is not None else "NULL"
    if bound.op == "between":
        return f"{m} BETWEEN {lo} AND {hi}"
    if bound.op == "not between":
        return f"NOT ({m} BETWEEN {lo} AND {hi})"
    return f"{m} {bound.op} {lo}"


def _struct_sql(contract_id: str, s: CheckSpec, metric: str, detail: str | None = None,
                judged: str | None = None) -> str:
    """``judged``: what the bound is held against when it is not the whole-number metric. A rule that
    did not run has neither passed nor failed."""
    m = f"CAST({metric} AS BIGINT)"
    if detail is None:
        detail = f"concat(coalesce(CAST({m} AS STRING), 'no value'), {sql_str(' ' + s.unit)})"
    lit = lambda v: "CAST(NULL AS STRING)" if v is None else sql_str(str(v))
    result = f"CASE WHEN {_passes_sql(s.bound, judged or m)} THEN 'passed' ELSE 'failed' END"
    if s.kind == "not_run":
        result = sql_str(NOT_RUN)
    return (
        f"named_struct('contract', {lit(contract_id)}, 'check', {lit(s.name)}, 'kind', {lit(s.kind)}, "
        f"'field', {lit(s.field)}, 'dimension', {lit(s.dimension)}, 'severity', {lit(s.severity)}, "
        f"'metric', {m}, 'bound', {lit(s.bound.text())}, "
        f"'result', {result}, "
        f"'detail', {detail}, 'description', {lit(s.description)})"
    )


def _inline(df: DataFrame, structs: list[str]) -> DataFrame:
    return df.select(F.expr(f"inline(array({', '.join(structs)}))"))


def fused_metrics(df: DataFrame, specs: Iterable[CheckSpec]) -> list[Column]:
    """Aggregate expressions of the fused checks, aliased ``m<idx>`` (usable in ``observe``)."""
    return [F.expr(f"{s.sql} AS {s.alias}") for s in specs if s.plan == "fused"]


def _schema_rows(spark, contract_id: str, specs: list[CheckSpec], schema: T.StructType,
                 presence: T.StructType | None = None) -> DataFrame | None:
    rows = [s for s in specs if s.plan == "schema"]
    if not rows:
        return None
    types = {f.name: normalise_type_text(f.dataType.simpleString()) for f in schema}
    present = {f.name for f in (presence or schema)}
    structs = []
    for s in rows:
        if s.kind == "not_run":
            bad, detail = "NULL", "not run: rule of another engine"
        elif s.kind == "surplus_column":
            bad, detail = 0, "column not in the contract: dropped"
        elif s.kind == "present":
            bad = 0 if s.field in present else 1
            detail = "present" if not bad else "column missing"
        else:
            actual = types.get(s.field)
            bad = 0 if actual == s.expected_type else 1
            detail = f"expected {s.expected_type}, found {actual or 'nothing'}"
        structs.append(_struct_sql(contract_id, s, str(bad), sql_str(detail)))
    return _inline(spark.range(1), structs)


def _fused_rows(contract_id: str, specs: list[CheckSpec], one_row: DataFrame) -> DataFrame:
    fused = [s for s in specs if s.plan == "fused"]
    return _inline(one_row, [_struct_sql(contract_id, s, s.alias) for s in fused])


# Key checks on keys wider than one 8-byte value shuffle a 64-bit hash first ("auto").
UNIQUE_STRATEGY = "auto"  # auto | exact | hash_first


_FIXED_WIDTH = {T.LongType: 8, T.IntegerType: 4, T.ShortType: 2, T.ByteType: 1, T.DateType: 4,
                T.TimestampType: 8, T.TimestampNTZType: 8, T.DoubleType: 8, T.FloatType: 4,
                T.BooleanType: 1}


def _narrow_key(df: DataFrame, keys: Sequence[str]) -> bool:
    """Key of at most 16 fixed-width bytes: shuffling it costs about what a hash would."""
    width = 0
    for k in keys:
        w = _FIXED_WIDTH.get(type(df.schema[k].dataType))
        if w is None:  # strings, binaries, decimals: variable or wide
            return False
        width += w
    return width <= 16


def duplicate_keys(df: DataFrame, keys: Sequence[str], strategy: str | None = None,
                   hash_fn=None) -> DataFrame:
    """One row ``(groups, rows)``: key values occurring more than once, and their rows.
    NULL keys group together.

    ``exact``: ``groupBy(keys).count()`` with map-side partial counts.
    ``hash_first``: count a 64-bit hash of the key first (8 bytes per row shuffled, partial
    counts), keep only rows whose hash repeats (semi join; AQE broadcasts the candidate
    hashes when few), then count those rows exactly by key. Same answer: true duplicates
    share a hash, and a collision is resolved by the exact step.
    """
    strategy = strategy or UNIQUE_STRATEGY
    cols = [qcol(k) for k in keys]
    if strategy == "auto":
        strategy = "exact" if _narrow_key(df, keys) else "hash_first"
    if strategy == "hash_first":
        h = (hash_fn or (lambda cs: F.xxhash64(*cs)))(cols).alias("__h")
        cand = (df.select(h).groupBy("__h").agg(F.count(F.lit(1)).alias("__c"))
                .where(F.col("__c") > 1).select("__h"))
        df = df.select(*cols, h).join(cand, "__h", "left_semi")
        cols = [qcol(k) for k in keys]
    return (
        df.groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .agg(F.count(F.lit(1)).alias("groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
    )


def _key_cell(c: Column, t: T.DataType) -> Column | None:
    """A key cell as text, different for different values; None for a type without such a text."""
    if getattr(t, "collation", "UTF8_BINARY") != "UTF8_BINARY":
        return None  # texts that differ may be one key
    if isinstance(t, T.TimestampType):
        c = F.unix_micros(c)  # a local time may stand for two instants
    elif isinstance(t, (T.FloatType, T.DoubleType)):
        c = c + F.lit(0.0).cast(t)  # -0.0 and 0.0 are one key
    elif isinstance(t, T.BinaryType):
        c = F.hex(c)
    elif not isinstance(t, (T.StringType, T.IntegralType, T.DecimalType, T.BooleanType, T.DateType, T.TimestampNTZType)):
        return None
    text = c.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _key_text(df: DataFrame, keys: Sequence[str]) -> Column | None:
    """A key as text: its cells, each behind its length. None where a cell has no text."""
    cells = [_key_cell(qcol(k), df.schema[k].dataType) for k in keys]
    return None if any(c is None for c in cells) else F.concat(*cells)


def _short(text: Column) -> Column:
    return F.when(F.octet_length(text) < 32, text.cast("binary")).otherwise(F.unhex(F.sha2(text.cast("binary"), 256)))


def key_digest(df: DataFrame, keys: Sequence[str]) -> Column | None:
    """A key of any columns in at most 32 bytes: its cells (each behind its length) as they are below 32
    bytes, else their SHA-256. NULL cells are equal to each other. None where a cell has no text."""
    text = _key_text(df, keys)
    return None if text is None else _short(text)


def _word(c: Column, t: T.DataType) -> tuple[str, Column] | None:
    """A key cell as one 8-byte value of the named type, different for different values; None for texts and other types."""
    if isinstance(t, T.DateType):
        return "bigint", F.unix_date(c).cast("bigint")
    if isinstance(t, T.TimestampType):
        return "bigint", F.unix_micros(c)
    if isinstance(t, (T.IntegralType, T.BooleanType)):
        return "bigint", c.cast("bigint")
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return "double", c.cast("double")
    return ("timestamp_ntz", c) if isinstance(t, T.TimestampNTZType) else None


def shared_duplicate_keys(df: DataFrame, checks: Sequence[tuple[int, Sequence[str]]]) -> DataFrame:
    """``duplicate_keys`` of several keys in one scan and one exchange: one row with ``g<idx>`` (repeated
    key values) and ``r<idx>`` (their rows) for each ``(idx, keys)``. Rows are tagged with their check
    and counted in their task first, so a hot key of any check arrives as one row per task. Cells of fixed
    width are grouped as they are, in slots that the checks share; only the others go through a digest."""
    names = {k: f"k{j}" for j, k in enumerate(dict.fromkeys(k for _, keys in checks for k in keys))}
    texts, words, slots = {}, {}, {}
    for i, keys in checks:
        cells = {k: _word(F.col(names[k]), df.schema[k].dataType) for k in keys}
        words[i] = {}
        for kind, c in (w for w in cells.values() if w is not None):
            slot = f"{kind}_{sum(x.startswith(kind) for x in words[i])}"
            words[i][slot], slots[slot] = c, kind
        if wide := [k for k in cells if cells[k] is None]:
            texts[i] = _key_text(df, wide).alias(f"t{i}")
            words[i]["text"] = _short(F.col(f"t{i}"))
    if texts:
        slots["text"] = "binary"
    df = df.select(*[qcol(k).alias(n) for k, n in names.items()], *texts.values())  # a text is built once a row
    # The check comes last: a map that outgrows its memory is sorted by the first columns.
    tagged = F.array(*[F.struct(*[words[i].get(s, F.lit(None).cast(kind)).alias(s) for s, kind in slots.items()],
                                F.lit(i).alias("check")) for i, _ in checks])
    counted = (df.select(F.explode(tagged).alias("t")).groupBy(*[f"t.{s}" for s in slots], "t.check")
               .agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    return counted.agg(*[
        c for i, _ in checks for c in (
            F.count_if(F.col("check") == i).alias(f"g{i}"),
            F.coalesce(F.sum(F.when(F.col("check") == i, F.col("n"))), F.lit(0)).alias(f"r{i}"))])


def _unique_struct(contract_id: str, s: CheckSpec, groups: str, rows: str) -> str:
    detail = f"concat(CAST(`{groups}` AS STRING), ' repeated keys over ', CAST(`{rows}` AS STRING), ' rows')"
    return _struct_sql(contract_id, s, f"`{groups}`", detail)


def _unique_rows(contract_id: str, df: DataFrame, specs: list[CheckSpec]) -> list[DataFrame]:
    """Key checks: two or more share one pass; a single one, or a key without a digest, has its own."""
    shared = [s for s in specs if key_digest(df, s.keys) is not None]
    shared = shared if len(shared) > 1 else []
    out = []
    if shared:
        one = shared_duplicate_keys(df, [(s.idx, s.keys) for s in shared])
        out.append(_inline(one, [_unique_struct(contract_id, s, f"g{s.idx}", f"r{s.idx}") for s in shared]))
    for s in specs:
        if s not in shared:
            out.append(_inline(duplicate_keys(df, s.keys), [_unique_struct(contract_id, s, "groups", "rows")]))
    return out


def _sql_rows(contract_id: str, df: DataFrame, model: str, s: CheckSpec) -> DataFrame:
    spark = df.sparkSession
    with as_relation(df, model):
        # analysed now; stays valid once the view is gone
        res = spark.sql(dependency_query(s.query, model, df.schema) or s.query)
    if len(res.columns) != 1:
        raise ContractError(f"{s.name}: an SQL rule returns one value, this one has {len(res.columns)} columns")
    # The value is judged as it is; the report's whole-number metric shows it when it is one. A
    # query of several rows, or none, has no value and fails.
    value = F.max(qcol(res.columns[0]).cast("double"))
    one = res.agg(F.count(F.lit(1)).alias("n"), value.alias("x")).select(
        "n", F.when(F.col("n") == 1, F.col("x")).alias("x")
    ).withColumn("v", F.when(F.col("x") == F.floor("x"), F.floor("x")))
    shown = (f"CASE WHEN `n` <> 1 THEN concat(CAST(`n` AS STRING), ' rows instead of one value') "
             f"ELSE concat(coalesce(CAST(`v` AS STRING), CAST(`x` AS STRING), 'no value'), {sql_str(' ' + s.unit)}) END")
    return _inline(one, [_struct_sql(contract_id, s, "`v`", shown, "`x`")])


def cast_loss_specs(contract: Contract, present: Iterable[str], start: int) -> list[CheckSpec]:
    """Opt-in, informational: per delivered column, non-NULL text that TRY_CAST made NULL.
    Evaluated over a frame carrying the raw text as ``__raw__<name>`` next to the typed column."""
    present = set(present)
    out = []
    for f in contract.fields:
        if f.name in present:
            raw, typed = qname(f"__raw__{f.name}"), qname(f.name)
            out.append(CheckSpec(idx=start + len(out), name=f"{f.name}:cast_loss", kind="cast_loss",
                                 field=f.name, plan="fused", bound=Bound(">=", 0.0), dimension="conformity",
                                 severity="info", unit="values could not be typed",
                                 sql=f"count_if({raw} IS NOT NULL AND {typed} IS NULL)"))
    return out


def surplus_specs(columns: Iterable[str], start: int) -> list[CheckSpec]:
    """Informational rows: delivery columns the contract does not declare (dropped by typing)."""
    return [CheckSpec(idx=start + i, name=f"{c}:surplus", kind="surplus_column", field=c, plan="schema",
                      bound=ZERO, dimension="conformity", severity="info", unit="column not in the contract")
            for i, c in enumerate(columns)]


MALFORMED = "__malformed_line"


def malformed_spec(idx: int) -> CheckSpec:
    """Opt-in: rows of the delivery whose number of cells differs from the header."""
    return CheckSpec(idx=idx, name="delivery:malformed_rows", kind="malformed_rows", field=None,
                     plan="fused", bound=ZERO, dimension="conformity",
                     unit="rows with another number of cells than the header",
                     sql=f"count_if({qname(MALFORMED)} IS NOT NULL)")


def usable_fused(df: DataFrame, specs: list[CheckSpec]) -> list[CheckSpec]:
    """Fused SQL predicates that do not analyse as a row predicate fall back to SQL."""
    out = []
    for s in specs:
        if s.plan == "fused" and s.kind == "sql":
            try:
                df.agg(F.expr(s.sql)).schema  # eager analysis
            except PySparkException:
                s = replace(s, plan="sql", sql=None)
        out.append(s)
    return out


def check_report(
    df: DataFrame,
    contract: Contract,
    *,
    specs: list[CheckSpec] | None = None,
    observed: dict[str, Any] | None = None,
    schema: T.StructType | None = None,
    presence: T.StructType | None = None,
) -> DataFrame:
    """One row per check (schema ``REPORT_SCHEMA``), lazily.

    ``observed`` holds fused metrics already gathered (e.g. by ``observe`` on the staging
    write); then the fused part needs no pass over ``df``. ``schema`` overrides the schema
    the presence/type checks look at (e.g. the raw delivery's).
    """
    spark = df.sparkSession
    specs = usable_fused(df, specs if specs is not None else compile_checks(contract))
    parts: list[DataFrame] = []

    sch = _schema_rows(spark, contract.id, specs, schema or df.schema, presence)
    if sch is not None:
        parts.append(sch)

    fused = [s for s in specs if s.plan == "fused"]
    if fused:
        if observed is not None and all(s.alias in observed for s in fused):
            one_row = spark.range(1).select(
                *[F.lit(observed[s.alias]).cast("bigint").alias(s.alias) for s in fused]
            )
        else:
            one_row = df.agg(*fused_metrics(df, fused))
        parts.append(_fused_rows(contract.id, specs, one_row))

    parts += _unique_rows(contract.id, df, [s for s in specs if s.plan == "unique"])
    for s in specs:
        if s.plan == "sql":
            parts.append(_sql_rows(contract.id, df, contract.model, s))

    if not parts:
        return spark.createDataFrame([], REPORT_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --------------------------------------------------------------------------------------
# R2 / F1
# --------------------------------------------------------------------------------------


def stops(result: str, not_run_blocks: bool = False) -> bool:
    """Whether a check's result stops a load: a failed one does, one that did not run if asked."""
    return result != "passed" and (not_run_blocks or result != NOT_RUN)


def verdict(report: DataFrame, not_run_blocks: bool = False) -> DataFrame:
    """R2: one row: passed only if no check failed, with counts of all, of those that failed and of
    those that did not run (which count as neither). ``not_run_blocks``: a rule that did not run
    is no pass either."""
    wrong = F.col("result") != "passed"
    if not not_run_blocks:
        wrong = wrong & (F.col("result") != NOT_RUN)
    return report.agg(
        (~F.coalesce(F.bool_or(wrong), F.lit(False))).alias("passed"),
        F.count(F.lit(1)).alias("checks"),
        F.count_if(F.col("result") == "failed").alias("failed"),
        F.count_if(F.col("result") == NOT_RUN).alias("not_run"),
    )


def failing(report: DataFrame) -> DataFrame:
    """results other than ``passed``; the whole report when none fails.

    A report has one row per declared check (bounded by the contract), so the
    unpartitioned window below holds tens of rows, never data rows.
    """
    from pyspark.sql import Window

    nbad = F.count_if(F.col("result") != "passed").over(Window.partitionBy())
    return (
        report.withColumn("__nbad", nbad)
        .where((F.col("__nbad") == 0) | (F.col("result") != "passed"))
        .drop("__nbad")
    )


def failing_rows(rows: list) -> list:
    """F1 on a collected report (rows are small: one per check)."""
    bad = [r for r in rows if r["result"] != "passed"]
    return bad if bad else list(rows)
