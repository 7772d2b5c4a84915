"""Registered queries: each runs one operator family of the library over the driver tables
(whole tables, no subsets) and returns a DataFrame whose columns match its oracle SQL."""

from __future__ import annotations

import uuid
from dataclasses import replace
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..contract import Contract, Field
from ..functions.text import normalise_text
from ..operators import checks as K
from ..operators import diff as D
from ..operators.evolution import drift_verdict, schema_drift
from ..operators.publish import ensure_table
from ..operators.shape import align_by_name, type_columns
from ..operators.windows import later_repeats, running_count
from ..plans import dictionary as M
from ..plans.apply import apply_all, apply_contract
from ..session import scratch_path
from ..sources.catalog import read_target
from ..sources.text import as_text, read_landing_text
from . import contracts as C
from . import derived as X

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

REPORT_OUT = ["contract", "check", "kind", "field", "metric", "result"]


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _run_schema() -> str:
    return f"run_{uuid.uuid4().hex[:10]}"


def _with_root(spark: SparkSession) -> None:
    # Tables created by the suite live under the shared folder of the session.
    spark.conf.set("lakepact.lake.root", scratch_path(spark, "lake"))


def _report(df: DataFrame, contract: Contract, kinds: tuple[str, ...] | None = None, **kw) -> DataFrame:
    specs = K.compile_checks(contract)
    if kinds is not None:
        specs = [s for s in specs if s.kind in kinds]
    return K.check_report(df, contract, specs=specs, **kw).select(*REPORT_OUT)


# ---- S1 / S3 / P1–P4 ------------------------------------------------------------------


def q_text_scan(spark, sf):
    """Customer written as a header-CSV delivery, read back as text, typed, summarised."""
    path = scratch_path(spark, "deliveries", "customer")
    as_text(t(spark, sf, "customer")).write.option("header", True).csv(path)
    typed = type_columns(read_landing_text(spark, path), C.customer())
    return typed.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("c_acctbal").alias("n_acctbal"),
        (F.sum("c_acctbal") * 100).cast("bigint").alias("sum_acctbal_cents"),
        F.sum("c_nationkey").cast("bigint").alias("sum_nationkey"),
        F.count_distinct("c_name").alias("n_names"),
    )


def q_quoted_splits(spark, sf):
    """Pages written as CSV files whose cells hold quoted line breaks and quotes, each file far larger than
    what one task reads (small tables: one file), read back in many tasks: every row's whole text by its digest."""
    path = scratch_path(spark, "deliveries", "pages")
    pages = t(spark, sf, "pages").select(
        F.col("page_id").cast("string").alias("page_id"), "url",
        F.concat(F.lit('<p class="a">\n'), F.coalesce("html", F.lit("")), F.lit('\n"end",\n')).alias("body"))
    whole = {"header": True, "escape": '"', "quoteAll": True, "ignoreTrailingWhiteSpace": False}
    size = pages.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    files = max(1, -(-size // C.DELIVERY_FILE_BYTES))  # bounded files, so that no task writes the whole table
    (pages.coalesce(1) if files == 1 else pages.repartition(files)).write.options(**whole).csv(path)
    rows = read_landing_text(spark, path, split_quoted=True)
    return rows.select(F.col("page_id").cast("bigint").alias("page_id"), "url", F.md5("body").alias("body_md5"))


def q_table_count(spark, sf):
    """S3: a catalog table over the region file, scanned by name."""
    ns = f"suite_landing__{_run_schema()}"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{ns}`")
    spark.sql(f"CREATE TABLE `{ns}`.`region` USING parquet LOCATION '{sf}/region.parquet'")
    return read_target(spark, f"`{ns}`.`region`").agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit("region").alias("table_name"), "row_count"
    )


def q_typed_projection(spark, sf):
    """P1 + P3: orders as text → typed by contract (o_orderpriority declared INT: NULL)."""
    c = C.orders().with_fields(
        [f if f.name != "o_orderpriority" else replace(f, physical_type="INT", options={})
         for f in C.orders().fields]
    )
    typed = type_columns(as_text(t(spark, sf, "orders")), c)
    return typed.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("o_orderkey").alias("n_orderkey"),
        F.count("o_totalprice").alias("n_totalprice"),
        F.count("o_orderdate").alias("n_orderdate"),
        F.count("o_orderpriority").alias("n_priority"),
        (F.sum("o_totalprice") * 100).cast("bigint").alias("sum_totalprice_cents"),
        F.min("o_orderdate").alias("min_orderdate"),
        F.max("o_orderdate").alias("max_orderdate"),
        F.sum("o_orderkey").cast("bigint").alias("sum_orderkey"),
    )


def q_null_fill(spark, sf):
    """A contract column the delivery lacks becomes a typed NULL."""
    typed = type_columns(as_text(t(spark, sf, "nation")), C.nation(with_comment=True))
    return typed.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("n_comment").alias("n_comment_values"),
        F.count("n_name").alias("n_name_values"),
        F.sum("n_regionkey").cast("bigint").alias("sum_regionkey"),
    )


def q_align_by_name(spark, sf):
    """A frame with columns in another order aligned to the target's column order."""
    c = C.supplier()
    typed = type_columns(as_text(t(spark, sf, "supplier")), c)
    shuffled = typed.select(*reversed(typed.columns))
    return align_by_name(shuffled, c.names)


# ---- K1–K15 ---------------------------------------------------------------------------


def q_check_presence_type(spark, sf):
    """K1/K2 of what was written: the headings of a delivery that lacks one column, and the
    columns of a stored table against a contract declaring one absent column and other types.
    Both are counted too (K10)."""
    kinds = ("present", "type", "row_count")
    base = C.orders()
    path = scratch_path(spark, "delivery", "orders")
    as_text(t(spark, sf, "orders").drop("o_orderpriority")).write.option("header", True).csv(path)
    text = read_landing_text(spark, path)
    delivered = _report(type_columns(text, base), base, kinds, presence=text.schema)

    fields = [f if f.name != "o_orderpriority" else replace(f, physical_type="INT", options={})
              for f in base.fields]
    fields.append(Field(name="o_comment", physical_type="STRING", required=False))
    stored = _report(t(spark, sf, "orders"), base.with_fields(fields), kinds)
    return delivered.withColumn("source", F.lit("delivery")).unionByName(stored.withColumn("source", F.lit("table")))


def q_check_required(spark, sf):
    """K3: events with error events blanked out."""
    ev = t(spark, sf, "events").withColumn("event_type", F.expr("nullif(event_type, 'error')"))
    return _report(ev, C.events(), ("required",))


def q_check_unique_single(spark, sf):
    """K4 through the report: the key check of the orders contract."""
    return _report(t(spark, sf, "orders"), C.orders(), ("unique",))


def q_check_unique_composite(spark, sf):
    """K5: (l_orderkey, l_linenumber) repeated groups and rows."""
    rep = _report(t(spark, sf, "lineitem"), C.lineitem(), ("unique",))
    rows = K.duplicate_keys(t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
    return rep.join(rows.select(F.lit("lineitem").alias("contract"), F.col("rows").cast("bigint").alias("dup_rows")),
                    "contract")


def q_check_unique_many(spark, sf):
    """K4 + K5: five key checks of one table in one scan and one exchange."""
    keys = [("l_orderkey",), ("l_comment_free",), ("l_orderkey", "l_linenumber"), ("l_shipdate", "l_partkey"),
            ("l_partkey", "l_suppkey", "l_quantity")]
    df = t(spark, sf, "lineitem").withColumn(
        "l_comment_free", F.concat_ws("/", "l_returnflag", "l_linestatus", F.col("l_shipdate").cast("string")))
    c = _rule_contract("lineitem", "lineitem_delivery", {
        "type": "library", "metric": "duplicateValues", "arguments": {"properties": list(keys[0])}, "mustBe": 0})
    c = replace(c, rules=tuple(replace(c.rules[0], arguments={"properties": list(k)}) for k in keys))
    return _report(df, c)


def q_check_valid_values(spark, sf):
    """K6: event types outside click/view/signup."""
    return _report(t(spark, sf, "events"), C.events(), ("valid_values",))


def q_check_valid_values_long(spark, sf):
    """K6 with a long list (12000 customer keys, built by rule): the same fused predicate."""
    c = Contract.from_dict({"id": "orders", "schema": [{"name": "orders_delivery", "properties": [
        {"name": "o_custkey", "physicalType": "BIGINT", "quality": [
            {"type": "library", "metric": "invalidValues", "name": "known_customer", "mustBe": 0,
             "arguments": {"validValues": list(range(12000))}}]}]}]})
    return _report(t(spark, sf, "orders"), c, ("valid_values",))


def q_library_metrics(spark, sf):
    """K3/K4/K5/K6/K14 in the contract vocabulary: nullValues and missingValues metrics,
    a field declared unique, a table-level duplicateValues over two properties, and
    between / greater-than bounds."""
    c = Contract.from_dict({"id": "events", "schema": [{"name": "events_delivery", "properties": [
        {"name": "event_id", "physicalType": "BIGINT", "unique": True},
        {"name": "event_type", "physicalType": "STRING", "quality": [
            {"type": "library", "metric": "nullValues", "name": "few_untyped", "mustBeLessThan": 100},
            {"type": "library", "metric": "missingValues", "name": "errors_as_missing",
             "arguments": {"missingValues": ["error", "n/a"]}, "mustBeBetween": [1000, 5000]}]},
        {"name": "user_id", "physicalType": "BIGINT"},
    ], "quality": [
        {"type": "library", "metric": "duplicateValues", "name": "one_event_type_per_user",
         "arguments": {"properties": ["user_id", "event_type"]}, "mustBe": 0},
        {"type": "library", "metric": "rowCount", "name": "enough_rows", "mustBeGreaterOrEqualTo": 100},
    ]}]})
    ev = t(spark, sf, "events").withColumn("event_type", F.expr("nullif(event_type, 'view')"))
    return K.check_report(ev, c, specs=K.compile_checks(c, include_schema=False)).select(
        "check", "kind", "metric", "bound", "result")


def q_check_pattern(spark, sf):
    """K7: p_brand against ^Brand#[0-9]$."""
    return _report(t(spark, sf, "part"), C.part(), ("pattern",))


def q_check_length(spark, sf):
    """K8: p_name length between 9 and 11."""
    return _report(t(spark, sf, "part"), C.part(), ("min_length", "max_length"))


def q_check_exclusive_min(spark, sf):
    """K9: c_acctbal > 0 as two checks (below, equal)."""
    return _report(t(spark, sf, "customer"), C.customer(), ("exclusive_minimum", "exclusive_minimum_equal"))


def q_check_row_count(spark, sf):
    """K10 on every driver table."""
    parts = []
    for name in TABLES:
        c = Contract.from_dict({"id": name, "schema": [{"name": name, "properties": [], "quality": [C.ROWS]}]})
        parts.append(_report(t(spark, sf, name), c, ("row_count",)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.col("contract").alias("table_name"), F.col("metric").alias("row_count"), "result")


def _rule_contract(cid: str, model: str, rule: dict) -> Contract:
    return Contract.from_dict({"id": cid, "schema": [{"name": model, "properties": [], "quality": [rule]}]})


def q_sql_rule_filter(spark, sf):
    """K11 + S4: SELECT COUNT(*) … WHERE, fused into the check aggregate."""
    c = _rule_contract("lineitem", "lineitem_delivery", {
        "type": "sql", "name": "no_zero_tax", "mustBe": 0,
        "query": "SELECT COUNT(*) FROM lineitem_delivery WHERE l_tax = 0"})
    return _report(t(spark, sf, "lineitem"), c)


def q_sql_rule_fd(spark, sf):
    """K12 + S4: brands with more than one type (grouped SQL over the model view)."""
    return _report(t(spark, sf, "part"), C.part(), ("sql",))


def q_sql_rule_two_columns(spark, sf):
    """l_tax below l_discount."""
    c = _rule_contract("lineitem", "lineitem_delivery", {
        "type": "sql", "name": "tax_below_discount", "mustBe": 0,
        "query": "SELECT COUNT(*) FROM lineitem_delivery WHERE l_tax IS NOT NULL AND l_tax < l_discount"})
    return _report(t(spark, sf, "lineitem"), c)


def _typed(spark, sf, name: str, c: Contract) -> DataFrame:
    return type_columns(as_text(t(spark, sf, name)), c)


def q_gate_report(spark, sf):
    """The full reports of the orders and lineitem contracts over typed text, with
    each check's labels."""
    o, li = C.orders(), C.lineitem()
    cols = [*REPORT_OUT, "dimension", "severity", "bound", "description"]
    return K.check_report(_typed(spark, sf, "orders", o), o).select(*cols).unionByName(
        K.check_report(_typed(spark, sf, "lineitem", li), li).select(*cols))


def q_gate_verdict(spark, sf):
    """R2/G1/F1: verdict per contract (passed, checks, failed)."""
    o, li = C.orders(), C.lineitem()
    parts = []
    for name, c in (("orders", o), ("lineitem", li)):
        rep = K.check_report(_typed(spark, sf, name, c), c)
        parts.append(K.verdict(rep).select(F.lit(c.id).alias("contract"), "passed", "checks", "failed"))
    return parts[0].unionByName(parts[1])


def q_custom_rule(spark, sf):
    """R2/G1 third outcome: a contract with a rule of another engine, judged with and without that
    rule blocking. It is counted as not run, never as passed."""
    c = C.with_custom_rule()
    rep = K.check_report(_typed(spark, sf, "supplier", c), c)
    parts = [K.verdict(rep, blocks).select(F.lit(blocks).alias("not_run_blocks"), "passed", "checks", "failed", "not_run")
             for blocks in (False, True)]
    return parts[0].unionByName(parts[1])


def q_gate_failing(spark, sf):
    """failing checks of the lineitem contract (all of them when none fails)."""
    li = C.lineitem()
    return K.failing(K.check_report(_typed(spark, sf, "lineitem", li), li)).select(*REPORT_OUT)


# ---- S5–S7, E1–E7, A1, G2, W1, W2 ------------------------------------------------------


def _load_supplier(spark, sf):
    _with_root(spark)
    c = C.supplier(_run_schema())
    res = apply_contract(spark, c, C.ENV, as_text(t(spark, sf, "supplier")))
    return c, res


def q_flagship_load(spark, sf):
    """W1 end to end: orders written as a CSV delivery, read as text (S1), typed (P1),
    staged with the fused checks as observed metrics, key/SQL checks on the staged copy,
    gated, published by version switch, then checked again on the table (G2)."""
    _with_root(spark)
    c = C.orders(_run_schema())
    path = scratch_path(spark, "deliveries", "orders")
    as_text(t(spark, sf, "orders")).write.option("header", True).csv(path)
    res = apply_contract(spark, c, C.ENV, path)
    return _report(read_target(spark, res.table), c)


def q_gate_refusal(spark, sf):
    """G1 refusal: orders loaded, then a delivery holding every order twice is refused; the
    failing checks are returned with the rows the table still holds."""
    from ..operators.gate import GateFailed
    _with_root(spark)
    c = C.orders(_run_schema())
    text = as_text(t(spark, sf, "orders"))
    res = apply_contract(spark, c, C.ENV, text, post_check=False)
    try:
        apply_contract(spark, c, C.ENV, text.unionAll(text), post_check=False)
        failed, current = [], None
    except GateFailed as e:
        failed = [(r["check"], r["metric"]) for r in e.report if r["result"] != "passed"]
        current = e.current_rows
    out = spark.createDataFrame(failed, "check string, metric bigint")
    return out.select("check", "metric", F.lit(current).cast("bigint").alias("current_rows"),
                      F.lit(read_target(spark, res.table).count()).cast("bigint").alias("rows_after"))


def q_landing_stream(spark, sf):
    """Structured Streaming: orders land as a CSV delivery in a watched folder, behind a ragged one;
    the watcher refuses the first and loads the second (W1); the loaded table's report is returned."""
    from ..operators.publish import make_folder, rename_only_file
    from ..streaming.landing import MARKER, Refused, watch_landing
    _with_root(spark)
    c = C.orders(_run_schema())
    landing = scratch_path(spark, "landing", "orders")
    # A bad delivery comes first: its rows have a cell more than its heading.
    orders = as_text(t(spark, sf, "orders"))
    lines = spark.range(1).select(F.lit(",".join(orders.columns)).alias("line")).unionByName(
        orders.limit(3).select(F.concat_ws(",", *orders.columns, F.lit("surplus")).alias("line")))
    lines.coalesce(1).write.text(f"{landing}/ragged")
    spark.range(1).select(F.lit("done")).coalesce(1).write.text(f"{landing}/early")
    make_folder(spark, f"{landing}/bad")
    rename_only_file(spark, f"{landing}/ragged", f"{landing}/bad/rows.csv")
    rename_only_file(spark, f"{landing}/early", f"{landing}/bad/{MARKER}")
    # One delivery of many files, complete when its marker is there.
    as_text(t(spark, sf, "orders")).repartition(24).write.option("header", True).csv(f"{landing}/first")
    spark.createDataFrame([("done",)], "v string").coalesce(1).write.text(f"{landing}/marker")
    rename_only_file(spark, f"{landing}/marker", f"{landing}/first/{MARKER}")
    seen = []
    q = watch_landing(spark, c, C.ENV, landing, pattern="*.csv", available_now=True,
                      checkpoint=scratch_path(spark, "streams", "orders"),
                      on_result=lambda _b, out: seen.append(out))
    q.awaitTermination()
    if len(seen) != 2 or not isinstance(seen[0], Refused) or isinstance(seen[1], Refused):
        raise RuntimeError(f"landing watcher did not load the delivery: {seen!r}")
    return _report(read_target(spark, seen[-1].table), c)


def q_malformed_rows(spark, sf):
    """Opt-in ragged-row check: orders delivered as CSV without quoting, urgent orders
    carrying an extra cell; the load counts them in its one pass and refuses the delivery."""
    from ..operators.gate import GateFailed
    _with_root(spark)
    c = C.orders(_run_schema())
    o = as_text(t(spark, sf, "orders"))
    o = o.withColumn("o_orderpriority", F.when(F.col("o_orderpriority").startswith("1-"),
                                                 F.concat(F.col("o_orderpriority"), F.lit(",late")))
                     .otherwise(F.col("o_orderpriority")))
    path = scratch_path(spark, "deliveries", "orders_ragged")
    o.write.option("header", True).option("quote", "\u0000").csv(path)
    try:
        res = apply_contract(spark, c, C.ENV, path, malformed_rows=True, post_check=False)
        report = res.gate
    except GateFailed as e:
        report = e.report
    rows = [(r["check"], r["metric"], r["result"]) for r in report
            if r["kind"] in ("malformed_rows", "row_count")]
    return spark.createDataFrame(rows, "check string, metric bigint, result string")


def q_publish_roundtrip(spark, sf):
    """W1 + S5 + A1: supplier delivered as text, gated, published; the table read back."""
    c, res = _load_supplier(spark, sf)
    return read_target(spark, res.table).select(*c.names)


def q_post_load(spark, sf):
    """The contract's checks on the physical table after the load."""
    c, res = _load_supplier(spark, sf)
    return _report(read_target(spark, res.table), c)


def q_cast_loss(spark, sf):
    """P1 opt-in metric: orders loaded with o_orderpriority declared INT (optional); the load
    passes and reports, per delivered column, the text TRY_CAST could not type."""
    _with_root(spark)
    base = C.orders(_run_schema())
    c = base.with_fields([
        f if f.name != "o_orderpriority" else replace(f, physical_type="INT", options={}, required=False)
        for f in base.fields])
    res = apply_contract(spark, c, C.ENV, as_text(t(spark, sf, "orders")), cast_loss=True, post_check=False)
    rows = [(r["field"], r["metric"], r["result"]) for r in res.gate if r["kind"] == "cast_loss"]
    return spark.createDataFrame(rows, "field string, metric bigint, result string")


def q_publish_overwrite(spark, sf):
    """S5 in the reference's mode: INSERT OVERWRITE by name into a loaded table; the rows
    are replaced, not appended."""
    from ..operators.publish import publish
    c, res = _load_supplier(spark, sf)
    publish(spark, type_columns(as_text(t(spark, sf, "supplier")), c), res.table, mode="overwrite")
    return read_target(spark, res.table).select(*c.names)


def _drift_inputs(spark, sf):
    p = t(spark, sf, "part")
    tc = X.spark_derive(spark, X.TABLE_COLUMNS_SQL, part=p).select(
        F.col("table_id").alias("table"), F.col("column_name").alias("column"), F.col("type_name").alias("type"))
    cf = X.spark_derive(spark, X.DRIFT_FIELDS_SQL, part=p)
    return tc, cf


def q_schema_drift(spark, sf):
    """E2–E5 over one table per part: full outer join of inventories and contracts."""
    return schema_drift(*_drift_inputs(spark, sf))


def q_schema_drift_verdict(spark, sf):
    """E6 per table: compatible, problems, columns to add."""
    return drift_verdict(schema_drift(*_drift_inputs(spark, sf)))


def q_additive_evolution(spark, sf):
    """Nation loaded, then its contract gains an optional column: one ALTER, old files
    read back NULL."""
    _with_root(spark)
    schema = _run_schema()
    res = apply_contract(spark, C.nation(schema), C.ENV, as_text(t(spark, sf, "nation")))
    ensure_table(spark, C.nation(schema, with_comment=True), res.table,
                 res.table.rsplit(".", 1)[0], "nation")
    tbl = read_target(spark, res.table)
    return tbl.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("n_comment").isNull()).alias("n_comment_nulls"),
        F.lit(len(tbl.columns)).alias("n_columns"),
    )


def q_multi_contract(spark, sf):
    """Orders, customer and part loaded as independent jobs, and a delivery that is not there;
    one outcome each."""
    _with_root(spark)
    schema = _run_schema()
    jobs = [(C.orders(schema), C.ENV, as_text(t(spark, sf, "orders"))),
            (C.customer(schema), C.ENV, as_text(t(spark, sf, "customer"))),
            (C.part(schema), C.ENV, as_text(t(spark, sf, "part"))),
            (C.nation(schema), C.ENV, scratch_path(spark, "no_such_delivery"))]
    out = apply_all(spark, jobs, max_parallel=3)
    rows = [(o.contract, o.status, o.checks, o.failed, o.rows_loaded) for o in out]
    return spark.createDataFrame(rows, "contract string, status string, checks int, failed int, rows_loaded bigint")


# ---- D1–D5 ----------------------------------------------------------------------------


def _snapshots(spark, sf):
    p = t(spark, sf, "part")
    return (X.spark_derive(spark, X.OLD_SNAPSHOT_SQL, part=p),
            X.spark_derive(spark, X.NEW_SNAPSHOT_SQL, part=p))


def q_contract_diff(spark, sf):
    """Every difference between two registry snapshots."""
    old, new = _snapshots(spark, sf)
    return D.contract_diff(old, new)


def q_contract_diff_verdict(spark, sf):
    """Breaking or not, per contract of either snapshot."""
    old, new = _snapshots(spark, sf)
    return D.diff_verdict(D.contract_diff(old, new), old, new)


def q_contract_diff_overall(spark, sf):
    """One verdict over all contracts of both snapshots."""
    old, new = _snapshots(spark, sf)
    return D.overall_verdict(D.diff_verdict(D.contract_diff(old, new), old, new))


def q_changelog(spark, sf):
    """D3: every contract's differences, numbered in the changelog's order."""
    old, new = _snapshots(spark, sf)
    return D.changelog(D.contract_diff(old, new)).select("contract", "position", "field", "change")


def q_in_sync(spark, sf):
    """Stored vs regenerated snapshot, rows on one side only."""
    p = t(spark, sf, "part")
    stored = X.spark_derive(spark, X.OLD_SNAPSHOT_SQL, part=p)
    regen = X.spark_derive(spark, X.REGENERATED_SNAPSHOT_SQL, part=p)
    return D.in_sync(stored, regen)


# ---- M1–M21 ---------------------------------------------------------------------------


def q_norm_text(spark, sf):
    """M1 over whole document texts: distinct normalised texts and their length per language."""
    d = t(spark, sf, "documents").select("lang", normalise_text(F.col("text")).alias("norm"))
    return d.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_distinct(F.sha2("norm", 256)).alias("n_distinct_norm"),
        F.sum(F.length("norm")).cast("bigint").alias("sum_len_norm"),
    )


def q_norm_compat(spark, sf):
    """M1 over whole texts written with ligatures, a fraction and letters beyond the BMP: what
    they stand for, without a Python worker."""
    text = F.translate("text", "ae", "𝐚𝖊")
    for plain, form in [("ff", "ﬀ"), ("st", "ﬆ"), ("no", "№"), ("fi", "ﬁ")]:
        text = F.replace(text, F.lit(plain), F.lit(form))
    d = t(spark, sf, "documents").select("lang", normalise_text(F.concat(F.lit("½ "), text)).alias("norm"))
    return d.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_distinct(F.md5("norm")).alias("n_distinct_norm"),
        F.sum(F.length("norm")).cast("bigint").alias("sum_len_norm"),
        F.min(F.md5("norm")).alias("least_md5"), F.max(F.md5("norm")).alias("greatest_md5"),
    )


def q_duplicate_first_seen(spark, sf):
    """M8 on documents: a later document repeating an earlier text, with the first id."""
    d = t(spark, sf, "documents").select("doc_id", "text")
    return later_repeats(d, ["text"], "doc_id", "first_doc_id").select("doc_id", "first_doc_id")


def q_key_position(spark, sf):
    """M14 on conversations: running number of user turns in turn order."""
    c = t(spark, sf, "conversations").select("conv_id", "turn", "role")
    out = running_count(c, ["conv_id"], "turn", (F.col("role") == "user").cast("int"), "key_position")
    return out.where(F.col("role") == "user").select("conv_id", "turn", "key_position")


def _dict_inputs(spark, sf):
    fd = X.spark_derive(spark, X.FIELD_DEFS_SQL, part=t(spark, sf, "part"))
    td = X.spark_derive(spark, X.TABLE_DEFS_SQL, nation=t(spark, sf, "nation"), part=t(spark, sf, "part"))
    roles = spark.createDataFrame(X.CELL_ROLES, "sheet string, cell string, role string")
    td, fd = M.prepare(td, fd)
    return td, fd, roles


def q_yes_no(spark, sf):
    """M2: yes/no cells mapped to SI / NO / invalid, counted."""
    _, fd, _ = _dict_inputs(spark, sf)
    p = M.prepare_fields(fd)
    from ..functions import rules as R
    cells = p.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("cell"), F.col(f"{c}__raw").alias("raw"), F.col(c).alias("mapped"))
        for c in R.FIELD_FLAGS])))
    return cells.groupBy("cell", "mapped").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("raw").alias("n_filled"))


def q_not_applicable(spark, sf):
    """M3: not-applicable cells turned into NULL, counted per cell."""
    from ..functions.text import null_if_not_applicable
    _, fd, _ = _dict_inputs(spark, sf)
    cells = ["ejemplos", "catalogo", "longitud_landing", "sustento_criticidad"]
    u = fd.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("cell"), F.col(c).alias("raw"), null_if_not_applicable(F.col(c)).alias("kept"))
        for c in cells])))
    return u.groupBy("cell").agg(
        F.count_if(F.col("kept").isNull()).alias("n_not_applicable"),
        F.count("kept").alias("n_kept"))


def _issues(spark, sf, rules: tuple[str, ...] | None = None, with_role: bool = False):
    td, fd, roles = _dict_inputs(spark, sf)
    iss = M.lint(td, fd, roles)
    if rules is not None:
        iss = iss.where(F.col("rule").isin(list(rules)))
    cols = ["document", "sheet", "row", "cell", "rule", "severity"] + (["role"] if with_role else [])
    return iss.select(*cols)


def q_mandatory_cells(spark, sf):
    """M5: unfilled mandatory cells with the role that must fill them."""
    return _issues(spark, sf, ("mandatory",), with_role=True)


def q_allowed_values(spark, sf):
    """M6 + M11: table cells outside their lists, layer, classification, criticality."""
    return _issues(spark, sf, ("allowed_values", "layer", "classification", "criticality"))


def q_identifier_rule(spark, sf):
    """M7: table and field names that are not lower snake_case."""
    return _issues(spark, sf, ("identifier",))


def q_repeated_names(spark, sf):
    """M8 on the dictionary: later active rows repeating a valid field name."""
    td, fd, _ = _dict_inputs(spark, sf)
    rep = M.duplicate_name_issues(M.prepare_fields(fd))
    return rep.select("document", "row", "cell", "rule", "message")


def q_decimal_length(spark, sf):
    """M9: precision and scale of decimal fields (NULL when the length is malformed)."""
    _, fd, _ = _dict_inputs(spark, sf)
    typed = M.field_types(M.prepare_fields(fd))
    dec = typed.where(M.landing_format(F.col("formato_landing")) == "decimal")
    return dec.select("document", "row", "longitud_landing", "physical_type")


def q_type_mapping(spark, sf):
    """Landing format → logical and physical type for active fields."""
    _, fd, _ = _dict_inputs(spark, sf)
    typed = M.field_types(M.prepare_fields(fd))
    return typed.select("document", "row", "logical_type", "physical_type", "max_length")


def q_discard_filter(spark, sf):
    """Rows per document, active and discarded."""
    _, fd, _ = _dict_inputs(spark, sf)
    p = M.prepare_fields(fd)
    return p.groupBy("document").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if("active").alias("n_active"),
        F.count_if(~F.col("active")).alias("n_discarded"))


def q_sensitivity(spark, sf):
    """Contract classification of active fields, raised for sensitive public ones."""
    _, fd, _ = _dict_inputs(spark, sf)
    a = M.active_fields(M.prepare_fields(fd))
    return a.select("document", "row", M.classification(a).alias("classification"),
                    (F.col("dac") == "SI").alias("sensitive"), M.field_tags().alias("tags"))


def q_split_examples(spark, sf):
    """Up to four distinct examples in order, joined with '|'."""
    _, fd, _ = _dict_inputs(spark, sf)
    s = M.split_cells(M.prepare_fields(fd)).where(F.col("examples").isNotNull())
    return s.select("document", "row", F.array_join("examples", "|").alias("examples"),
                    F.size("examples").alias("n_examples"))


def q_split_values(spark, sf):
    """Allowed-values lists, joined with '|'."""
    _, fd, _ = _dict_inputs(spark, sf)
    s = M.split_cells(M.prepare_fields(fd)).where(F.col("values").isNotNull())
    return s.select("document", "row", F.array_join("values", "|").alias("vals"),
                    F.size("values").alias("n_values"))


def q_document_rollup(spark, sf):
    """M17 + M18 per document."""
    td, fd, _ = _dict_inputs(spark, sf)
    return M.document_rollup(td, fd)


def q_dictionary_lint(spark, sf):
    """Every issue of every document (errors and warnings)."""
    return _issues(spark, sf)


def q_dictionary_contracts(spark, sf):
    """M19 + M14: contract_fields rows of documents without errors."""
    td, fd, roles = _dict_inputs(spark, sf)
    return M.contract_fields(td, fd, M.lint(td, fd, roles))


def q_table_properties(spark, sf):
    """M17/M20 at table level: custom properties per document."""
    td, fd, _ = _dict_inputs(spark, sf)
    return M.table_properties(td, fd)


def q_attribute_pairs(spark, sf):
    """(property, value) pairs of active fields, documents without errors."""
    td, fd, _ = _dict_inputs(spark, sf)
    return M.attribute_pairs(td, fd).select("document", "row", "position", "property", "value")


def q_derive_checks(spark, sf):
    """Check rows per document, with the business rules added to some of them."""
    td, fd, _ = _dict_inputs(spark, sf)
    extra = X.spark_derive(spark, X.EXTRA_RULES_SQL, nation=t(spark, sf, "nation"), part=t(spark, sf, "part"))
    return M.derive_checks(td, fd, extra.withColumnRenamed("check_name", "check"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn for name, fn in globals().items() if name.startswith("q_") and callable(fn)
}
