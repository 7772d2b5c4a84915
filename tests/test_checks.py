"""K1–K15 compilation and evaluation, R1/R2/F1."""


import pytest
import dataclasses
from lakepact import Contract, check_report, compile_checks, failing, verdict
from lakepact.contract import ContractError
from lakepact.operators import checks as K
from lakepact.operators.checks import REPORT_SCHEMA, fusable_predicate
from helpers import fixture_path


def test_expansion_totals():
    c1 = Contract.load(fixture_path("berth_stays.odcs.yaml"))
    c2 = Contract.load(fixture_path("meter_readings.odcs.yaml"))
    assert len(compile_checks(c1)) == 40
    assert len(compile_checks(c2)) == 39
    kinds = [s.kind for s in compile_checks(c2)]
    assert kinds.count("exclusive_minimum") == 1 and kinds.count("exclusive_minimum_equal") == 1
    assert kinds.count("unique") == 1  # composite key is one check


def test_fusable_predicates():
    assert fusable_predicate("SELECT COUNT(*) FROM t WHERE a <= 0", "t") == "a <= 0"
    assert fusable_predicate("select count(*) from t where a is not null and a < b;", "t") == "a is not null and a < b"
    assert fusable_predicate("SELECT COUNT(*) FROM (SELECT k FROM t GROUP BY k HAVING COUNT(DISTINCT v) > 1)", "t") is None
    assert fusable_predicate("SELECT COUNT(*) FROM other WHERE a = 1", "t") is None
    assert fusable_predicate("SELECT COUNT(*) FROM t WHERE a IN (SELECT x FROM u)", "t") is None


def _c(props, quality=()):
    return Contract.from_dict({"id": "c", "schema": [{"name": "m", "properties": props, "quality": list(quality)}]})


def test_null_rules(spark):
    c = _c([{"name": "v", "physicalType": "STRING", "required": True,
             "logicalTypeOptions": {"pattern": "^[A-Z]$", "minLength": 1},
             "quality": [{"type": "library", "metric": "invalidValues", "arguments": {"validValues": ["A"]},
                          "mustBe": 0, "name": "vv"}]}])
    df = spark.createDataFrame([("A",), (None,), ("b",)], "v string")
    rep = {r.check: r.metric for r in check_report(df, c).collect()}
    assert rep["v:required"] == 1      # only `required` reports the NULL
    assert rep["vv"] == 1              # "b"; NULL is not a violation
    assert rep["v:pattern"] == 1
    assert rep["v:min_length"] == 0


def test_composite_key_nulls_group_together(spark):
    c = _c([{"name": "a", "physicalType": "STRING", "primaryKey": True, "primaryKeyPosition": 1},
            {"name": "b", "physicalType": "STRING", "primaryKey": True, "primaryKeyPosition": 2}])
    df = spark.createDataFrame([("x", None), ("x", None), ("x", "1")], "a string, b string")
    r = [r for r in check_report(df, c).collect() if r.kind == "unique"][0]
    assert r.metric == 1 and r.result == "failed" and "2 rows" in r.detail


def test_sql_rules_fused_and_grouped(spark):
    c = _c([{"name": "k", "physicalType": "STRING"}, {"name": "v", "physicalType": "STRING"},
            {"name": "n", "physicalType": "INT"}],
           [{"type": "sql", "name": "neg", "mustBe": 0, "query": "SELECT COUNT(*) FROM m WHERE n < 0"},
            {"type": "sql", "name": "fd", "mustBe": 0,
             "query": "SELECT COUNT(*) FROM (SELECT k FROM m GROUP BY k HAVING COUNT(DISTINCT v) > 1)"}])
    specs = {s.name: s.plan for s in compile_checks(c)}
    assert specs["neg"] == "fused" and specs["fd"] == "sql"
    df = spark.createDataFrame([("a", "1", -1), ("a", "2", 3), ("b", "1", 0)], "k string, v string, n int")
    rep = {r.check: (r.metric, r.result) for r in check_report(df, c).collect()}
    assert rep["neg"] == (1, "failed") and rep["fd"] == (1, "failed")
    assert not df.sparkSession.catalog.tableExists("m")  # the model view is gone


def test_long_value_list_is_one_plan_and_carries_its_labels(spark):
    c = _c([{"name": "v", "physicalType": "STRING", "quality": [
        {"type": "library", "metric": "invalidValues", "arguments": {"validValues": ["a", *(f"v{i}" for i in range(20_000))]},
         "mustBe": 0, "name": "vv", "description": "known codes", "dimension": "conformity", "severity": "warning"}]}])
    assert [(s.plan, s.description) for s in compile_checks(c) if s.name == "vv"] == [("fused", "known codes")]
    df = spark.createDataFrame([("a",), ("z",), (None,), ("z",)], "v string")
    rep = {r.check: r for r in check_report(df, c).collect()}
    assert (rep["vv"].metric, rep["vv"].description, rep["vv"].severity, rep["vv"].bound) == (2, "known codes", "warning", "= 0")
    assert rep["v:type"].description is None


def test_report_schema_verdict_failing(spark):
    c = _c([{"name": "v", "physicalType": "INT", "required": True}], [
        {"type": "library", "metric": "rowCount", "mustBeGreaterThan": 0, "name": "rows"}])
    df = spark.createDataFrame([(1,), (None,)], "v int")
    rep = check_report(df, c)
    assert [f.name for f in rep.schema] == [f.name for f in REPORT_SCHEMA]
    v = verdict(rep).collect()[0]
    assert (v.passed, v.checks, v.failed) == (False, 4, 1)
    assert [r.check for r in failing(rep).collect()] == ["v:required"]
    ok = spark.createDataFrame([(1,)], "v int")
    assert failing(check_report(ok, c)).count() == 4  # all shown when none fails


def test_one_scan_for_fused_checks(spark):
    """All per-row checks of a contract compile to ONE aggregate over one scan."""
    c = Contract.load(fixture_path("meter_readings.odcs.yaml"))
    df = spark.createDataFrame([], c.spark_schema())
    one = df.agg(*K.fused_metrics(df, compile_checks(c)))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") <= 1


def test_hash_first_key_check_is_exact_under_collisions(spark):
    import random
    from pyspark.sql import functions as F
    rnd = random.Random(3)
    rows = [(f"k{rnd.randint(0, 60)}", rnd.choice([None, "a", "b"])) for _ in range(400)]
    df = spark.createDataFrame(rows, "a string, b string")
    exact = K.duplicate_keys(df, ["a", "b"], "exact").collect()[0]
    crowded = K.duplicate_keys(df, ["a", "b"], "hash_first",
                               hash_fn=lambda cs: F.xxhash64(*cs) % 5).collect()[0]  # forced collisions
    plain = K.duplicate_keys(df, ["a", "b"], "hash_first").collect()[0]
    assert (exact.groups, exact.rows) == (crowded.groups, crowded.rows) == (plain.groups, plain.rows)
    assert K._narrow_key(spark.range(1), ["id"]) and not K._narrow_key(df, ["a"])


def test_empty_contract_gives_empty_report(spark):
    c = _c([])
    rep = check_report(spark.range(3), c, specs=compile_checks(c, include_schema=False))
    assert rep.count() == 0 and verdict(rep).collect()[0].passed


def test_concurrent_sql_rules_same_model_name(spark):
    from concurrent.futures import ThreadPoolExecutor
    c = _c([{"name": "k", "physicalType": "STRING"}, {"name": "v", "physicalType": "STRING"}],
           [{"type": "sql", "name": "fd", "mustBe": 0,
             "query": "SELECT COUNT(*) FROM (SELECT k FROM m GROUP BY k HAVING COUNT(DISTINCT v) > 1)"}])
    frames = [spark.createDataFrame([("a", str(i)), ("a", str(i + 1))] * (i % 2) + [("b", "x")],
                                    "k string, v string") for i in range(8)]
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda df: [r.metric for r in check_report(df, c).collect() if r.check == "fd"][0], frames))
    assert got == [i % 2 for i in range(8)]


def test_custom_rules_are_reported_as_not_run(spark):
    c = _c([{"name": "a", "physicalType": "STRING",
             "quality": [{"type": "text", "description": "values come from the sales system"}]}],
           [{"type": "custom", "engine": "other", "implementation": "..."}])
    assert [s.kind for s in compile_checks(c)] == ["present", "type", "not_run"]
    last = check_report(spark.createDataFrame([("x",)], "a string"), c).collect()[-1]
    assert last.severity == "info" and last.detail.startswith("not run")


def test_sql_rule_values_are_judged_as_they_are(spark):
    ask = lambda q, **bound: {"type": "sql", "name": q, "query": f"SELECT {q} FROM m", **bound}
    c = _c([{"name": "n", "physicalType": "INT"}],
           [ask("0.9 * max(n) / max(n)", mustBe=0), ask("n", mustBe=1), ask("max(n)", mustBeGreaterThan=5, mustBeLessThan=8),
            ask("max(n) - 4", mustBeGreaterThan=5, mustBeLessThan=8)])
    c = c.with_rules([dataclasses.replace(r, query=r.query.replace(" m", f" {c.model}")) for r in c.rules])
    rep = check_report(spark.createDataFrame([(1,), (10,)], "n int"), c).collect()[2:]
    assert [r.result for r in rep] == ["failed", "failed", "failed", "passed"]
    assert rep[0].metric is None and "0.9" in rep[0].detail and "2 rows" in rep[1].detail
    two = c.with_rules([dataclasses.replace(c.rules[1], query=f"SELECT 1, 2 FROM {c.model}")])
    with pytest.raises(ContractError):
        check_report(spark.createDataFrame([(1,)], "n int"), two)


def test_percent_is_refused():
    with pytest.raises(ContractError):
        _c([{"name": "a", "physicalType": "STRING", "quality": [
            {"metric": "nullValues", "mustBeLessThan": 5, "unit": "percent"}]}])


def test_sql_rule_placeholders(spark):
    c = _c([{"name": "n", "physicalType": "INT", "quality": [
        {"type": "sql", "name": "negatives", "mustBe": 0, "query": "SELECT COUNT(*) FROM {model} WHERE {field} < 0"},
        {"type": "sql", "name": "repeats", "mustBe": 0,
         "query": "SELECT COUNT(*) FROM (SELECT {column} FROM {table} GROUP BY {column} HAVING COUNT(*) > 1)"}]}])
    plans = {s.name: s.plan for s in compile_checks(c)}
    assert plans == {"n:present": "schema", "n:type": "schema", "negatives": "fused", "repeats": "sql"}
    df = spark.createDataFrame([(1,), (-2,), (1,)], "n int")
    rep = {r.check: r.metric for r in check_report(df, c).collect()}
    assert rep["negatives"] == 1 and rep["repeats"] == 1
