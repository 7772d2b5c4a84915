"""W1/W2 end to end with the golden counts, seeded errors and failure injection."""

import pytest
from pyspark.sql import functions as F

from lakepact import Contract, ContractError, GateFailed, apply_all, apply_contract, read_landing_text
from lakepact.sources.catalog import table_location
from helpers import fixture_path, rebind


def _load(name, env):
    return rebind(Contract.load(fixture_path(f"{name}.odcs.yaml")), env)


def test_berth_stays_ok_then_errors(spark, lake, fresh_env):
    c = _load("berth_stays", fresh_env)
    res = apply_contract(spark, c, fresh_env, fixture_path("berth_stays_ok.csv"))
    assert len(res.gate) == 40 and all(r.result == "passed" for r in res.gate)
    assert res.rows_read == 8 and res.rows_loaded == 8
    assert all(r.result == "passed" for r in res.post)
    assert res.actions[0].startswith("table created")
    loc = table_location(spark, res.table)

    with pytest.raises(GateFailed) as e:
        apply_contract(spark, c, fresh_env, fixture_path("berth_stays_errors.csv"))
    failed = sorted(r.check for r in e.value.report if r.result != "passed")
    assert failed == sorted(["stay_id:unique", "ship:required", "cargo_kinds", "berth_on_one_quay",
                             "leaves_after_mooring"])
    assert len(e.value.report) == 40 and e.value.current_rows == 8
    assert spark.table(res.table).count() == 8 and table_location(spark, res.table) == loc


def test_meter_readings_ok_then_errors(spark, lake, fresh_env):
    c = _load("meter_readings", fresh_env)
    res = apply_contract(spark, c, fresh_env, fixture_path("meter_readings_ok.csv"))
    assert len(res.gate) == 39 and res.passed and res.rows_loaded == 8
    with pytest.raises(GateFailed) as e:
        apply_contract(spark, c, fresh_env, fixture_path("meter_readings_errors.csv"))
    failed = sorted(r.check for r in e.value.report if r.result != "passed")
    assert failed == sorted([
        "meter+read_on:unique", "meter:min_length", "meter:max_length", "plant:pattern", "known_method",
        "litres:exclusive_minimum_equal", "billed_within_reading", "reader:required"])
    assert spark.table(res.table).count() == 8


def test_second_good_load_replaces_rows(spark, lake, fresh_env):
    c = _load("berth_stays", fresh_env)
    apply_contract(spark, c, fresh_env, fixture_path("berth_stays_ok.csv"))
    text = read_landing_text(spark, fixture_path("berth_stays_ok.csv")).limit(3)
    res = apply_contract(spark, c, fresh_env, text)
    assert res.rows_loaded == 3 and spark.table(res.table).count() == 3


def test_empty_file_fails_only_row_count(spark, lake, fresh_env, tmp_path):
    c = _load("berth_stays", fresh_env)
    header = open(fixture_path("berth_stays_ok.csv"), encoding="utf-8").readline()
    p = tmp_path / "empty.csv"
    p.write_text(header, encoding="utf-8")
    with pytest.raises(GateFailed) as e:
        apply_contract(spark, c, fresh_env, str(p))
    assert [r.check for r in e.value.report if r.result != "passed"] == ["some_stays"]


def test_missing_columns(spark, lake, fresh_env):
    c = _load("meter_readings", fresh_env)
    text = read_landing_text(spark, fixture_path("meter_readings_ok.csv"))
    res = apply_contract(spark, c, fresh_env, text.drop("litres_billed"))  # optional: passes
    assert res.passed
    with pytest.raises(GateFailed) as e:
        apply_contract(spark, c, fresh_env, text.drop("reader"))  # required: fails
    assert [r.check for r in e.value.report if r.result != "passed"] == ["reader:required"]


def test_error_during_publish_keeps_rows(spark, lake, fresh_env):
    c = _load("berth_stays", fresh_env)
    res = apply_contract(spark, c, fresh_env, fixture_path("berth_stays_ok.csv"))
    loc = table_location(spark, res.table)
    text = read_landing_text(spark, fixture_path("berth_stays_ok.csv"))
    boom = text.withColumn("ship", F.when(F.col("stay_id") == "S-5005", F.raise_error(F.lit("injected failure")))
                           .otherwise(F.col("ship")))
    with pytest.raises(Exception, match="injected failure"):
        apply_contract(spark, c, fresh_env, boom)
    assert spark.table(res.table).count() == 8 and table_location(spark, res.table) == loc
    import os
    parent = loc.replace("file:", "").rsplit("/", 1)[0]
    assert sorted(os.listdir(parent)) == sorted(n for n in os.listdir(parent) if n <= loc.rsplit("/", 1)[1])


def test_apply_all_independent_jobs(spark, lake, fresh_env):
    ok = _load("berth_stays", fresh_env)
    meters = _load("meter_readings", fresh_env)
    out = apply_all(spark, [(ok, fresh_env, fixture_path("berth_stays_ok.csv")),
                            (meters, fresh_env, fixture_path("meter_readings_errors.csv"))])
    by = {o.contract: o for o in out}
    assert by[ok.id].status == "loaded" and by[ok.id].rows_loaded == 8
    assert by[meters.id].status == "gate_failed" and by[meters.id].failed == 8 and by[meters.id].checks == 39


def test_overwrite_mode_and_retention(spark, lake, fresh_env):
    from lakepact.operators.publish import prune_versions, publish
    from lakepact.operators.shape import type_columns
    import os

    c = _load("berth_stays", fresh_env)
    res = apply_contract(spark, c, fresh_env, fixture_path("berth_stays_ok.csv"))
    typed = type_columns(read_landing_text(spark, fixture_path("berth_stays_ok.csv")), c)
    out = publish(spark, typed.limit(5), res.table, mode="overwrite")   # the reference's plain overwrite
    assert out.rows == 5 and out.location == out.previous
    for n in (4, 3, 2):
        out = publish(spark, typed.limit(n), res.table)                 # versioned switch
        assert out.rows == n and out.location != out.previous
    parent = out.location.replace("file:", "").rsplit("/", 1)[0]
    before = sorted(os.listdir(parent))
    removed = prune_versions(spark, res.table, keep=2)
    after = sorted(os.listdir(parent))
    assert len(removed) == len(before) - 2 and len(after) == 2
    assert spark.table(res.table).count() == 2


def test_rule_that_is_not_a_row_predicate_falls_back_to_sql(spark, lake, fresh_env):
    from lakepact.contract import Rule, Bound
    c = _load("berth_stays", fresh_env)
    odd = Rule(name="more_than_one_ship", type="sql", bound=Bound("=", 0.0),
               query="SELECT COUNT(*) FROM berth_stay WHERE count(ship) > 100")
    c = c.with_rules(list(c.rules) + [odd])
    with pytest.raises(Exception):
        # an aggregate in WHERE is invalid SQL: the rule fails loudly as SQL, not inside observe
        apply_contract(spark, c, fresh_env, fixture_path("berth_stays_ok.csv"))
    import os
    from lakepact.sources.catalog import table_location
    from lakepact.contract import resolve_target
    name = resolve_target(c, fresh_env).spark_name(spark)
    loc = table_location(spark, name).replace("file:", "")
    assert set(os.listdir(loc.rsplit("/", 1)[0])) <= {loc.rsplit("/", 1)[1]}  # no staged debris left
    from lakepact.operators.checks import compile_checks, usable_fused
    df = read_landing_text(spark, fixture_path("berth_stays_ok.csv"))
    plans = {s.name: s.plan for s in usable_fused(df, compile_checks(c))}
    assert plans["more_than_one_ship"] == "sql"


def test_schema_only_post_check(spark, lake, fresh_env):
    c = _load("berth_stays", fresh_env)
    res = apply_contract(spark, c, fresh_env, fixture_path("berth_stays_ok.csv"), post_check="schema")
    assert len(res.gate) == 40 and len(res.post) == 27 and res.passed


def test_publish_mode_overwrite_and_standalone_gate(spark, lake, fresh_env):
    from lakepact import gate
    c = _load("meter_readings", fresh_env)
    res = apply_contract(spark, c, fresh_env, fixture_path("meter_readings_ok.csv"), publish_mode="overwrite")
    assert res.rows_loaded == 8 and res.location is None and res.passed
    typed = __import__("lakepact").type_columns(read_landing_text(spark, fixture_path("meter_readings_errors.csv")), c)
    with pytest.raises(GateFailed) as e:
        gate(typed, c, table=res.table, materialize=True)
    assert e.value.current_rows == 8


def test_declared_local_source(spark, tmp_path):
    import dataclasses
    from lakepact.plans.apply import check_declared_source
    c = Contract.load(fixture_path("meter_readings.odcs.yaml"))
    servers = tuple(dataclasses.replace(s, path=fixture_path("meter_readings_errors.csv")) if s.server == "local" else s
                    for s in c.servers)
    c = dataclasses.replace(c, servers=servers)
    out = check_declared_source(spark, c, "local")
    assert not out.passed and len(out.failed) == 8 and len(out.report) == 39


def test_delivery_as_list_of_files(spark, lake, fresh_env, tmp_path):
    c = _load("berth_stays", fresh_env)
    a, b = tmp_path / "a.csv", tmp_path / "b.csv"
    lines = open(fixture_path("berth_stays_ok.csv"), encoding="utf-8").read().splitlines()
    a.write_text("\n".join(lines[:5]) + "\n", encoding="utf-8")
    b.write_text("\n".join([lines[0]] + lines[5:]) + "\n", encoding="utf-8")
    res = apply_contract(spark, c, fresh_env, [str(a), str(b)])
    assert res.rows_loaded == 8 and res.passed


def test_latin1_delivery(spark, lake, fresh_env, tmp_path):
    c = _load("meter_readings", fresh_env)
    text = open(fixture_path("meter_readings_ok.csv"), encoding="utf-8").read().replace("Mill Lane", "Calle Peñón")
    p = tmp_path / "latin1.csv"
    p.write_bytes(text.encode("latin-1"))
    res = apply_contract(spark, c, fresh_env, str(p), encoding="ISO-8859-1")
    names = {r.street for r in spark.table(res.table).collect()}
    assert "Calle Peñón" in names and res.rows_loaded == 8


def test_malformed_rows_check(spark, lake, fresh_env, tmp_path):
    c = _load("meter_readings", fresh_env)
    lines = open(fixture_path("meter_readings_ok.csv"), encoding="utf-8").read().splitlines()
    head = lines[0] + ",extra_note"                      # a surplus column the contract does not read
    body = [ln + ",n" for ln in lines[1:]]
    body[2] = body[2] + ",surplus cell"                  # one cell too many
    body[5] = ",".join(body[5].split(",")[:-3])          # three cells short
    p = tmp_path / "ragged.csv"
    p.write_text("\n".join([head, *body]) + "\n", encoding="utf-8")
    with pytest.raises(GateFailed) as e:
        apply_contract(spark, c, fresh_env, str(p), malformed_rows=True)
    bad = {r.check: r.metric for r in e.value.report if r.result != "passed"}
    assert bad.get("delivery:malformed_rows") == 2
    assert len(e.value.report) == 41                     # 39 contract checks, the opt-in one, 1 surplus info row
    assert [r.check for r in e.value.report if r.severity == "info"] == ["extra_note:surplus"]
    res = apply_contract(spark, c, fresh_env, fixture_path("meter_readings_ok.csv"), malformed_rows=True)
    assert res.passed and res.surplus_columns == []


def test_surplus_columns_reported_as_information(spark, lake, fresh_env):
    from pyspark.sql import functions as F
    c = _load("meter_readings", fresh_env)
    text = read_landing_text(spark, fixture_path("meter_readings_ok.csv")).withColumn("nota", F.lit("x"))
    res = apply_contract(spark, c, fresh_env, text)
    info = [r for r in res.gate if r.severity == "info"]
    assert res.passed and len(res.gate) == 40 and [(r.check, r.result) for r in info] == [("nota:surplus", "passed")]
    assert res.surplus_columns == ["nota"]


def test_retention_spares_newer_in_flight_stages(spark, lake, fresh_env):
    import os
    from lakepact.operators.publish import next_version_path, prune_versions
    c = _load("berth_stays", fresh_env)
    res = apply_contract(spark, c, fresh_env, fixture_path("berth_stays_ok.csv"))
    apply_contract(spark, c, fresh_env, fixture_path("berth_stays_ok.csv"))
    in_flight = next_version_path(spark, res.table).replace("file:", "")
    os.makedirs(in_flight)                                   # a stage another load is still writing
    removed = prune_versions(spark, res.table, keep=1)
    assert os.path.isdir(in_flight) and len(removed) >= 1
    assert spark.table(res.table).count() == 8


def test_load_refused_when_another_published_meanwhile(spark, lake, fresh_env, monkeypatch):
    import lakepact.plans.apply as A

    c = _load("berth_stays", fresh_env)
    apply_contract(spark, c, fresh_env, fixture_path("berth_stays_ok.csv"))
    real, seen = A.check_report, []

    def slow_report(*args, **kw):  # a second load runs from start to end while the first is checked
        if not seen:
            seen.append(1)
            seen.append(apply_contract(spark, c, fresh_env, fixture_path("berth_stays_ok.csv")))
        return real(*args, **kw)

    monkeypatch.setattr(A, "check_report", slow_report)
    with pytest.raises(ContractError, match="another load"):
        apply_contract(spark, c, fresh_env, fixture_path("berth_stays_ok.csv"))
    assert spark.table(seen[1].table).count() == seen[1].rows_loaded
