"""E1–E7 table states against the contract (structure step of a load)."""

import pytest

from lakepact import Contract, EvolutionRefused, apply_contract
from lakepact.contract import Field
from lakepact.operators.evolution import drift_verdict, schema_drift
from lakepact.operators.publish import ensure_table
from helpers import fixture_path, rebind


def _setup(spark, env):
    c = rebind(Contract.load(fixture_path("meter_readings.odcs.yaml")), env)
    res = apply_contract(spark, c, env, fixture_path("meter_readings_ok.csv"))
    ns = res.table.rsplit(".", 1)[0]
    return c, res.table, ns


def test_equal_and_optional_added(spark, lake, fresh_env):
    c, name, ns = _setup(spark, fresh_env)
    assert ensure_table(spark, c, name, ns) == ["existing table, structure unchanged"]
    c2 = c.with_fields(list(c.fields) + [Field("obs", "STRING", required=False, description="note")])
    assert ensure_table(spark, c2, name, ns) == ["column added: obs STRING"]
    rows = spark.table(name).collect()
    assert len(rows) == 8 and all(r.obs is None for r in rows)


def test_incompatible_changes_all_listed_nothing_changed(spark, lake, fresh_env):
    c, name, ns = _setup(spark, fresh_env)
    before = spark.table(name).schema
    fields = [f for f in c.fields if f.name != "reader"]  # table keeps a column the contract lacks
    fields = [Field(f.name, "STRING", required=f.required) if f.name == "litres" else f for f in fields]
    fields.append(Field("new_req", "STRING", required=True))
    with pytest.raises(EvolutionRefused) as e:
        ensure_table(spark, c.with_fields(fields), name, ns)
    assert len(e.value.problems) == 3
    text = "\n".join(e.value.problems)
    assert "reader" in text and "litres" in text and "new_req" in text
    assert spark.table(name).schema == before


def test_drift_over_many_tables(spark):
    tc = spark.createDataFrame(
        [("t1", "a", "int"), ("t1", "b", "string"), ("t2", "a", "bigint"), ("t2", "x", "string"), ("t3", "a", "int")],
        "table string, column string, type string")
    cf = spark.createDataFrame(
        [("t1", "a", 1, None, "INTEGER", True, None), ("t1", "b", 2, None, "VARCHAR(3)", True, None),
         ("t1", "c", 3, None, "DATE", False, None),
         ("t2", "a", 1, None, "INT", True, None), ("t2", "y", 2, None, "STRING", True, None),
         ("t9", "a", 1, None, "INT", True, None)],
        "contract string, field string, position int, logical_type string, physical_type string, required boolean, key_position int")
    d = {(r.table, r.column): r.change for r in schema_drift(tc, cf).collect()}
    assert d == {("t1", "a"): "unchanged", ("t1", "b"): "unchanged", ("t1", "c"): "new_optional",
                 ("t2", "a"): "type_mismatch", ("t2", "x"): "extra_column", ("t2", "y"): "new_required"}
    v = {r.table: (r.compatible, r.problems, r.columns_to_add) for r in drift_verdict(schema_drift(tc, cf)).collect()}
    assert v == {"t1": (True, 0, 1), "t2": (False, 3, 0)}


def test_inventories_from_catalog_tables(spark, lake, fresh_env):
    from lakepact.operators.evolution import contract_fields_frame
    from lakepact.sources.catalog import schema_of, table_columns_frame
    c, name, ns = _setup(spark, fresh_env)
    schema = schema_of(spark, name)
    assert list(schema)[:2] == ["meter", "read_on"]
    inv = table_columns_frame(spark, {c.id: spark.table(name).schema})
    drift = schema_drift(inv, contract_fields_frame(spark, [c]))
    assert {r.change for r in drift.collect()} == {"unchanged"}
