"""Contract model: parsing, types, naming (no Spark session needed)."""

import pytest
from pyspark.sql import types as T

from lakepact.contract import Bound, Contract, ContractError, parse_type, resolve_target
from helpers import fixture_path


def test_parse_types():
    assert parse_type("STRING") == T.StringType()
    assert parse_type("DECIMAL(12,2)") == T.DecimalType(12, 2)
    assert parse_type("decimal( 12 , 2 )") == T.DecimalType(12, 2)
    assert parse_type("INTEGER") == T.IntegerType()
    assert parse_type("VARCHAR(5)") == T.StringType()
    assert parse_type("TIMESTAMP") == T.TimestampType()
    assert parse_type("numeric(9)") == T.DecimalType(9, 0)
    with pytest.raises(ContractError):
        parse_type("GEOGRAPHY")


def test_load_contracts_and_keys():
    c1 = Contract.load(fixture_path("berth_stays.odcs.yaml"))
    assert len(c1.fields) == 13 and c1.key == ["stay_id"]
    assert sum(f.required for f in c1.fields) == 9
    c2 = Contract.load(fixture_path("meter_readings.odcs.yaml"))
    assert c2.key == ["meter", "read_on"]
    assert not c2.field("litres_billed").required
    assert c2.model == "meter_reading"


def test_one_model_only():
    with pytest.raises(ContractError):
        Contract.from_dict({"id": "x", "schema": [{"name": "a", "properties": []}, {"name": "b", "properties": []}]})


def test_naming_convention():
    c = Contract.load(fixture_path("berth_stays.odcs.yaml"))
    t = resolve_target(c, "desa")
    assert t.fqn == "desa_landing.harbour_ops.berth_stay"
    assert t.spark_name() == "`desa_landing__harbour_ops`.`berth_stay`"
    with pytest.raises(ContractError):
        resolve_target(c, "qa")  # no such server


def test_naming_convention_violations():
    base = {
        "id": "x", "customProperties": [{"property": "capa", "value": "LANDING"},
                                        {"property": "schemaLanding", "value": "s1"}],
        "schema": [{"name": "t", "properties": [{"name": "a", "physicalType": "STRING"}]}],
    }
    bad_catalog = dict(base, servers=[{"server": "desa", "catalog": "desa_raw", "schema": "s1"}])
    with pytest.raises(ContractError, match="must be desa_landing.s1"):
        resolve_target(Contract.from_dict(bad_catalog), "desa")
    no_schema = dict(base, servers=[{"server": "desa", "catalog": "desa_landing", "schema": ""}])
    with pytest.raises(ContractError, match="found desa_landing"):
        resolve_target(Contract.from_dict(no_schema), "desa")
    other_schema = dict(base, servers=[{"server": "desa", "catalog": "desa_landing", "schema": "s2"}])
    with pytest.raises(ContractError, match="must be desa_landing.s1, found desa_landing.s2"):
        resolve_target(Contract.from_dict(other_schema), "desa")


def test_bounds():
    assert Bound("=", 0).holds(0) and not Bound("=", 0).holds(1)
    assert Bound(">", 0).holds(3) and not Bound(">", 0).holds(0)
    assert Bound("between", 1, 3).holds(2) and not Bound("between", 1, 3).holds(4)
    assert not Bound("=", 0).holds(None)


def test_three_part_name_when_catalog_configured(spark):
    c = Contract.load(fixture_path("berth_stays.odcs.yaml"))
    t = resolve_target(c, "prod")
    assert t.spark_name(spark) == "`prod_landing__harbour_ops`.`berth_stay`"
    spark.conf.set("spark.sql.catalog.prod_landing", "org.example.NotLoaded")
    try:
        assert t.spark_name(spark) == "`prod_landing`.`harbour_ops`.`berth_stay`"
    finally:
        spark.conf.unset("spark.sql.catalog.prod_landing")


def test_generated_ddl_matches_golden_artefact():
    from lakepact.operators.publish import create_table_ddl
    c = Contract.load(fixture_path("meter_readings.odcs.yaml"))
    ddl = create_table_ddl(c, "`desa_landing__water_ops`.`meter_reading`",
                           "/lake/desa_landing__water_ops/meter_reading/meter_reading_v0")
    with open(fixture_path("meter_readings.ddl.sql"), encoding="utf-8") as fh:
        assert ddl == fh.read().rstrip("\n")
