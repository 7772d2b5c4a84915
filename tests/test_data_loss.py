"""Cases in which rows, tables or outcomes could be lost without trace."""

import os

import pytest
from pyspark.sql import functions as F

from lakepact import Contract, apply_contract, read_landing_text
from lakepact.contract import ContractError
from lakepact.operators.publish import prune_versions, published_versions, publish
from lakepact.operators.windows import later_repeats, running_count
from lakepact.plans.apply import apply_all

from helpers import fixture_path, rebind


def _small(env, table="sales"):
    doc = {"id": table, "schema": [{"name": table, "physicalName": table, "properties": [
        {"name": "a", "physicalType": "INT"}, {"name": "b", "physicalType": "INT"}]}],
        "servers": [{"server": env, "type": "databricks", "catalog": f"{env}_landing", "schema": "s"}],
        "customProperties": [{"property": "capa", "value": "LANDING"}]}
    return Contract.from_dict(doc)


def test_files_in_another_column_order_are_refused(spark, lake, fresh_env, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "d" / "2.csv").write_text("b,a\n3,4\n")
    with pytest.raises(Exception):
        apply_contract(spark, _small(fresh_env), fresh_env, str(tmp_path / "d"))
    (tmp_path / "d" / "2.csv").write_text("a,b\n4,3\n")
    res = apply_contract(spark, _small(fresh_env), fresh_env, str(tmp_path / "d"))
    assert {tuple(r) for r in spark.table(res.table).collect()} == {(1, 2), (4, 3)}


def test_ragged_rows_are_refused_by_default(spark, lake, fresh_env, tmp_path):
    p = tmp_path / "r.csv"
    p.write_text("a,b\n1,2,99\n3,4\n")
    with pytest.raises(ContractError):
        apply_contract(spark, _small(fresh_env), fresh_env, str(p))
    assert read_landing_text(spark, str(p), mode="PERMISSIVE").count() == 2


def test_retention_leaves_other_tables_and_stages(spark, lake, fresh_env, tmp_path):
    p = tmp_path / "r.csv"
    p.write_text("a,b\n1,2\n")
    sales, near = _small(fresh_env, "sales"), _small(fresh_env, "sales_v1")
    one = apply_contract(spark, sales, fresh_env, str(p))
    two = apply_contract(spark, near, fresh_env, str(p))
    for _ in range(3):
        publish(spark, spark.table(one.table), one.table)
    folder = published_versions(spark, one.table)[-1]
    stage = folder.replace("file:", "").rsplit("/", 1)[0] + "/sales_v00000000000000000001_abcdef"
    os.makedirs(stage)  # older by name, but never published
    removed = prune_versions(spark, one.table, keep=1)
    assert removed and os.path.isdir(stage) and len(published_versions(spark, one.table)) == 1
    assert spark.table(one.table).count() == 1 and spark.table(two.table).count() == 1


def test_old_versions_go_after_a_good_load(spark, lake, fresh_env, tmp_path):
    p = tmp_path / "r.csv"
    p.write_text("a,b\n1,2\n")
    for _ in range(4):
        res = apply_contract(spark, _small(fresh_env), fresh_env, str(p), keep_versions=2)
    assert len(published_versions(spark, res.table)) == 2 and spark.table(res.table).count() == 1


def test_one_bad_job_keeps_the_other_outcomes(spark, lake, fresh_env):
    c = rebind(Contract.load(fixture_path("berth_stays.odcs.yaml")), fresh_env)
    out = apply_all(spark, [(c, fresh_env, "/nowhere/at/all.csv"), (c, fresh_env, fixture_path("berth_stays_ok.csv"))],
                    max_parallel=1)
    assert [o.status for o in out] == ["error", "loaded"] and "all.csv" in out[0].message


def test_null_keys_stay(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 4), ("b", 5)], "k string, n int")
    assert {(r.k, r.n, r.first_seen) for r in later_repeats(df, ["k"], "n").collect()} == {(None, 2, 1), ("a", 4, 3)}
    got = running_count(df, ["k"], "n", F.lit(True), "c", block=2)
    assert {(r.k, r.n, r.c) for r in got.collect()} == {(None, 1, 1), (None, 2, 2), ("a", 3, 1), ("a", 4, 2), ("b", 5, 1)}
