"""The reference's seven-step end-to-end smoke flow, on Spark, asserted step by step."""

import dataclasses

import pytest

from lakepact import Contract, GateFailed, apply_contract
from lakepact.contract import Field
from lakepact.operators.diff import contract_diff, diff_verdict
from lakepact.operators.evolution import contract_fields_frame
from lakepact.operators.publish import create_table_ddl, ensure_table
from lakepact.plans import dictionary as M
from helpers import fixture_path, rebind
from test_dictionary import GOOD_TABLE, _defs, _field


def test_seven_steps(spark, lake, fresh_env):
    # 1-2. scope document → contract rows; a badly filled document stops with every error
    bad_table = dict(GOOD_TABLE, tabla_landing="De Maestro", dominio="Canales")
    td, fd = _defs(spark, [bad_table], [_field(10, "cod", pk="SI", nombre_modelado="Cod Canal"),
                                        _field(11, "des", definicion=None), _field(12, "tip", formato_landing="Numerico")])
    assert M.lint(td, fd).where("severity = 'error'").count() == 5
    assert M.contract_fields(td, fd).count() == 0
    td, fd = _defs(spark, [GOOD_TABLE], [_field(10, "cod", pk="SI"), _field(11, "des")])
    assert M.contract_fields(td, fd).count() == 2

    # 3. artefacts: DDL from the contract
    c = rebind(Contract.load(fixture_path("berth_stays.odcs.yaml")), fresh_env)
    assert create_table_ddl(c, "`x`.`t`", "/lake/t").startswith("CREATE TABLE IF NOT EXISTS `x`.`t` (")

    # 4. good data passes (40 checks, 8 rows)
    res = apply_contract(spark, c, fresh_env, fixture_path("berth_stays_ok.csv"))
    assert len(res.gate) == 40 and res.rows_loaded == 8

    # 5. bad data fails (5 checks) and nothing is written
    with pytest.raises(GateFailed) as e:
        apply_contract(spark, c, fresh_env, fixture_path("berth_stays_errors.csv"))
    assert len([r for r in e.value.report if r.result != "passed"]) == 5
    assert spark.table(res.table).count() == 8

    # 6. compatible change: a new optional field passes the diff and is added to the table
    v2 = dataclasses.replace(c, version="1.1.0", fields=c.fields + (Field("remark", "STRING"),))
    old, new = contract_fields_frame(spark, [c]), contract_fields_frame(spark, [v2])
    assert not diff_verdict(contract_diff(old, new), old, new).collect()[0].breaking
    assert ensure_table(spark, v2, res.table, res.table.rsplit(".", 1)[0]) == ["column added: remark STRING"]

    # 7. breaking change: a removed field is blocked
    v3 = dataclasses.replace(c, version="2.0.0",
                             fields=tuple(f for f in c.fields if f.name != "flag"))
    new3 = contract_fields_frame(spark, [v3])
    assert diff_verdict(contract_diff(old, new3), old, new3).collect()[0].breaking
