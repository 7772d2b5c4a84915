"""The commit of a load: one successor per version, whatever loads do at the same time."""

import threading

import pytest

from helpers import fixture_path, rebind
from lakepact import Contract, ContractError, GateFailed, apply_all, apply_contract
from lakepact.operators import publish
from lakepact.plans import apply as plan
from lakepact.sources.catalog import table_location
from lakepact.suite import contracts as C


def _ok(env):
    return rebind(Contract.load(fixture_path("berth_stays.odcs.yaml")), env), fixture_path("berth_stays_ok.csv")


def test_two_loads_between_test_and_switch(spark, lake, fresh_env, monkeypatch):
    c, source = _ok(fresh_env)
    first = apply_contract(spark, c, fresh_env, source)
    barrier = threading.Barrier(2, timeout=120)

    def together(*args):
        barrier.wait()  # both loads have staged, and both saw the same current version
        return publish.claim_switch(*args)

    monkeypatch.setattr(plan, "claim_switch", together)
    out = apply_all(spark, [(c, fresh_env, source)] * 2, max_parallel=2)
    assert sorted(o.status for o in out) == ["error", "loaded"]
    assert "another load published" in next(o.message for o in out if o.status == "error")
    versions = publish.published_versions(spark, first.table)
    assert len(versions) == 3 and table_location(spark, first.table) == versions[-1]
    assert spark.table(first.table).count() == 8


def test_claim_is_created_once(spark, tmp_path):
    won = []
    barrier = threading.Barrier(8, timeout=60)

    def one(i):
        barrier.wait()
        if publish._create_once(spark, f"file:{tmp_path}/claim", f"v{i}"):
            won.append(i)

    threads = [threading.Thread(target=one, args=(i,)) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and publish._read_text(spark, f"file:{tmp_path}/claim") == f"v{won[0]}"
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("claim.")]


@pytest.mark.parametrize("complete", [True, False])
def test_half_done_switch_is_recovered(spark, lake, fresh_env, complete):
    c, source = _ok(fresh_env)
    res = apply_contract(spark, c, fresh_env, source)
    current = table_location(spark, res.table)
    staged = publish.next_version_path(spark, res.table)
    if complete:  # its rows were written and passed; the load died before its switch
        spark.table(res.table).limit(5).coalesce(1).write.parquet(staged)
    publish.claim_switch(spark, res.table, current, staged)
    with pytest.raises(ContractError, match="load again"):
        apply_contract(spark, c, fresh_env, source)
    at = table_location(spark, res.table).rstrip("/")
    assert at.endswith(staged.rsplit("/", 1)[1] if complete else current.rsplit("/", 1)[1])
    assert spark.table(res.table).count() == (5 if complete else 8)
    assert apply_contract(spark, c, fresh_env, source).rows_loaded == 8


def test_rollback_leaves_the_table_loadable(spark, lake, fresh_env, monkeypatch):
    c, source = _ok(fresh_env)
    res = apply_contract(spark, c, fresh_env, source)
    before = table_location(spark, res.table)
    real = plan.run_checks
    monkeypatch.setattr(plan, "run_checks", lambda *a, **k: plan.Outcome(False, real(*a, **k).report))
    with pytest.raises(ContractError):
        apply_contract(spark, c, fresh_env, source, rollback=True)
    assert table_location(spark, res.table) == before
    monkeypatch.undo()
    assert apply_contract(spark, c, fresh_env, source).rows_loaded == 8


def test_rule_of_another_engine_neither_passes_nor_fails(spark, lake, fresh_env):
    c = rebind(C.with_custom_rule(), fresh_env)
    rows = spark.sql("SELECT '1' AS s_suppkey, '2.50' AS s_acctbal")
    with pytest.raises(GateFailed, match="balance_profile"):
        apply_contract(spark, c, fresh_env, rows, not_run_blocks=True)
    res = apply_contract(spark, c, fresh_env, rows)
    assert res.passed and res.not_run == ["balance_profile"] and res.rows_loaded == 1
    assert {r.result for r in res.gate} == {"passed", "not_run"}
    assert next(r.metric for r in res.gate if r.result == "not_run") is None
