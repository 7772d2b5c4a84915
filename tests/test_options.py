"""Opt-in cast-loss rows, raw presence checks, and the streaming landing watcher."""

import shutil

import pytest

from lakepact import Contract, GateFailed, apply_contract, read_landing_text
from lakepact.streaming.landing import MARKER, Refused, watch_landing
from helpers import fixture_path, rebind


def test_cast_loss_rows(spark, lake, fresh_env, tmp_path):
    c = rebind(Contract.load(fixture_path("meter_readings.odcs.yaml")), fresh_env)
    text = read_landing_text(spark, fixture_path("meter_readings_ok.csv"))
    from pyspark.sql import functions as F
    bad = text.withColumn("litres_billed", F.when(F.col("litres_billed").isNotNull(), F.lit("31/12/2026")))
    res = apply_contract(spark, c, fresh_env, bad, cast_loss=True)
    loss = {r.field: r.metric for r in res.gate if r.kind == "cast_loss"}
    assert loss["litres_billed"] == 1 and loss["litres"] == 0
    assert res.passed  # informational only: an unreadable optional date still passes, as in the reference


def test_raw_presence(spark, lake, fresh_env):
    c = rebind(Contract.load(fixture_path("meter_readings.odcs.yaml")), fresh_env)
    text = read_landing_text(spark, fixture_path("meter_readings_ok.csv")).drop("litres_billed")
    with pytest.raises(GateFailed) as e:
        apply_contract(spark, c, fresh_env, text, raw_schema_checks=True)
    assert [r.check for r in e.value.report if r.result != "passed"] == ["litres_billed:present"]


def test_landing_stream(spark, lake, fresh_env, tmp_path):
    c = rebind(Contract.load(fixture_path("berth_stays.odcs.yaml")), fresh_env)
    folder = tmp_path / "landing"
    head, *rows = open(fixture_path("berth_stays_ok.csv"), encoding="utf-8").read().splitlines()
    (folder / "d1").mkdir(parents=True)
    for i, row in enumerate(rows):  # one delivery of many files
        (folder / "d1" / f"part{i}.csv").write_text(f"{head}\n{row}\n", encoding="utf-8")
    (folder / "d0").mkdir()
    shutil.copy(fixture_path("berth_stays_errors.csv"), folder / "d0" / "x.csv")  # not marked complete
    (folder / "d1" / MARKER).write_text("done")
    seen = []
    q = watch_landing(spark, c, fresh_env, str(folder), available_now=True,
                      checkpoint=str(tmp_path / "ckpt"), on_result=lambda b, o: seen.append(o))
    q.awaitTermination(120)
    assert len(seen) == 1 and seen[0].rows_loaded == 8
    (folder / "d0" / MARKER).write_text("done")
    q = watch_landing(spark, c, fresh_env, str(folder), available_now=True,
                      checkpoint=str(tmp_path / "ckpt"), on_result=lambda b, o: seen.append(o))
    q.awaitTermination(120)
    # only the newly marked folder is a delivery
    assert len(seen) == 2 and isinstance(seen[1], Refused) and isinstance(seen[1].cause, GateFailed)
    assert spark.table(seen[0].table).count() == 8


def test_bad_deliveries_do_not_stop_the_watcher(spark, lake, fresh_env, tmp_path):
    import os
    import time

    c = rebind(Contract.load(fixture_path("berth_stays.odcs.yaml")), fresh_env)
    folder, good = tmp_path / "in", open(fixture_path("berth_stays_ok.csv"), encoding="utf-8").read()
    now = time.time()
    for i, name in enumerate(["a_ragged", "b_empty", "c_failing", "d_good"]):
        (folder / name).mkdir(parents=True)
        (folder / name / MARKER).write_text("done")
        os.utime(folder / name / MARKER, (now + 2 * i, now + 2 * i))  # oldest first
    (folder / "a_ragged" / "x.csv").write_text(good + "one,cell,too,few\n", encoding="utf-8")
    shutil.copy(fixture_path("berth_stays_errors.csv"), folder / "c_failing" / "x.csv")
    (folder / "d_good" / "x.csv").write_text(good, encoding="utf-8")
    seen = []
    run = lambda: watch_landing(spark, c, fresh_env, str(folder), available_now=True,
                                checkpoint=str(tmp_path / "ckpt"), on_result=lambda b, o: seen.append(o)).awaitTermination(180)
    run()
    assert [isinstance(o, Refused) for o in seen] == [True, True, True, False]
    assert seen[0].delivery.endswith("a_ragged") and "heading" in seen[0].reason
    assert isinstance(seen[2].cause, GateFailed) and seen[3].rows_loaded == 8
    run()  # nothing is tried again
    assert len(seen) == 4 and spark.table(seen[3].table).count() == 8
