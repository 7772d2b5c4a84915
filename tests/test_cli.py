"""The job / command-line entry point."""

import shutil

import yaml

from lakepact.__main__ import main
from helpers import fixture_path


def _env_contract(tmp_path, env, name="berth_stays"):
    doc = yaml.safe_load(open(fixture_path(f"{name}.odcs.yaml"), encoding="utf-8"))
    for s in doc["servers"]:
        if s.get("catalog"):
            s["server"] = env
            s["catalog"] = f"{env}_landing"
    p = tmp_path / f"{name}.yaml"
    p.write_text(yaml.safe_dump(doc, allow_unicode=True), encoding="utf-8")
    return str(p)


def test_cli_apply_ddl_diff(spark, lake, fresh_env, tmp_path, capsys):
    c = _env_contract(tmp_path, fresh_env)
    assert main(["ddl", c, fresh_env]) == 0
    assert "CREATE TABLE IF NOT EXISTS" in capsys.readouterr().out
    assert main(["apply", c, fresh_env, fixture_path("berth_stays_ok.csv")]) == 0
    assert "loaded 8 rows" in capsys.readouterr().out
    assert main(["apply", c, fresh_env, fixture_path("berth_stays_errors.csv")]) == 1
    assert "5 failed" in capsys.readouterr().out
    old, new = tmp_path / "old", tmp_path / "new"
    old.mkdir(); new.mkdir()
    shutil.copy(c, old / "c.yaml")
    doc = yaml.safe_load(open(c, encoding="utf-8"))
    doc["schema"][0]["properties"] = doc["schema"][0]["properties"][1:]
    (new / "c.yaml").write_text(yaml.safe_dump(doc), encoding="utf-8")
    assert main(["diff", str(old), str(old)]) == 0
    assert main(["diff", str(old), str(new)]) == 1
    assert "field_removed" in capsys.readouterr().out


def test_cli_apply_all(spark, lake, fresh_env, tmp_path, capsys):
    c1 = _env_contract(tmp_path, fresh_env)
    c2 = _env_contract(tmp_path, fresh_env, "meter_readings")
    jobs = tmp_path / "jobs.yaml"
    jobs.write_text(yaml.safe_dump([
        {"contract": c1, "files": [fixture_path("berth_stays_ok.csv")]},
        {"contract": c2, "files": [fixture_path("meter_readings_errors.csv")]},
    ]), encoding="utf-8")
    assert main(["apply-all", str(jobs), fresh_env]) == 1
    out = capsys.readouterr().out
    assert "loaded" in out and "gate_failed" in out
