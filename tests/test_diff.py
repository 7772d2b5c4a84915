"""D1–D5 registry diff cases."""

from lakepact.operators.diff import contract_diff, diff_verdict, in_sync, overall_verdict

COLS = "contract string, field string, position int, logical_type string, physical_type string, required boolean, key_position int"


def _snap(spark, rows):
    return spark.createDataFrame(rows, COLS)


def test_diff_cases(spark):
    old = _snap(spark, [
        ("a", "id", 1, "number", "BIGINT", True, 1), ("a", "name", 2, "string", "STRING", True, None),
        ("b", "id", 1, "number", "BIGINT", True, 1), ("b", "gone", 2, "string", "STRING", False, None),
        ("c", "id", 1, "number", "INT", True, 1), ("c", "opt", 2, "string", "STRING", True, None),
        ("d", "id", 1, "number", "INT", True, 1),
    ])
    new = _snap(spark, [
        ("a", "id", 1, "number", "BIGINT", True, 1), ("a", "name", 2, "string", "VARCHAR(9)", True, None),
        ("a", "note", 3, "string", "STRING", False, None),                       # optional added
        ("b", "id", 1, "number", "BIGINT", True, 1),                             # field removed
        ("c", "id", 1, "number", "BIGINT", True, 1), ("c", "opt", 2, "string", "STRING", False, None),
        ("c", "must", 3, "string", "STRING", True, None),                        # type changed, required added
        ("e", "id", 1, "number", "INT", True, 1),                                # contract new (d removed)
    ])
    d = contract_diff(old, new)
    got = sorted((r.contract, r.field, r.change, r.severity) for r in d.collect())
    assert got == sorted([
        ("a", "note", "optional_field_added", "compatible"),
        ("b", "gone", "field_removed", "breaking"),
        ("c", "id", "type_changed", "breaking"),
        ("c", "must", "required_field_added", "breaking"),
        ("c", "opt", "required_relaxed", "compatible"),
        ("d", None, "contract_removed", "breaking"),
        ("e", None, "contract_added", "information"),
    ])
    v = {r.contract: r.breaking for r in diff_verdict(d, old, new).collect()}
    assert v == {"a": False, "b": True, "c": True, "d": True, "e": False}
    o = overall_verdict(diff_verdict(d, old, new)).collect()[0]
    assert (o.contracts, o.breaking_contracts, o.passed) == (5, 3, False)


def test_in_sync(spark):
    s = _snap(spark, [("a", "id", 1, "number", "BIGINT", True, 1), ("a", "x", 2, "string", "STRING", False, None)])
    assert in_sync(s, s).count() == 0
    r = _snap(spark, [("a", "id", 1, "number", "BIGINT", True, 1), ("a", "x", 3, "string", "STRING", False, None)])
    sides = sorted(x.side for x in in_sync(s, r).collect())
    assert sides == ["only_regenerated", "only_stored"]


def test_registry_of_yaml_files_and_diff(spark, tmp_path):
    import yaml
    from helpers import fixture_path
    from lakepact.sources.registry import read_contract_registry
    from lakepact.operators.diff import contract_diff

    old_dir, new_dir = tmp_path / "old", tmp_path / "new"
    old_dir.mkdir(); new_dir.mkdir()
    for name in ["berth_stays", "meter_readings"]:
        text = open(fixture_path(f"{name}.odcs.yaml"), encoding="utf-8").read()
        (old_dir / f"{name}.yaml").write_text(text, encoding="utf-8")
        doc = yaml.safe_load(text)
        props = doc["schema"][0]["properties"]
        if name == "berth_stays":   # optional field added: compatible
            props.append({"name": "obs", "physicalType": "STRING", "required": False})
        else:                          # field removed: breaking
            doc["schema"][0]["properties"] = [p for p in props if p["name"] != "street"]
        (new_dir / f"{name}.yaml").write_text(yaml.safe_dump(doc, allow_unicode=True), encoding="utf-8")
    old = read_contract_registry(spark, str(old_dir)).drop("path")
    new = read_contract_registry(spark, str(new_dir)).drop("path")
    assert old.count() == 24
    got = sorted((r.field, r.change, r.severity) for r in contract_diff(old, new).collect())
    assert got == [("obs", "optional_field_added", "compatible"), ("street", "field_removed", "breaking")]


def test_changelog_order(spark):
    from lakepact.operators.diff import changelog
    old = _snap(spark, [("b", "x", 1, None, "INT", False, None), ("a", "y", 1, None, "INT", False, None)])
    new = _snap(spark, [("a", "y", 1, None, "BIGINT", False, None), ("c", "z", 1, None, "INT", False, None)])
    rows = [(r.contract, r.change) for r in changelog(contract_diff(old, new)).collect()]
    assert rows == [("a", "type_changed"), ("b", "contract_removed"), ("c", "contract_added")]
