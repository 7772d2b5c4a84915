"""Property tests: drift (E3–E6) and registry diff (D1–D4) against brute-force Python."""

from hypothesis import given, settings, strategies as st

from lakepact.operators.diff import contract_diff, diff_verdict
from lakepact.operators.evolution import schema_drift

TYPES = ["int", "bigint", "string", "date"]
DECLARED = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR(9)", "date": "DATE"}
COLS = "contract string, field string, position int, logical_type string, physical_type string, required boolean, key_position int"

tables = st.sampled_from(["t1", "t2", "t3"])
columns = st.sampled_from(["a", "b", "c", "d"])
inventory = st.dictionaries(st.tuples(tables, columns), st.sampled_from(TYPES), max_size=10)
contract = st.dictionaries(st.tuples(tables, columns), st.tuples(st.sampled_from(TYPES), st.booleans()), max_size=10)


def drift_by_hand(inv, con):
    both = {t for t, _ in inv} & {t for t, _ in con}
    out = {}
    for key in set(inv) | set(con):
        if key[0] not in both:
            continue
        if key not in con:
            out[key] = "extra_column"
        elif key not in inv:
            out[key] = "new_required" if con[key][1] else "new_optional"
        elif inv[key] != con[key][0]:
            out[key] = "type_mismatch"
        else:
            out[key] = "unchanged"
    return out


@settings(max_examples=10, deadline=None)
@given(inventory, contract)
def test_drift_equals_brute_force(spark, inv, con):
    tc = spark.createDataFrame([(t, c, ty) for (t, c), ty in inv.items()], "table string, column string, type string")
    cf = spark.createDataFrame([(t, c, 1, None, DECLARED[ty], req, None) for (t, c), (ty, req) in con.items()], COLS)
    got = {(r.table, r.column): r.change for r in schema_drift(tc, cf).collect()}
    assert got == drift_by_hand(inv, con)


def diff_by_hand(old, new):
    out = set()
    oc, nc = {c for c, _ in old}, {c for c, _ in new}
    out |= {(c, None, "contract_removed") for c in oc - nc}
    out |= {(c, None, "contract_added") for c in nc - oc}
    for key in set(old) | set(new):
        if key[0] not in oc & nc:
            continue
        if key not in new:
            out.add((*key, "field_removed"))
        elif key not in old:
            out.add((*key, "required_field_added" if new[key][1] else "optional_field_added"))
        else:
            if old[key][0] != new[key][0]:
                out.add((*key, "type_changed"))
            if not old[key][1] and new[key][1]:
                out.add((*key, "required_tightened"))
            if old[key][1] and not new[key][1]:
                out.add((*key, "required_relaxed"))
    return out


@settings(max_examples=6, deadline=None)
@given(contract, contract)
def test_diff_equals_brute_force(spark, old, new):
    def frame(d):
        return spark.createDataFrame([(t, c, 1, None, DECLARED[ty], req, None) for (t, c), (ty, req) in d.items()], COLS)
    o, n = frame(old), frame(new)
    d = contract_diff(o, n)
    got = {(r.contract, r.field, r.change) for r in d.collect()}
    want = diff_by_hand(old, new)
    assert got == want
    breaking = {"contract_removed", "field_removed", "required_field_added", "type_changed", "required_tightened"}
    verdict = {r.contract: r.breaking for r in diff_verdict(d, o, n).collect()}
    every = {c for c, _ in old} | {c for c, _ in new}
    assert verdict == {c: any(ch in breaking for cc, _, ch in want if cc == c) for c in every}
