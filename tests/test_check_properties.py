"""Property test: every fused metric equals a plain-Python count over the same rows."""

import re

from hypothesis import given, settings, strategies as st

from lakepact import Contract, check_report

CONTRACT = Contract.from_dict({"id": "p", "schema": [{
    "name": "m",
    "properties": [
        {"name": "code", "physicalType": "STRING", "required": True,
         "logicalTypeOptions": {"pattern": "^[A-C][0-9]$", "minLength": 2, "maxLength": 2},
         "quality": [{"type": "library", "metric": "invalidValues", "name": "code_list",
                      "arguments": {"validValues": ["A1", "B2", "C3"]}, "mustBe": 0}]},
        {"name": "amount", "physicalType": "INT", "required": False,
         "logicalTypeOptions": {"exclusiveMinimum": 0, "maximum": 50}},
        {"name": "k", "physicalType": "INT", "primaryKey": True},
    ],
    "quality": [{"type": "sql", "name": "big", "mustBe": 0,
                 "query": "SELECT COUNT(*) FROM m WHERE amount IS NOT NULL AND amount > k"},
                {"type": "library", "metric": "rowCount", "mustBeGreaterThan": 0, "name": "rows"}],
}]})

codes = st.one_of(st.none(), st.sampled_from(["A1", "B2", "C3", "D4", "A", "A11", "b2", "C9"]))
amounts = st.one_of(st.none(), st.integers(-3, 60))
keys = st.integers(0, 6)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(codes, amounts, keys), max_size=25))
def test_metrics_equal_python_counts(spark, rows):
    df = spark.createDataFrame(rows, "code string, amount int, k int")
    got = {r.check: r.metric for r in check_report(df, CONTRACT).collect()}
    c = [r[0] for r in rows]
    a = [r[1] for r in rows]
    ks = [r[2] for r in rows]
    nn = [x for x in c if x is not None]
    want = {
        "code:required": sum(x is None for x in c),
        "code:pattern": sum(not re.search("^[A-C][0-9]$", x) for x in nn),
        "code:min_length": sum(len(x) < 2 for x in nn),
        "code:max_length": sum(len(x) > 2 for x in nn),
        "code_list": sum(x not in ("A1", "B2", "C3") for x in nn),
        "amount:exclusive_minimum": sum(x < 0 for x in a if x is not None),
        "amount:exclusive_minimum_equal": sum(x == 0 for x in a if x is not None),
        "amount:maximum": sum(x > 50 for x in a if x is not None),
        "k:unique": sum(1 for v in set(ks) if ks.count(v) > 1),
        "big": sum(1 for x, k in zip(a, ks) if x is not None and x > k),
        "rows": len(rows),
    }
    for name, value in want.items():
        assert got[name] == value, name
