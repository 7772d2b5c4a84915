"""The driver contract: entry, queries, oracles (spot-checked against DuckDB at sf0.001)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from lakepact.suite.queries import QUERIES

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@needs_data
def test_entry_runs(spark, lake):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and all(r.result == "passed" for r in rows)


@needs_data
@pytest.mark.parametrize("name", ["q_check_unique_composite", "q_gate_report", "q_dictionary_lint",
                                  "q_contract_diff", "q_key_position", "q_norm_text"])
def test_oracle_agreement(spark, name):
    con = duckdb.connect()
    for t in ["part", "nation", "orders", "lineitem", "documents", "conversations"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()

    def canon(cols, rows):
        idx = sorted(range(len(cols)), key=lambda i: cols[i])
        return sorted((tuple(str(r[i]) for i in idx) for r in rows))

    assert sorted(df.columns) == sorted(dcols)
    assert canon(df.columns, df.collect()) == canon(dcols, drows)
