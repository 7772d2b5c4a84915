"""S1 text deliveries and P1–P4 typing."""

import decimal
import datetime as dt

import pytest

from lakepact import Contract, align_by_name, read_landing_text, type_columns
from lakepact.operators.shape import cast_loss, surplus_columns


def _contract(props):
    return Contract.from_dict({"id": "c", "schema": [{"name": "m", "properties": props}]})


def _write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text, encoding="utf-8")
    return str(p)


def test_text_values_kept_or_null(spark, tmp_path):
    p = _write(tmp_path, "a.csv", 'a,b,c\n"",NA,null\n,  x ,"q,1"\n"he said ""hi""","line\nbreak",z\n')
    rows = read_landing_text(spark, p).collect()
    assert rows[0].a is None and rows[0].b == "NA" and rows[0].c == "null"
    assert rows[1].a is None and rows[1].b == "  x " and rows[1].c == "q,1"
    assert rows[2].a == 'he said "hi"' and rows[2].b == "line\nbreak"


def test_ragged_rows_rejected_in_failfast(spark, tmp_path):
    p = _write(tmp_path, "r.csv", "a,b\n1,2\n3,4,5\n")
    with pytest.raises(Exception):
        read_landing_text(spark, p, mode="FAILFAST").collect()


def test_try_cast_rules(spark):
    c = _contract([
        {"name": "d", "physicalType": "DATE"}, {"name": "n", "physicalType": "DECIMAL(4,2)"},
        {"name": "b", "physicalType": "BOOLEAN"}, {"name": "s", "physicalType": "STRING"},
    ])
    df = spark.createDataFrame([("2026-13-45", "123.45", "maybe", "x"), ("2026-01-05", "1.005", "true", "y")],
                               "d string, n string, b string, s string")
    rows = type_columns(df, c).collect()
    assert rows[0].d is None and rows[0].n is None and rows[0].b is None  # unreadable, overflow
    assert rows[1].d == dt.date(2026, 1, 5) and rows[1].n == decimal.Decimal("1.01") and rows[1].b is True
    loss = df.agg(*cast_loss(df, c)).collect()[0].asDict()
    assert loss == {"d:cast_loss": 1, "n:cast_loss": 1, "b:cast_loss": 1, "s:cast_loss": 0}


def test_shape_prune_fill_order_case(spark):
    c = _contract([{"name": "a", "physicalType": "INT"}, {"name": "b", "physicalType": "STRING"},
                   {"name": "cod_x", "physicalType": "STRING"}])
    df = spark.createDataFrame([("x", "1", "surplus", "upper")], "b string, a string, extra string, COD_X string")
    out = type_columns(df, c)
    assert out.columns == ["a", "b", "cod_x"]
    r = out.collect()[0]
    assert r.a == 1 and r.b == "x" and r.cod_x is None  # heading in upper case counts as missing
    assert surplus_columns(df, c) == ["extra", "COD_X"]


def test_align_by_name(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    assert align_by_name(df, ["y", "x"]).columns == ["y", "x"]
    with pytest.raises(ValueError):
        align_by_name(df, ["z"])


def test_utf8_bom_heading(spark, tmp_path):
    p = tmp_path / "bom.csv"
    p.write_bytes(b"\xef\xbb\xbfcod_x,b\nA,1\n")
    assert read_landing_text(spark, str(p)).columns == ["cod_x", "b"]
