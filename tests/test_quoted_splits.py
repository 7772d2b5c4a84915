"""Large files with quoted line breaks: many tasks, the rows of the multi-line reader."""

import csv
import io
import random

import pytest

from lakepact.sources.text import read_landing_text


@pytest.fixture()
def small_blocks(spark):
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"]
    old = {k: spark.conf.get(k, None) for k in keys}

    def cut(n):
        for k, v in zip(keys, [n, 1, 1]):
            spark.conf.set(k, str(v))

    yield cut
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _cell(rng):
    kind = rng.random()
    if kind < 0.15:
        return ""
    words = ["a", "ñandú", "x,y", 'say "hi"', "l1\nl2", '"', "\n", "\n\n,", "NA", " b ", "long " * rng.randrange(1, 40),
             "\n".join("q" * rng.randrange(3) for _ in range(rng.randrange(2, 30)))]
    return "".join(rng.choice(words) for _ in range(rng.randrange(1, 3)))


def _write(path, rows, newline="\n", end=True, bom=False):
    out = io.StringIO()
    csv.writer(out, lineterminator=newline).writerows(rows)
    text = out.getvalue()
    text = text if end else text[:-len(newline)]
    path.write_bytes((("﻿" if bom else "") + text).encode())


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed,block,newline,end,bom", [
    (1, 64, "\n", True, False), (2, 200, "\r\n", True, False), (3, 1000, "\n", False, True), (4, 17, "\n", True, False)])
def test_equals_the_multi_line_reader(spark, tmp_path, small_blocks, seed, block, newline, end, bom):
    rng = random.Random(seed)
    folder = tmp_path / "in"
    folder.mkdir()
    for f in range(3):
        rows = [[f"k{f}-{i}", _cell(rng), _cell(rng)] for i in range(rng.randrange(1, 150))]
        _write(folder / f"p{f}.csv", [["id", "some text", "c"], *rows], newline, end, bom)
    small_blocks(128 << 20)
    want = _rows(read_landing_text(spark, str(folder)))
    small_blocks(block)
    df = read_landing_text(spark, str(folder), split_quoted=True)
    assert df.columns == ["id", "some text", "c"]
    assert _rows(df) == want


def test_one_big_file_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    rows = [[str(i), "first\nsecond, \"third\"\n" * (i % 5), "z"] for i in range(20_000)]
    _write(tmp_path / "big.csv", [["id", "t", "z"], *rows])
    small_blocks(64 << 10)
    df = read_landing_text(spark, str(tmp_path / "big.csv"), split_quoted=True)
    assert df.rdd.getNumPartitions() > 8
    assert read_landing_text(spark, str(tmp_path / "big.csv")).rdd.getNumPartitions() == 1
    assert {(r["id"], r["t"] or "", r["z"]) for r in df.collect()} == {tuple(r) for r in rows}


def test_a_record_over_many_blocks(spark, tmp_path, small_blocks):
    rows = [["1", "x"], ["2", "line\n" * 3000], ["3", "y\n"], ["4", "\n" * 500]]
    _write(tmp_path / "one.csv", [["id", "t"], *rows])
    small_blocks(256)
    got = read_landing_text(spark, str(tmp_path / "one.csv"), split_quoted=True).collect()
    assert sorted(tuple(r) for r in got) == [tuple(r) for r in rows]


def test_blank_lines_and_empty_deliveries(spark, tmp_path, small_blocks):
    small_blocks(32)
    (tmp_path / "b.csv").write_text('\n\nid,t\n\n1,"a\n\nb"\n\n\n2,""\n')
    df = read_landing_text(spark, str(tmp_path / "b.csv"), split_quoted=True)
    assert _rows(df) == _rows(read_landing_text(spark, str(tmp_path / "b.csv")))
    (tmp_path / "h.csv").write_text("id,t\n")
    assert read_landing_text(spark, str(tmp_path / "h.csv"), split_quoted=True).count() == 0


def test_ragged_rows(spark, tmp_path, small_blocks):
    small_blocks(16)
    (tmp_path / "r.csv").write_text('id,t\n1,a\n2,"b\nc",extra\n3\n4,d\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_landing_text(spark, str(tmp_path / "r.csv"), split_quoted=True).collect()
    flagged = read_landing_text(spark, str(tmp_path / "r.csv"), split_quoted=True, malformed_column="bad")
    assert {r["id"]: r["bad"] for r in flagged.collect()} == {"1": None, "2": '2,"b\nc",extra', "3": "3", "4": None}


@pytest.mark.parametrize("text,message", [
    ('id,t\n1,5" pipe\n2,b\n', "pair up"), ('id,t\n1,5" and 6" pipe\n', "unquoted cell"), ('id,t\n1, "a"\n', "unquoted cell")])
def test_refused_rather_than_misread(spark, tmp_path, text, message):
    (tmp_path / "s.csv").write_text(text)
    with pytest.raises(Exception, match=message):
        read_landing_text(spark, str(tmp_path / "s.csv"), split_quoted=True).collect()


def test_the_query_writes_files_of_bounded_size(spark, small_blocks, tmp_path, monkeypatch):
    from lakepact.suite import contracts, queries
    rows = [(i, f"u{i}", None if i % 7 == 0 else 'x "y"\n,' * (i % 40)) for i in range(300)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    whole = _rows(queries.q_quoted_splits(spark, str(tmp_path)))
    folder = tmp_path / "delivery"
    monkeypatch.setattr(queries, "scratch_path", lambda *parts: str(folder))
    monkeypatch.setattr(contracts, "DELIVERY_FILE_BYTES", 10_000)
    small_blocks(4000)
    assert _rows(queries.q_quoted_splits(spark, str(tmp_path))) == whole and len(whole) == 300
    sizes = [f.stat().st_size for f in folder.glob("*.csv")]
    assert len(sizes) > 3 and max(sizes) < 30_000


def test_another_heading_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,t\n1,a\n")
    (tmp_path / "b.csv").write_text("t,id\nb,2\n")
    with pytest.raises(Exception, match="another heading"):
        read_landing_text(spark, str(tmp_path), split_quoted=True).collect()
    (tmp_path / "c.csv").write_text("id,id\n1,2\n")
    with pytest.raises(Exception, match="repeated names"):
        read_landing_text(spark, str(tmp_path / "c.csv"), split_quoted=True).collect()
