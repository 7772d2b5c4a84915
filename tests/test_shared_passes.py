"""Several key checks in one pass, dependency rules without a distinct count, digests before rows."""

import random
import re

import pytest
from pyspark.sql import Row, functions as F

from lakepact import Contract, check_report
from lakepact.operators import checks as K
from lakepact.operators.diff import in_sync, snapshot_digests

TYPES = "a bigint, b string, c double, d date, e timestamp, f binary, g decimal(10,2), h boolean"


def _frame(spark, n=400, seed=3):
    rng = random.Random(seed)
    some = lambda f: None if rng.random() < 0.1 else f()
    rows = [(some(lambda: rng.randrange(300)), some(lambda: rng.choice(["x", "x" * 40, "1:x", "é", ""]) * rng.randrange(1, 4)),
             some(lambda: rng.choice([0.0, -0.0, float("nan"), 1.5])), rng.randrange(50), rng.randrange(80), some(lambda: rng.randbytes(2)),
             rng.randrange(500), some(lambda: rng.random() < 0.5)) for _ in range(n)]
    df = spark.createDataFrame(rows, "a bigint, b string, c double, d int, e int, f binary, g int, h boolean")
    return df.select("a", "b", "c", F.date_add(F.lit("2026-01-01").cast("date"), "d").alias("d"),
                     F.timestamp_seconds(F.col("e") * 900 + 1_700_000_000).alias("e"), "f",
                     (F.col("g") / 100).cast("decimal(10,2)").alias("g"), "h")


KEYS = [("a",), ("b",), ("a", "b"), ("c", "h"), ("d", "e"), ("f",), ("g", "b"), tuple("abcdefgh")]


def test_shared_keys_equal_separate_groupings(spark):
    df = _frame(spark).repartition(5).cache()
    got = K.shared_duplicate_keys(df, list(enumerate(KEYS))).first()
    for i, keys in enumerate(KEYS):
        want = K.duplicate_keys(df, keys, "exact").first()
        assert (got[f"g{i}"], got[f"r{i}"]) == (want["groups"], want["rows"]), keys
    assert K.shared_duplicate_keys(df.where("false"), [(0, ("a",)), (1, ("b",))]).first() == Row(g0=0, r0=0, g1=0, r1=0)


def test_cells_do_not_run_together(spark):
    df = spark.createDataFrame([("a", "b:c"), ("a:b", "c"), ("1:a", None), (None, "1:a"), ("-", ""), (None, None), (None, None)],
                               "x string, y string")
    got = K.shared_duplicate_keys(df, [(0, ("x", "y")), (1, ("x",))]).first()
    assert (got["g0"], got["r0"], got["g1"], got["r1"]) == (1, 2, 1, 3)


def _unique_contract(names):
    return Contract.from_dict({"id": "u", "schema": [{"name": "m", "properties": [
        {"name": n, "physicalType": "BIGINT", "unique": True} for n in names]}]})


def test_five_key_checks_read_the_rows_once(spark, tmp_path):
    path = str(tmp_path / "five")
    spark.range(2000).selectExpr(*[f"(id * {k}) % 1999 AS c{k}" for k in (1, 2, 3, 5, 7)]).write.parquet(path)
    df = spark.read.parquet(path)
    report = check_report(df, _unique_contract(df.columns), specs=[
        s for s in K.compile_checks(_unique_contract(df.columns)) if s.plan == "unique"])
    rows = report.collect()
    assert [r["metric"] for r in rows] == [1] * 5 and all("over 2 rows" in r["detail"] for r in rows)
    plan = report._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len(re.findall(r"Scan parquet", plan)) == 1


def test_types_without_a_digest_keep_their_own_pass(spark):
    df = spark.createDataFrame([(1, [1]), (1, [1]), (2, None)], "a bigint, l array<int>")
    assert K.key_digest(df, ["l"]) is None
    specs = [K.CheckSpec(i, n, "unique", n, "unique", keys=(n,)) for i, n in enumerate("al")]
    assert [r["metric"] for r in check_report(df, _unique_contract(["a"]), specs=specs).collect()] == [1, 1]


def test_fixed_width_keys_are_grouped_without_a_text(spark):
    df = _frame(spark).withColumn("e", F.col("e").cast("timestamp_ntz"))
    fixed, mixed = [("a",), ("c", "h"), ("d", "e"), ("a", "d", "c")], [("b", "a"), ("g",)]
    for keys, texts in ((fixed, False), (fixed + mixed, True)):
        plan = K.shared_duplicate_keys(df, list(enumerate(keys)))._jdf.queryExecution().optimizedPlan().toString()
        assert ("sha2" in plan) == ("as string" in plan) == texts, plan


def test_shared_slots_keep_checks_and_cells_apart(spark):
    rows = [(1, 2, True, 1.0, None, "1"), (2, 1, False, 1.0, None, "1"), (None, 1, None, -0.0, 0, ""), (1, None, None, 0.0, 0, None),
            (None, None, True, float("nan"), None, None), (None, None, True, float("nan"), 1, "-")]
    df = spark.createDataFrame(rows, "k0 bigint, t1 int, h boolean, c double, s int, b string").select(
        "k0", "t1", "h", "c", F.col("c").cast("float").alias("r"), "b", F.timestamp_seconds("s").alias("u"),
        F.timestamp_seconds("s").cast("timestamp_ntz").alias("v"), F.date_add(F.lit("1970-01-01").cast("date"), "s").alias("d"))
    keys = [("k0",), ("k0", "t1"), ("t1", "k0"), ("h",), ("c", "h"), ("r", "c"), ("u", "v"), ("d", "b"), ("b", "t1", "k0"), ("v", "d", "u")]
    got = K.shared_duplicate_keys(df, list(enumerate(keys))).first()
    for i, k in enumerate(keys):
        want = K.duplicate_keys(df, k, "exact").first()
        assert (got[f"g{i}"], got[f"r{i}"]) == (want["groups"], want["rows"]), k


RULE = "SELECT COUNT(*) FROM (SELECT {s} FROM m {w} GROUP BY {k} HAVING COUNT(DISTINCT {v}) {o})"


@pytest.mark.parametrize("shown,where,keys,value,op", [
    ("a", "", "a", "b", "> 1"), ("a, h", "WHERE b IS NOT NULL AND a <> 1", "a, h", "c", ">= 2"), ("1", "", "h", "e", ">1"),
    ("`a`", "", "`a`", "`g`", "<> 1"), ("a", "WHERE (a <> 1)", "A", "b", "> 1"), ("1", "", "d", "f", "!= 1"), ("c", "", "c", "a", "> 1")])
def test_dependency_rewrite_counts_the_same(spark, shown, where, keys, value, op):
    df = _frame(spark, 900, 5)
    query = RULE.format(s=shown, w=where, k=keys, v=value, o=op)
    quick = K.dependency_query(query, "m", df.schema)
    assert quick and "DISTINCT" not in quick
    with K.as_relation(df, "m"):
        assert spark.sql(quick).first() == spark.sql(query).first()


@pytest.mark.parametrize("query", [
    RULE.format(s="a", w="", k="a", v="b", o="> 2"), RULE.format(s="b", w="", k="a", v="b", o="> 1"),
    RULE.format(s="a", w="", k="a", v="missing", o="> 1"), RULE.format(s="a", w="WHERE a IN (SELECT 1)", k="a", v="b", o="> 1"),
    RULE.format(s="1", w="", k="1", v="b", o="> 1"), RULE.replace("FROM m", "FROM other").format(s="a", w="", k="a", v="b", o="> 1"),
    "SELECT COUNT(*) FROM (SELECT a FROM m GROUP BY a HAVING COUNT(DISTINCT b, c) > 1)", "SELECT MAX(a) FROM m"])
def test_other_rules_run_as_written(spark, query):
    assert K.dependency_query(query, "m", _frame(spark, 2).schema) is None


def test_dependency_rule_has_no_distinct_expansion(spark):
    df = _frame(spark)
    rule = {"type": "sql", "name": "fd", "mustBe": 0, "query": RULE.format(s="d", w="", k="d", v="a", o="> 1")}
    c = Contract.from_dict({"id": "u", "schema": [{"name": "m", "properties": [], "quality": [rule]}]})
    report = check_report(df, c)
    # one grouping by key (partial, final), then the count (partial, final) and the one value (partial, final)
    plan = report._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "distinct" not in plan.lower() and len(re.findall(r"Exchange hashpartitioning", plan)) == 1


def test_digests_decide_which_contracts_are_compared(spark):
    cols = "contract string, field string, x string, n int"
    stored = [("c1", "f", "a", 1), ("c1", "f", "a", 1), ("c1", "g", None, 2), ("c2", "f", None, 1), ("c3", "f", "p", 1),
              (None, "f", "q", 1), ("c4", "f", "a", None)]
    made = [("c1", "g", None, 2), ("c1", "f", "a", 1), ("c1", "f", "a", 1), ("c2", None, "f", 1), ("c3", "f", "p", 1),
            ("c3", "f", "p", 1), (None, "f", "r", 1), ("c5", "f", "a", None)]
    s, r = spark.createDataFrame(stored, cols), spark.createDataFrame(made, cols)
    same = {x["contract"]: (x["same"], x["rows"]) for x in snapshot_digests(s, r).collect()}
    assert same == {"c1": (True, 0), "c2": (False, 0), "c3": (False, -1), None: (False, 0), "c4": (False, 1), "c5": (False, -1)}
    got = sorted(in_sync(s, r).collect(), key=repr)
    plain = s.exceptAll(r).withColumn("side", F.lit("only_stored")).union(
        r.exceptAll(s).withColumn("side", F.lit("only_regenerated")))
    assert got == sorted(plain.collect(), key=repr) and len(got) == 7
    assert in_sync(s, s).count() == 0
