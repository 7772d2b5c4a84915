"""Operators over documents against brute force, on awkward rows and on the given tables."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from helpers_llm import SCHEMA, awkward, awkward_rows, toks
from pyspark.sql import functions as F

from lakepact.llm import lm_mixing, records, simhash, source_mix
from lakepact.llm.common import components

SF = "/root/testdata/sf0.001"


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


# --- SimHash ---

def brute_fp(text):
    ws = toks(text)
    if not ws:
        return 0
    grams = [" ".join(ws[i:i + 3]) for i in range(max(1, len(ws) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, linked):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                root[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return [low.get(find(i)) for i in range(len(ids))]


def test_simhash_awkward(spark):
    rows = awkward_rows()
    fps = [brute_fp(r[1]) for r in rows]
    comp = brute_components([r[0] for r in rows], lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    got = simhash.near_duplicates(awkward(spark)).select("doc_id", "fingerprint", "component_id").collect()
    assert key(got) == key([(r[0], f"{f:016x}", c) for r, f, c in zip(rows, fps, comp)])


def test_simhash_links_any_bits(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 40, dtype=np.int64)
    fps = {int(x) for x in base}
    for x in base[:20]:  # neighbours one to four bits away, dense around some
        for _ in range(12):
            y = int(x)
            for b in rng.choice(64, rng.integers(1, 5), replace=False):
                y ^= 1 << int(b)
            fps.add(y - (1 << 64) if y >= 1 << 63 else y)
    fps = sorted(fps)
    df = spark.createDataFrame([(x,) for x in fps], "fp bigint")
    for bits in (1, 2, 3):
        want = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if ((a ^ b) & (2**64 - 1)).bit_count() <= bits}
        assert {tuple(r) for r in simhash.links(df, bits).collect()} == want


def test_simhash_keep_one(spark):
    df = awkward(spark)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    rows = awkward_rows()
    found = simhash.near_duplicates(df).collect()
    groups = {(r["component_id"], None if r["component_id"] is not None else r["fingerprint"]) for r in found}
    got = kept.collect()
    assert len(got) == len(groups)
    assert {r["doc_id"] for r in got if r["doc_id"] is not None} == {g[0] for g in groups if g[0] is not None}
    assert all((r["doc_id"], r["text"]) in {(x[0], x[1]) for x in rows} for r in got)
    assert simhash.keep_one(df.where("false")).count() == 0


def test_simhash_keep_one_leaves_clashing_columns(spark):
    rows = [(1, "a b c d", "mine", "k", 7), (2, "a b c d", "yours", None, 8), (None, "x y z", None, "l", 9), (3, "", "m", "n", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, Keep_ID_ string, keep_key_ string, keep_n_ int")
    kept = simhash.keep_one(df)
    assert kept.schema == df.schema
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([rows[0], *rows[2:]], key=repr)


def test_components_chain_and_hub(spark):
    edges = [(i, i + 1) for i in range(50)] + [(1000, i) for i in range(1001, 1200)] + [(7, 7), (5, None)]
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 1000 for i in range(1000, 1200)}}


# --- mixing ---

def brute_targets(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, full, t = sum(sizes.values()), set(), {}
    while True:  # share by weight, stop at three times the size, share the excess anew
        rest = total - sum(3 * sizes[s] for s in full)
        free = [s for s in names if s not in full]
        t = {s: 3 * sizes[s] for s in full} | {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if t[s] > 3 * sizes[s]}
        if not over:
            return t
        full |= over


@pytest.mark.parametrize("which", ["awkward", "given"])
def test_source_mix(spark, which):
    docs = awkward(spark) if which == "awkward" else spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], len(toks(r["text"])), r["source"]) for r in docs.collect()]
    sizes = Counter()
    for _, n, s in rows:
        sizes[s] += n
    want = brute_targets(sizes)
    got = source_mix.mix(docs).collect()
    by = {}
    for r in rows:
        by.setdefault(r[0], set()).add((r[1], sizes[r[2]], round(want[r[2]], 6)))
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        assert (r["size"], r["source_size"], round(r["target"], 6)) in by[r["doc_id"]]
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[round(r["target"], 6), r["source_size"]] += r["taken"]
    largest = Counter()
    for d, n, s in rows:
        k = (round(want[s], 6), sizes[s])
        largest[k] = max(largest[k], n * sum(1 for x in rows if x[:1] == (d,)))
    for s in sizes:
        k = (round(want[s], 6), sizes[s])
        same = sum(1 for x in sizes if (round(want[x], 6), sizes[x]) == k)
        assert same * want[s] - same * largest[k] - 1 <= taken[k] <= same * want[s] + 1e-6
    again = source_mix.mix(docs.repartition(5)).collect()
    assert key([tuple(r) for r in again]) == key([tuple(r) for r in got])


def test_source_mix_take(spark):
    df = awkward(spark)
    mixed = source_mix.mix(df).where("doc_id is not null").groupBy("doc_id").sum("copies", "size").collect()
    taken = {r["doc_id"]: r["count"] for r in source_mix.take(df).groupBy("doc_id").count().collect()}
    for r in mixed:
        if r["sum(size)"] > 0:
            assert taken.get(r["doc_id"], 0) == r["sum(copies)"]
    assert source_mix.take(df).columns == df.columns
    assert source_mix.take(df.where("false")).count() == 0 and source_mix.mix(df.where("false")).count() == 0


# --- token records ---

def test_records_round_trip(spark, tmp_path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(records.tokenizer_file())
    rows = sorted(awkward_rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    folder = str(tmp_path / "out")
    manifest = records.write_records(awkward(spark), folder, records.tokenizer_file())
    got = records.read_records(manifest, folder).orderBy("start").collect()
    want, start = [], 0
    ids_of = lambda x: [*t.encode(x or "", add_special_tokens=False).ids, 2]
    nulls = {zlib.crc32(np.array(ids_of(r[1]), "<u4").tobytes()) for r in rows if r[0] is None}
    for r in rows:
        ids = ids_of(r[1])
        want.append((r[0], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert [r["doc_id"] for r in got] == [w[0] for w in want]
    for r, w in zip(got, want):
        assert r["start"] == start
        assert r["ids_crc32"] == w[2] or r["ids_crc32"] in nulls
        start += r["n_tokens"]
    assert start == sum(w[1] for w in want)
    some = got[len(got) // 2]
    doc_id, ids = records.open_record(folder, some["file"], some["record"])
    assert doc_id == some["doc_id"] and zlib.crc32(ids) == some["ids_crc32"]


def test_records_special_strings_and_damage(spark):
    from tokenizers import Tokenizer

    t, e = Tokenizer.from_file(records.tokenizer_file()), records.Encoder(records.tokenizer_file())
    for text in ("a<|endoftext|>b <|startoftext|>", "don't stop   x", "é́ ﬁ ½ 日本", "'s 's\t'd", ""):
        assert list(np.frombuffer(e.encode([text.encode()])[0], "<u2")) == t.encode(text, add_special_tokens=False).ids
    small = records.pack(None, b"\1\0\2\0", 2)
    assert records.unpack(records.read_frame(memoryview(small))) == (None, b"\1\0\0\0\2\0\0\0")
    data = bytearray(records.pack(7, b"\1\0\0\0"))
    assert records.unpack(records.read_frame(memoryview(bytes(data)))) == (7, b"\1\0\0\0")
    for i in (0, 9, 14, len(data) - 1):
        bad = bytearray(data)
        bad[i] ^= 1
        with pytest.raises(ValueError):
            records.read_frame(memoryview(bytes(bad)))


def test_records_given_and_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = records.encode_documents(docs).orderBy("doc_id").collect()
    assert len(got) == docs.count() and [r["start"] for r in got] == list(
        np.cumsum([0] + [r["n_tokens"] for r in got[:-1]])
    )
    assert records.encode_documents(docs.where("false")).count() == 0


# --- language model ---

def brute_base(rows):
    held = [r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in rows]
    c = Counter()
    for r, h in zip(rows, held):
        if not h:
            c.update(toks(r[1]))
            c["<end>"] += 1
    n, v = sum(c.values()), len(c)
    out = []
    for r, h in zip(rows, held):
        ts = [*toks(r[1]), "<end>"]
        out.append((r[0], h, len(ts), sum(c[t] > 0 for t in ts), n, sum(math.log10((c[t] + 1) / (n + v + 1)) for t in ts)))
    return out


@pytest.mark.parametrize("which", ["awkward", "given"])
def test_lm_base(spark, which, monkeypatch):
    monkeypatch.setattr(lm_mixing, "HEAD_SHARE", 300)  # so that both the head and the tail are used
    docs = awkward(spark) if which == "awkward" else spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = lm_mixing.score_documents(docs).collect()
    a = key([(*tuple(r)[:5], round(r["base_score"], 6)) for r in got])
    b = key([(*x[:5], round(x[5], 6)) for x in brute_base(rows)])
    assert [x[:5] for x in a] == [x[:5] for x in b]
    assert np.allclose([x[5] for x in a], [x[5] for x in b], atol=1e-5)
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in got)


def small_model(texts):
    voc = Counter(w for t in texts for w in t.split())
    voc[b""] = len(texts)
    raw = np.bincount(np.frombuffer(b"".join(texts), np.uint8), minlength=256)
    sym = lm_mixing.symbol_map(raw)
    words = lm_mixing.WordRows(dict(voc), sym)
    a = sym[np.frombuffer(b"".join(texts), np.uint8)]
    begin = np.cumsum([0] + [len(t) for t in texts[:-1]])
    counts = []
    for row in lm_mixing.contexts(a, lm_mixing.lags(a, begin, words.end), words):
        slot, n = np.unique(row.astype(np.int64) << 6 | a, return_counts=True)
        counts.append((slot, n))
    return lm_mixing.Model(counts, raw, words)


def test_lm_is_a_probability():
    """The chances of all single next bytes sum to one, whatever came before."""
    m = small_model([lm_mixing.normal(t) for t in (b"the cat sat", b"the hat is on the cat", b"a dog ate it")])
    for head in (b"", b"the ca", b"xyz "):
        start = m.score([head])[0] if head else 0.0
        # The cost of head + byte, less that of head: blocks are far longer than these texts.
        more = m.score([head + bytes([b]) for b in range(256)])
        assert abs(np.exp2(-(more - start)).sum() - 1) < 1e-3


def test_lm_pieces_and_batches_agree(monkeypatch):
    texts = [lm_mixing.normal(t) for t in (b"the cat sat on the mat " * 40, b"a b c", b"", b"the hat " * 500)]
    m = small_model(texts)
    alone = np.array([m.score([t])[0] for t in texts])
    assert np.allclose(m.score(texts), alone, rtol=1e-4)
    monkeypatch.setattr(lm_mixing, "PIECE_BYTES", lm_mixing.FIRST_BLOCK * 7)
    assert np.allclose(m.score(texts), alone, rtol=0.1)  # a piece also ends a block


def test_lm_beats_base_on_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    r = lm_mixing.score_documents(docs).where("held_out").selectExpr("sum(score)", "sum(base_score)").first()
    assert r[0] > r[1]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert lm_mixing.score_documents(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0


def test_source_mix_many_sources(spark):
    """Targets of 3,000 sources, sorted in several ranges: the same water level as one sorted list gives."""
    rng = random.Random(9)
    sizes = {f"host{i:05d}.é": rng.choice([0, 1, 7, 7, 300, rng.randint(1, 10**6)]) for i in range(3000)}
    sizes[None] = 5_000_000
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # keeps the ranges apart
    try:
        rows = source_mix.targets(df).collect()
        run = source_mix.sums_before(df.withColumn("one", F.lit(1)), [F.col("source").asc_nulls_last()],
                                     {"rank": "one", "upto": "source_size"}).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = brute_targets(sizes)
    assert len(rows) == len(sizes)
    assert all(abs(r.target - want[r.source]) <= 1e-9 * max(1.0, want[r.source]) for r in rows)
    at = 0
    for k, r in enumerate(sorted(run, key=lambda r: (r.source is None, r.source or ""))):
        assert (r["rank"], r["upto"]) == (k, at)
        at += r.source_size
