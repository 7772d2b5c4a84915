"""Spelling variants, phrase stripes and quality votes against brute force."""

import collections
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from helpers_llm import SCHEMA, awkward, awkward_rows, lower

from lakepact.llm import phrases, quality_rules, spelling
from lakepact.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def key(rows):
    return sorted((tuple(r) for r in rows), key=str)


def table(spark, sf, name="documents"):
    return [r.asDict() for r in spark.read.parquet(f"{sf}/{name}.parquet").collect()]


# --- spelling variants ---

def brute_variants(rows, min_count=5):
    n = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 199 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    n = {w: c for w, c in n.items() if c >= min_count and len(w) >= 6}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    by_size = collections.defaultdict(list)
    for w in n:
        by_size[len(w)].append(w)
    found = {w: [v for d in (-1, 0, 1) for v in by_size[len(w) + d] if near(w, v)] for w in n}
    form = {}
    for w, vs in found.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 5 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(found[w]), n[form[w]] if w in form else None))
    return out


def test_spelling_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF)]
    assert key(QUERIES["op11_spelling"](spark, SF).collect()) == key(brute_variants(rows))


def test_spelling_awkward(spark):
    got = spelling.variants(awkward(spark)).collect()
    assert key(got) == key(brute_variants([r[:2] for r in awkward_rows()]))
    assert spelling.variants(spark.createDataFrame([], SCHEMA)).collect() == []


def test_spelling_chain_ties_and_letters(spark):
    words = {"abcdefg": 125, "abcdefh": 25, "abcdeh": 5, "abcdefi": 25, "pèreètre": 5, "pèreêtre": 30, "pèreátre": 30,
             "aaaaaa": 6, "aaaaaaa": 6, "bananas": 5, "bananax": 4}
    rows = [(1, " ".join(w for w, c in words.items() for _ in range(c)), "fr", "s", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["word"]: r for r in spelling.variants(df).collect()}
    assert key(tuple(r) for r in got.values()) == key(brute_variants([r[:2] for r in rows]))
    assert got["abcdeh"]["root"] == "abcdefg" and got["abcdeh"]["form"] == "abcdefh"
    assert got["pèreètre"]["form"] == "pèreátre"  # ties: first in code-point order
    assert got["bananas"]["n_near"] == 0 and "bananax" not in got


@pytest.mark.parametrize("first,second", [(1, 4), (1, 5), (2, 3), (2, 4), (3, 1)])
def test_partenum_loses_no_pair(spark, first, second):
    rng = random.Random(first * 10 + second)
    words = {"".join(rng.choice("abcé") for _ in range(rng.randint(6, 9))) for _ in range(400)}
    for w in list(words)[:200]:  # edits at every place
        at = rng.randrange(len(w) + 1)
        words |= {w[:at] + rng.choice("abz") + w[at:], w[:at] + w[at + 1:] + "q", w[:at] + "y" + w[at + 1:]}
    words = sorted(w for w in words if len(w) >= 6)
    near = lambda a, b: (
        sum(x != y for x, y in zip(a, b)) == 1 if len(a) == len(b)
        else any(max(a, b, key=len)[:i] + max(a, b, key=len)[i + 1:] == min(a, b, key=len) for i in range(max(len(a), len(b))))
    )
    want = {(a, b) for i, a in enumerate(words) for b in words[i + 1:] if abs(len(a) - len(b)) < 2 and near(a, b)}
    df = spark.createDataFrame([(w,) for w in words], "word string")
    assert {tuple(r) for r in spelling.near_pairs(df, first, second).collect()} == want


def test_signatures_meet_within_two():
    rng = random.Random(3)
    for _ in range(300):
        w = [rng.choice("abcdé") for _ in range(rng.randint(6, 12))]
        v = list(w)
        v[rng.randrange(len(v))] = rng.choice("abcdéz")
        rng.shuffle(v)  # letters alone count
        for f, s in ((1, 4), (2, 3), (3, 1)):
            assert set(spelling.signatures("".join(w), f, s)) & set(spelling.signatures("".join(v), f, s))


# --- phrases ---

def brute_phrases(rows, least=100, most=5, top=2000):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, most + 1):
                f[lang].update(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if a >= least}
        inside = collections.Counter()
        for p, a in cand.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        inside[p[i:j]] = max(inside[p[i:j]], a)
        ranked = []
        for p, a in cand.items():
            if len(p) > 1 and not (p in inside and 100 * inside[p] >= 100 * a):
                score, k = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, x, y) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, p.decode(), -a, x, y, n[lang], -s))
    return out


def test_phrases_query_and_sql(spark):
    rows = [(r["text"], r["lang"]) for r in table(spark, SF)]
    got = key(QUERIES["op12_phrases"](spark, SF).collect())
    assert got and got == key(brute_phrases(rows))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    assert key(con.execute(ORACLES["op12_phrases"]).fetchall()) == got


@pytest.mark.parametrize("least,most,top", [(3, 5, 2000), (2, 3, 7), (5, 2, 2000)])
def test_phrases_awkward(spark, monkeypatch, least, most, top):
    monkeypatch.setattr(phrases, "HELD_BYTES", 2_000)  # several stripes of a prefix from one task
    got = phrases.collocations(awkward(spark), least, most, top).collect()
    assert got and key(got) == key(brute_phrases([r[1:3] for r in awkward_rows()], least, most, top))


def test_phrases_empty(spark):
    for rows in ([], [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "one two. three", "en", "s", 0)]):
        assert phrases.collocations(spark.createDataFrame(rows, SCHEMA), 2).collect() == []


def test_phrases_odd_characters(spark):
    text = "\x00 a\x0b b\x0c c\td É é.É é!x\ry z\x85w z\x85w A a" * 3
    rows = [(i, text, None, "s", 0) for i in range(3)]
    got = phrases.collocations(spark.createDataFrame(rows, SCHEMA), 3).collect()
    assert key(got) == key(brute_phrases([r[1:3] for r in rows], 3))


def test_stripes_merge_across_batches():
    rng = random.Random(4)
    want, rows = collections.Counter(), []
    for _ in range(400):
        p, part = f"p{rng.randrange(6)}", rng.randrange(2)
        words = rng.sample(["a", "b", "c", "d", ""], rng.randint(1, 5))
        counts = [rng.randrange(1, 9) for _ in words]
        rows.append(("en", p, part, " ".join(words), " ".join(map(str, counts))))
        for w, c in zip(words, counts):
            want[p, part, w] += c
    rows.sort(key=lambda r: r[:3])
    schema = pa.schema([("lang", pa.string()), ("prefix", pa.string()), ("part", pa.int32()),
                        ("words", pa.string()), ("counts", pa.string())])
    cut_at = [0, 1, 2, 90, 91, 300, 400]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[a:b]), schema.types)], schema=schema)
               for a, b in zip(cut_at, cut_at[1:])]
    got, seen = collections.Counter(), []
    for b in phrases.merge_stripes(batches):
        for r in b.to_pylist():
            seen.append((r["prefix"], r["part"]))
            for w, c in zip(r["words"].split(" "), r["counts"].split(" "), strict=True):
                assert (r["prefix"], r["part"], w) not in got
                got[r["prefix"], r["part"], w] = int(c)
    assert got == want and len(seen) == len(set(seen))


def test_hot_prefix_in_parts(spark, monkeypatch):
    rows = [(i, " ".join(f"the w{j % 40}" for j in range(200)), "en", "s", 0) for i in range(20)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = key(brute_phrases([r[1:3] for r in rows], 20))
    assert key(phrases.collocations(df, 20).collect()) == want
    words = df.selectExpr("lang", "explode(split(text, ' ')) w").distinct()
    known = [phrases.Bitmap.of(words.selectExpr("xxhash64(concat(lang, '\x1f', w)) hash"))]
    hot = np.array([phrases.word_hash(b"en", b"the")], np.uint64)
    merged = phrases.stripes(df.selectExpr("text", "lang", "1L AS n"), 2, known, hot, 20)
    assert merged.where("prefix = 'the'").count() > 10  # its stripe is dealt to many parts
    assert merged.where("prefix = 'the'").selectExpr("sum(total)").first()[0] == 4000


def test_bitmap_holds_every_phrase(spark):
    df = spark.range(50_000).selectExpr("xxhash64(concat('en', '\x1f', 'w', id, 'é')) AS hash")
    known = phrases.Bitmap.of(df)
    of = lambda lang: np.array([phrases.word_hash(lang, f"w{i}é".encode()) for i in range(50_000)], np.uint64)
    assert known.has(of(b"en")).all() and known.has(of(b"de")).sum() < 10_000


def test_runs_keep_every_pair_and_longer_phrase(spark):
    rows = [(" ".join(random.Random(i).choice("abcde") for _ in range(60)) + ". x y", "en") for i in range(40)]
    docs = spark.createDataFrame(rows, "text string, lang string").selectExpr("*", "1L AS n")
    frequent = {"a b", "b c", "c c", "e a"}
    hashes = lambda of: spark.createDataFrame(
        [(int(np.array([phrases.phrase_hash(b"en", p.encode())], np.uint64).view(np.int64)[0]),) for p in of], "hash bigint"
    )
    known = [phrases.Bitmap.of(hashes(["a", "b", "c", "d", "e"])), phrases.Bitmap.of(hashes(frequent))]
    want = collections.Counter()
    for text, _ in rows:
        ws = text.split(".")[0].split()
        run = ws[:1]
        for a, b in zip(ws, [*ws[1:], None]):
            if f"{a} {b}" in frequent:
                run.append(b)
            else:
                if len(run) > 1:
                    want[" ".join(run)] += 1
                run = [b]
    got = collections.Counter()
    for r in phrases.narrow(docs, known).collect():
        got[r["text"]] += r["n"]
    assert got == want


# --- quality rules ---

def brute_base(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    wins = collections.Counter(tuple(ws[i:i + 3]) for i in range(len(ws) - 2))
    hit = {i + j for i in range(len(ws) - 2) if wins[tuple(ws[i:i + 3])] > 1 for j in range(3)}
    n = len(ws)
    return (n, sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), n < 50 or 100 * len(hit) > 50 * n)


BASE = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def naive_quality(rows):
    """Votes by plain rules and plain EM, document by document."""
    votes = [r["votes"] for r in rows]
    code = {"b": 0, "g": 1, "-": 2}
    m = len(votes[0])
    prior, good, bad = 0.8, [0.02] * m, [0.3] * m
    for _ in range(quality_rules.ROUNDS):
        post = []
        for v in votes:
            a, b = prior, 1 - prior
            for j, x in enumerate(v):
                if code[x] != 2:
                    a *= good[j] if code[x] == 0 else 1 - good[j]
                    b *= bad[j] if code[x] == 0 else 1 - bad[j]
            post.append(a / (a + b))
        prior = (1 + sum(post)) / (2 + len(post))
        for j in range(m):
            cast = [(p, code[v[j]]) for p, v in zip(post, votes) if code[v[j]] != 2]
            good[j] = (0.02 + sum(p for p, x in cast if x == 0)) / (1 + sum(p for p, _ in cast))
            bad[j] = max(good[j], (0.3 + sum(1 - p for p, x in cast if x == 0)) / (1 + sum(1 - p for p, _ in cast)))
    return post


def test_quality_query(spark):
    rows = table(spark, SF)
    got = QUERIES["op13_quality_rules"](spark, SF)
    have = got.collect()
    assert key(tuple(r[c] for c in BASE) for r in have) == key((r["doc_id"], *brute_base(r["text"])) for r in rows)
    for r, p in zip(have, naive_quality(have)):
        assert r["quality"] == pytest.approx(p, abs=1e-4)
        assert r["kept"] == (not r["base_failed"] and r["quality"] >= 0.5)


def test_quality_awkward(spark):
    have = quality_rules.judge(awkward(spark)).collect()
    assert key(tuple(r[c] for c in BASE) for r in have) == key((r[0], *brute_base(r[1])) for r in awkward_rows())
    assert quality_rules.judge(spark.createDataFrame([], SCHEMA)).collect() == []


def test_quality_against_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels")}
    have = {r["doc_id"]: r for r in QUERIES["op13_quality_rules"](spark, sf).collect()}
    judged = [(q, have[d]) for d, q in labels.items() if d in have and not have[d]["base_failed"]]
    right = sum(r["kept"] == bool(q) for q, r in judged)
    assert right >= 0.97 * len(judged)  # the labels take no part in the estimate


def test_repeat_words():
    rng = random.Random(2)
    for _ in range(200):
        n, kinds = rng.randint(0, 30), rng.randint(1, 6)
        ids = [rng.randrange(kinds) for _ in range(n)]
        ids = [sorted(set(ids)).index(x) for x in ids]
        wins = collections.Counter(tuple(ids[i:i + 3]) for i in range(n - 2))
        want = len({i + j for i in range(n - 2) if wins[tuple(ids[i:i + 3])] > 1 for j in range(3)})
        assert quality_rules.repeat_words(np.array(ids, np.int64), len(set(ids))) == want


def test_vote_model_finds_the_rates():
    rng = np.random.default_rng(1)
    good = rng.random(20_000) < 0.7
    fire = np.where(good[:, None], 0.03, np.array([0.5, 0.4, 0.6, 0.3]))
    votes = np.where(rng.random(fire.shape) < fire, quality_rules.BAD, quality_rules.GOOD)
    votes[rng.random(votes.shape) < 0.2] = quality_rules.ABSTAIN
    kinds, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality_rules.VoteModel.fit(kinds, counts.astype(float))
    assert abs(model.prior - 0.7) < 0.05
    assert np.abs(model.good - 0.03).max() < 0.03 and np.abs(model.bad - [0.5, 0.4, 0.6, 0.3]).max() < 0.1
