"""Trained operators and pair operators against brute force, on small fixtures and given tables."""

import hashlib
import random
import re
import shutil
import zlib

import numpy as np
import pytest
from helpers_llm import SCHEMA, awkward, awkward_rows
from pyspark.sql import functions as F

import corpus_pipeline
from lakepact.llm import embed_lsh, licence, pii_semicrf, qgram_decon, toxicity_cnn, url_rules

SF = "/root/testdata/sf0.01"


# --- PII ---

def plain_base(x):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", x)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", x):
        if all(int(p) < 256 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", x):
        d = re.sub("[ -]", "", m[0])
        if 14 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else (int(c) * 2 - 9 if int(c) > 4 else int(c) * 2)
                                      for i, c in enumerate(reversed(d))) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", x):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_pii_base_rules():
    rng = random.Random(4)
    for _ in range(4000):
        x = "".join(rng.choice("0123456789 -.@+()a%_é") if rng.random() < 0.6 else rng.choice("0123456789.@")
                    for _ in range(rng.randint(0, 40)))
        assert pii_semicrf.base_spans(x) == plain_base(x), x


@pytest.mark.parametrize("which", ["awkward", "given"])
def test_pii_query(spark, which):
    docs = awkward(spark) if which == "awkward" else spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    got = pii_semicrf.digest(pii_semicrf.find_entities(docs)).collect()
    show = lambda s: ",".join(f"{pii_semicrf.KINDS[k]}:{a}:{b}" for a, k, b in s)
    want = sorted(str((i, hashlib.sha256(show(plain_base(t)).encode()).hexdigest())) for i, t in rows)
    assert sorted(str((r["doc_id"], r["base_sha256"])) for r in got) == want
    for r in got:  # base spans stay; added ones overlap none
        spans = [tuple(s.split(":")) for s in r["spans"].split(",")] if r["spans"] else []
        assert r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] <= len(spans)


def every_segmentation(cands, i, n):
    """All ways to lay candidates (by index) over atoms i to n, atoms between them left alone."""
    if i >= n:
        yield []
        return
    yield from every_segmentation(cands, i + 1, n)
    for c, (start, end, _, _) in enumerate(cands):
        if start == i:
            for rest in every_segmentation(cands, end, n):
                yield [c, *rest]


def short_islands(count, seed=12):
    rng = random.Random(seed)
    bits = ["+49 ", "030", "1234567", " ", "-", "(0)", "555", "a@b.de", "10.0.0.1", ".", "@", "x", "4111111111111111", "99"]
    out = []
    while len(out) < count:
        x = "".join(rng.choice(bits) for _ in range(rng.randint(1, 6)))
        bounds = pii_semicrf.atoms(x, 0, len(x))
        if len(list(pii_semicrf.candidates(x, bounds))) <= 40 and len(bounds) <= 16:
            out.append(x)
    return out


def test_pii_decoding_equals_enumeration():
    """The dynamic program finds a segmentation of the highest score among all that there are."""
    rng = random.Random(5)
    model, found = pii_semicrf.SemiCRF(), 0
    for x in short_islands(300):
        bounds = pii_semicrf.atoms(x, 0, len(x))
        cands = list(pii_semicrf.candidates(x, bounds))
        for _, _, _, features in cands:  # weights of both signs, so that many segmentations compete
            for f in features:
                model.w.setdefault(f, rng.uniform(-2.0, 2.5))
        score = model._scores(cands)
        ways = list(every_segmentation(cands, 0, len(bounds) - 1))
        best = max(sum(score[c] for c in way) for way in ways)
        at = {(bounds[i], k, bounds[j]): score[c] for c, (i, j, k, _) in enumerate(cands)}
        got = model.decode(x, 0, len(x))
        assert all(a[2] <= b[0] for a, b in zip(got, got[1:]))
        assert abs(sum(at[span] for span in got) - best) < 1e-9, x
        found += len(got)
    assert found > 100


def test_pii_likelihood_equals_enumeration():
    """Forward sums hold exactly the segmentations there are: the likelihood is the plain one."""
    for x in short_islands(100, seed=13):
        model = pii_semicrf.SemiCRF()
        bounds = pii_semicrf.atoms(x, 0, len(x))
        cands = list(pii_semicrf.candidates(x, bounds))
        score = model._scores(cands)
        ways = [sum(score[c] for c in way) for way in every_segmentation(cands, 0, len(bounds) - 1)]
        gold = set(model.decode(x, 0, len(x)))
        true = sum(score[c] for c, (i, j, k, _) in enumerate(cands) if (bounds[i], k, bounds[j]) in gold)
        want = true - float(np.logaddexp.reduce(ways))
        assert abs(model.gradient_step(x, gold, 0.0) - want) < 1e-9, x


def test_pii_finds_what_stands_side_by_side(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = pii_semicrf.fit(docs)
    for text, want in (
        ("call +1 (269) 555-3296 4111111111111111 now", {("phone", "+1 (269) 555-3296"), ("card", "4111111111111111")}),
        ("no 4111111111111112 here", set()), ("order 1234567890", set()), ("v 300.1.2.3", set()),
    ):
        found = model.added(text, pii_semicrf.base_spans(text))
        assert {(pii_semicrf.KINDS[k], text[a:b]) for a, k, b in found} == want


def test_pii_long_islands(spark):
    """Entities of an island of many thousand characters, wherever they stand in it."""
    model = pii_semicrf.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    rng = random.Random(6)
    for sep in (" ", "  ", " - "):
        text, want = "", []
        for _ in range(900):
            number = f"({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
            want.append((len(text), 3, len(text) + len(number)))
            text += number + sep
        assert pii_semicrf.base_spans(text) == [] and len(pii_semicrf.islands(text, [])) == 1
        assert model.added(text, []) == want


# --- toxicity ---

def test_toxicity_held_out(spark):
    """In this table a part of the toxic labels outside English stands on texts without any sign of it
    (41 of 97 held-out ones); nearly all others are found, and clean texts are left alone."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    y = labels.select("doc_id", F.col("toxic").alias("y"))
    found = toxicity_cnn.score_documents(docs, labels)
    assert found.where("score < 0 or score > 1 or score is null or (score >= 0.5) <> (predicted = 1)").count() == 0
    r = found.where("held_out").join(y, "doc_id").join(docs.select("doc_id", "lang"), "doc_id").selectExpr(
        "avg(int(predicted = y))", "avg(if(y = 1 and lang = 'en', predicted, null))", "avg(if(y = 0, predicted, null))").first()
    assert r[0] > 0.94 and r[1] > 0.85 and r[2] < 0.01


def test_toxicity_awkward(spark):
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (None, 1, 1), (3, None, None)], "doc_id bigint, quality int, toxic int")
    docs = awkward(spark)
    assert toxicity_cnn.score_documents(docs, labels).count() == len(awkward_rows())
    assert toxicity_cnn.score_documents(docs, labels.where("false")).selectExpr("max(score)").first()[0] == 0.0
    assert toxicity_cnn.drop_toxic(docs, labels.where("false")).columns == docs.columns
    empty = spark.createDataFrame([], SCHEMA)
    assert toxicity_cnn.score_documents(empty, labels).count() == 0


def plain_score(model, text):
    """The net's score of one text, window by window in double precision."""
    zero = np.zeros(toxicity_cnn.DIM)
    e = [model.embed[list(toxicity_cnn.features(w))].astype(float).sum(axis=0) for w in toxicity_cnn.words(text)] or [zero]
    total = float(model.out_bias)
    for i, width in enumerate(toxicity_cnn.WIDTHS):
        for k in range(toxicity_cnn.FILTERS):
            peak = max(
                sum(float(np.dot(model.conv[width][j][:, k], e[at + j])) for j in range(width) if at + j < len(e))
                for at in range(len(e))
            ) + float(model.bias[width][k])
            total += float(model.out[i * toxicity_cnn.FILTERS + k]) * max(0.0, peak)
    return 1 / (1 + np.exp(-total))


def test_toxicity_score_equals_plain_net(monkeypatch):
    rng = random.Random(8)
    model = toxicity_cnn.TextCNN(seed=3)
    model.embed[1:] *= 8  # scores well apart
    for width in toxicity_cnn.WIDTHS:
        model.bias[width] += np.float32(0.1)
    vocab = [f"w{i}".encode() for i in range(40)] + ["été".encode(), b"!!", b"\xff"]
    texts = [b"", b" \n", b"one"] + [b" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 30))) for _ in range(30)]
    want = [plain_score(model, t) for t in texts]
    assert np.ptp(want) > 0.2
    assert np.allclose(model.scorer().score(texts), want, atol=1e-4)
    monkeypatch.setattr(toxicity_cnn, "PIECE_WORDS", 8)  # long texts in pieces
    assert np.allclose(model.scorer().score(texts), want, atol=1e-4)
    monkeypatch.setattr(toxicity_cnn, "CACHE_WORDS", 45)  # remembered words are dropped on the way
    scorer = model.scorer()
    got = np.concatenate([scorer.score(texts[i:i + 4]) for i in range(0, len(texts), 4)])
    assert np.allclose(got, want, atol=1e-4)


def test_toxicity_holds_few_words_at_a_time():
    import tracemalloc
    scorer = toxicity_cnn.TextCNN(seed=3).scorer()
    texts = [b" ".join(b"%d" % (i * k % 5000) for k in range(1000)) for i in range(400)]
    scorer.score(texts[:1])
    tracemalloc.start()
    scorer.score(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 18_000_000


def test_toxicity_remembers_no_more_than_it_may(monkeypatch):
    monkeypatch.setattr(toxicity_cnn, "CACHE_WORDS", 3000)
    scorer = toxicity_cnn.TextCNN(seed=3).scorer()
    for i in range(5):
        scorer.score([b" ".join(b"%d" % j for j in range(i * 500, i * 500 + 500))])
    assert len(scorer.place) == 2501 and scorer.parts.shape[1] <= 3000


def test_threshold_choice():
    assert toxicity_cnn.best_threshold(np.array([0.1, 0.2, 0.3, 0.9]), np.array([0, 0, 1, 1])) == pytest.approx(0.25)


def test_thresholds_of_all_labelled_rows(spark):
    """More rows of a class than a bounded sample held, and long texts: the cuts are those of all rows."""
    rng = random.Random(8)
    rows, marks = [], []
    for i in range(14000):
        toxic = int(rng.random() < 0.05)
        ws = [rng.choice(("sun", "moon", "tree", "road")) for _ in range(6)]
        ws += [rng.choice(("vile", "nasty", "cruel", "sun")) for _ in range(rng.choice((1, 2, 3) if toxic else (0, 0, 0, 1)))]
        rng.shuffle(ws)
        rows.append((i, " ".join(ws * (800 if i % 700 == 0 else 1)), rng.choice(("en", "de")), "s", 0))
        marks.append((i, 1, toxic))
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    model, got = toxicity_cnn.fit(docs, labels)
    fold = [(r[1].encode(), r[2], m[2]) for r, m in zip(rows, marks) if zlib.crc32(str(r[0]).encode()) % toxicity_cnn.FOLDS == 1]
    assert sum(not y for _, _, y in fold) > 1500
    scores = model.scorer().score([t for t, _, _ in fold])
    for lang in ("en", "de"):
        own = np.array([x == lang for _, x, _ in fold])
        truth = np.array([y for _, _, y in fold])[own]
        assert got[lang] == pytest.approx(toxicity_cnn.best_threshold(scores[own], truth), abs=1e-6)


# --- URL rules ---

def test_url_base_rules(spark):
    urls = ["http://A.Net/x", "http://net/", "http://net", "https://www.example.net/en/1?q", "https://example.net/de/",
            "http://example.com/de/x", "http://x.example.com/de", "http://a.org/fr/", "http://aorg/fr/", None, "no scheme",
            "x://", "http://h?p://q/r", "http://h#/net/", "://a.b.net/é", "http://notnet.com/a"]
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id bigint, url string, host string")
    got = {r["page_id"]: r for r in url_rules.judge(df, df.selectExpr("url", "0 as label")).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
        fits = [(h + p, v) for v, h, p in url_rules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda x: len(x[0]), default=(None, "allow"))
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == (host, path, rule, verdict), u


def rounded(rules):
    return {s: (round(a, 9), round(b, 9)) for s, (a, b) in rules.items()}


def level_wise(rows, least, confidence):
    """Smallest rules of any size, counting sets one token larger at a time."""
    from itertools import combinations

    found, level = {}, {frozenset([x]) for t, y in rows if y for x in t}
    while level:
        alone, both = dict.fromkeys(level, 0), dict.fromkeys(level, 0)
        size = len(next(iter(level)))
        tokens = set().union(*level)
        for t, y in rows:
            for s in map(frozenset, combinations(sorted(t & tokens), size)):
                if s in alone:
                    alone[s] += 1
                    both[s] += y
        often = {s for s in level if both[s] >= least}
        found |= {s: (both[s] / len(rows), both[s] / alone[s]) for s in often if both[s] >= confidence * alone[s]}
        left = often - set(found)
        level = {a | {x} for a in left for b in left for x in b - a if len(a | b) == size + 1}
        level = {s for s in level if all(s - {x} in left for x in s)}
    return found


def test_url_mining_equals_level_wise_count(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    labelled = url_rules.seed_labels(pages).where("page_id % 3 <> 0")
    hidden = set(url_rules.SEED_TOKENS)
    rows = [(frozenset(r["t"]) - hidden, r["label"]) for r in labelled.select(url_rules.tokens_of(F.col("url")).alias("t"), "label").collect()]
    want = level_wise(rows, max(2.0, 0.004 * len(rows)), 0.9)
    mined = url_rules.mine(labelled, 0.004, 0.9, url_rules.SEED_TOKENS).collect()
    got = {frozenset(r["tokens"]): (r["support"], r["confidence"]) for r in mined}
    assert len(got) == len(mined) and rounded(got) == rounded(want)
    assert any(len(s) > 1 for s in got) and not any(hidden & s for s in got)
    judged = url_rules.judge(pages, labelled, 0.004, 0.9, url_rules.SEED_TOKENS)
    beyond = 0
    for r in judged.select("page_id", "mined_rule").join(pages, "page_id").join(labelled.select("page_id", "label"), "page_id", "left").select(
        url_rules.tokens_of(F.col("url")).alias("t"), "mined_rule", "label"
    ).collect():
        assert (r["mined_rule"] is not None) == any(s <= set(r["t"]) for s in want)
        beyond += r["mined_rule"] is not None and r["label"] is None
    assert beyond > 0  # pages without a label are judged, too


def test_url_mining_sizes_and_hot_copies(spark):
    """Rules of four tokens; one URL holding a third of all rows; ties between rules."""
    rng = random.Random(8)
    rows = []
    for i in range(600):
        words = {f"w{rng.randrange(30)}" for _ in range(6)}
        four = [x for j, x in enumerate(("a", "b", "c", "d")) if i % 5 == 0 or j != i % 4]
        rows.append((i, "http://h.example/" + "/".join([*sorted(words), *four]), int(i % 5 == 0)))
    rows += [(1000 + i, "http://same.example/copy/" + "/".join(f"c{j}" for j in range(25)), i % 2) for i in range(300)]
    labelled = spark.createDataFrame(rows, "page_id bigint, url string, label int")
    items = [(frozenset(r["t"]), r["label"]) for r in labelled.select(url_rules.tokens_of(F.col("url")).alias("t"), "label").collect()]
    less = labelled.where("page_id < 1000")
    got = {frozenset(r["tokens"]): (r["support"], r["confidence"]) for r in url_rules.mine(less, 0.05, 0.9).collect()}
    assert rounded(got) == rounded(level_wise(items[:600], 30, 0.9)) and frozenset({"p=a", "p=b", "p=c", "p=d"}) in got
    some = {f"p=c{j}" for j in range(3, 25)}  # the copies' tokens; the fewer are left, the fewer sets there are to list
    got = {frozenset(r["tokens"]) for r in url_rules.mine(labelled, 0.05, 0.9, tuple(some)).collect()}
    assert got == set(level_wise([(t - some, y) for t, y in items], 45, 0.9))


def test_url_mining_without_both_kinds(spark):
    for rows in ([], [(1, "http://a.b/c", 1)], [(1, "http://a.b/c", 0), (2, None, 1)], [(1, "http://a.b/c", None)]):
        df = spark.createDataFrame(rows, "page_id bigint, url string, label int")
        assert url_rules.mine(df).collect() == []
        assert len(url_rules.judge(df, df).collect()) == len(rows)


def test_url_tokens_behind_a_long_path(spark):
    """Tokens behind the first dozens of a URL are mined like any other; every labelled page counts."""
    rng = random.Random(2)
    rows = []
    for i in range(400):
        path = "/".join(f"w{rng.randint(0, 60)}" for _ in range(70))
        tail = {0: "red=blue=green", 1: "red=blue", 2: "blue=green", 3: "red=green"}[i % 4]
        rows.append((i, f"http://a.example/{path}?{tail}", int(i % 4 == 0)))
    labelled = spark.createDataFrame(rows, "page_id bigint, url string, label int")
    got = {tuple(r["tokens"]): (r["support"], r["confidence"]) for r in url_rules.mine(labelled, 0.2, 0.9).collect()}
    assert got == {("q=blue", "q=green", "q=red"): (0.25, 1.0)}


def test_url_query_mines_from_all_pages(spark, tmp_path):
    """The blocked pages are all in fold 0, which mining left out before."""
    from lakepact.llm import queries

    zero = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 5 == 0]
    rows = [(i, f"http://casino-win.example/p{i}") for i in zero[:2]] + [(i, f"http://plain.example/p{i}") for i in zero[2:40]]
    spark.createDataFrame(rows, "page_id bigint, url string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r["page_id"]: r["mined_rule"] for r in queries.op5_url_rules(spark, str(tmp_path)).collect()}
    assert [i for i, x in got.items() if x] and {i for i, x in got.items() if x} == set(zero[:2])


# --- decontamination ---

def test_leaks_given(spark):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [(r["item_id"], qgram_decon.fold(r["text"].encode()).strip()) for r in bench.collect()]
    exact = {(r["doc_id"], i) for r in docs.collect() for i, t in items if t in qgram_decon.fold(r["text"].encode())}
    got = qgram_decon.find_leaks(docs, bench).collect()
    assert exact <= {(r["doc_id"], r["item_id"]) for r in got}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in got:
        if r["edits"] == 0:
            span = texts[r["doc_id"]][r["start"]:r["end"]]
            assert qgram_decon.fold(span.encode()).strip() in dict(items)[r["item_id"]]
    kept = qgram_decon.drop_leaks(docs, bench)
    leaked = {r["doc_id"] for r in got}
    assert {r["doc_id"] for r in kept.collect()} == set(texts) - leaked


def whole_distance(item, text):
    """Least edits of the whole item against any part of the text."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        old, row = row, [0] * len(row)
        for i in range(1, len(row)):
            row[i] = min(old[i - 1] + (item[i - 1] != c), old[i] + 1, row[i - 1] + 1)
        best = min(best, row[-1])
    return best


def test_leaks_with_edits_equal_brute_force():
    rng = random.Random(3)
    words = ["er", "than", "ing", "thor", "be", "of", "nd"]
    text = lambda n: " ".join(rng.choice(words) + rng.choice(words) for _ in range(n)).encode()
    for _ in range(120):
        item, around = text(rng.randint(3, 25)), text(60)
        s = bytearray(item)
        for _ in range(rng.randint(0, int(len(item) * 0.14))):
            p, o = rng.randrange(len(s)), rng.random()
            if o < 0.33:
                s[p] = rng.choice(b"abcde ")
            elif o < 0.66:
                s.insert(p, rng.choice(b"abcde "))
            elif len(s) > 1:
                del s[p]
        p = rng.randint(0, len(around))
        t = around[:p] + bytes(s) + around[p:]
        want = whole_distance(item, t)
        got = [m for m in qgram_decon.Block([item]).matches([b"", t, b"x"]) if m[0] == 1]
        assert (want <= len(item) // 10) == bool(got)
        if got:
            assert got[0][2] == want == whole_distance(item, t[got[0][3]:got[0][4]])


def test_short_items_equal_whole_word_search(spark, monkeypatch):
    rng = random.Random(8)
    words = ["a", "ab", "ñ", "abc", "b1", "漢字", "of", "than", "x" * 7, "er than", "a b"]
    items = sorted({" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))).encode() for _ in range(60)}, key=len)
    items = [t for t in items if len(t) < 20]
    texts = ["".join(rng.choice(words) + rng.choice([" ", "-", "", ". "]) for _ in range(rng.randint(0, 90))) for _ in range(60)]
    texts += ["", "a", " a", "ab", "aab a b", "a" * 300, "ab " * 200]
    folded = [qgram_decon.fold(t.encode()) for t in texts]
    want = set()
    for n, t in enumerate(folded):
        for i, item in enumerate(items):
            at = (b" " + t + b" ").find(b" " + item + b" ")  # the padding moves a place by as much as its blank
            if at >= 0:
                want.add((n, i, 0, at, at + len(item)))
    assert len({len(t) for t in items}) > 10 and len(want) > 500
    assert set(qgram_decon.Block(items, short=20).matches(folded)) == want
    monkeypatch.setattr(qgram_decon, "WINDOW", 64)
    monkeypatch.setattr(qgram_decon, "PIECE", 32)
    assert set(qgram_decon.Block(items, short=20).matches(folded)) == want
    docs = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(items)] + [(-1, " .?! ")], "item_id bigint, text string")
    found = qgram_decon.find_leaks(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(n, i) for n, i, *_ in want}
    assert all(texts[r["doc_id"]][r["start"]:r["end"]] for r in found)


def test_leaks_awkward_and_blocks(spark, monkeypatch):
    rows = awkward_rows()
    long = rows[75][1]
    bench = spark.createDataFrame(
        [(1, long[50000:50200]), (2, None), (3, ""), (4, "short"), (None, rows[60][1]), (1, rows[0][1] * 3 + "zzzz yyyy")],
        "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in qgram_decon.find_leaks(awkward(spark), bench).collect()}
    assert (130, 1) in got and {(100 + i, None) for i in range(12)} <= got
    monkeypatch.setattr(qgram_decon, "BLOCK_ITEMS", 1)
    monkeypatch.setattr(qgram_decon, "WINDOW", 4096)
    assert {(r["doc_id"], r["item_id"]) for r in qgram_decon.find_leaks(awkward(spark), bench).collect()} == got
    assert qgram_decon.find_leaks(awkward(spark), bench.where("false")).count() == 0
    assert qgram_decon.drop_leaks(awkward(spark), bench.where("false")).count() == len(rows)


# --- embeddings ---

def brute_vectors(rows, bar=0.93):
    n = len(rows)
    unit = []
    for _, v, _ in rows:
        ok = v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v, float) / np.sqrt(np.sum(np.square(np.array(v, float)))) if ok else None)
    root, links = list(range(n)), [0] * n

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            a, b = unit[i], unit[j]
            if rows[i][2] is not None and rows[i][2] == rows[j][2] and a is not None and b is not None and len(a) == len(b) and a @ b >= bar:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    low = {}
    for i in range(n):
        if rows[i][0] is not None:
            low[find(i)] = min(rows[i][0], low.get(find(i), rows[i][0]))
    return [(rows[i][0], links[i], low.get(find(i))) for i in range(n)]


def test_embeddings_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embed_lsh, "CHUNK", 16)  # so that hot buckets are cut into blocks
    rng = np.random.default_rng(2)
    rows, i = [], 0
    for label in (0, 1, None):
        for _ in range(12):
            centre = rng.standard_normal(64)
            for _ in range(rng.integers(1, 60)):
                v = centre + rng.standard_normal(64) * 0.15
                rows.append((i, [float(np.float32(x)) for x in v], label))
                i += 1
    rows += [(1000 + k, rows[5][1], rows[5][2]) for k in range(40)]
    rows += [(2000, None, 0), (2001, [0.0] * 64, 0), (2002, [float("nan")] * 64, 0), (2003, [], 0), (2004, [None] * 64, 0),
             (2005, [1.0, 2.0], 0), (2006, [2.0, 4.0], 0), (None, rows[5][1], rows[5][2]), (2007, [float("inf")] * 64, 1)]
    rows += [rows[7]] * 2
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").withColumn("cid", F.lit("x"))
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in embed_lsh.near_vectors(df).collect()), key=str)
    want = sorted(brute_vectors(rows), key=str)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    found, all_ = sum(g[1] for g in got), sum(w[1] for w in want)
    assert found >= 0.97 * all_
    assert np.mean([g[2] == w[2] for g, w in zip(got, want)]) > 0.98
    assert embed_lsh.near_vectors(df.where("false")).count() == 0


def test_embeddings_recall_given(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()][:1500]
    part = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = {r["vec_id"]: r["n_links"] for r in embed_lsh.near_vectors(part).collect()}
    want = {i: n for i, n, _ in brute_vectors(rows)}
    assert all(got[i] <= want[i] for i in want) and sum(got.values()) >= 0.95 * sum(want.values())


# --- licences ---

def test_licences(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lines = {"Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
             "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}
    want = sorted((r["doc_id"], lines[x]) for r in docs.collect() for x in r["text"].split("\n") if x in lines)
    got = licence.scan(docs).collect()
    assert sorted((r["doc_id"], r["family"]) for r in got) == want
    assert licence.scan(awkward(spark)).count() == 0 and licence.scan(docs.where("false")).count() == 0


def test_licence_held_out():
    """Sentences that are in no template."""
    plain = ["the quick brown fox jumps over the dog", "we went to the market on a sunny day", "numbers and words in a row"] * 40
    m = licence.LicenceModel().fit(plain)
    judge = lambda s: (m.judge(licence.words(s)) or (None,))[0]
    assert judge("All code here is licensed under the MIT License, see below") == "MIT"
    assert judge("Please note: licensed under the Apache License, Version 2.0 by its authors") == "Apache-2.0"
    assert judge("My driver's license was renewed on a sunny day") is None
    assert judge("Released under the Zorp Public License 7") in ("unknown", None)


WRAPPED = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software.""",
    "BSD": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are
met: retain the notice above.""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
notice appears.""",
}


def test_licence_wrapped(spark):
    plain = "Thand onesen erblest it hein ti inenan.\nEranenes whou therouou thon the heoron.\n\n"
    rows = [(i, plain + x + "\n\n" + plain, "en", "s", 0) for i, x in enumerate(WRAPPED.values())]
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("text not like '%icense%'").limit(400)
    got = licence.scan(docs.unionByName(spark.createDataFrame(rows, SCHEMA).selectExpr("-1 - doc_id as doc_id", *docs.columns[1:]))).collect()
    assert sorted((-1 - r["doc_id"], r["family"]) for r in got if r["doc_id"] < 0) == list(enumerate(WRAPPED))
    for r in got:
        if r["doc_id"] < 0:
            text, want = rows[-1 - r["doc_id"]][1], list(WRAPPED.values())[-1 - r["doc_id"]]
            assert len(set(text[r["start"]:r["end"]].split()) & set(want.split())) > 0.7 * len(set(want.split()))


def test_licence_without_key_word(spark):
    """Other wording reaches the model, through the query."""
    says = ["Distributed under the terms of the GNU GPL version 3", "Available under Apache-2.0", "MIT licensing applies",
            "You may sublicense under MIT", "Dedicated to the public domain (CC0 1.0)"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("text not like '%icense%'").limit(400)
    rows = spark.createDataFrame([(-1 - i, x, "en", "s", 0) for i, x in enumerate(says)], SCHEMA).select(*docs.columns)
    got = licence.scan(docs.unionByName(rows)).collect()
    assert {r["doc_id"] for r in got} == {-1 - i for i in range(len(says))}


# --- pipeline ---

def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "token_records"]
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, SF).cache()
    scores = toxicity_cnn.score_documents(docs, labels)
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in scores.where("not toxic").collect()}
    one = stages["near_duplicates"](spark, clean, SF).cache()
    from lakepact.llm import simhash

    reps = {r["component_id"] for r in simhash.near_duplicates(clean).collect()}
    assert sorted(r["doc_id"] for r in one.collect()) == sorted(reps)
    kept = stages["decontamination"](spark, one, SF).cache()
    leaked = {r["doc_id"] for r in qgram_decon.find_leaks(one, bench).collect()}
    assert {r["doc_id"] for r in kept.collect()} == reps - leaked
    mixed = stages["mixing"](spark, kept, SF).cache()
    assert mixed.columns == docs.columns
    last = stages["token_records"](spark, mixed, SF)
    assert last.count() == mixed.count()
    run = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, last.collect()))


def test_pipeline_awkward(spark, tmp_path, monkeypatch):
    """Extra columns named like the operators' own change no row; only the last stage's folder stays."""
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/plain/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/plain/benchmark.parquet")
    shutil.copytree(f"{tmp_path}/plain", f"{tmp_path}/clash")
    out = {}
    for name, extra in (("plain", False), ("clash", True)):
        sf, shared = f"{tmp_path}/{name}", tmp_path / f"shared-{name}"
        awkward(spark, extra=extra).write.parquet(f"{sf}/documents.parquet")
        monkeypatch.setattr(corpus_pipeline, "checkpoint_root", lambda spark, at=shared: str(at))
        out[name] = sorted(map(tuple, corpus_pipeline.run(spark, sf).collect()), key=str)
        assert [p.name.rsplit("-", 1)[0] for p in shared.iterdir()] == ["pipeline-token_records"]
    assert len(out["plain"]) > 0 and out["plain"] == out["clash"]
