"""Toxicity by a convolutional text classifier, trained in numpy.

A word's embedding is the sum of three hashed rows: the word, its first four and its first five
bytes (so unseen forms of a known stem are recognised). Filters of widths one, two and three run
over the whole text, the largest positive answer of each is kept, and a logistic layer scores the
pooled vector. One column of the embedding starts at the smoothed log odds of its bucket in the
training sample, the rest at random; Adagrad trains everything.

Training sample (bounded, documented): at most ``fit_rows`` labelled rows of each class among texts
of at most ``fit_bytes`` bytes, in hash order of the id. The sample is balanced, so the output's bias
is moved back to the labels' own odds, counted over all labelled rows in use. Labels are learned
only from rows whose crc32(doc_id as text) modulo ``folds`` is not 0; those with remainder 1 are not
used for fitting but to choose the thresholds: all of them are scored, whole texts, and for each
language with enough of both classes the score with the best F1 is taken, else 0.5. The cut is found
by running counts over the distinct scores, within bins of the score and then over the bins, so no
task holds a language. Scores never see label, language, source or id.

Defined cases: null or empty text gets the score of a text without words; null or unknown language
uses the threshold 0.5; a null doc_id is not held out and, if labelled, never used; conflicting
labels of one id count as the larger; labels without both classes: every score is the share of
toxic labels (0 without any); whole texts are scored, long ones in pieces; repeated rows each keep
their row; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakepact.llm.common import broadcast_below, cut, id_bucket, map_batches, slices, text_bytes

FOLDS = 5
FIT_ROWS, FIT_BYTES = 1500, 20_000
BUCKETS, DIM, FILTERS, WIDTHS = 1 << 15, 16, 16, (1, 2, 3)
EPOCHS, BATCH, LEARN = 6, 32, 0.05
CACHE_WORDS = 150_000
PIECE_WORDS = 100_000
LEAST_LABELS = 20  # of each class, for a language to get a threshold of its own
LABEL_BROADCAST = 1_000_000
SCORE_BINS = 64  # to a unit of the log odds
LANGUAGE_BROADCAST = 100_000

FOLD = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def features(word: bytes) -> tuple[int, int, int]:
    """Buckets of the word and of its stems; bucket 0 is the empty word's."""
    m = BUCKETS - 1
    return (
        zlib.crc32(word) % m + 1, zlib.crc32(b"4" + word[:4]) % m + 1, zlib.crc32(b"5" + word[:5]) % m + 1
    )


class TextCNN:
    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.embed = (rng.standard_normal((BUCKETS, DIM)) * 0.1).astype(np.float32)
        self.embed[0] = 0
        self.conv = {w: (rng.standard_normal((w, DIM, FILTERS)) * 0.2).astype(np.float32) for w in WIDTHS}
        self.bias = {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}
        self.out = (rng.standard_normal(FILTERS * len(WIDTHS)) * 0.2).astype(np.float32)
        self.out_bias = np.float32(0)
        self.constant: float | None = None

    # --- training ---

    def fit(self, texts: list[bytes], labels: list[int], odds: float, seed: int = 7) -> TextCNN:
        """Train on a balanced sample; ``odds`` are those of label 1 among all labelled rows."""
        y = np.array(labels, np.float32)
        if not len(y) or y.min() == y.max():
            self.constant = 0.0 if not len(y) else odds / (1 + odds) if np.isfinite(odds) else 1.0
            return self
        docs = []
        known: dict[bytes, tuple[int, int, int]] = {}
        for t in texts:
            ws = words(t)
            for w in ws:
                if w not in known:
                    known[w] = features(w)
            docs.append(np.array([known[w] for w in ws] or [(0, 0, 0)], np.int64))
        hits = np.zeros((2, BUCKETS))
        for d, label in zip(docs, y):
            hits[int(label), np.unique(d)] += 1
        n = np.array([(y == 0).sum(), (y == 1).sum()])
        self.embed[:, 0] = np.log((hits[1] + 0.5) / (n[1] + 1)) - np.log((hits[0] + 0.5) / (n[0] + 1))
        self.embed[0] = 0
        for w in WIDTHS:  # every width has a filter that starts as the sum of its words' log odds
            self.conv[w][:, :, 0] = 0
            self.conv[w][:, 0, 0] = 0.3
            self.out[WIDTHS.index(w) * FILTERS] = 0.5
        rng = np.random.default_rng(seed)
        self._sums = {k: np.full_like(v, 1e-3) for k, v in self._parameters().items()}
        for _ in range(EPOCHS):
            order = rng.permutation(len(docs))
            for at in range(0, len(docs), BATCH):
                self._step([docs[i] for i in order[at:at + BATCH]], y[order[at:at + BATCH]])
        del self._sums
        self.out_bias += np.float32(np.log(odds) - np.log(n[1] / n[0]))
        return self

    def _parameters(self) -> dict[str, np.ndarray]:
        return {"embed": self.embed, "out": self.out, **{f"c{w}": self.conv[w] for w in WIDTHS},
                **{f"b{w}": self.bias[w] for w in WIDTHS}}

    def _step(self, docs: list[np.ndarray], y: np.ndarray) -> None:
        widest = max(WIDTHS)
        size = np.array([len(d) + widest - 1 for d in docs])  # an empty word or two after each text
        begin = np.cumsum(size) - size
        f = np.zeros((size.sum() + widest - 1, 3), np.int64)
        for d, b in zip(docs, begin):
            f[b:b + len(d)] = d
        e = self.embed[f].sum(axis=1)
        n = size.sum()
        pooled, where = [], []
        for w in WIDTHS:
            z = sum(e[j:n + j] @ self.conv[w][j] for j in range(w)) + self.bias[w]
            # Windows start at words of the text only.
            z[np.concatenate([np.arange(b + s - widest + 1, b + s) for b, s in zip(begin, size)])] = -1
            best = np.stack([b + z[b:b + s].argmax(axis=0) for b, s in zip(begin, size)])
            pooled.append(np.maximum(z[best, np.arange(FILTERS)], 0))
            where.append(best)
        h = np.concatenate(pooled, axis=1)
        p = 1 / (1 + np.exp(-np.clip(h @ self.out + self.out_bias, -30, 30)))
        g = ((p - y) / len(y)).astype(np.float32)
        grads = {"out": h.T @ g + 1e-4 * self.out}
        back = np.outer(g, self.out)
        rows, deltas = [], []
        for i, w in enumerate(WIDTHS):
            gw = back[:, i * FILTERS:(i + 1) * FILTERS] * (pooled[i] > 0)
            conv = np.zeros_like(self.conv[w])
            for j in range(w):
                at = where[i] + j
                conv[j] = np.einsum("df,dfe->ef", gw, e[at])
                delta = gw[:, :, None] * self.conv[w][j].T[None]
                rows.append(f[at].reshape(-1, 3))
                deltas.append(delta.reshape(-1, DIM))
            grads[f"c{w}"], grads[f"b{w}"] = conv, gw.sum(axis=0)
        for k, g_ in grads.items():
            v, s = self._parameters()[k], self._sums[k]
            s += g_ * g_
            v -= LEARN * g_ / np.sqrt(s)
        self.out_bias -= np.float32(LEARN * g.sum())
        flat, d = np.concatenate(rows), np.concatenate(deltas)
        names, at = np.unique(flat, return_inverse=True)
        total = np.zeros((len(names), DIM), np.float32)
        np.add.at(total, at.reshape(flat.shape), d[:, None, :])
        total[names == 0] = 0
        s = self._sums["embed"][names] + total * total
        self._sums["embed"][names] = s
        self.embed[names] -= LEARN * total / np.sqrt(s)

    # --- scoring ---

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    """Scores texts; a word's part in every filter is computed once and remembered."""

    def __init__(self, model: TextCNN) -> None:
        self.m = model
        self.weights = np.concatenate([model.conv[w][j] for w in WIDTHS for j in range(w)], axis=1)
        self.clear()

    def clear(self) -> None:
        self.place: dict[bytes, int] = {b"": 0}
        self.parts = np.zeros((sum(WIDTHS), 1024, FILTERS), np.float32)

    def learn(self, fresh: list[bytes]) -> None:
        f = np.array([features(w) for w in fresh], np.int64)
        rows = self.m.embed[f].sum(axis=1) @ self.weights
        used = len(self.place)
        if used + len(rows) > self.parts.shape[1]:
            room = max(min(2 * used, CACHE_WORDS), used + len(rows))  # never beyond what may be remembered
            grown = np.zeros((sum(WIDTHS), room, FILTERS), np.float32)
            grown[:, :used] = self.parts[:, :used]
            self.parts = grown
        self.parts[:, used:used + len(rows)] = rows.reshape(len(rows), -1, FILTERS).transpose(1, 0, 2)
        self.place.update(zip(fresh, range(used, used + len(rows))))

    def pooled(self, texts: list[list[bytes]], goes_on: bool = False) -> np.ndarray:
        """Every filter's peak by text; of a text that goes on only windows that lie in it whole."""
        widest = max(WIDTHS)
        flat: list[bytes] = []
        for t in texts:
            flat += t or [b""]
            flat += [b""] * (widest - 1)
        try:
            at = [self.place[w] for w in flat]
        except KeyError:
            fresh = {w for w in flat if w not in self.place}
            if len(self.place) + len(fresh) > CACHE_WORDS:
                self.clear()
                fresh = set(flat) - {b""}
            self.learn(list(fresh))
            at = [self.place[w] for w in flat]
        at = np.array([*at, *[0] * (widest - 1)], np.int64)
        size = np.array([max(1, len(t)) + widest - 1 for t in texts])
        begin = np.cumsum(size) - size
        # Windows start at words only: odd entries of the edges close each text's own range.
        end = begin + size - (widest - 1) * (2 if goes_on else 1)
        edges = np.stack((begin, end), axis=1).reshape(-1)
        n, column, out = int(size.sum()), 0, []
        for w in WIDTHS:
            z = None
            for j in range(w):
                x = self.parts[column].take(at[j:n + j], axis=0)
                z = x if z is None else np.add(z, x, out=z)
                column += 1
            out.append(np.maximum.reduceat(z, edges, axis=0)[::2] + self.m.bias[w])
        return np.maximum(np.concatenate(out, axis=1), 0)

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.m.constant is not None:
            return np.full(len(texts), self.m.constant)
        out = np.empty((len(texts), FILTERS * len(WIDTHS)), np.float32)
        # Only one group's words are held at a time: as objects they take several times the texts' bytes.
        group: list[list[bytes]] = []
        places: list[int] = []
        size = 0

        def close() -> None:
            if group:
                out[places] = self.pooled(group)
                group.clear()
                places.clear()

        for i, t in enumerate(texts):
            ws = words(t)
            if len(ws) > PIECE_WORDS:  # pieces overlap, so that every window is seen
                step = PIECE_WORDS - max(WIDTHS) + 1
                parts = [self.pooled([ws[a:a + PIECE_WORDS]], a + PIECE_WORDS < len(ws))[0]
                         for a in range(0, len(ws) - max(WIDTHS) + 1, step)]
                out[i] = np.max(parts, axis=0)
                continue
            group.append(ws)
            places.append(i)
            size += len(ws)
            if size >= PIECE_WORDS // 4:
                close()
                size = 0
        close()
        z = out.astype(np.float64) @ self.m.out.astype(np.float64) + float(self.m.out_bias)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def best_threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """The cut with the best F1 (midway between two scores; of equal ones the nearest to 0.5)."""
    order = np.argsort(-scores, kind="stable")
    s, y = scores[order], labels[order]
    hit = np.cumsum(y)
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + y.sum())
    last = np.append(s[1:] != s[:-1], True)
    cuts = np.append((s[:-1] + s[1:]) / 2, s[-1] / 2)
    good = np.flatnonzero(last & (f1 >= f1[last].max() - 1e-12))
    return float(cuts[good[np.argmin(np.abs(cuts[good] - 0.5))]])


def best_thresholds(scored: DataFrame) -> dict[str, float]:
    """``best_threshold`` of each language of ``scored(lang, score, toxic)`` with enough of both classes."""
    odds = F.when(F.col("score") >= 1, F.lit(1e3)).when(F.col("score") <= 0, F.lit(-1e3)).otherwise(
        F.log("score") - F.log1p(-F.col("score"))
    )
    counts = cut(
        scored.where("lang is not null and lang <> ''").groupBy("lang", "score")
        .agg(F.count("*").alias("n"), F.sum("toxic").alias("y"))
        .withColumn("bin", F.floor(odds * SCORE_BINS))
    )
    # Running counts: bins of a language first (a few thousand rows), then the scores of a bin.
    down = Window.partitionBy("lang").orderBy(F.col("bin").desc())
    before = down.rowsBetween(Window.unboundedPreceding, -1)
    bins = counts.groupBy("lang", "bin").agg(F.sum("n").alias("n"), F.sum("y").alias("y"), F.max("score").alias("top")).select(
        "lang", "bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum("y").over(before), F.lit(0)).alias("y_before"), F.lead("top").over(down).alias("next_top"),
    )
    whole = counts.groupBy("lang").agg(F.sum("n").alias("n_all"), F.sum("y").alias("y_all")).where(
        F.least(F.col("y_all"), F.col("n_all") - F.col("y_all")) >= LEAST_LABELS
    )
    own = Window.partitionBy("lang", "bin").orderBy(F.col("score").desc())
    upto = own.rowsBetween(Window.unboundedPreceding, 0)
    cuts = counts.withColumn("n_own", F.sum("n").over(upto)).withColumn("y_own", F.sum("y").over(upto)).withColumn(
        "next", F.lead("score").over(own)
    ).join(bins, ["lang", "bin"]).join(broadcast_below(whole, LANGUAGE_BROADCAST), "lang").select(
        "lang", "score",
        (2 * (F.col("y_own") + F.col("y_before")) / (F.col("n_own") + F.col("n_before") + F.col("y_all"))).alias("f1"),
        ((F.col("score") + F.coalesce("next", "next_top", F.lit(0.0))) / 2).alias("cut"),
    )
    best = cuts.groupBy("lang").agg(F.max("f1").alias("best"))
    chosen = cuts.join(broadcast_below(best, LANGUAGE_BROADCAST), "lang").where("f1 >= best - 1e-12").groupBy("lang").agg(
        F.min_by("cut", F.struct(F.abs(F.col("cut") - 0.5), -F.col("score"))).alias("cut")
    )
    return {r["lang"]: r["cut"] for r in chosen.orderBy("lang").collect()}


def fit(docs: DataFrame, labels: DataFrame, folds: int = FOLDS) -> tuple[TextCNN, dict[str, float]]:
    """The model, from a bounded sample of labelled rows, and the thresholds by language, from all of their fold."""
    y = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic")
    ).withColumn("bucket", id_bucket("doc_id", folds)).where("bucket <> 0")
    counts = {r["toxic"]: r["n"] for r in y.where("bucket <> 1").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    short = docs.select("doc_id", "text").where(F.octet_length("text") <= FIT_BYTES)

    def sample(rows: DataFrame, most: int) -> list:
        """At most ``most`` rows of each class, by hash order of the id (a top-k per class)."""
        out = []
        for label in (0, 1):
            picked = rows.where(F.col("toxic") == label).withColumn("h", F.xxhash64("doc_id"))
            # ids first: only the chosen ids' texts travel
            ids = picked.select("doc_id", "toxic", "h").orderBy("h", "doc_id").limit(2 * most)
            out.append(short.join(broadcast_below(ids, 2 * most), "doc_id").orderBy("h", "doc_id", "text").limit(most))
        return out[0].unionByName(out[1]).collect()

    train = sample(y.where("bucket <> 1"), FIT_ROWS)
    odds = counts.get(1, 0) / counts[0] if counts.get(0) else float("inf")
    model = TextCNN().fit([(r["text"] or "").encode() for r in train], [r["toxic"] for r in train], odds)
    if model.constant is not None:
        return model, {}
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = sent.value.scorer()
        for b in slices(batches):
            scores = scorer.score(text_bytes(b.column(0)))
            yield pa.RecordBatch.from_arrays(
                [b.column(1), b.column(2), pa.array(scores, pa.float64())], ["lang", "toxic", "score"]
            )

    tune = y.where("bucket = 1").select("doc_id", "toxic")
    rows = docs.where(id_bucket("doc_id", folds) == 1).select(
        "doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    ).join(broadcast_below(tune, LABEL_BROADCAST), "doc_id").select("text", "lang", "toxic")
    return model, best_thresholds(map_batches(rows, run, "lang string, toxic int, score double"))


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = FOLDS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, threshold (its language's),
    toxic (score at or above it)."""
    model, thresholds = fit(docs, labels, folds)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = sent.value.scorer()
        for b in slices(batches):
            scores = scorer.score(text_bytes(b.column(1)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), b.column(3), pa.array(scores, pa.float64())],
                ["doc_id", "lang", "held_out", "score"],
            )

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"), (id_bucket("doc_id", folds) == 0).alias("held_out"),
    )
    scored = map_batches(rows, run, "doc_id bigint, lang string, held_out boolean, score double")
    bar = threshold_of(F.col("lang"), thresholds)
    return scored.select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        bar.alias("threshold"), (F.col("score") >= bar).alias("toxic"),
    )


def threshold_of(lang: Column, thresholds: dict[str, float]) -> Column:
    out = F.lit(0.5)
    for name, value in thresholds.items():
        out = F.when(lang == name, F.lit(value)).otherwise(out)
    return out


def drop_toxic(docs: DataFrame, labels: DataFrame, folds: int = FOLDS) -> DataFrame:
    """The documents whose score stays below their language's threshold; one pass, no shuffle."""
    model, thresholds = fit(docs, labels, folds)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at, lang_at = docs.columns.index("text"), docs.columns.index("lang")

    def run(batches):
        scorer = sent.value.scorer()
        for b in slices(batches):
            bars = np.array([thresholds.get(x, 0.5) for x in b.column(lang_at).to_pylist()])
            yield b.filter(pa.array(scorer.score(text_bytes(b.column(at))) < bars))

    return docs.mapInArrow(run, docs.schema)
