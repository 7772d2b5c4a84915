"""Language-model scores by online logistic context mixing, and a unigram base score.

The text is scored as its lower-cased (A-Z) words joined by single spaces, with an end byte. Bytes
are coded bit by bit along a binary code tree chosen by the byte before (Huffman codes from corpus
counts, so common bytes take few decisions). The 63 commonest bytes have symbols of their own; any
other byte is an escape symbol followed by a byte of its own static code.

Predictors: counts of symbols by context, gathered over all training texts by Spark: the last three
symbols (backed off to the last two), the last four (hashed rows), and the current word so far (rows
for the commonest beginnings of frequent words, found by hash).
Each gives the log odds of the next bit at its node of the tree. A gate (does the fourth-order
context, does the word context know anything here) selects a weight set; the weighted sum of log
odds is squashed to a probability. Each gate has its own weights: they start at fixed values and are
moved along each document by the gradient of the coding cost of the bits that this gate mixed, after
every block of it (blocks double from 96 to 24,576 bytes), so the code length is that of a real
sequential coder. Last, an adaptive map per
document refines the mixed log odds by what their bucket has missed so far.

Score: log10 probability of the whole text, and total bits per byte. The base score is the
add-one unigram of the contract over exact counts of all training tokens. Tokens with at least
``N / 2**21`` occurrences (at most 2**21 of them by that rule, each of 64 bytes or less) are sent
to the tasks; all others are joined by key, where none is frequent enough to be a hot key.

Defined cases: null text counts as empty (one end token); a null doc_id is in the training part;
repeated rows are scored and counted each; very long texts are scored in pieces that carry all
state; an empty table gives an empty result, an empty training part N = V = 0; extra columns are
ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakepact.llm.common import cut, id_bucket, map_batches, slices, text_bytes

FOLDS, HELD_OUT = 7, 2
SYMBOLS = 64
ROW_BITS = 18  # rows of each table beyond order two
ORDERS = ("three", "four", "word")
LEAD = 64  # bytes before a piece of a very long text that its contexts look at
HEAD_SHARE, HEAD_BYTES = 1 << 21, 64
DICT_WORDS = 500_000
CHUNK_BYTES = 1 << 19  # of text scored at once
SCORE_ROWS = 512
COUNT_BYTES = 1 << 16  # of text counted at once: its arrays stay in a core's cache
PIECE_BYTES = 1 << 20
FIRST_BLOCK, BLOCK_STEPS = 96, 9  # bytes: 96, 192, ... 24576, then 24576 each
LEAST, LONGEST = 2e-4, 64  # LONGEST: above the depth of any code tree
END = 10  # the byte that ends a text; it never occurs inside
# Starting weights by gate (four knows + 2 * word knows), for the predictors in ORDERS.
START = np.array([[0.7, 0.0, 0.0], [0.6, 0.6, 0.0], [0.6, 0.0, 0.5], [0.15, 0.6, 0.45]], np.float32)
RATE, SLOW = 1.0, 400.0
PRIOR, BACK_OFF = 0.4, 2.0
MAP_BUCKETS, MAP_STEPS, MAP_PRIOR, MAP_GAIN = 24, 1.5, 60.0, 4.0
GATES = len(START)
LOG_STEPS = 6  # probabilities multiplied before their logarithm is taken; exp(-LIMIT) ** 6 is far from underflow
LIMIT = 11.0  # log odds beyond this are cut, so every text keeps a probability
FIRST_STEPS = np.log2(np.arange(FIRST_BLOCK * ((1 << BLOCK_STEPS) - 1) + 1) // FIRST_BLOCK + 1).astype(np.int64)
LAST_BLOCK = FIRST_BLOCK << (BLOCK_STEPS - 1)


def normal(text: bytes) -> bytes:
    return b" ".join(text.lower().split()) + b"\n"


# --- contexts ---------------------------------------------------------------------------------

def symbol_map(byte_counts: np.ndarray) -> np.ndarray:
    """Byte -> symbol: the 63 commonest bytes, 63 for the rest; the end byte always has its own."""
    weight = byte_counts.astype(np.float64).copy()
    weight[END] = np.inf
    order = np.argsort(-weight, kind="stable")[:SYMBOLS - 1]
    m = np.full(256, SYMBOLS - 1, np.uint8)
    m[np.sort(order)] = np.arange(len(order))
    return m


def contexts(sym: np.ndarray, lag: list[np.ndarray], words: WordRows) -> list[np.ndarray]:
    """Row of each predictor's table for each position; ``lag[d]`` is the symbol d + 1 back."""
    p = [x.astype(np.uint32) for x in lag]
    first = p[0] << np.uint32(ROW_BITS - 6)
    pair = p[1] << np.uint32(6) | p[2]
    four = ((pair << np.uint32(6) | p[3]) + np.uint32(1)) * GOLDEN >> np.uint32(32 - (ROW_BITS - 6))
    return [first | pair, first | four, words.rows(sym, lag[0])]


GOLDEN, STEP = np.uint32(0x9E3779B1), 0x01000193
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """STEP ** i and its inverse ** i modulo 2 ** 32, i below n."""
    if not _POWERS or len(_POWERS[0]) < n:
        back = pow(STEP, -1, 1 << 32)
        _POWERS[:] = [np.multiply.accumulate(np.r_[1, np.full(2 * n, x)].astype(np.uint32), dtype=np.uint32) for x in (STEP, back)]
    return _POWERS[0][:n], _POWERS[1][:n]


class WordRows:
    """Rows for the commonest beginnings of words; row 0 stands for all others, 1 and 2 for the
    empty beginning after a space and at a text's start."""

    SLOTS = 21

    def __init__(self, head: dict[bytes, int], sym_of: np.ndarray) -> None:
        self.space, self.end = int(sym_of[32]), int(sym_of[END])
        count: Counter = Counter()
        table = sym_of.tobytes()
        for token, c in head.items():
            w = token.translate(table)
            for i in range(1, len(w) + 1):
                count[w[:i]] += c
        best = heapq.nsmallest((1 << ROW_BITS) - 3, count.items(), key=lambda x: (-x[1], x[0]))
        self.last = np.array([self.end, self.space, self.end, *(w[-1] for w, _ in best)], np.int64)
        self.check = np.zeros(1 << self.SLOTS, np.uint32)
        self.row = np.zeros(1 << self.SLOTS, np.int32)
        names = np.zeros(len(best), np.uint32)
        for i, (w, _) in enumerate(best):
            h = 0
            for c in w:
                h = (h + c + 1) * STEP & 0xFFFFFFFF
            names[i] = h
        slot = self._slot(names)[::-1]  # of two beginnings of one slot the commoner stays
        self.check[slot] = names[::-1]
        self.row[slot] = np.arange(len(best), 0, -1) + 2

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return (h ^ h >> np.uint32(15)) * GOLDEN >> np.uint32(32 - self.SLOTS)

    def rows(self, sym: np.ndarray, before: np.ndarray) -> np.ndarray:
        power, back = _powers(len(sym) + 1)
        total = np.zeros(len(sym) + 1, np.uint32)
        np.cumsum((sym + np.uint32(1)) * back[:-1], out=total[1:], dtype=np.uint32)
        fresh = (before == self.space) | (before == self.end)
        start = np.maximum.accumulate(np.where(fresh, np.arange(len(sym), dtype=np.int32), 0))
        h = (total[:-1] - total.take(start)) * power[:-1]
        slot = self._slot(h)
        out = self.row.take(slot)
        out *= self.check.take(slot) == h
        out[fresh] = 1
        out[before == self.end] = 2
        return out


def lags(sym: np.ndarray, begin: np.ndarray, end: int, back: int = 4) -> list[np.ndarray]:
    """Symbols 1..back before each position, the end symbol before a text's begin."""
    out = []
    for d in range(1, back + 1):
        x = np.empty_like(sym)
        x[d:] = sym[:-d] if d < len(sym) else sym[:0]
        x[:d] = end
        for e in range(d):
            at = begin + e
            x[at[at < len(x)]] = end
        out.append(x)
    return out


# --- gathering --------------------------------------------------------------------------------

def byte_counts(vocabulary: DataFrame) -> np.ndarray:
    """Exact counts of each byte value of the training texts, from ``vocabulary(token, c)``."""

    def run(batches):
        total = np.zeros(256, np.float64)
        for b in batches:
            tokens = b.column(0).to_pylist()
            n = np.repeat(b.column(1).to_numpy(), [len(t) for t in tokens])
            total += np.bincount(np.frombuffer(b"".join(tokens), np.uint8), n, 256)
            total[32] += b.column(1).to_numpy().sum()
            total[END] += sum(c for t, c in zip(tokens, b.column(1).to_pylist()) if not t)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at].astype(np.int64))], ["byte", "n"])

    rows = map_batches(vocabulary, run, "byte bigint, n bigint").groupBy("byte").agg(F.sum("n").alias("n"))
    out = np.zeros(256, np.int64)
    for r in rows.collect():  # at most 256 rows
        out[r["byte"]] = r["n"]
    # Every token but the ends and the last word of each text is followed by a space.
    out[32] = max(0, out[32] - 2 * out[END])
    return out


def corpus_counts(train: DataFrame, sym_of: np.ndarray, words: WordRows) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each predictor (slot, count): slot = row * 64 + symbol. Summed over all training texts;
    the tables' sizes are fixed, whatever the corpus."""
    sent = train.sparkSession.sparkContext.broadcast(words)

    def run(batches):
        words = sent.value
        acc = [np.zeros(SYMBOLS << ROW_BITS, np.int32) for _ in ORDERS]

        def add(texts: list[bytes]) -> None:
            a = sym_of[np.frombuffer(b"".join(texts), np.uint8)]
            begin = np.cumsum([0] + [len(t) for t in texts[:-1]])
            for k, row in enumerate(contexts(a, lags(a, begin, words.end), words)):
                np.add.at(acc[k], row.astype(np.int64) << 6 | a, np.int32(1))

        held: list[bytes] = []
        size = seen = 0
        for b in slices(batches):
            for t in text_bytes(b.column(0)):
                t = normal(t)
                for at in range(0, len(t), PIECE_BYTES):
                    held.append(t[at:at + PIECE_BYTES])
                    size += len(held[-1])
                    if size >= COUNT_BYTES:
                        add(held)
                        seen += size
                        held, size = [], 0
                if seen > 1 << 30:  # far below what an int32 count can hold
                    yield from emit(acc)
                    for x in acc:
                        x[:] = 0
                    seen = 0
        if held:
            add(held)
        yield from emit(acc)

    def emit(acc):
        for k, x in enumerate(acc):
            at = np.flatnonzero(x)
            for lo in range(0, len(at), 100_000):
                part = at[lo:lo + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part + (k << (ROW_BITS + 6))), pa.array(x[part].astype(np.int64))], ["slot", "n"]
                )

    sums = map_batches(train.select("text"), run, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    table = sums.toArrow()  # at most the tables' fixed number of slots
    slot, n = table["slot"].to_numpy(), table["n"].to_numpy()
    order = slot >> (ROW_BITS + 6)
    return [(slot[order == k] & ((1 << (ROW_BITS + 6)) - 1), n[order == k]) for k in range(len(ORDERS))]


# --- model ------------------------------------------------------------------------------------

def huffman(weights: np.ndarray) -> list[list[tuple[int, int]]]:
    """For each symbol its path of (node, bit), root first; the root is node 0."""
    heap = [(float(w), i, i) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    kids: dict[int, tuple[int, int]] = {}
    fresh = len(weights)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        kids[fresh] = (a[2], b[2])
        heapq.heappush(heap, (a[0] + b[0], fresh, fresh))
        fresh += 1
    paths: list[list[tuple[int, int]]] = [[] for _ in weights]
    stack = [(fresh - 1, [])]
    while stack:
        x, path = stack.pop()
        if x < len(weights):
            paths[x] = path
            continue
        node = fresh - 1 - x
        for bit in (0, 1):
            stack.append((kids[x][bit], [*path, (node, bit)]))
    return paths


class Model:
    """Code trees, log-odds tables and the byte costs of escapes, built from corpus counts."""

    def __init__(self, counts: list[tuple[np.ndarray, np.ndarray]], bytes_: np.ndarray, words: WordRows) -> None:
        self.sym_of, self.words = symbol_map(bytes_), words
        self.end = words.end
        rare = self.sym_of == SYMBOLS - 1
        share = np.where(rare, bytes_ + 1.0, 0.0)
        self.escape_bits = np.where(rare, -np.log2(np.where(rare, share / share.sum(), 1.0)), 0.0)
        slot, n = counts[0]
        pairs = np.zeros((SYMBOLS, SYMBOLS))
        np.add.at(pairs, (slot >> 18, slot & 63), n)  # row = last << 12 | ...
        single = pairs.sum(axis=0) + 1.0
        # No symbol is taken for rarer than LEAST: that bounds the depth of the trees.
        share = [p / p.sum() for p in pairs + single / single.sum()]
        trees = [huffman(np.maximum(p, LEAST)) for p in share]
        flat = [p for tree in trees for p in tree]
        self.length = np.array([len(p) for p in flat], np.int64)
        self.offset = np.cumsum(self.length) - self.length
        self.step = np.array([x << 1 | y for p in flat for x, y in p], np.int32)
        # The second-order counts are sums of the third-order ones and back those off.
        two = self._counts(np.arange(SYMBOLS**2) >> 6, *_merge(slot >> 12 << 6 | slot & 63, n))
        prior = (two[0] + PRIOR) / (two.sum(axis=0) + 2 * PRIOR)
        self.place, self.odds = [], []
        for k, (slot, n) in enumerate(counts):
            rows, at = np.unique(slot >> 6, return_inverse=True)
            last = rows >> (ROW_BITS - 6) if k < 2 else words.last[rows]
            odds = np.empty((len(rows), SYMBOLS), np.float32)
            for lo in range(0, len(rows), 1 << 14):  # in blocks, for the driver's memory
                own = (at >= lo) & (at < lo + (1 << 14))
                ones, zeros = self._counts(last[lo:lo + (1 << 14)], (at[own] - lo) << 6 | slot[own] & 63, n[own])
                if k == 0:
                    base = prior.reshape(-1, SYMBOLS)[rows[lo:lo + (1 << 14)] >> 6].reshape(-1)
                    ones, zeros = ones + BACK_OFF * base, zeros + BACK_OFF * (1 - base)
                else:
                    ones, zeros = ones + PRIOR, zeros + PRIOR
                odds[lo:lo + (1 << 14)] = np.log(ones / zeros).reshape(-1, SYMBOLS)
            # Only rows that occur are kept; the first stands for all others.
            place = np.zeros(1 << ROW_BITS, np.int32)
            if k == 0:
                back = np.log(prior / (1 - prior))
                place[:] = np.repeat(np.arange(SYMBOLS**2), SYMBOLS)
            else:
                back = np.zeros(SYMBOLS)
                if k == 2:  # counts under row 0 are of many beginnings, with many code trees
                    odds[rows == 0] = 0
            place[rows] = np.arange(len(rows)) + len(back) // SYMBOLS
            if k == 2:
                place[0] = 0
            self.place.append(place)
            self.odds.append(np.concatenate((back.astype(np.float32), odds.reshape(-1))))

    def _counts(self, last: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """(ones, zeros) at every node of each row: ``at`` is row * 64 + symbol, ``last`` the symbol
        whose tree a row uses."""
        out = np.zeros((2, len(last) * SYMBOLS))
        for lo in range(0, len(at), 1 << 20):
            row, sym, c = at[lo:lo + (1 << 20)] >> 6, at[lo:lo + (1 << 20)] & 63, n[lo:lo + (1 << 20)]
            code = last[row] << 6 | sym
            size = self.length[code]
            step = self.step[np.repeat(self.offset[code] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
            np.add.at(out, (1 - (step & 1), np.repeat(row << 6, size) | step >> 1), np.repeat(c, size).astype(float))
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each normalised text."""
        bits = np.zeros(len(texts))
        group, size = [], 0
        for i, t in enumerate(texts):
            if len(t) > PIECE_BYTES:
                state = None
                for at in range(0, len(t), PIECE_BYTES):
                    b, state = self._chunk([t[max(0, at - LEAD):at + PIECE_BYTES]], min(at, LEAD), at, state)
                    bits[i] += b[0]
                continue
            group.append(i)
            size += len(t)
            if size >= CHUNK_BYTES:
                bits[group] = self._chunk([texts[j] for j in group])[0]
                group, size = [], 0
        if group:
            bits[group] = self._chunk([texts[j] for j in group])[0]
        return bits

    def _chunk(self, texts, lead: int = 0, done: int = 0, state=None):
        """Bits of each text. ``lead`` bytes of a single text are context only; ``done`` bytes of
        it came before, with the ``state`` they left."""
        raw = np.frombuffer(b"".join(texts), np.uint8)
        a = self.sym_of[raw]
        sizes = np.array([len(t) for t in texts])
        begin = np.cumsum(sizes) - sizes
        lag = lags(a, np.zeros(0, np.int64) if lead else begin, self.end)
        rows = [place.take(r) for place, r in zip(self.place, contexts(a, lag, self.words))]
        if lead:
            rows, lag = [x[lead:] for x in rows], [x[lead:] for x in lag]
            raw, a, sizes = raw[lead:], a[lead:], sizes - lead
        code = lag[0].astype(np.int64) << 6 | a
        bits = np.add.reduceat(self.escape_bits.take(raw), begin)
        # A round is one block of every text.
        text = np.repeat(np.arange(len(sizes)), sizes)
        where = np.arange(len(a)) - begin[text] + done
        last = FIRST_BLOCK * ((1 << BLOCK_STEPS) - 1)
        step = np.where(where < last, FIRST_STEPS.take(np.minimum(where, last)), BLOCK_STEPS + (where - last) // LAST_BLOCK)
        step -= step.min()
        # Inside a round, bytes with longer codes come first: the bytes that still have a decision
        # to take at depth d are then the first ones, and nothing has to be gathered for them.
        size = self.length.take(code)
        key = step * LONGEST + (LONGEST - 1 - size)
        order = np.argsort(key.astype(np.uint16) if key.max() < 65536 else key, kind="stable")
        code, text, step, size = code.take(order), text.take(order), step.take(order), size.take(order)
        gate = ((rows[1] > 0) + 2 * (rows[2] > 0)).take(order)
        rows = [x.take(order) << np.int32(6) for x in rows]
        offset = self.offset.take(code)
        rounds = np.flatnonzero(np.concatenate(([True], step[1:] != step[:-1])))
        kinds = len(rows)
        if state is None:
            delta = np.zeros((len(sizes) * GATES, kinds), np.float32)
            moved, seen = np.zeros((2, len(sizes) * MAP_BUCKETS), np.float32)
        else:
            delta, moved, seen = state
        for lo, hi in zip(rounds.tolist(), [*rounds[1:].tolist(), len(a)]):
            own, g, at = text[lo:hi], gate[lo:hi], offset[lo:hi]
            set_ = own * GATES + g  # every text has its own weights for every gate
            weight = [START[:, k].take(g) + delta[:, k].take(set_) for k in range(kinds)]
            row = [x[lo:hi] for x in rows]
            base = (own * MAP_BUCKETS + MAP_BUCKETS // 2).astype(np.int32)
            shift = moved / (seen + MAP_PRIOR)
            cost, likely = np.zeros(hi - lo, np.float32), np.ones(hi - lo, np.float32)
            buckets, misses = [], []
            slope = [np.zeros(hi - lo, np.float32) for _ in range(kinds)]
            alive = hi - lo - np.concatenate(([0], np.cumsum(np.bincount(size[lo:hi]))))
            for d in range(int(size[lo])):
                n = int(alive[d + 1])  # bytes whose code is longer than d
                path = self.step.take(at[:n] + d)
                miss = (path & 1).astype(np.float32)
                path >>= 1
                odds = [table.take(r[:n] + path) for table, r in zip(self.odds, row)]
                z = odds[0] * weight[0][:n]
                for k in range(1, kinds):
                    z += odds[k] * weight[k][:n]
                # The adaptive map: what the text's own bucket of log odds has been missing so far.
                bucket = (z * MAP_STEPS).astype(np.int32)
                np.clip(bucket, 1 - MAP_BUCKETS // 2, MAP_BUCKETS // 2 - 1, out=bucket)
                bucket += base[:n]
                buckets.append(bucket)
                z += shift.take(bucket)
                np.clip(z, -LIMIT, LIMIT, out=z)
                np.exp(-z, out=z)
                z += 1
                miss -= 1 / z  # the bit that came less its probability of being one
                for k in range(kinds):
                    slope[k][:n] += miss * odds[k]
                misses.append(miss)
                likely[:n] *= 1 - np.abs(miss)
                if d % LOG_STEPS == LOG_STEPS - 1:
                    cost += np.log2(likely)
                    likely[:] = 1
            # The map is read by the next round only, so the round's decisions are added at once.
            if buckets:
                bucket = np.concatenate(buckets)
                seen += np.bincount(bucket, minlength=len(seen))
                moved += np.bincount(bucket, np.concatenate(misses), len(seen)) * MAP_GAIN
            cost += np.log2(likely)
            bits -= np.bincount(own, cost, len(bits))
            many = np.bincount(set_, size[lo:hi], len(delta)) + SLOW
            for k in range(kinds):
                delta[:, k] += RATE * np.bincount(set_, slope[k], len(delta)) / many
        return bits, (delta, moved, seen)


def _merge(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    names, at = np.unique(key, return_inverse=True)
    return names, np.bincount(at, n, len(names))


# --- base -------------------------------------------------------------------------------------

def token_counts(train: DataFrame) -> DataFrame:
    """(token, c) of all training tokens; the end is the empty token."""

    def run(batches):
        counts: Counter = Counter()
        for b in slices(batches):
            for t in text_bytes(b.column(0)):
                counts.update(t.lower().split())
                counts[b""] += 1
                if len(counts) > DICT_WORDS:
                    yield from emit(counts)
                    counts.clear()
        yield from emit(counts)

    def emit(counts):
        keys, values = list(counts.keys()), list(counts.values())
        for lo in range(0, len(keys), 50_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[lo:lo + 50_000], pa.binary()), pa.array(values[lo:lo + 50_000], pa.int64())], ["token", "n"]
            )

    rows = map_batches(train.select("text"), run, "token binary, n bigint")
    return rows.groupBy("token").agg(F.sum("n").alias("c"))


def score_documents(docs: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte."""
    sc = docs.sparkSession.sparkContext
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
        (id_bucket("doc_id", folds) == held_out).alias("held_out"),
    )
    train = rows.where(~F.col("held_out"))
    vocabulary = cut(token_counts(train))
    total, distinct = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    bar = max(1, -(-total // HEAD_SHARE))
    is_head = (F.col("c") >= bar) & (F.length("token") <= HEAD_BYTES)
    head = {bytes(r["token"]): r["c"] for r in vocabulary.where(is_head).toLocalIterator()}
    raw = byte_counts(vocabulary)
    words = WordRows(head, symbol_map(raw))
    model = Model(corpus_counts(train, symbol_map(raw), words), raw, words)
    logs = {w: math.log10(c + 1) for w, c in head.items()}  # once, not in every task
    sent = sc.broadcast((model, logs))
    del head, logs, model

    def run(batches):
        model, logs = sent.value
        for b in slices(batches, rows=SCORE_ROWS):
            texts = text_bytes(b.column(1))
            n_tokens, known, base, tails, tail_n = [], [], [], [], []
            normals = []
            for t in texts:
                tokens = t.lower().split()
                normals.append(b" ".join(tokens) + b"\n")
                counts = Counter(tokens)
                counts[b""] = 1
                rest = [w for w in counts if w not in logs]
                n_rest = [counts.pop(w) for w in rest]
                n_tokens.append(len(tokens) + 1)
                known.append(len(tokens) + 1 - sum(n_rest))
                base.append(math.fsum(map(mul, map(logs.__getitem__, counts), counts.values())))
                tails.append(rest)
                tail_n.append(n_rest)
            bits = model.score(normals)
            size = np.array([len(t) for t in normals], np.float64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(n_tokens, pa.int64()), pa.array(known, pa.int64()),
                 pa.array(base, pa.float64()), pa.array(-bits * math.log10(2)), pa.array(bits / size),
                 pa.array(tails, pa.list_(pa.binary())), pa.array(tail_n, pa.list_(pa.int64()))],
                ["doc_id", "held_out", "n_tokens", "head_known", "head_sum", "score", "bits_per_byte", "tail", "tail_n"],
            )

    schema = (
        "doc_id bigint, held_out boolean, n_tokens bigint, head_known bigint, head_sum double, score double, "
        "bits_per_byte double, tail array<binary>, tail_n array<bigint>"
    )
    scored = cut(map_batches(rows.select("doc_id", "text", "held_out"), run, schema))
    scored = scored.withColumn("row", F.monotonically_increasing_id())
    tail = scored.select("row", F.explode(F.arrays_zip("tail", "tail_n")).alias("x")).select(
        "row", F.col("x.tail").alias("token"), F.col("x.tail_n").alias("n")
    )
    rest = tail.join(vocabulary.where(~is_head), "token").groupBy("row").agg(
        F.sum("n").alias("tail_known"), F.sum(F.log10(F.col("c") + 1.0) * F.col("n")).alias("tail_sum")
    )
    size = math.log10(total + distinct + 1)
    return scored.drop("tail", "tail_n").join(rest, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(int(total)).cast("bigint").alias("train_tokens"),
        (F.col("head_sum") + F.coalesce("tail_sum", F.lit(0.0)) - F.col("n_tokens") * F.lit(size)).alias("base_score"),
        "score", "bits_per_byte",
    )
