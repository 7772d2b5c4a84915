"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts are compared as UTF-8 bytes with A-Z lowered and every ASCII byte that is neither letter
nor digit turned into a space, so offsets stay those of the text. An item of ``n`` bytes may be
found with at most ``k = floor(rate * n)`` edits (insert, delete, substitute).

Q-gram lemma: a region within ``k`` edits of the item shares at least ``n - q + 1 - k * q`` of the
item's q-grams with it, at positions whose diagonals (text position minus item position) lie
within ``k`` of each other. Diagonals are cut into bands of ``2 * width`` that overlap by half
(``width`` a power of two above ``k``), so one band holds them all. Hits are counted per (item,
band) - distinct item positions only, as a q-gram that repeats in the text must not count twice.
Bands that reach the bound are verified: a banded semi-global alignment (the item whole, the
text's ends free) gives the least number of edits and the span.

q is 8, or for short items the largest that keeps the bound positive, down to 1; so every item
however short is found by the same rule. An item under ``short`` bytes (default 20) says little by
itself, so it is found without edits and as whole words only: what stands before and after it is a
blank (any ASCII byte but letters and digits) or the text's end.

The benchmark is a query set. It goes to the tasks in blocks of at most ``block_bytes`` bytes of
text; a benchmark of any size is worked through block by block, so what is broadcast is bounded.

Defined cases: null or empty documents and items match nothing (an item without letters, digits or
characters beyond ASCII is empty); whole texts are scanned; repeated rows and items each give their own rows; an empty benchmark finds nothing;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakepact.llm.common import map_batches, slices, text_bytes

Q = 8
RATE = 0.1
SHORT = 20
BLOCK_BYTES, BLOCK_ITEMS = 2 << 20, 1 << 16
# Bytes of text scanned at once; longer texts are scanned in windows that overlap.
WINDOW = 16 << 20
PIECE = 1 << 19
EDIT = 1 << 32

FOLD = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def fold(text: bytes) -> bytes:
    return text.translate(FOLD)


def edits_allowed(n: int, rate: float) -> int:
    return int(rate * n)


def gram_length(n: int, k: int, q: int = Q) -> int:
    """The largest q, at most ``q``, that keeps n - q + 1 - k * q positive."""
    return max(1, min(q, n // (k + 1)))


def grams(a: bytes, q: int) -> np.ndarray:
    """All q-grams of ``a`` (q at most 8) as integers."""
    n = len(a) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    m = n // 8 + 1
    padded = a + bytes(24)
    out = np.empty(8 * m, np.uint64)
    for o in range(8):
        out[o::8] = np.frombuffer(padded, "<u8", count=m, offset=o)
    return out[:n] & np.uint64((1 << (8 * q)) - 1) if q < 8 else out[:n]


def align(item: bytes, text: bytes, low: int, high: int) -> tuple[int, int, int]:
    """(edits, start, end) of the best place for the whole of ``item`` in ``text``, on alignments
    whose diagonals stay in low..high. Ties: the earliest start, then the earliest end."""
    n, d = len(item), high - low + 1
    rim = bytes(max(0, -low)) + text[max(0, low):max(0, high + n)]
    t = np.frombuffer(rim + bytes(max(0, d + n - len(rim))), np.uint8)
    it = np.frombuffer(item, np.uint8)
    at = np.arange(d, dtype=np.int64)
    # A cell holds edits * EDIT + the diagonal of its start: the minimum keeps the earliest start.
    inside = (at + low >= 0) & (at + low <= len(text))
    row = np.where(inside, at, 1 << 60)
    step = at * EDIT
    for i in range(1, n + 1):
        new = row + (t[i - 1:i - 1 + d] != it[i - 1]) * EDIT
        new[:-1] = np.minimum(new[:-1], row[1:] + EDIT)
        row = np.minimum.accumulate(new - step) + step
    row = np.where(at + low + n <= len(text), row, 1 << 60)
    row = np.where(at + low + n >= 0, row, 1 << 60)
    best = int(np.argmin(row))
    edits, start = divmod(int(row[best]), EDIT)
    return edits, start + low, best + low + n


def whole_words(part: bytes, start: int, end: int, first: bool, last: bool) -> bool:
    """Whether blanks or the text's ends stand around start..end of a window; ``first`` and ``last``: the
    window begins or ends its text (else windows overlap, and another one sees the place whole)."""
    before = part[start - 1] == 32 if start else first
    return before and (part[end] == 32 if end < len(part) else last)


class Block:
    """A block of items ready to scan texts with."""

    def __init__(self, items: list[bytes], rate: float = RATE, q: int = Q, short: int = 0) -> None:
        """Items under ``short`` bytes are found without edits, as whole words."""
        self.items, self.short = items, short
        size = np.array([len(t) for t in items], np.int64)
        self.k = np.array([edits_allowed(len(t), rate) if len(t) >= short else 0 for t in items], np.int64)
        qs = np.array([gram_length(len(t), int(k), q) for t, k in zip(items, self.k)])
        self.need = size - qs + 1 - self.k * qs
        # A band is two steps of 2 ** shift diagonals, 2 ** shift > k.
        self.shift = np.array([int(k).bit_length() for k in self.k], np.int64)
        self.longest = int(size.max())
        self.pos_bits = self.longest.bit_length()
        self.parts = []
        for length in sorted(set(qs.tolist())):
            own = np.flatnonzero(qs == length)
            g = [grams(items[i], length) for i in own]
            flat = np.concatenate(g)
            item = np.repeat(own, [len(x) for x in g])
            pos = np.concatenate([np.arange(len(x)) for x in g])
            order = np.argsort(flat, kind="stable")
            distinct, first, count = np.unique(flat[order], return_index=True, return_counts=True)
            bits = max(16, int(len(distinct) * 16).bit_length())
            seen = np.zeros(1 << bits, bool)
            seen[self._slot(distinct, bits)] = True
            self.parts.append((length, distinct, first, count, item[order], pos[order], bits, seen))

    @staticmethod
    def _slot(g: np.ndarray, bits: int) -> np.ndarray:
        return ((g * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)

    def _hits(self, text: bytes, part: tuple) -> np.ndarray:
        """Packed (item, band, item position) of every shared q-gram, twice: once for each band."""
        length, distinct, first, count, item, pos, bits, seen = part
        keys = []
        band_bits = 62 - self.pos_bits - BLOCK_ITEMS.bit_length()
        for at in range(0, len(text), PIECE):
            g = grams(text[at:at + PIECE + length - 1], length)
            where = np.flatnonzero(seen[self._slot(g, bits)])
            slot = np.searchsorted(distinct, g[where])
            slot[slot == len(distinct)] = 0
            hit = distinct[slot] == g[where]
            where, slot = where[hit], slot[hit]
            n = count[slot]
            if not n.sum():
                continue
            entry = np.repeat(first[slot] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            it, ip = item[entry], pos[entry]
            band = (np.repeat(where + at, n) - ip + self.longest) >> self.shift[it]
            for b in (band, band + 1):  # band b holds the steps b - 1 and b
                keys.append((((it << band_bits) | b) << self.pos_bits) | ip)
        return np.concatenate(keys) if keys else np.zeros(0, np.int64)

    def regions(self, text: bytes) -> list[tuple[int, int, int]]:
        """(item, lowest, highest diagonal) of the merged bands that reach their item's bound."""
        band_bits = 62 - self.pos_bits - BLOCK_ITEMS.bit_length()
        out: list[tuple[int, int, int]] = []
        for part in self.parts:
            key = np.sort(self._hits(text, part))
            if not len(key):
                continue
            # A q-gram that repeats in the text counts once for each item position.
            pair = key[np.concatenate(([True], key[1:] != key[:-1]))] >> self.pos_bits
            starts = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
            total = np.diff(np.concatenate((starts, [len(pair)])))
            it, b = pair[starts] >> band_bits, pair[starts] & ((1 << band_bits) - 1)
            good = total >= self.need[it]
            for i, x in zip(it[good].tolist(), b[good].tolist()):
                low = ((x - 1) << int(self.shift[i])) - self.longest
                high = ((x + 1) << int(self.shift[i])) - 1 - self.longest
                if out and out[-1][0] == i and low <= out[-1][2] + 1:
                    out[-1] = (i, out[-1][1], high)
                else:
                    out.append((i, low, high))
        return out

    def matches(self, texts: list[bytes]) -> list[tuple[int, int, int, int, int]]:
        """(text, item, edits, start, end): the best place of each item found in each text."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        gap = bytes(8)  # no item holds a zero byte
        overlap = 2 * self.longest + 64
        group, size = [], 0
        jobs = []
        for n, t in enumerate(texts):
            for at in range(0, max(1, len(t)), WINDOW):
                part = t[at:at + WINDOW + overlap] if len(t) > WINDOW else t
                if group and size + len(part) > WINDOW:
                    jobs.append(group)
                    group, size = [], 0
                group.append((n, at, part))
                size += len(part)
        jobs.append(group)
        for job in jobs:
            joined = gap.join(p for _, _, p in job)
            begin = np.cumsum([0] + [len(p) + len(gap) for _, _, p in job])
            for i, low, high in self.regions(joined):
                item, k = self.items[i], int(self.k[i])
                # Edits before the first or after the last shared q-gram may leave the band by k.
                low, high = low - k, high + k
                first = max(0, int(np.searchsorted(begin, low, "right")) - 1)
                last = min(len(job) - 1, int(np.searchsorted(begin, high + len(item) + k, "right")) - 1)
                for j in range(first, last + 1):
                    n, at, part = job[j]
                    a, z = low - int(begin[j]), high - int(begin[j])
                    a, z = max(a, -k), min(z, len(part) - len(item) + k)
                    if a > z:
                        continue
                    exact = part.find(item, max(0, a), z + len(item))
                    if len(item) < self.short:
                        # Each place until one stands between blanks; no place that is part of a word counts.
                        ends = at == 0, at + len(part) >= len(texts[n])
                        while exact >= 0 and not whole_words(part, exact, exact + len(item), *ends):
                            exact = part.find(item, exact + 1, z + len(item))
                        if exact < 0:
                            continue
                    edits, start, end = (0, exact, exact + len(item)) if exact >= 0 else align(item, part, a, z)
                    if edits <= k:
                        found = (edits, start + at, end + at)
                        best[n, i] = min(best.get((n, i), found), found)
        return [(n, i, *v) for (n, i), v in sorted(best.items())]


def blocks(benchmark: DataFrame, short: int = SHORT, rate: float = RATE, q: int = Q) -> Iterator[tuple[list, Block]]:
    """The benchmark's items in blocks of bounded size, with their ids; one block at a time is on
    the driver."""
    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    ids: list = []
    texts: list[bytes] = []
    size = 0
    for r in rows.where("text is not null").toLocalIterator():
        t = fold(r["text"].encode()).strip()
        if not t:
            continue
        if texts and (size + len(t) > BLOCK_BYTES or len(texts) >= BLOCK_ITEMS):
            yield ids, Block(texts, rate, q, short)
            ids, texts, size = [], [], 0
        ids.append(r["item_id"])
        texts.append(t)
        size += len(t)
    if texts:
        yield ids, Block(texts, rate, q, short)


def code_points(text: bytes, start: int, end: int) -> tuple[int, int]:
    """The byte span as code points, widened to whole characters."""
    while start > 0 and start < len(text) and text[start] & 0xC0 == 0x80:
        start -= 1
    while end < len(text) and text[end] & 0xC0 == 0x80:
        end += 1
    before = len(text[:start].decode())
    return before, before + len(text[start:end].decode())


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, rate: float = RATE, q: int = Q, short: int = SHORT
) -> DataFrame:
    """(doc_id, item_id, edits, start, end, item_bytes): the best place, in code points, of every
    benchmark item found in every document."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id bigint, item_id bigint, edits bigint, start bigint, end bigint, item_bytes bigint"
    sc = docs.sparkSession.sparkContext
    found = None
    for ids, block in blocks(benchmark, short, rate, q):
        sent = sc.broadcast((ids, block))

        def run(batches, sent=sent):
            ids, block = sent.value
            for b in slices(batches):
                docs_, raw = b.column(0).to_pylist(), text_bytes(b.column(1))
                out = []
                for n, i, edits, start, end in block.matches([fold(t) for t in raw]):
                    out.append((docs_[n], ids[i], edits, *code_points(raw[n], start, end), len(block.items[i])))
                cols = list(zip(*out)) if out else [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in cols],
                    ["doc_id", "item_id", "edits", "start", "end", "item_bytes"],
                )

        part = map_batches(rows, run, schema)
        found = part if found is None else found.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if found is None else found


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, rate: float = RATE, q: int = Q, short: int = SHORT
) -> DataFrame:
    """The documents without any benchmark item; one pass, no shuffle."""
    sc = docs.sparkSession.sparkContext
    at = docs.columns.index("text")
    for _, block in blocks(benchmark, short, rate, q):
        sent = sc.broadcast(block)

        def run(batches, sent=sent):
            block = sent.value
            for b in slices(batches):
                leaked = {n for n, *_ in block.matches([fold(t) for t in text_bytes(b.column(at))])}
                yield b.filter(pa.array([n not in leaked for n in range(b.num_rows)]))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
