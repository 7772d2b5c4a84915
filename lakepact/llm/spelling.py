"""Spelling variants by PartEnum signatures over letter multisets.

Words are the letter runs of all texts (lower-cased in A-Z, some runs with one letter taken out by the
rule of ``runs``), of at least ``MIN_LENGTH`` code points and ``MIN_COUNT`` occurrences. Two words are
near if they differ by exactly one inserted, deleted or replaced code point.

PartEnum: a word's letters are a set of (letter, copy) elements, a binary vector. One edit changes at
most two elements, so near words have Hamming distance two at most. Elements are dealt by a hash to
``first`` parts; some part holds at most ``2 // first`` of the differences. Each part is dealt again
to ``second`` smaller parts, and each choice of ``second - 2 // first`` of them is a signature (which
choice, and a hash of its elements). Two vectors within distance two agree in at least one signature.

Letters alone do not tell apart words built of the same syllables, so many words would share a
signature. One edit also leaves the first or the last half of the shorter word as it is. A word is
therefore keyed by (length of the shorter word, which half, the half, signature), once with its own
length and once as the longer of the two. Equal keys are joined, and the edit distance verifies each
pair. Nothing is lost: near words agree in a half and, whichever it is, in a signature. Words of one
key share at least half their letters in order and most of the rest, so groups stay small; a
colliding hash only adds a pair that fails.

A word's form is its most frequent near word (ties: first in code-point order) if that is at least
``RATIO`` times as frequent; the root is reached from form to form. Frequencies rise at each step by
that ratio, so chains end, and pointers that double reach their ends in a few rounds.

Defined cases: a null text has no words; a null doc_id is an empty one in the rule of ``runs``; texts of
any length are read whole; repeated rows each count; words without a near word have n_near 0; an
empty table gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakepact.llm.common import cut, map_batches, slices, text_bytes

MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
EVERY = 199  # runs whose checksum this divides lose a letter
DISTANCE = 2
FIRST, SECOND = 1, 4
# A run, of at least MIN_LENGTH code points; a shorter one is no word, whether or not it loses a letter.
RUN = re.compile(r"[A-Za-zÀ-ÿ]{%d,}" % MIN_LENGTH)
HELD_WORDS = 400_000


def runs(text: bytes, doc_id: int | None) -> Counter:
    """The words of one text and their counts, after the rule that takes letters out."""
    found = Counter(RUN.findall(text.lower().decode()))  # bytes: lowers A-Z only
    start = zlib.crc32(b"%s:" % (b"" if doc_id is None else b"%d" % doc_id))
    out: Counter = Counter()
    for word, n in found.items():
        h = zlib.crc32(word.encode(), start)
        if h % EVERY == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
        out[word] += n
    return out


def vocabulary(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words with ``min_count`` occurrences or more."""

    def run(batches):
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            words = [w for w in held if len(w) >= MIN_LENGTH]
            b = pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array([held[w] for w in words], pa.int64())], ["word", "n"]
            )
            held.clear()
            return b

        for b in slices(batches):
            for doc_id, text in zip(b.column(0).to_pylist(), text_bytes(b.column(1))):
                held.update(runs(text, doc_id))
            if len(held) > HELD_WORDS:
                yield out()
        yield out()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = map_batches(rows, run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= min_count)


_MIXED: dict[tuple[str, int], int] = {}


def _mixed(element: tuple[str, int]) -> int:
    """A 64-bit hash of one (letter, copy) element; there are few, so they are remembered."""
    h = _MIXED.get(element)
    if h is None:
        h = xxhash.xxh64_intdigest(f"{element[0]}{element[1]}".encode(), seed=1)
        if len(_MIXED) < 100_000:
            _MIXED[element] = h
    return h


def signatures(word: str, first: int = FIRST, second: int = SECOND) -> list[tuple[int, int]]:
    """PartEnum signatures (which choice, hash of its elements) of a word's letters."""
    left = DISTANCE // first
    sums = [[0] * second for _ in range(first)]
    copies: dict[str, int] = {}
    for letter in word:
        copies[letter] = copy = copies.get(letter, 0) + 1
        h = _mixed((letter, copy))
        # The sum of its elements' hashes stands for a part, whatever their order.
        sums[h % first][h // first % second] += h
    out = []
    for i, parts in enumerate(sums):
        for j, choice in enumerate(combinations(range(second), second - left)):
            out.append((i * 1000 + j, sum((2 * c + 1) * parts[c] for c in choice) & (1 << 64) - 1))
    return out


def keys(word: str, first: int = FIRST, second: int = SECOND) -> list[int]:
    """64-bit join keys: (shorter length, which half, the half, signature), signed."""
    own = signatures(word, first, second)
    out = []
    for shorter in (len(word), len(word) - 1):
        half = shorter // 2
        for side, text in enumerate((word[:half], word[-half:])):
            seed = xxhash.xxh64_intdigest(f"{shorter}/{side}/{text}".encode(), seed=2)
            out += [xxhash.xxh64_intdigest(b"%d/%d" % s, seed=seed) for s in own]
    return [k - (1 << 64) if k >> 63 else k for k in out]


def keyed(words: DataFrame, first: int = FIRST, second: int = SECOND) -> DataFrame:
    """(key, word, own): the keys of every word; ``own`` where the word is the shorter one or as long."""

    def run(batches):
        for b in slices(batches, rows=4096):
            names = b.column(0).to_pylist()
            found = [keys(w, first, second) for w in names]
            n = len(found[0]) if found else 0
            flat = pa.array([k for ks in found for k in ks], pa.int64())
            own = pa.array(([True] * (n // 2) + [False] * (n // 2)) * len(names), pa.bool_())
            at = pa.array([i for i in range(len(names)) for _ in range(n)], pa.int64())
            yield pa.RecordBatch.from_arrays([flat, b.column(0).take(at), own], ["key", "word", "own"])

    return map_batches(words.select("word"), run, "key bigint, word string, own boolean")


def near_pairs(words: DataFrame, first: int = FIRST, second: int = SECOND) -> DataFrame:
    """All pairs (u, v), u < v, of near words of ``words(word)``."""
    rows = keyed(words, first, second)
    u = rows.select("key", F.col("word").alias("u"), F.col("own").alias("u_own"))
    v = rows.select("key", F.col("word").alias("v"), F.col("own").alias("v_own"))
    same_length = F.col("u_own") | F.col("v_own")  # two longer ones meet by their own length, too
    near = F.levenshtein("u", "v", 1) == 1
    return u.join(v, ["key"]).where((F.col("u") < F.col("v")) & same_length & near).select("u", "v").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from ``forms(word, form)``: the end of each chain."""
    at = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("next_"))
        moved = cut(at.join(step, "root", "left"))
        if moved.where("next_ is not null").isEmpty():
            return at
        at = moved.select("word", F.coalesce("next_", "root").alias("root"))


def variants(docs: DataFrame, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = cut(vocabulary(docs, min_count))
    pairs = cut(near_pairs(words))
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    ranked = both.join(words.select(F.col("word").alias("v"), F.col("n").alias("v_n")), "v")
    best = ranked.groupBy(F.col("u").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("v_n")).alias("less"), F.col("v"))).alias("best")
    )
    is_form = -F.col("best.less") >= ratio * F.col("n")
    rows = cut(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(is_form, F.col("best.v")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"),
    ))
    ends = roots(rows.where("form is not null"))
    return rows.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
