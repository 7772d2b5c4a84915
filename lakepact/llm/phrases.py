"""Phrase collocations by the stripes pattern: each prefix keys an associative counter of next words.

Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and pieces into words. Per
language, level by level from one word to ``max_words``:

- A task maps its texts to stripes: a prefix of k - 1 words, and how often each word follows it. What
  follows but cannot make a candidate (an infrequent word, the piece's end) is counted under one
  entry without a word. Stripes are combined in the task before they leave it.
  From the third level on, tasks read only the runs of words in which every pair is frequent,
  written once in the shared folder.
- Stripes are dealt by prefix, sorted, and merged elementwise as a stream that holds one stripe. A
  prefix with more than 1/512 of all words is dealt in 64 parts by the hash of the next word; there
  are at most 512 such prefixes a level, so their list is small whatever the corpus.
- A merged stripe gives all three: its entries of ``min_count`` or more are the candidates of k words,
  its sum is the frequency of the prefix, and its largest entry the most frequent phrase that
  extends the prefix to the right. The same for extension to the left is a maximum by the
  phrase without its first word.

Pruning is exact: a phrase can only reach ``min_count`` if both its (k - 1)-word ends do. Tasks know
the frequent phrases of earlier levels from a bitmap of hashes, sixteen bits a phrase and at most
2 ** MAX_BITS bits (32 MB). Two phrases that share a bit cost an idle stripe or entry, never a result:
counts are always of the words themselves.

A candidate's lowest score ``floor(1000 * a * n / (l * r))`` over its cuts (ties: the shortest first
part) counts, in decimals of 38 digits. It is dropped if some longer candidate that holds it is as
frequent; by one word at a time, such a chain never falls below it, so the maxima of one word more
decide. Of each language, the first ``top`` by score, frequency and phrase (bytes) are returned.

Defined cases: a null text is empty and adds nothing; a null language is ``und``; texts of any length
are read whole, and one text may fill a batch by itself; repeated rows count each; ties are ordered
by the phrase; an empty table gives an empty result; columns other than text and lang are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakepact.llm.common import cut, map_batches, slices, text_bytes

MIN_COUNT, MAX_WORDS, TOP = 100, 5, 2000
MIN_BITS, MAX_BITS = 16, 28
# A prefix with more than this share of all words is dealt in HOT_PARTS parts.
HOT_SHARE, HOT_PARTS = 512, 64
# Bytes of text read in a task before what was found in them is handed on.
HELD_BYTES = 12 << 20

_STOPS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes(
    ord("\n") if c in _STOPS else ord(" ") if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256)
)
ROLL = 0x9E3779B97F4A7C15  # an odd multiplier
BREAK, NOTHING = -1, -2  # numbers of a piece's end (or of a word that ends all runs), and of an empty token


def fold(text: bytes) -> bytes:
    """A-Z lowered, piece marks as line feeds, tabs as blanks."""
    return text.translate(_FOLD)


def word_hash(lang: bytes, word: bytes) -> int:
    """XXH64, seed 42, unsigned: Spark's xxhash64 of the same string."""
    return xxhash.xxh64_intdigest(lang + b"\x1f" + word, seed=42)


def phrase_hash(lang: bytes, phrase: bytes) -> int:
    """The hashes of its words, rolled into one."""
    h = 0
    for word in phrase.split(b" "):
        h = (h * ROLL + word_hash(lang, word)) & (1 << 64) - 1
    return h


def _words(phrase: str, n: Column) -> Column:
    """The first ``n`` words of a phrase, or the last ``-n``."""
    return F.call_function("substring_index", F.col(phrase), F.lit(" "), n)


class Bitmap:
    """Which hashes may be those of frequent phrases."""

    def __init__(self, bits: int, words: np.ndarray) -> None:
        self.mask, self.words = np.uint64((1 << bits) - 1), words

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & self.mask
        return (self.words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)

    @classmethod
    def of(cls, phrases: DataFrame) -> Bitmap:
        """Bitmap of ``phrases(hash)``; Spark folds the bits, 64 a row, before they are fetched."""
        n = phrases.count()
        bits = min(MAX_BITS, max(MIN_BITS, (16 * n).bit_length()))
        at = F.col("hash").bitwiseAND(F.lit((1 << bits) - 1).cast("bigint"))
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("at").bitwiseAND(63).cast("int"))
        rows = (
            phrases.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("block")).agg(F.bit_or(bit).alias("set")).toArrow()
        )
        words = np.zeros(1 << (bits - 6), np.uint64)
        words[rows["block"].to_numpy()] = rows["set"].to_numpy().view(np.uint64)
        return cls(bits, words)


def encode(texts: list[bytes]) -> tuple[np.ndarray, pa.Array]:
    """Tokens of the texts as numbers, and what the numbers stand for: words, a line feed after each
    piece (and after each text), and empty tokens where blanks meet."""
    blob = fold(b"\n".join([*texts, b""])).replace(b"\n", b" \n ")
    tokens = pc.split_pattern(pa.array([blob], pa.binary()), b" ").flatten().dictionary_encode()
    return tokens.indices.to_numpy(), tokens.dictionary


def _by_lang(batches: Iterable[pa.RecordBatch]) -> Iterator[dict[bytes, tuple[list[bytes], list[int]]]]:
    """Texts and their weights by language, some HELD_BYTES at a time, from batches of (text, lang, n)."""
    held: dict[bytes, tuple[list[bytes], list[int]]] = {}
    size = 0
    for b in slices(batches, rows=4096):
        for text, lang, n in zip(text_bytes(b.column(0)), text_bytes(b.column(1)), b.column(2).to_pylist()):
            if text:
                texts, weights = held.setdefault(lang, ([], []))
                texts.append(text)
                weights.append(n)
                size += len(text)
        if size > HELD_BYTES:
            yield held
            held, size = {}, 0
    if held:
        yield held


def count_words(docs: DataFrame) -> DataFrame:
    """(lang, phrase, f): every word of ``docs(text, lang, n)`` and, with a null phrase, the words of
    the language in all."""

    def run(batches):
        for held in _by_lang(batches):
            for lang, (texts, _) in held.items():
                codes, names = encode(texts)
                counts = np.bincount(codes, minlength=len(names))
                words = pc.invert(pc.is_in(names, pa.array([b"", b"\n"], pa.binary())))
                counts = pa.array(counts).filter(words)
                f = pa.concat_arrays([counts, pa.array([pc.sum(counts).as_py() or 0], pa.int64())])
                phrase = pa.concat_arrays([names.filter(words).cast(pa.string()), pa.array([None], pa.string())])
                yield pa.RecordBatch.from_arrays([pa.array([lang.decode()] * len(f), pa.string()), phrase, f], ["lang", "phrase", "f"])

    return map_batches(docs, run, "lang string, phrase string, f bigint").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


class StripeMapper:
    """Frequent phrases in texts by language; ``known`` are the bitmaps of phrases of 1, 2, ... words."""

    def __init__(self, known: list[Bitmap], hot: np.ndarray | None = None) -> None:
        self.known, self.hot = known, np.zeros(0, np.uint64) if hot is None else hot

    def frequent(self, held: dict[bytes, tuple[list[bytes], list[int]]], k: int) -> tuple[np.ndarray, ...]:
        """Numbers of the words in a row, whether a frequent phrase of ``k`` words begins at each, the
        hash of that phrase, and how often each place counts (None: once). Sets what the numbers stand for."""
        rows, weigh, names, langs, hashes = [], [], [], [], []
        base, once = 0, all(w == 1 for _, weights in held.values() for w in weights)
        for lang, (texts, weights) in held.items():
            codes, words = encode(texts)
            start = lang + b"\x1f"
            h = np.fromiter((xxhash.xxh64_intdigest(start + w, seed=42) for w in words.to_pylist()), np.uint64, len(words))
            number = np.where(self.known[0].has(h), base + np.arange(len(words), dtype=np.int32), np.int32(BREAK))
            for mark, meaning in ((b"\n", BREAK), (b"", NOTHING)):
                at = pc.index(words, pa.scalar(mark, pa.binary())).as_py()
                if at >= 0:
                    number[at] = meaning
                if mark == b"\n" and not once:  # then the texts are runs, one piece each
                    ends = codes == at
            got = number[codes]
            real = got != NOTHING
            rows.append(got[real])
            if not once:
                weigh.append(np.append(np.array(weights, np.int64), 1)[np.cumsum(ends) - ends][real])
            names.append(words)
            langs.append(pa.array([lang]).cast(pa.string()).take(pa.array(np.zeros(len(words), np.int8))))
            hashes.append(h)
            base += len(words)
        first = np.concatenate([*rows, np.full(k + 1, BREAK, np.int32)])
        weight = None if once else np.concatenate([*weigh, np.ones(k + 1, np.int64)])
        self.names = pa.concat_arrays([*names, pa.array([b""], pa.binary())]).cast(pa.string())
        self.langs = pa.concat_arrays(langs)
        self.hashes = np.append(np.concatenate(hashes), np.uint64(0))
        ok = first >= 0
        rolled = self.hashes[first]
        for j in range(2, k + 1):
            at = np.flatnonzero(ok[:-1] & ok[1:])
            got = rolled[at] * np.uint64(ROLL) + self.hashes[first[at + j - 1]]
            keep = self.known[j - 1].has(got)
            ok = np.zeros(len(first), bool)
            rolled = np.zeros(len(first), np.uint64)
            ok[at[keep]], rolled[at[keep]] = True, got[keep]
        return first, ok, rolled, weight

    def phrases(self, first: np.ndarray, at: np.ndarray, k: int) -> pa.Array:
        """The phrases of ``k`` words that begin at the places ``at``."""
        words = [self.names.take(pa.array(first[at + j])) for j in range(k)]
        return words[0] if k == 1 else pc.binary_join_element_wise(*words, " ")

    def runs(self, held: dict[bytes, tuple[list[bytes], list[int]]]) -> pa.RecordBatch:
        """Longest runs of words in which all pairs are frequent: lang, text, n (equal runs are one row)."""
        first, ok, _, _ = self.frequent(held, 2)
        edge = np.diff(ok.astype(np.int8), prepend=0, append=0)
        buffer, size = first.tobytes(), first.itemsize
        found = Counter(
            buffer[a * size:(b + 1) * size] for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())
        )
        ids = np.frombuffer(b"".join(found), first.dtype)
        starts = np.cumsum([0, *(len(x) // size for x in found)])
        return pa.RecordBatch.from_arrays(
            [self.langs.take(pa.array(ids[starts[:-1]])), _joined(pa.array(starts, pa.int32()), self.names.take(pa.array(ids))),
             pa.array(list(found.values()), pa.int64())],
            ["lang", "text", "n"],
        )

    def stripes(self, held: dict[bytes, tuple[list[bytes], list[int]]], k: int) -> pa.RecordBatch:
        """Stripes of the frequent prefixes of ``k - 1`` words. Words and counts of a stripe are joined
        by blanks; the entry of what makes no candidate has an empty word."""
        first, ok, rolled, weight = self.frequent(held, k - 1)
        at = np.flatnonzero(ok)
        # The next word counts by name only if the phrase without its first word is frequent, too.
        nxt = np.where(ok[at + 1], first[at + k - 1], BREAK).astype(np.int64)
        prefix = first[at].astype(np.int64)
        for j in range(1, k - 1):  # exact numbers of the prefixes
            _, prefix = np.unique(prefix * len(self.names) + first[at + j], return_inverse=True)
        place = np.zeros(prefix.max(initial=-1) + 1, np.int64)  # of one occurrence of each
        place[prefix] = at
        wide = len(self.names)
        if weight is None:
            kinds, counts = np.unique(prefix * wide + nxt + 1, return_counts=True)
        else:
            kinds, which = np.unique(prefix * wide + nxt + 1, return_inverse=True)
            counts = np.zeros(len(kinds), np.int64)
            np.add.at(counts, which, weight[at])
        prefix, nxt = np.divmod(kinds, wide)
        nxt -= 1
        spread = (self.hashes[nxt] % np.uint64(HOT_PARTS)).astype(np.int64)
        dealt = prefix * HOT_PARTS + np.where(np.isin(rolled[place], self.hot)[prefix] & (nxt >= 0), spread, 0)
        order = np.argsort(dealt, kind="stable")  # entries are in order but for the parts of hot prefixes
        dealt, nxt, counts = dealt[order], nxt[order], counts[order]
        new = np.flatnonzero(np.diff(dealt, prepend=-1))
        prefix, part = np.divmod(dealt[new], HOT_PARTS)
        place = place[prefix]
        offsets = pa.array(np.append(new, len(dealt)), pa.int32())
        words = self.names.take(pa.array(np.where(nxt < 0, wide - 1, nxt)))
        return pa.RecordBatch.from_arrays(
            [self.langs.take(pa.array(first[place])), self.phrases(first, place, k - 1), pa.array(part, pa.int32()),
             _joined(offsets, words), _joined(offsets, pa.array(counts).cast(pa.string()))],
            STRIPE,
        )


STRIPE = ["lang", "prefix", "part", "words", "counts"]


def _joined(offsets: pa.Array, values: pa.Array) -> pa.Array:
    return pc.binary_join(pa.ListArray.from_arrays(offsets, values), " ")


def merge_stripes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stripes sorted by (lang, prefix, part), merged elementwise; holds a batch and one stripe."""
    left = None  # the last stripe, to which the next batch may add
    for b in batches:
        if not b.num_rows:
            continue
        merged = _merge(b if left is None else pa.concat_batches([left, b]))
        left = merged.slice(merged.num_rows - 1)
        if merged.num_rows > 1:
            yield merged.slice(0, merged.num_rows - 1)
    if left is not None:
        yield left


def _entries(b: pa.RecordBatch) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The row, word and count of every entry."""
    words = pc.split_pattern(b.column(3), " ")
    lengths = words.value_lengths().to_numpy()
    counts = pc.split_pattern(b.column(4), " ").flatten().cast(pa.int64()).to_numpy()
    return np.repeat(np.arange(b.num_rows), lengths), words.flatten(), counts


def _merge(b: pa.RecordBatch) -> pa.RecordBatch:
    changed = np.zeros(b.num_rows, bool)
    changed[0] = True
    for c in range(3):
        codes = b.column(c).dictionary_encode().indices.to_numpy()
        changed[1:] |= codes[1:] != codes[:-1]
    if changed.all():
        return b
    group, start = np.cumsum(changed) - 1, np.flatnonzero(changed)
    row, words, counts = _entries(b)
    words = words.dictionary_encode()
    wide = len(words.dictionary)
    key = group[row] * wide + words.indices.to_numpy()
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.flatnonzero(np.diff(key, prepend=-1) != 0)
    sums = np.add.reduceat(counts[order], new)
    of, code = np.divmod(key[new], wide)
    offsets = pa.array(np.searchsorted(of, np.arange(len(start) + 1)), pa.int32())
    first = pa.array(start)
    return pa.RecordBatch.from_arrays(
        [b.column(0).take(first), b.column(1).take(first), b.column(2).take(first),
         _joined(offsets, words.dictionary.take(pa.array(code))), _joined(offsets, pa.array(sums).cast(pa.string()))],
        STRIPE,
    )


DIGEST = "lang string, prefix string, total bigint, largest bigint, words array<string>, counts array<bigint>, hashes array<bigint>"


def digest_stripes(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Of each merged stripe: its sum, its largest named entry, and its entries of ``least`` or more
    with the hash of the phrase that each makes."""
    for b in merge_stripes(batches):
        row, words, counts = _entries(b)
        starts = np.flatnonzero(np.diff(row, prepend=-1))  # no stripe is empty
        named = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
        keep = named & (counts >= least)
        kept, names = row[keep], words.filter(pa.array(keep))
        offsets = pa.array(np.searchsorted(kept, np.arange(b.num_rows + 1)), pa.int32())
        phrases = pc.binary_join_element_wise(b.column(1).take(pa.array(kept)), names, " ")
        langs = b.column(0).take(pa.array(kept))
        hashes = np.array([phrase_hash(g, p) for g, p in zip(text_bytes(langs), text_bytes(phrases))], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(np.add.reduceat(counts, starts)),
             pa.array(np.maximum.reduceat(np.where(named, counts, 0), starts)),
             *(pa.ListArray.from_arrays(offsets, x) for x in (names, pa.array(counts[keep]), pa.array(hashes)))],
            [f.split()[0] for f in DIGEST.split(", ")],
        )


def narrow(docs: DataFrame, known: list[Bitmap]) -> DataFrame:
    """(text, lang, n): the runs of words of ``docs(text, lang, n)`` in which every pair is frequent.
    Longer candidates lie in them whole, and so does every occurrence of a frequent pair."""
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        mapper = StripeMapper(sent.value)
        for held in _by_lang(batches):
            yield mapper.runs(held)

    return map_batches(docs, run, "lang string, text string, n bigint").select("text", "lang", "n")


def stripes(texts: DataFrame, k: int, known: list[Bitmap], hot: np.ndarray, min_count: int) -> DataFrame:
    """DIGEST rows of the prefixes of ``k - 1`` words in ``texts(text, lang, n)``; hot ones in parts."""
    sent = texts.sparkSession.sparkContext.broadcast((known, hot))

    def run(batches):
        mapper = StripeMapper(*sent.value)
        for held in _by_lang(batches):
            yield mapper.stripes(held, k)

    dealt = map_batches(texts, run, "lang string, prefix string, part int, words string, counts string")
    dealt = dealt.repartition("lang", "prefix", "part").sortWithinPartitions("lang", "prefix", "part")
    return map_batches(dealt, lambda batches: digest_stripes(batches, min_count), DIGEST)


def _hot(phrases: DataFrame, words: int) -> np.ndarray:
    """Hashes of the phrases (f, hash) with over 1/HOT_SHARE of ``words``: fewer than HOT_SHARE rows."""
    rows = phrases.where(F.col("f") * HOT_SHARE > words).select("hash").collect()
    return np.array([r["hash"] for r in rows], np.int64).view(np.uint64)


def candidates(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The candidates (lang, phrase, k, f, longer), frequencies of their parts (lang, phrase, f), and words (lang, n)."""
    texts = docs.select(
        F.col("text").cast("string").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.lit(1).cast("bigint").alias("n"),
    )
    words = cut(count_words(texts).where(F.col("phrase").isNull() | (F.col("f") >= min_count)))
    totals = words.where("phrase is null").select("lang", F.col("f").alias("n"))
    in_all = totals.agg(F.sum("n")).first()[0] or 0
    of_word = F.xxhash64(F.concat("lang", F.lit("\x1f"), "phrase"))
    last = words.where("phrase is not null").select("lang", "phrase", "f", of_word.alias("hash"))
    known: list[Bitmap] = []
    found, sums, longer = [], [], []
    for k in range(2, max_words + 1):
        known.append(Bitmap.of(last))
        if k == 3:
            texts = cut(narrow(texts, known))
        merged = cut(stripes(texts, k, known, _hot(last, in_all), min_count))
        sums.append(merged.groupBy("lang", F.col("prefix").alias("phrase")).agg(F.sum("total").alias("f")))
        longer.append(merged.select("lang", F.col("prefix").alias("phrase"), F.col("largest").alias("f")))
        last = merged.select("lang", "prefix", F.explode(F.arrays_zip("words", "counts", "hashes")).alias("e")).select(
            "lang", F.concat_ws(" ", "prefix", "e.words").alias("phrase"), F.col("e.counts").alias("f"), F.col("e.hashes").alias("hash")
        )
        found.append(last.select("lang", "phrase", "f", F.lit(k).alias("k")))
        longer.append(last.select("lang", _words("phrase", F.lit(1 - k)).alias("phrase"), "f"))
        if last.isEmpty():
            break
    union = lambda dfs: dfs[0] if len(dfs) == 1 else dfs[0].unionByName(union(dfs[1:]))
    if not found:
        none = words.where("false").select("lang", "phrase", "f")
        return none.withColumn("k", F.lit(0)).withColumn("longer", F.col("f")), none, totals
    more = union(longer).groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    every = union(found).join(more, ["lang", "phrase"], "left").withColumn("longer", F.coalesce("longer", F.lit(0)))
    return every, union(sums), totals


def collocations(
    docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    every, sums, totals = candidates(docs, min_count, max_words)
    sums = cut(sums.where(F.col("f") >= min_count))
    kept = every.where(F.col("longer") < F.col("f")).select("lang", "phrase", F.col("f").alias("a"), "k")
    cuts = kept.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("at")).select(
        "lang", "phrase", "a", "at",
        _words("phrase", F.col("at")).alias("head"), _words("phrase", F.col("at") - F.col("k")).alias("tail"),
    )
    part = lambda name, f: sums.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    both = cuts.join(part("head", "l"), ["lang", "head"]).join(part("tail", "r"), ["lang", "tail"]).join(totals, "lang")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    both = both.withColumn("top_", (wide("a") * 1000).cast("decimal(38,0)") * wide("n").cast("decimal(16,0)")).withColumn(
        "under_", wide("l") * wide("r")
    )
    scored = both.withColumn("score", F.expr("cast(top_ div under_ as bigint)"))
    least = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "at", "l", "r")).alias("s"))
    order = W.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    return (
        least.select("lang", "phrase", "a", F.col("s.l").alias("l"), F.col("s.r").alias("r"), "n", F.col("s.score").alias("score"))
        .withColumn("rank", F.row_number().over(order).cast("bigint"))
        .where(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
