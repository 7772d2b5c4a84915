"""Personal data by a semi-Markov conditional random field beside fixed base patterns.

Base entities (email, ip, card, phone) are found by fixed rules in linear time. They stay. The
model works on what is left: islands of text that hold digits with separators or an ``@`` are cut
into atoms (digit runs, letter runs, single characters). A segmentation of an island is a sequence
of single atoms outside any entity and of entity segments of at most ``MAX_ATOMS`` atoms. Whole-span
features (digit count, Luhn sum, octet range, group shape, separators, what stands left and right)
score each candidate segment; a dynamic program over the island chooses boundaries and kinds
jointly. So a phone number and a card number that stand side by side, which a greedy pattern reads
as one failing match, are both found.

Training maximises the conditional likelihood over all segmentations (forward and backward sums).
The islands come from a bounded sample of documents (``FIT_ROWS`` of them, by hash order of the id,
texts of at most ``FIT_BYTES`` bytes; documented bound), labelled by the base rules, and from
variations of them: two entities side by side (both are gold), numbers with a changed digit, octets
out of range, bare digits (no gold), and the national form of a phone number. A sample without any
entity leaves the model with its prior weights.

Spans are code points, end exclusive. Defined cases: null text counts as empty; no entity gives zero
counts, empty spans and the hash of the empty string; whole texts are scanned, an island of any length
as one segmentation (candidates of one atom at a time, two numbers kept for each atom); repeated rows each keep their row; a null doc_id
keeps its row; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakepact.llm.common import broadcast_below, map_batches, slices

KINDS = ("email", "ip", "card", "phone")
FIT_ROWS, FIT_BYTES, FIT_ISLANDS, EPOCHS = 4000, 20_000, 1500, 4
MAX_ATOMS = 24

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
# Islands: characters of numbers with their separators, or of addresses around an @.
_NUMBERS = re.compile(r"[0-9+().\x20-]{7,}+")
_ADDRESS = re.compile(r"[A-Za-z0-9._%+@-]*+")
_ATOM = re.compile(r"[0-9]+|[A-Za-z]+|.", re.S)

Span = tuple[int, int, int]  # start, index of the kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _only_digits(s: str) -> str:
    return "".join(_DIGIT.findall(s))


def base_spans(text: str) -> list[Span]:
    """All base entities, by start and then kind."""
    out: list[Span] = []
    # An address is led by its @: the local part is the run before it, back to the last match.
    at, floor = text.find("@"), 0
    while at >= 0:
        m = _DOMAIN.match(text, at + 1)
        if m:
            start = at
            while start > floor and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                out.append((start, 0, m.end()))
                floor = m.end()
        at = text.find("@", max(at + 1, floor))
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        d = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_only_digits(m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def islands(text: str, taken: list[Span]) -> list[tuple[int, int]]:
    """Ranges worth a segmentation: at least seven digits, or an @; without what is taken."""
    found = []
    if _DIGIT.search(text):
        for m in _NUMBERS.finditer(text):
            if len(_only_digits(m[0])) >= 4:
                found.append((m.start(), m.end()))
    at = text.find("@")
    while at >= 0:
        start = at
        while start > 0 and text[start - 1] in _LOCAL:
            start -= 1
        end = _ADDRESS.match(text, at).end()
        found.append((start, end))
        at = text.find("@", end)
    merged: list[list[int]] = []
    for s, e in sorted(found):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    out, used = [], sorted((s, e) for s, _, e in taken)
    k = 0
    for s, e in merged:
        while k < len(used) and used[k][1] <= s:
            k += 1
        j = k
        while j < len(used) and used[j][0] < e:
            if used[j][0] > s:
                out.append((s, used[j][0]))
            s = max(s, used[j][1])
            j += 1
        if s < e:
            out.append((s, e))
    return [(s, e) for s, e in out if e - s >= 7]


def _side(c: str) -> str:
    if c == "":
        return "edge"
    if c.isspace():
        return "space"
    return "digit" if c.isdigit() else "letter" if c.isalpha() else "joint" if c in ".-+@_%" else "mark"


def _shape(s: str) -> str:
    return _DIGIT.sub("9", s)


def atoms(text: str, a: int, b: int) -> list[int]:
    """Atom bounds of text[a:b]."""
    return [m.start() for m in _ATOM.finditer(text, a, b)] + [b]


def candidates(text: str, bounds: list[int]) -> Iterator[tuple[int, int, int, list[str]]]:
    """The candidate segments (first atom, end atom, kind, features), by first and then end atom."""
    n = len(bounds) - 1
    first = [text[x] for x in bounds[:-1]]
    for i in range(n):
        if not (first[i].isascii() and (first[i].isalnum() or first[i] in "+(")):
            continue
        last = min(n, i + MAX_ATOMS)
        address = "@" in text[bounds[i]:bounds[last]]
        for j in range(i + 1, last + 1):
            if not (first[j - 1].isascii() and first[j - 1].isalnum()):
                continue
            s = text[bounds[i]:bounds[j]]
            edge = None
            d = _only_digits(s)
            if len(d) > 19 and not address:
                break
            kinds: list[tuple[int, list[str]]] = []
            if "@" in s:
                if s.count("@") == 1:
                    local, _, domain = s.partition("@")
                    parts = domain.split(".")
                    if local and domain and not set(local) - _LOCAL and not re.search(r"[^A-Za-z0-9.-]", domain):
                        kinds.append((0, [f"dots{min(3, len(parts) - 1)}", f"tld{parts[-1].isalpha() and len(parts[-1]) > 1}",
                                          f"whole{all(parts)}"]))
            elif d and not re.search(r"[A-Za-z]", s):
                if s.count(".") == 3 and len(d) == len(s) - 3:
                    p = s.split(".")
                    if all(p):
                        kinds.append((1, [f"range{all(len(x) < 6 and int(x) < 256 for x in p)}"]))
                if 13 <= len(d) <= 19 and not re.search(r"[^0-9\x20-]", s):
                    seps = set(s) - set("0123456789")
                    kinds.append((2, [f"luhn{luhn(d)}", f"n{len(d)}", f"seps{len(seps)}",
                                      f"double{bool(re.search(r'[ -]{2}', s))}"]))
                if 7 <= len(d) <= 15 and not re.search(r"[^0-9+().\x20-]", s) and "+" not in s[1:]:
                    kinds.append((3, [f"plus{s[0] == '+'}", f"n{len(d)}", f"marks{bool(re.search('[() .-]', s))}",
                                      f"paren{s.count('(') == s.count(')')}{'(' in s}",
                                      "shape" + _shape(re.sub(r"^\+[0-9]+ ?", "+", s))]))
            if kinds and edge is None:
                left = _side(text[bounds[i] - 1] if bounds[i] else "")
                right = _side(text[bounds[j]] if bounds[j] < len(text) else "")
                edge = ["left-" + left, "right-" + right]
            for k, f in kinds:
                yield i, j, k, [f"{KINDS[k]}:{x}" for x in ("bias", *f, *edge)]


# What a sample may not teach: weights before training.
PRIOR = {
    "email:bias": -1.0, "email:dots0": -6.0, "email:tldTrue": 1.0, "ip:bias": -1.0, "ip:rangeFalse": -8.0,
    "card:bias": -3.0, "card:luhnTrue": 3.0, "card:luhnFalse": -8.0, "card:n13": -3.0, "card:doubleTrue": -6.0,
    "phone:bias": -4.0, "phone:plusTrue": 3.0, "phone:marksFalse": -4.0, "phone:n7": -4.0, "phone:n8": -4.0, "phone:n9": -4.0,
}


class SemiCRF:
    def __init__(self) -> None:
        self.w: dict[str, float] = dict(PRIOR)

    def _scores(self, cands: list) -> list[float]:
        w = self.w
        return [sum([w.get(x, 0.0) for x in f]) for _, _, _, f in cands]

    def gradient_step(self, text: str, gold: set[Span], rate: float) -> float:
        """One ascent step on the log likelihood of ``gold`` in the text as one island."""
        bounds = atoms(text, 0, len(text))
        cands = list(candidates(text, bounds))
        n = len(bounds) - 1
        score = self._scores(cands)
        starting: list[list[int]] = [[] for _ in range(n + 1)]
        ending: list[list[int]] = [[] for _ in range(n + 1)]
        for c, (i, j, _, _) in enumerate(cands):
            starting[i].append(c)
            ending[j].append(c)
        fwd, bwd = [0.0] * (n + 1), [0.0] * (n + 1)
        for j in range(1, n + 1):
            fwd[j] = _log_sum([fwd[j - 1], *(fwd[cands[c][0]] + score[c] for c in ending[j])])
        for i in range(n - 1, -1, -1):
            bwd[i] = _log_sum([bwd[i + 1], *(bwd[cands[c][1]] + score[c] for c in starting[i])])
        likelihood = -fwd[n]
        for c, (i, j, k, f) in enumerate(cands):
            expected = math.exp(min(0.0, fwd[i] + score[c] + bwd[j] - fwd[n]))
            true = (bounds[i], k, bounds[j]) in gold
            likelihood += score[c] if true else 0.0
            step = rate * (true - expected)
            if abs(step) > 1e-6:
                for x in f:
                    self.w[x] = self.w.get(x, 0.0) + step
        return likelihood

    def decode(self, text: str, a: int, b: int) -> list[Span]:
        """The best segmentation's entities in text[a:b]."""
        bounds = atoms(text, a, b)
        n = len(bounds) - 1
        w = self.w
        # An atom's best is final once all segments that begin before it were seen.
        best, back = [0.0] + [-math.inf] * n, [(-1, -1)] * (n + 1)
        done = 0
        for i, j, k, f in candidates(text, bounds):
            while done < i:
                self._close(best, back, done := done + 1)
            v = best[i] + sum([w.get(x, 0.0) for x in f])
            if v > best[j]:
                best[j], back[j] = v, (i, k)
        while done < n:
            self._close(best, back, done := done + 1)
        out, j = [], n
        while j > 0:
            i, k = back[j]
            if i < 0:
                j -= 1
            else:
                out.append((bounds[i], k, bounds[j]))
                j = i
        return out[::-1]

    @staticmethod
    def _close(best: list[float], back: list[tuple[int, int]], j: int) -> None:
        """Leave atom j - 1 outside any entity unless a segment that ends at j is better."""
        if best[j] <= best[j - 1]:
            best[j], back[j] = best[j - 1], (-1, -1)

    def fit(self, texts: list[str], seed: int = 3) -> SemiCRF:
        rng = random.Random(seed)
        single: list[tuple[str, int]] = []
        for t in texts:
            for s, k, e in base_spans(t):
                single.append((t[s:e], k))
        rng.shuffle(single)
        single = single[:FIT_ISLANDS]
        if not single:
            return self
        data: list[tuple[str, set[Span]]] = []
        for s, k in single:
            data.append((s, {(0, k, len(s))}))
            other, ko = rng.choice(single)
            sep = rng.choice((" ", " ", ", "))
            at = len(s) + len(sep)
            data.append((s + sep + other, {(0, k, len(s)), (at, ko, at + len(other))}))
            if k == 1:
                parts = s.split(".")
                parts[rng.randrange(4)] = str(rng.randint(256, 999))
                data.append((".".join(parts), set()))
            if k == 2:
                i = rng.choice([i for i, c in enumerate(s) if c.isdigit()])
                data.append((s[:i] + str((int(s[i]) + rng.randint(1, 9)) % 10) + s[i + 1:], set()))
            if k == 3:
                d = _only_digits(s)
                data.append((d[-10:], set()))
                if len(d) >= 10:
                    d = d[-10:]
                    national = f"({d[:3]}) {d[3:6]}-{d[6:]}"
                    data.append((national, {(0, 3, len(national))}))
        for epoch in range(EPOCHS):
            rng.shuffle(data)
            for text, gold in data:
                self.gradient_step(text, gold, 0.3 / (1 + epoch))
        return self

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """Entities beside the base ones, none overlapping them."""
        out: list[Span] = []
        for a, b in islands(text, base):
            out += self.decode(text, a, b)
        return out


def _log_sum(v: list[float]) -> float:
    if len(v) == 1:
        return v[0]
    m = max(v)
    return m + math.log(sum([math.exp(x - m) for x in v]))


def fit(docs: DataFrame) -> SemiCRF:
    rows = docs.where("doc_id is not null").select("doc_id", F.xxhash64("doc_id").alias("h"))
    ids = rows.orderBy("h", "doc_id").limit(FIT_ROWS)
    texts = docs.where(F.octet_length("text") <= FIT_BYTES).select("doc_id", "text").join(
        broadcast_below(ids, FIT_ROWS), "doc_id"
    )
    # Only texts with a digit or an @ can hold an entity.
    sample = texts.where(F.col("text").rlike("[0-9@]")).orderBy("h", "doc_id", "text").limit(FIT_ROWS)
    return SemiCRF().fit([r["text"] for r in sample.select("text").collect()])


def find_entities(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, base array<struct>, spans array<struct> (kind, start, end, text)."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs))
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("text", pa.string())])

    def run(batches):
        model = sent.value
        for b in slices(batches):
            base_col, all_col = [], []
            for t in b.column(1).to_pylist():
                t = t or ""
                base = base_spans(t)
                every = sorted(base + model.added(t, base))
                for spans, col in ((base, base_col), (every, all_col)):
                    col.append([{"kind": KINDS[k], "start": s, "end": e, "text": t[s:e]} for s, k, e in spans])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(base_col, pa.list_(span)), pa.array(all_col, pa.list_(span))],
                ["doc_id", "base", "spans"],
            )

    kind = "array<struct<kind:string,start:bigint,end:bigint,text:string>>"
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, run, f"doc_id bigint, base {kind}, spans {kind}")


def digest(found: DataFrame) -> DataFrame:
    """Counts, the hash of the base spans, and all spans as text."""
    text = lambda c: F.array_join(
        F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("bigint").alias(f"n_{k}")
    return found.select(
        "doc_id", *[count(k) for k in KINDS],
        F.sha2(text(F.col("base")), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"),
    )
