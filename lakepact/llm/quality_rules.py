"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Each rule looks at one measure of a text and votes good, bad, or abstains between its two bars. No
rule decides alone. The model: a document is good or bad (hidden), and given that, each rule that does
not abstain votes independently, with its own rates P(bad vote | bad) and P(bad vote | good).
Expectation-maximisation estimates these rates and the share of good documents from the votes of all
documents. The posterior probability of good, by Bayes' rule over the votes, replaces the usual
demand that every rule passes; a document is kept at ``keep_at`` or more and if the base rules hold.

EM sees vote patterns with their counts, summed by Spark over all documents. A pattern is one of
three values for each rule, so there are at most 3 ** len(RULES) of them (59,049), whatever the
corpus; only these go to the driver, and only the estimated rates come back, as constants of an
expression.

EM begins from rates that say what a rule is: it seldom fires on good text (``START_GOOD``), and it
knows its own kind of bad text only, so it fires on a part of the bad (``START_BAD``). Rates keep that
order (a bad vote never speaks for good), so the two classes cannot change names.

Base figures, exact: word_chars (code points inside words), n_symbols (``#*$%&|<>``), n_dup_lines
(lines with a word, equal to an earlier line), n_repeat_words (words inside three-word windows that
occur twice or more in the text).

Defined cases: a null text has no words, fails the base rules and takes part in the estimate like an
empty one; texts of any length are measured whole; repeated rows each count and get equal results;
ties: a posterior equal to ``keep_at`` is kept; a rule on which all abstain changes nothing; an empty
table gives an empty result; columns other than doc_id, text and lang are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakepact.llm.common import cut, map_batches, slices, text_bytes

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
GOOD, BAD, ABSTAIN = 1, 0, 2
START_PRIOR, START_GOOD, START_BAD = 0.8, 0.02, 0.3
ROUNDS, CLOSE = 500, 1e-10
KEEP_AT = 0.5

BLANKS, SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
# Commonest short words of the four languages whose texts the rule on function words judges.
STOP_WORDS = {
    "en": "the of and to a in is that for it as was with by on are be this or an at from have not",
    "fr": "le la les de des du et un une en que qui dans pour par sur est pas au avec ce il",
    "es": "el la los las de del y un una en que por con para se su es no al lo como",
    "de": "der die das und in zu den von mit ist im auf ein eine nicht sich des dem für es an",
}
STOPS = {lang: [w.encode() for w in words.split()] for lang, words in STOP_WORDS.items()}
# A word of letters (any byte beyond ASCII counts as one), joined by - or ', with marks around it.
PLAIN = re.compile(rb"[\"'(\[]*[A-Za-z\x80-\xff]+(?:[-'][A-Za-z\x80-\xff]+)*[.,;:!?\"')\]]{0,3}")
CLOSED = re.compile(rb"[.!?;:,\"')\]]$")
CACHED_WORDS = 200_000

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_letters", "n_capitals", "n_digits", "n_exclamations", "n_plain", "n_distinct", "n_closed", "n_stops",
)


def _mask(codes: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(codes)] = True
    return out


_BLANK, _SYMBOL = _mask(BLANKS), _mask(SYMBOLS)
_CAPITAL, _SMALL = _mask(bytes(range(65, 91))), _mask(bytes(range(97, 123)))
_DIGIT, _LEAD, _REST = _mask(bytes(range(48, 58))), _mask(bytes(range(0xC0, 256))), _mask(bytes(range(0x80, 0xC0)))


def repeat_words(ids: np.ndarray, kinds: int) -> int:
    """How many words (given as numbers below ``kinds``) lie in a three-word window that occurs again."""
    n = len(ids)
    if n < 4 or kinds == n:
        return 0
    pairs, at = np.unique(ids[:-1] * kinds + ids[1:], return_inverse=True)
    if len(pairs) == n - 1:  # no pair occurs again, so no window does
        return 0
    _, at, often = np.unique(at[:-1] * kinds + ids[2:], return_inverse=True, return_counts=True)
    hit = often[at] > 1
    inside = np.zeros(n, bool)
    for k in range(3):
        inside[k:n - 2 + k] |= hit
    return int(inside.sum())


def measure(text: bytes, lang: str | None, plain: dict[bytes, bool]) -> tuple[int, ...]:
    """The MEASURES of one UTF-8 text; ``plain`` remembers which words are plain ones."""
    of = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    count = lambda mask: int(of[mask].sum())
    words = text.split()  # ASCII white space only
    kinds = Counter(words)
    number = {w: i for i, w in enumerate(kinds)}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    n_plain = 0
    for w, c in kinds.items():
        ok = plain.get(w)
        if ok is None:
            ok = PLAIN.fullmatch(w) is not None
            if len(plain) < CACHED_WORDS:
                plain[w] = ok
        n_plain += c if ok else 0
    lines = [x for x in text.split(b"\n") if x.strip(BLANKS)]
    capitals, beyond = count(_CAPITAL), count(_LEAD)
    return (
        len(words), len(text) - count(_REST) - count(_BLANK), count(_SYMBOL),
        len(lines) - len(set(lines)), repeat_words(ids, len(kinds)),
        len(lines), capitals + count(_SMALL) + beyond, capitals, count(_DIGIT), int(of[33]), n_plain, len(kinds),
        sum(1 for x in lines if CLOSED.search(x.rstrip(BLANKS))),
        sum(kinds.get(w, 0) for w in STOPS.get(lang, ())) if lang in STOPS else -1,
    )


def measures(docs: DataFrame) -> DataFrame:
    """(doc_id, *MEASURES), one row per input row; n_stops is -1 where the language has no list."""

    def run(batches):
        plain: dict[bytes, bool] = {}
        for b in slices(batches):
            found = [measure(t, lang, plain) for t, lang in zip(text_bytes(b.column(1)), b.column(2).to_pylist())]
            cols = list(zip(*found)) or [()] * len(MEASURES)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.int64()) for c in cols)], ["doc_id", *MEASURES]
            )

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
    )
    return map_batches(rows, run, "doc_id bigint, " + ", ".join(f"{m} bigint" for m in MEASURES))


def _share(top: str, of: str) -> Column:
    return F.col(top) / F.when(F.col(of) > 0, F.col(of))


def _low(value: Column, good: float, bad: float) -> Column:
    """Good at ``good`` or less, bad above ``bad``; null abstains."""
    return F.when(value <= good, GOOD).when(value > bad, BAD).otherwise(ABSTAIN)


def _high(value: Column, good: float, bad: float) -> Column:
    """Good at ``good`` or more, bad below ``bad``; null abstains."""
    return F.when(value >= good, GOOD).when(value < bad, BAD).otherwise(ABSTAIN)


def rules() -> dict[str, Column]:
    """Name of each rule, and its vote over the MEASURES."""
    enough = F.col("n_words") >= 20  # shares of a handful of words say nothing
    some = lambda x: F.when(enough, x)
    return {
        "length": _high(F.col("n_words"), 80, MIN_WORDS),
        "word_length": F.when(_share("word_chars", "n_words").between(3, 9), GOOD)
        .when(_share("word_chars", "n_words").between(2, 14), ABSTAIN).otherwise(BAD),
        "symbols": _low(_share("n_symbols", "n_words"), 0.02, 0.1),
        "repeated_lines": _low(F.when(F.col("n_lines") > 1, _share("n_dup_lines", "n_lines")), 0.05, 0.25),
        "repeated_words": _low(some(_share("n_repeat_words", "n_words")), 0.1, 0.3),
        "capitals": _low(some(_share("n_capitals", "n_letters")), 0.12, 0.3),
        "exclamations": _low(some(_share("n_exclamations", "n_words")), 0.03, 0.15),
        "plain_words": _high(some(_share("n_plain", "n_words")), 0.9, 0.75),
        "variety": _high(some(F.log("n_distinct") / F.log("n_words")), 0.72, 0.6),
        "function_words": _high(F.when(F.col("n_stops") >= 0, some(_share("n_stops", "n_words"))), 0.08, 0.02),
    }


RULES = (
    "length", "word_length", "symbols", "repeated_lines", "repeated_words", "capitals", "exclamations",
    "plain_words", "variety", "function_words",
)


class VoteModel:
    """Rates of bad votes in the two classes, and the share of good documents."""

    def __init__(self, prior: float, good: np.ndarray, bad: np.ndarray) -> None:
        self.prior, self.good, self.bad = prior, good, bad

    @classmethod
    def start(cls, n_rules: int) -> VoteModel:
        return cls(START_PRIOR, np.full(n_rules, START_GOOD), np.full(n_rules, START_BAD))

    def weights(self) -> tuple[float, np.ndarray]:
        """Log odds of good: a constant, and for each rule what a BAD (0), a GOOD (1) and no vote (2) add."""
        add = np.stack([np.log(self.good / self.bad), np.log((1 - self.good) / (1 - self.bad)), np.zeros(len(self.good))], 1)
        return math.log(self.prior / (1 - self.prior)), add

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        constant, add = self.weights()
        odds = constant + add[np.arange(votes.shape[1]), votes].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))

    @classmethod
    def fit(cls, votes: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> VoteModel:
        """EM over distinct vote patterns (rows of ``votes``) and how many documents show each."""
        model = cls.start(votes.shape[1])
        if not len(votes):
            return model
        voted, bad_vote = votes != ABSTAIN, votes == BAD
        for _ in range(rounds):
            p = model.posterior(votes)
            for_good, for_bad = counts * p, counts * (1 - p)

            def rate(weight: np.ndarray, start: float) -> np.ndarray:
                # one pseudo-vote at the starting rate, so that no rate is 0 or 1
                return (start + weight @ bad_vote) / (1 + weight @ voted)

            good = rate(for_good, START_GOOD)
            new = cls(float((1 + for_good.sum()) / (2 + counts.sum())), good, np.maximum(rate(for_bad, START_BAD), good))
            moved = max(abs(new.prior - model.prior), np.abs(new.good - model.good).max(), np.abs(new.bad - model.bad).max())
            model = new
            if moved < CLOSE:
                break
        return model


def judge(docs: DataFrame, keep_at: float = KEEP_AT) -> DataFrame:
    """One row per document: base figures, votes (one letter for each rule), posterior, base_failed, kept."""
    vote = rules()
    rows = cut(measures(docs))
    voted = rows.select("*", F.concat(*[vote[r].cast("string") for r in RULES]).alias("votes"))
    patterns = voted.groupBy("votes").agg(F.count("*").alias("n")).orderBy("votes").toArrow()
    votes = np.array([[int(x) for x in p] for p in patterns["votes"].to_pylist()], np.int64).reshape(-1, len(RULES))
    model = VoteModel.fit(votes, patterns["n"].to_numpy().astype(float))
    constant, add = model.weights()
    odds = F.lit(constant)
    for i in range(len(RULES)):
        letter = F.substring("votes", i + 1, 1)
        odds = odds + F.when(letter == str(BAD), float(add[i, BAD])).when(letter == str(GOOD), float(add[i, GOOD])).otherwise(0.0)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return voted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        F.translate("votes", "012", "bg-").alias("votes"), (1 / (1 + F.exp(-odds))).alias("quality"),
    ).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= keep_at))
