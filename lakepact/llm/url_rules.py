"""URL filters: fixed host and path rules, and association rules mined from labelled URLs.

Method: the URL's tokens (host labels cut at dots and hyphens, path and query words, numbers as
``#``) are the items of a transaction. A rule ``tokens -> block`` needs at least ``min_support`` of the
labelled rows and ``min_confidence``, and no rule over fewer of its tokens. Tokens that are rarer among
blocked URLs than the support can be in no rule; those that make a rule alone can be in no larger
one. Spark's FP-growth mines the blocked URLs, cut down to the tokens that are left (all of them, however
many), for sets of any size. Their confidence needs the other URLs, too: each set stands under its
rarest token, the URLs that hold this token are joined to it, and those that hold the whole set are
counted. Rules that hold a smaller rule are dropped.

A rule's support bounds how many there are, whatever the number of URLs: a kept set lies in min_support of
the rows. They are sent to the tasks and matched by an inverted index: a rule stands under its rarest
token, a URL looks up its own tokens only and compares the rest.

Fixed rules come first: the longest that fits the host (or a parent domain) and the path's start
gives the verdict, else the mined rules block, else the URL is allowed.

Defined cases: null URLs and those without ``://`` have empty host and path, no tokens, and are
allowed; repeated rows count each, in mining too; without labelled rows of both kinds no rule is
mined; URLs of any number of tokens enter mining, and matching, with them all; ties of matching rules
go to the first by name; extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakepact.llm.common import broadcast_below, cut, map_batches

# Fixed rules of the contract: (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
MIN_SUPPORT, MIN_CONFIDENCE = 0.0005, 0.9
# Tokens, or sets, that are sent to every executor to be joined.
BROADCAST_SETS = 100_000
# Seed words of unwanted hosts: the registered query labels URLs by them, and no rule may name them.
SEEDS = ("adult", "ads", "bets", "casino", "pills", "spam")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``; A-Z lowered; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    """Distinct items: h= host, p= path, q= query words; numbers as #."""
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    query = F.regexp_extract(rest, r"^[^?#]*[?#](.*)$", 1)

    def items(text: Column, kind: str) -> Column:
        found = F.filter(F.split(F.translate(text, UPPER, LOWER), r"[^a-z0-9\u0080-￿]+"), lambda x: x != "")
        named = F.transform(found, lambda x: F.concat(F.lit(kind), F.when(x.rlike("^[0-9]+$"), "#").otherwise(x)))
        return F.coalesce(named, F.array().cast("array<string>"))

    return F.array_distinct(F.concat(items(host_of(url), "h="), items(path_of(url), "p="), items(query, "q=")))


def fixed_rule(host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fixed rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(RULES, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def mine(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
    unnamed: tuple[str, ...] = (),
) -> DataFrame:
    """Rules (tokens, support, confidence) from ``labelled(url, label)``, label 1 for block. The
    tokens in ``unnamed`` (what labels were made from, say) are no items."""
    items = F.array_except(tokens_of(F.col("url")), F.array(*map(F.lit, unnamed)).cast("array<string>"))
    rows = cut(
        labelled.where("url is not null and label is not null")
        .select(F.monotonically_increasing_id().alias("row"), items.alias("tokens"), (F.col("label") == 1).alias("bad"))
    )
    total, bad = rows.agg(F.count("*"), F.count_if("bad")).first()
    spark = rows.sparkSession
    if not bad or bad == total:
        return spark.createDataFrame([], "tokens array<string>, support double, confidence double")
    least = max(2.0, min_support * total)
    one = cut(
        rows.select("bad", F.explode("tokens").alias("token")).groupBy("token")
        .agg(F.count("*").alias("n"), F.count_if("bad").alias("both")).where(F.col("both") >= least)
    )
    sure = F.col("both") >= F.col("n") * min_confidence
    singles = one.where(sure).select(F.array("token").alias("tokens"), "both", "n")
    left = one.where(~sure)
    cut_down = rows.where("bad").select("row", F.explode("tokens").alias("token")).join(
        broadcast_below(left.select("token"), BROADCAST_SETS), "token"
    ).groupBy("row").agg(F.collect_set("token").alias("items"))
    sets = FPGrowth(itemsCol="items", minSupport=(least - 1e-6) / bad).fit(cut(cut_down)).freqItemsets
    sets = sets.where(F.size("items") > 1).select(F.array_sort("items").alias("tokens"), F.col("freq").alias("both"))
    found = singles.unionByName(_in_all(rows.where("not bad"), sets, left)).where(F.col("both") >= F.col("n") * min_confidence)
    return _smallest(cut(found)).select(
        "tokens", (F.col("both") / total).alias("support"), (F.col("both") / F.col("n")).alias("confidence")
    )


def _in_all(good: DataFrame, sets: DataFrame, often: DataFrame) -> DataFrame:
    """(tokens, both, n) of ``sets(tokens, both)``: n adds the ``good`` rows that hold the whole set."""
    named = cut(sets.withColumn("set", F.monotonically_increasing_id()))
    rarest = named.select("set", F.explode("tokens").alias("token")).join(often.select("token", "n"), "token").groupBy(
        "set"
    ).agg(F.min(F.struct("n", "token"))["token"].alias("key"))
    keyed = cut(named.join(rarest, "set"))
    holds = good.select("tokens", F.explode("tokens").alias("key")).join(
        broadcast_below(keyed.select("key", "set", F.col("tokens").alias("need")), BROADCAST_SETS), "key"
    ).where(F.size(F.array_except("need", "tokens")) == 0)
    counted = holds.groupBy("set").agg(F.count("*").alias("other"))
    return keyed.join(counted, "set", "left").select(
        "tokens", "both", (F.col("both") + F.coalesce("other", F.lit(0))).alias("n")
    )


def _smallest(rules: DataFrame) -> DataFrame:
    """Rules that hold no other rule. Each proper holder meets the held rule under one of its tokens."""
    own = rules.select(F.col("tokens").alias("small"), F.col("tokens")[0].alias("key"))
    larger = rules.select(F.col("tokens").alias("large"), F.explode("tokens").alias("key"))
    held = larger.join(own, "key").where(
        (F.size("small") < F.size("large")) & (F.size(F.array_except("small", "large")) == 0)
    ).select(F.col("large").alias("tokens")).distinct()
    return rules.join(held, "tokens", "left_anti")


class RuleIndex:
    """Rules under their rarest token."""

    def __init__(self, rules: list[tuple[tuple[str, ...], float, float]]) -> None:
        often: dict[str, float] = defaultdict(float)
        for tokens, support, _ in rules:
            for t in tokens:
                often[t] += support
        self.at: dict[str, list[tuple[frozenset[str], str, float]]] = defaultdict(list)
        for tokens, _, confidence in rules:
            key = min(tokens, key=lambda t: (often[t], t))
            self.at[key].append((frozenset(tokens), " ".join(sorted(tokens)), confidence))

    def match(self, tokens: list[str]) -> tuple[str, float] | None:
        """The matching rule with the highest confidence (ties: the first by name)."""
        own, best = set(tokens), None
        for t in own:
            for need, name, confidence in self.at.get(t, ()):
                if need <= own and (best is None or (-confidence, name) < (-best[1], best[0])):
                    best = (name, confidence)
        return best


SEED_TOKENS = tuple("h=" + w for w in SEEDS)


def seed_labels(pages: DataFrame) -> DataFrame:
    """(page_id, url, label): 1 for hosts that hold a seed word as a whole token, and where a fixed
    rule blocks; other URLs 0."""
    url = F.col("url")
    _, verdict = fixed_rule(host_of(url), path_of(url))
    seeded = F.arrays_overlap(tokens_of(url), F.array(*map(F.lit, SEED_TOKENS)))
    blocked = F.coalesce(verdict == "block", seeded)
    return pages.where(F.instr("url", "://") > 0).select("page_id", "url", blocked.cast("int").alias("label"))


def judge(
    pages: DataFrame, labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
    unnamed: tuple[str, ...] = (),
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, mined_rule, confidence."""
    rules = mine(labelled, min_support, min_confidence, unnamed)
    index = RuleIndex([(tuple(r["tokens"]), r["support"], r["confidence"]) for r in rules.toLocalIterator()])
    sent = pages.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        index = sent.value
        for b in batches:
            found = [index.match(t or []) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(b.column(i) for i in (2, 3, 4, 5)),
                 pa.array([f and f[0] for f in found], pa.string()), pa.array([f and f[1] for f in found], pa.float64())],
                ["page_id", "host", "path", "rule", "fixed", "mined_rule", "confidence"],
            )

    url = F.col("url")
    rule, verdict = fixed_rule(F.col("host"), F.col("path"))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), tokens_of(url).alias("tokens"),
        host_of(url).alias("host"), path_of(url).alias("path"),
    ).select("page_id", "tokens", "host", "path", rule.alias("rule"), verdict.alias("fixed"))
    schema = "page_id bigint, host string, path string, rule string, fixed string, mined_rule string, confidence double"
    return map_batches(rows, run, schema).select(
        "page_id", "host", "path", "rule",
        F.coalesce("fixed", F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        "mined_rule", "confidence",
    )

