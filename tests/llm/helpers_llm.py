"""Small fixtures: documents with every awkward case, and plain-Python rules to hold results to."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def toks(s):
    return WORD.findall(lower(s or ""))


def awkward_rows(seed=1):
    rng = random.Random(seed)
    vocab = ["er", "than", "ing", "thor", "été", "ñoño", "straße", "Anna", "be", "of"]
    text = lambda n: " ".join(rng.choice(vocab) + rng.choice(["", "", "s", "ed"]) for _ in range(n))
    rows = [(i, text(rng.randint(1, 60)), rng.choice(["en", "de", None]), f"src{i % 4}", 0) for i in range(60)]
    same = text(40)
    rows += [(100 + i, same, "en", "src0", 0) for i in range(12)]                 # exact copies
    rows += [(120, None, None, None, None), (121, "", "en", None, 0), (122, " \t\n", "en", "src9", 0)]
    rows += [(130, text(20000), "fr", "src1", 0)]                                  # very long
    rows += [(140, "two words", "en", "src2", 0)] * 3                              # repeated rows
    rows += [(None, text(30), "en", "src3", 0), (None, None, None, None, None)]
    rows += [(150, " é x\x00y \x1c z", "xx", "src\U0001f600", 0)]
    return rows


def awkward(spark, extra=True):
    df = spark.createDataFrame(awkward_rows(), SCHEMA)
    if extra:  # names that operators use inside
        from pyspark.sql import functions as F

        for c in ("fp", "size", "hash", "copies", "threshold", "keep_id_", "row", "token", "base", "spans", "h", "bucket"):
            df = df.withColumn(c, F.lit("x"))
    return df
