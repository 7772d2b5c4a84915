"""Licence scans by a trained paragraph classifier.

A paragraph is a run of lines up to a blank line, line breaks counting as white space. Judged are each
of its lines and windows of ``WINDOW`` words (half overlapping) of it and of longer lines, all of them:
no key word is asked for. Hashed word one-, two- and three-grams feed a multinomial logistic regression
over licence families and a class for ordinary text. Grams are counted, so that a window's sum is the
difference of two running sums. Probabilities are calibrated by a temperature on samples kept from
training, and a family is only named at or above the least probability that keeps ``PRECISION`` of
those samples right; below it the window is ``unknown``. A named family must be confirmed by a template
of it: at least ``SIMILAR`` of the template's word pairs (counted with repeats) occur in the window.
One that the model takes for a licence without naming or confirming a family is ``unknown`` as well,
with a probability of at least ``OPEN`` and above that of ``ORDINARY`` of the ordinary samples kept
from training.

Of windows that overlap, one row for each family stays (the most similar, then the shortest), and an
unknown only where it overlaps no other row.

Training data: the templates with words dropped and ordinary words added, short wordings with the
families' names, and ordinary lines, single and joined, from a
bounded sample of documents (``FIT_ROWS`` documents by hash order of the id, texts of at most
``FIT_BYTES`` bytes; documented bound), also with single licence words mixed in.

Defined cases: null and empty texts hold no licence; whole texts are scanned; repeated rows and lines
each give their rows; a null doc_id keeps its rows; empty tables give an empty result; extra columns
are ignored. Spans are code points of the line or window.
"""

from __future__ import annotations

import bisect
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakepact.llm.common import broadcast_below, map_batches, slices

# Public licence notices by family.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-2.0-only",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "AGPL-3.0": (
        "Licensed under the GNU Affero General Public License, version 3",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "BSD": (
        "Released under the BSD License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License, Version 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "CC0-1.0": (
        "Released under the CC0 1.0 Universal Public Domain Dedication license",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "ISC": (
        "Released under the ISC License",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "SPDX-License-Identifier: ISC",
    ),
}
# Short wordings, for training only: names of the families and sentences to put them into.
NAMES = {
    "MIT": ("MIT", "the MIT terms", "MIT/Expat"),
    "Apache-2.0": ("Apache-2.0", "Apache 2.0", "the Apache License"),
    "GPL-3.0": ("the GNU GPL version 3", "GPLv3", "GPL-3.0", "the GNU GPL v3"),
    "GPL-2.0": ("the GNU GPL version 2", "GPLv2", "GPL-2.0", "the GNU GPL v2"),
    "LGPL": ("the GNU LGPL", "LGPL", "LGPL-2.1", "LGPLv3"),
    "AGPL-3.0": ("the GNU AGPL", "AGPL-3.0", "AGPLv3"),
    "BSD": ("BSD", "the BSD terms", "BSD-3-Clause", "BSD-2-Clause"),
    "MPL-2.0": ("MPL 2.0", "MPL-2.0", "the Mozilla Public License"),
    "CC-BY-4.0": ("CC BY 4.0", "CC-BY-4.0"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "CC-BY-SA-4.0"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "CC-BY-NC-4.0"),
    "CC0-1.0": ("CC0", "CC0 1.0", "the public domain (CC0 1.0)"),
    "ISC": ("ISC", "the ISC terms"),
}
FRAMES = (
    "Distributed under the terms of {}", "Available under {}", "{} licensing applies", "Sublicense under {}",
    "Permissions are those of {}", "Dedicated to {}", "Covered by {}", "You may use this under {}", "Made available under {}",
    "The terms of {} apply", "Provided under {}",
)
# Words of licences: ordinary lines with one are not learned from.
KEYS = ("license", "licensed", "licence", "licenced", "permission", "redistribution", "copyright", "spdx")
_WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*", re.U)
_SPACE = " \t\n\x0b\x0c\r"

WINDOW = 60
SIMILAR = 0.8
PRECISION = 0.99
# Least probability of an unknown licence: ordinary text is far commoner in a corpus than in the samples.
OPEN = 0.9
ORDINARY = 0.9998  # share of ordinary samples kept from training that stay without a verdict
FIT_ROWS, FIT_BYTES, PLAIN = 2000, 20_000, 1500
BITS = 18
NONE = "none"
# Words scored at once, and words whose hash is remembered.
CHUNK, CACHE_WORDS = 1 << 16, 300_000


def words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def windows(at: int, n: int) -> list[tuple[int, int]]:
    """Half-overlapping windows of the ``n`` words from ``at`` on."""
    step = WINDOW // 2
    return [(at + i, at + min(i + WINDOW, n)) for i in range(0, max(1, n - step), step)] if n else []


def units(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """The text's words, and as ranges of them its lines and the windows of its paragraphs."""
    found: list[str] = []
    out: list[tuple[int, int]] = []
    begin, lines = 0, 0

    def close() -> None:
        if lines > 1:
            out.extend(windows(begin, len(found) - begin))

    for line in text.split("\n"):
        own = _WORD.findall(line)
        if own:
            out += windows(len(found), len(own))
            found += own
            lines += 1
        elif not line.strip(_SPACE):
            close()
            begin, lines = len(found), 0
    close()
    return found, list(dict.fromkeys(out))


def span(text: str, at: list[tuple[int, int]], a: int, b: int) -> tuple[int, int]:
    """Code points of words a to b: whole lines where no other word stands on them, else to the next space."""
    start, end = at[a][0], at[b - 1][1]
    left, right = at[a - 1][1] if a else 0, at[b][0] if b < len(at) else len(text)
    line = text.rfind("\n", left, start)
    if line >= 0 or not a:
        part = text[max(left, line + 1):start]
        start -= len(part.lstrip(_SPACE))
    while start > left and text[start - 1] not in _SPACE:
        start -= 1
    line = text.find("\n", end, right)
    if line >= 0 or b == len(at):
        part = text[end:line if line >= 0 else right]
        end += len(part.rstrip(_SPACE))
    while end < right and text[end] not in _SPACE:
        end += 1
    return start, end


class Hashes(dict):
    """Hashes of words as they stand in the text, lower-cased."""

    def __missing__(self, word: str) -> int:
        h = self[word] = zlib.crc32(word.lower().encode("utf-8", "surrogatepass"))
        return h


def grams(h: np.ndarray) -> list[np.ndarray]:
    """Buckets of the one-, two- and three-grams that begin at each word (hashes as uint64)."""
    mul, out, x = np.uint64(0x9E3779B97F4A7C15), [], h
    for n in (1, 2, 3):
        if n > 1:
            x = (x[:-1] * np.uint64(0x100000001B3)) ^ (h[n - 1:] + np.uint64(n))
        out.append(((x * mul) >> np.uint64(64 - BITS)).astype(np.int64))
    return out


def counted(ws: list[str], hashes: Hashes) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a window and how often each occurs."""
    h = np.array([hashes[w] for w in ws], np.uint64)
    parts = grams(h)
    return np.unique(np.concatenate(parts), return_counts=True)


def pairs(ws: list[str]) -> Counter:
    return Counter(zip(ws, ws[1:])) if len(ws) > 1 else Counter(ws)


class LicenceModel:
    def __init__(self) -> None:
        self.classes = [NONE, *TEMPLATES]
        self.w = np.zeros((1 << BITS, len(self.classes)), np.float32)
        self.b = np.zeros(len(self.classes), np.float32)
        self.temperature, self.least, self.open = 1.0, 0.5, OPEN
        self.templates = {f: [(t, pairs(words(t))) for t in ts] for f, ts in TEMPLATES.items()}

    def probabilities(self, found: list[list[str]], ranges: list[list[tuple[int, int]]], hashes: Hashes) -> np.ndarray:
        """A row for each range of each text, in order."""
        if len(hashes) > CACHE_WORDS:
            hashes.clear()
        size = np.cumsum([0, *map(len, found)])
        h = np.array([hashes[w] for ws in found for w in ws], np.uint64)
        spans = np.array([(a + at, b + at) for own, at in zip(ranges, size.tolist()) for a, b in own], np.int64).reshape(-1, 2)
        z = np.zeros((len(spans), len(self.classes)))
        for at in range(0, len(h), CHUNK):  # windows that begin in this part
            mine = np.flatnonzero((spans[:, 0] >= at) & (spans[:, 0] < at + CHUNK))
            a, b = spans[mine, 0] - at, spans[mine, 1] - at
            total = np.zeros((len(mine), len(self.classes)))
            for n, g in enumerate(grams(h[at:at + CHUNK + WINDOW]), 1):
                run = np.zeros((len(g) + 1, len(self.classes)))
                np.cumsum(self.w[g], axis=0, dtype=np.float64, out=run[1:])
                last = np.maximum(a, b - n + 1)
                full = last > a
                total[full] += run[last[full]] - run[a[full]]
            n = b - a
            z[mine] = total / np.sqrt(np.maximum(1, n + np.maximum(0, n - 1) + np.maximum(0, n - 2)))[:, None]
        return self._softmax(z + self.b, self.temperature)

    @staticmethod
    def _softmax(z: np.ndarray, t: float) -> np.ndarray:
        e = np.exp(z / t - (z / t).max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def fit(self, lines: list[str], seed: int = 5, epochs: int = 12) -> LicenceModel:
        rng = random.Random(seed)
        named = set(KEYS) | {w for ns in NAMES.values() for n in ns for w in words(n) if len(w) > 2 and w.isalnum() and not w.isdigit()}
        named -= {"the", "version", "terms", "public", "domain"}
        plain = [w for w in (words(x) for x in lines) if len(w) >= 3 and not set(w) & named]
        rng.shuffle(plain)
        rest = plain[PLAIN:]
        plain = plain[:PLAIN] or [["the", "plain", "text"], ["some", "other", "words"]]
        stray = sorted({w for ts in TEMPLATES.values() for t in ts for w in words(t)})
        data: list[tuple[list[str], int]] = []

        def mixed(ws: list[str]) -> list[str]:
            ws = list(ws)
            for _ in range(rng.randint(1, 3)):
                ws.insert(rng.randrange(len(ws) + 1), rng.choice(stray if rng.random() < 0.7 else KEYS))
            return ws

        joined = lambda: [w for _ in range(rng.randint(1, 4)) for w in rng.choice(plain)]
        for i, ws in enumerate(plain):
            ws = (ws + joined() if i % 2 else ws)[:WINDOW]
            data.append((ws, 0))
            data.append((mixed(ws), 0))
        each = max(20, 2 * len(plain) // len(TEMPLATES) // 3)
        for k, (_, texts) in enumerate(TEMPLATES.items(), 1):
            for i in range(each):
                ws = words(texts[i % len(texts)])
                if i >= 2 * len(texts):
                    if i % 3 == 0:
                        ws = words(rng.choice(FRAMES).format(rng.choice(NAMES[self.classes[k]])))
                    else:
                        less = [w for w in ws if rng.random() > 0.06] or ws
                        name = self.classes[k]
                        # Without its number a notice may be another family's as well.
                        if all(self._similar(name, less)[0] > self._similar(f, less)[0] for f in TEMPLATES if f != name):
                            ws = less
                    around = joined()
                    n = rng.choice((0, 0, 3, 8, 20, 40))
                    m = n + rng.choice((0, 0, 5, 15, 40))
                    ws = (around[:n] + ws + around[n:m])[:max(WINDOW, n + len(ws))]
                    if around[:m]:  # what stands around a notice is ordinary text
                        data.append((mixed(around[:m][:WINDOW]) if i % 2 else around[:m][:WINDOW], 0))
                data.append((ws, k))
        rng.shuffle(data)
        hashes = Hashes()
        # Ordinary text that is only calibrated on: lines, and two joined.
        spare = [(ws + rest[i - 1] if i % 2 else ws)[:WINDOW] for i, ws in enumerate(rest)]
        coded = [(*counted(ws, hashes), y) for ws, y in data]
        kept = len(coded) // 5
        tune, train = coded[:kept], coded[kept:]
        sums = np.full_like(self.w, 1e-2)
        for _ in range(epochs):
            rng.shuffle(train)
            for at in range(0, len(train), 16):
                for g, c, y in train[at:at + 16]:
                    scale = c[:, None] / np.sqrt(max(1, c.sum()))
                    z = (self.w[g] * scale).sum(axis=0) + self.b
                    p = np.exp(z - z.max())
                    p /= p.sum()
                    p[y] -= 1
                    step = p * scale + 1e-4 * self.w[g]
                    sums[g] += step * step
                    self.w[g] -= 0.3 * step / np.sqrt(sums[g])
                    self.b -= 0.01 * p
        self._calibrate(tune, [ws for ws, _ in data[:kept]], [counted(ws, hashes) for ws in spare])
        return self

    def _similar(self, family: str, ws: list[str]) -> tuple[float, str | None]:
        """The largest share of a template's word pairs in the window, and the template."""
        own, best, name = pairs(ws), 0.0, None
        for text, need in self.templates[family]:
            share = sum((need & own).values()) / sum(need.values())
            if share > best:
                best, name = share, text
        return best, name

    def _calibrate(self, tune: list[tuple[np.ndarray, np.ndarray, int]], says: list[list[str]], spare: list) -> None:
        logits = lambda rows: np.array([c @ self.w[g] / np.sqrt(max(1, c.sum())) + self.b for g, c, *_ in rows], np.float64)
        z = logits(tune)
        y = np.array([y for *_, y in tune])

        def at(t: float, z: np.ndarray = z) -> np.ndarray:
            return self._softmax(z, t)

        loss = {t: -np.log(at(t)[np.arange(len(y)), y] + 1e-12).mean() for t in np.geomspace(0.2, 5, 25)}
        self.temperature = float(min(loss, key=loss.get))
        p = at(self.temperature)
        best, right = p.max(axis=1), p.argmax(axis=1) == y
        # Only confirmed families are named, so only those count.
        own = np.array([k > 0 and self._similar(self.classes[k], ws)[0] >= SIMILAR for k, ws in zip(p.argmax(axis=1), says)])
        cuts = np.sort(best[own])
        good = [c for c in cuts if right[own & (best >= c)].mean() >= PRECISION]
        self.least = float(max(0.5, good[0])) if good else 1.0
        ordinary = np.concatenate([1 - p[y == 0, 0], 1 - at(self.temperature, logits(spare))[:, 0]] if spare else [1 - p[y == 0, 0]])
        self.open = float(max(OPEN, np.quantile(ordinary, ORDINARY, method="higher"))) if len(ordinary) else OPEN

    def judge(self, ws: list[str], p: np.ndarray | None = None) -> tuple[str, float, str | None, float] | None:
        """(family or unknown, probability, template, similarity), or None for ordinary text."""
        if p is None:
            p = self.probabilities([ws], [[(0, len(ws))]], Hashes())[0]
        if 1 - p[0] < 0.5:  # no family can have the least probability
            return None
        k = int(p.argmax())
        family = self.classes[k] if k else self.classes[1 + int(p[1:].argmax())]
        best, name = self._similar(family, ws)
        probability = float(p[self.classes.index(family)])
        if k and probability >= self.least and best >= SIMILAR:
            return family, probability, name, best
        if 1 - p[0] > self.open:
            return "unknown", float(1 - p[0]), name, best
        return None

    def notices(self, texts: list[str], hashes: Hashes) -> list[list[tuple]]:
        """For each text (family, start, end, probability, template, similarity), by start."""
        found, ranges = zip(*map(units, texts)) if texts else ((), ())
        p = self.probabilities(found, ranges, hashes)
        owner = np.repeat(np.arange(len(texts)), [len(r) for r in ranges])
        place = np.cumsum([0, *map(len, ranges)])
        hits: dict[int, list] = {}
        for u in np.flatnonzero(1 - p[:, 0] >= 0.5).tolist():
            t = int(owner[u])
            a, b = ranges[t][u - place[t]]
            if got := self.judge([w.lower() for w in found[t][a:b]], p[u]):
                hits.setdefault(t, []).append((a, b, got))
        out: list[list[tuple]] = [[] for _ in texts]
        for t, own in hits.items():
            at = [m.span() for m in _WORD.finditer(texts[t])]
            for a, b, (family, *rest) in apart(own):
                out[t].append((family, *span(texts[t], at, a, b), *rest))
        return out


def apart(hits: list[tuple]) -> list[tuple]:
    """Of overlapping hits one for each family; an unknown only where it overlaps no other."""
    kept: dict[str, list[tuple[int, int]]] = {}
    out = []
    # Kept ranges of a family do not overlap; by their starts a neighbour on each side decides.
    for a, b, got in sorted(hits, key=lambda x: (x[2][0] == "unknown", -x[2][3] if x[2][0] != "unknown" else -x[2][1], x[1] - x[0], x[0])):
        rivals = kept.values() if got[0] == "unknown" else (kept.get(got[0], []),)
        if any(_meets(r, a, b) for r in rivals):
            continue
        bisect.insort(kept.setdefault(got[0], []), (a, b))
        out.append((a, b, got))
    return sorted(out, key=lambda x: x[:2])


def _meets(ranges: list[tuple[int, int]], a: int, b: int) -> bool:
    i = bisect.bisect_left(ranges, (b, 0))
    return i > 0 and ranges[i - 1][1] > a


def fit(docs: DataFrame) -> LicenceModel:
    ids = docs.where("doc_id is not null").select("doc_id", F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").limit(FIT_ROWS)
    texts = docs.where(F.octet_length("text") <= FIT_BYTES).select("doc_id", "text").join(
        broadcast_below(ids, FIT_ROWS), "doc_id"
    ).orderBy("h", "doc_id", "text").limit(FIT_ROWS)
    lines = [line for r in texts.select("text").collect() for line in r["text"].split("\n")]
    return LicenceModel().fit(lines)


def scan(docs: DataFrame) -> DataFrame:
    """One row per licence paragraph: doc_id, family, start, end, probability, template, similarity."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs))
    names = ["doc_id", "family", "start", "end", "probability", "template", "similarity"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.string(), pa.float64()]

    def run(batches):
        model, hashes = sent.value, Hashes()
        for b in slices(batches):
            rows = [(i, t) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if t]
            found = model.notices([t for _, t in rows], hashes)
            out = [(i, *x) for (i, _), own in zip(rows, found) for x in own]
            cols = list(zip(*out)) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id bigint, family string, start bigint, end bigint, probability double, template string, similarity double"
    return map_batches(rows, run, schema)
