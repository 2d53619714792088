"""Operator 6: licence scans by a trained paragraph classifier.

A paragraph is a line of a document, or successive lines that aren't blank, joined; long ones are read in windows of STRETCH
words, half a window apart. Its features are words and pairs of successive words in lower case, hashed, 0/1. A
softmax model with one class for each licence family and one for what is unknown is trained on varied notices and
paragraphs sampled from the corpus (bounded by `sample`; families come from the templates, so no labels are read). The
model's temperature is fitted on paragraphs that it wasn't trained on, and a family is predicted from `least` calibrated
probability on. A prediction stands if the closest template of its family has `confirm` of its words and pairs in the
paragraph, and half of those that no other family has, so licences outside of the list aren't taken for their neighbours; otherwise the paragraph is reported as `unknown` with confirmed = false. Where the families have that probability
only together, each of the two first is scored on what the other's closest template leaves of the paragraph; where one is
confirmed, the others are scored on what its closest template leaves.

Scanning is one pass without a shuffle over all words of all texts; a paragraph none of whose features has a weight is
unknown without more work, which is exact, as the intercepts then decide.

Results in special cases: null and empty texts and empty lines have no rows; joined lines have a
row only if confirmed where no line of theirs is confirmed for the family by itself, numbered by the first line that adds to
the similarity; repeated rows give repeated rows; equal paragraphs get equal results; very long texts are read whole,
in windows; of equally likely families the first of the list; columns other than the two named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels, linear
from .kernels import U64

UNKNOWN = "unknown"
SAMPLE = 3000
BITS = 18
LEAST = 0.9
CONFIRM = 0.6
#: Share of the features that tell a template from those of other families.
OWN = 0.5
VARIANTS = 24
#: Words of a window of joined lines: twice those of the longest template.
STRETCH = 100
#: Bytes that end a word: ASCII other than letters, digits, '.', '-' and '+'.
BREAKS = np.array([not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 or b in b"-+") for b in range(256)])
#: Notices of licence families.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License. See LICENSE in the project root for license information.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "The MIT License (MIT)",
        "MIT License",
        "SPDX-License-Identifier: MIT",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "BSD": (
        "Distributed under the BSD License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "License: GPLv2",
        "License: GPLv3",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "ISC": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ),
    "CC-BY": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "SPDX-License-Identifier: CC-BY-4.0"),
    "CC-BY-SA": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    "CC-BY-NC": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    "CC0": ("Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0.", "SPDX-License-Identifier: CC0-1.0"),
    "Unlicense": ("This is free and unencumbered software released into the public domain.", "Released under the Unlicense.", "SPDX-License-Identifier: Unlicense"),
    "Boost": ("Distributed under the Boost Software License, Version 1.0.", "SPDX-License-Identifier: BSL-1.0"),
    "All-rights-reserved": ("All rights reserved.", "Copyright the authors. All rights reserved.", "No part of this work may be reproduced without written permission of the publisher."),
}


class ParagraphFeatures:
    """Hashed words and pairs of successive words of each line, without repeats."""

    def __init__(self, bits: int = BITS):
        self.bits = bits

    def lines(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All lines of the texts as one column, and where each text's lines start."""
        lists = pc.split_pattern(kernels.utf8(texts), "\n")
        return lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()

    def of(self, lines: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        words = kernels.Words(lines, BREAKS, fold=True)
        own = words.owners()
        one = (words.hashes >> U64(64 - self.bits)).astype(np.int64)
        pair = np.flatnonzero(own[1:] == own[:-1]) if len(own) else np.zeros(0, np.int64)
        two = (kernels.mixed(words.hashes[pair] * U64(3) + words.hashes[pair + 1]) >> U64(64 - self.bits)).astype(np.int64)
        if wanted is not None:
            keep_one, keep_two = wanted[one], wanted[two]
            row, f = np.concatenate([own[keep_one], own[pair][keep_two]]), np.concatenate([one[keep_one], two[keep_two]])
        else:
            row, f = np.concatenate([own, own[pair]]), np.concatenate([one, two])
        code = np.unique((row << self.bits) + f)
        return code >> self.bits, code & ((1 << self.bits) - 1)


@dataclass
class LicenceModel:
    families: list[str]  #: the last is what is unknown
    slots: np.ndarray  #: feature -> row of weights, 0 without one
    weights: np.ndarray  #: row 0 is zeros
    intercepts: np.ndarray
    temperature: float
    features: ParagraphFeatures
    templates: list[tuple[int, np.ndarray, np.ndarray]]  #: family, sorted features, those that no other family's templates have

    def probabilities(self, x: linear.Sparse) -> np.ndarray:
        return linear.softmax((x.times(self.weights) + self.intercepts) / self.temperature)

    def scan(self, lines: pa.Array, least: float = LEAST, confirm: float = CONFIRM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(line, family, probability, similarity to the closest template) where a family has the probability."""
        row, f = self.features.of(lines, self.wanted)
        if not len(row):
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0),) * 2
        some, place = np.unique(row, return_inverse=True)
        p = self.probabilities(linear.Sparse(place, self.slots[f], len(some)))
        hit = np.flatnonzero((p[:, :-1].sum(1) >= least) & (p.argmax(1) < len(self.families) - 1))
        if not len(hit):
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0),) * 2
        row, f = self.features.of(lines.take(pa.array(some[hit])))
        bounds = np.searchsorted(row, np.arange(len(hit) + 1))
        out = []
        for k, h in enumerate(hit.tolist()):
            mine = f[bounds[k] : bounds[k + 1]]
            found = self._families(mine, p[h], least, confirm)
            out += [(int(some[h]), family, share, close) for family, share, close in found]
        columns = list(zip(*out)) or [()] * 4
        return np.array(columns[0], np.int64), np.array(columns[1], np.int64), np.array(columns[2], float), np.array(columns[3], float)

    def closest(self, mine: np.ndarray, family: int) -> tuple[float, np.ndarray]:
        """Similarity of a family's closest template to a paragraph's features, and its features. A template of whose own
        features the paragraph has less than OWN isn't like it, however much both share with other notices."""
        like = lambda t, own: float(np.isin(t, mine).mean()) if not len(own) or np.isin(own, mine).mean() >= OWN else 0.0
        return max(((like(t, own), t) for k, t, own in self.templates if k == family), key=lambda x: x[0], default=(0.0, mine[:0]))

    def _rest(self, mine: np.ndarray, *templates: np.ndarray) -> np.ndarray:
        """Probabilities of what some templates leave of a paragraph."""
        left = mine[self.wanted[mine] & ~np.isin(mine, np.concatenate(templates))]
        return self.probabilities(linear.Sparse(np.zeros(len(left), np.int64), self.slots[left], 1))[0]

    def _families(self, mine: np.ndarray, p: np.ndarray, least: float, confirm: float) -> list[tuple[int, float, float]]:
        """(family, probability, similarity) of a paragraph: the families confirmed, or the one predicted."""
        first, second = (int(k) for k in np.argsort(-p[:-1], kind="stable")[:2])
        if p[first] >= least:
            found = [(first, float(p[first]), self.closest(mine, first)[0])]
        else:
            found = []
            for family, other in ((first, second), (second, first)):
                share = self._rest(mine, self.closest(mine, other)[1])[family]
                if share >= least and (close := self.closest(mine, family)[0]) >= confirm:
                    found.append((family, float(share), close))
        while found and found[-1][2] >= confirm:
            rest = self._rest(mine, *(self.closest(mine, k)[1] for k, _, _ in found))
            k = int(rest.argmax())
            if k == len(self.families) - 1 or rest[k] < least or k in {x[0] for x in found} or (close := self.closest(mine, k)[0]) < confirm:
                break
            found.append((k, float(rest[k]), close))
        return found

    def scan_joined(self, lines: pa.Array, first: np.ndarray, line: np.ndarray, family: np.ndarray, close: np.ndarray, least: float, confirm: float) -> list[tuple[int, int, int, float, float]]:
        """(first line, end, family, probability, similarity) of notices that only joined lines confirm; line, family and
        close are of the lines by themselves, first has each text's first line."""
        text = lines.to_pylist()
        spans = stretches(text, first.tolist())
        if not spans:
            return []
        where, kind, share, similar = self.scan(pa.array([" ".join(text[a:b]) for a, b in spans], pa.string()), least, confirm)
        known: dict[int, list[tuple[int, int]]] = {}
        for at, k, c in zip(line.tolist(), family.tolist(), close.tolist()):
            if c >= confirm:
                known.setdefault(k, []).append((at, at + 1))
        out = []
        for i in np.argsort(-similar, kind="stable").tolist():
            (a, b), k, c = spans[where[i]], int(kind[i]), float(similar[i])
            if c < confirm:
                break
            if any(x < b and y > a and y - x == 1 for x, y in known.get(k, ())):
                continue
            like = lambda x, y: self.closest(self.features.of(pa.array([" ".join(text[x:y])]))[1], k)[0]  # noqa: B023, E731
            while b - a > 1 and like(a + 1, b) >= c:
                a += 1
            while b - a > 1 and like(a, b - 1) >= c:
                b -= 1
            if not any(x < b and y > a for x, y in known.get(k, ())):
                known.setdefault(k, []).append((a, b))
                out.append((a, b, k, float(share[i]), c))
        return sorted(out)

    @property
    def wanted(self) -> np.ndarray:
        return self.slots > 0


def stretches(lines: list[str], first: list[int], size: int = STRETCH) -> list[tuple[int, int]]:
    """Windows of two or more successive lines of one text, none blank, of `size` words or all there are, half of it apart."""
    out = []
    starts = set(first)
    at = 0
    while at < len(lines):
        end, counts = at, []
        while end < len(lines) and (end == at or end not in starts) and (n := len(lines[end].split())):
            counts.append(n)
            end += 1
        low = 0
        while len(counts) - low > 1:
            high, words, half = low, 0, low + 1
            while high < len(counts) and (words < size or high - low < 2):
                words += counts[high]
                high += 1
                if words <= size // 2:
                    half = high
            out.append((at + low, at + high))
            if high == len(counts):
                break
            low = max(half, low + 1)
        at = max(end, at + 1)
    return out


def train(negatives: list[str], bits: int = BITS, seed: int = 6) -> LicenceModel:
    """From the templates, varied by surroundings and lost words, and paragraphs of the corpus."""
    rng = np.random.default_rng(seed)
    features = ParagraphFeatures(bits)
    families = [*TEMPLATES, UNKNOWN]
    pool = [w for t in negatives for w in t.split()] or ["and", "of", "in"]
    texts, labels = [], []
    for k, family in enumerate(TEMPLATES):
        for template in TEMPLATES[family]:
            words = template.split()
            for v in range(VARIANTS):
                lost = 0 if v % 3 == 0 else 0.12 if len(words) > 8 else 0
                kept = [w for w in words if rng.random() >= lost]
                around = [[pool[i] for i in rng.integers(0, len(pool), int(rng.integers(0, 12)))] if v % 2 else [] for _ in range(2)]
                texts.append(" ".join([*around[0], *kept, *around[1]]))
                labels.append(k)
    # What shares words with notices and is none: single words of notices among others.
    notice_words = [w for ts in TEMPLATES.values() for t in ts for w in t.split()]
    mixes = [" ".join([*(pool[i] for i in rng.integers(0, len(pool), int(rng.integers(3, 20)))), *rng.choice(notice_words, int(rng.integers(1, 4)))]) for _ in range(len(texts))]
    for t in [*negatives, *mixes]:
        texts.append(t)
        labels.append(len(families) - 1)
    y = np.array(labels)
    row, f = features.of(pa.array(texts))
    shown = np.bincount(f, minlength=1 << bits)
    notices = np.bincount(f[y[row] < len(families) - 1], minlength=1 << bits)
    chosen = (notices >= 3) & (notices > 0.2 * shown)  # words as common elsewhere tell nothing
    place = np.cumsum(chosen) - 1
    keep = chosen[f]
    row, f = row[keep], place[f[keep]]
    learned = rng.random(len(y)) < 0.8
    one = np.eye(len(families))[y]
    counts = np.bincount(y, minlength=len(families))
    weight = np.where(learned, 1 / np.maximum(counts[y], 1), 0.0)
    x = linear.Sparse(row, f, len(y))
    w, b = linear.fit(x, one, weight, int(chosen.sum()), 1e-4, steps=200)
    z = (x.times(w) + b)[~learned]
    loss = lambda t: -np.log(np.maximum(linear.softmax(z / t)[np.arange(len(z)), y[~learned]], 1e-12)).mean()
    temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=loss)
    strong = np.abs(w).max(1) >= 0.02
    slots = np.zeros(1 << bits, np.int32)
    slots[np.flatnonzero(chosen)[strong]] = np.arange(1, strong.sum() + 1)
    weights = np.concatenate([np.zeros((1, len(families))), w[strong]])
    templates = []
    for k, family in enumerate(TEMPLATES):
        for t in TEMPLATES[family]:
            templates.append((k, features.of(pa.array([t]))[1]))
    templates = [(k, t, t[~np.isin(t, np.concatenate([x for j, x in templates if j != k]))]) for k, t in templates]
    return LicenceModel(families, slots, weights, b, float(temperature), features, templates)


def learn(docs: DataFrame, text: str = "text", id_column: str = "doc_id", sample: int = SAMPLE) -> LicenceModel:
    """Samples paragraphs of the corpus: expected `sample` documents by a hash of the id, one line of each."""
    n = docs.count()
    share = min(1.0, sample / max(1, n))
    lines = F.split(F.col(text), "\n")
    picked = docs.where(F.col(text).isNotNull() & (F.pmod(F.xxhash64(F.col(id_column).cast("string"), F.lit("licence sample")), F.lit(1 << 30)) < share * (1 << 30)))
    line = F.get(lines, F.pmod(F.xxhash64(F.col(id_column).cast("string"), F.lit("line")), F.size(lines)).cast("int"))
    negatives = [r.line for r in picked.select(line.alias("line"), F.col(id_column).alias("i")).orderBy("i", "line").collect() if r.line]
    known = train([])  # paragraphs that the notices alone explain are no examples of what is unknown
    if negatives:
        hits = known.scan(pa.array(negatives), 0.5)
        notices = {int(k) for k, s in zip(hits[0], hits[3]) if s >= CONFIRM}
        negatives = [t for k, t in enumerate(negatives) if k not in notices]
    return train(negatives)


def scan(docs: DataFrame, model: LicenceModel, id_column: str = "doc_id", text: str = "text", least: float = LEAST, confirm: float = CONFIRM) -> DataFrame:
    """(id, paragraph from 1, family, probability, similarity, confirmed) of each paragraph for which a family is predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand weights a family

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array(m.families, object)
        for batch in kernels.rebatched(batches, "text"):
            lines, first = m.features.lines(batch["text"])
            line, family, p, close = m.scan(lines, least, confirm)
            joined = m.scan_joined(lines, first, line, family, close, least, confirm)
            covered = {(at, k) for a, b, k, _, _ in joined for at in range(a, b)}
            alone = np.array([(at, k) not in covered for at, k in zip(line.tolist(), family.tolist())], bool)
            line, family, p, close = line[alone], family[alone], p[alone], close[alone]
            if joined:
                more = [np.array(x) for x in zip(*((a, k, share, c) for a, _, k, share, c in joined))]
                line, family, p, close = (np.concatenate(x) for x in zip((line, family, p, close), more))
                order = np.lexsort((family, line))
                line, family, p, close = line[order], family[order], p[order], close[order]
            if len(line):
                own = np.searchsorted(first, line, "right") - 1
                sure = close >= confirm
                columns = [batch["id"].take(pa.array(own)), pa.array((line - first[own] + 1).astype(np.int32)), pa.array(np.where(sure, names[family], UNKNOWN), pa.string()), pa.array(p), pa.array(close), pa.array(sure)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "paragraph", "family", "probability", "similarity", "confirmed"])

    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(scanned, f"id {kind}, paragraph int, family string, probability double, similarity double, confirmed boolean")
    return found.withColumnRenamed("id", id_column)
