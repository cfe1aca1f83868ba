"""Licence scan: a trained paragraph classifier, confirmed by template comparison.

Features of a paragraph (a line of a text) are its distinct word 1- and 2-grams, words in lower
case without punctuation. Multinomial logistic regression over the n-grams of the notices below
tells the licence families and an unknown class apart. It learns from the notices, cut and
worded in different ways, and for the unknown class from legal talk that names no licence and a
bounded sample of the corpus' own lines. The softmax is calibrated: its temperature and the least
probability of a licence are fitted on examples left out of the training.

A predicted family stands only if the paragraph agrees with one of its templates: the part of the
template's 2-grams that the paragraph has, or of the paragraph's known 2-grams that the
template has, must reach ``AGREEMENT``.

Lines without any n-gram of the notices are unknown by construction, and are recognised by the hashes
of their words before anything else is done. Null text has no paragraphs; whole texts are read; rows
are handled one by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimweave.llm import text as tx
from claimweave.llm.tables import fresh, quoted

# Usual short notices of the licence families.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
        "This project is released under the Apache 2.0 license.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Released under the GPL v3.",
    ),
    "GPL-2.0": (
        "Licensed under the GNU General Public License, version 2.",
        "under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 2.1 or 3.",
        "This library is free software under the terms of the GNU Lesser General Public License.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "AGPL-3.0": ("Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only"),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Use of this source code is governed by a BSD-style license.",
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License 2.0.", "SPDX-License-Identifier: MPL-2.0"),
    "CC-BY": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-ND": ("Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    "CC0-1.0": ("CC0 1.0 Universal, dedicated to the public domain.", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    "proprietary": ("All rights reserved. No part of this work may be reproduced without prior written permission.", "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited."),
}
OTHER = (
    "The licence of the driver was renewed.", "You need permission to enter the public building.", "They read the terms and conditions again.", "A new version of the software was released today.",
    "The work is free and open to the public.", "The source of the river is in the general area.", "He applied for a fishing license and a permit.", "The commons were used by any person of the village.",
    "No rights were lost and nothing was reserved for the author.", "Copyright law is a subject of its own.", "The project was released under pressure.", "This work is under way in its third version.",
)
# End of fixed values.

UNKNOWN = "unknown"
SAMPLE_LINES, AGREEMENT = 2000, 0.5
_WORD = re.compile(r"[a-z0-9]+|[^\x00-\x7f]+")


def grams(line: str) -> list[str]:
    w = _WORD.findall(line.lower())
    return list(dict.fromkeys([*w, *(f"{a} {b}" for a, b in zip(w, w[1:], strict=False))]))


class Classifier:
    """Weights over the n-grams of the notices; the last class is the unknown one."""

    def __init__(self, other_lines: list[str], seed: int = 0):
        rng = np.random.default_rng(seed)
        self.families = [*TEMPLATES, UNKNOWN]
        known = sorted({g for notices in TEMPLATES.values() for t in notices for g in grams(t)})
        self.place = {g: k for k, g in enumerate(known)}
        noise = [w for line in other_lines for w in _WORD.findall(line.lower())][:5000] or ["word"]
        examples: list[tuple[str, int]] = []
        for label, notices in enumerate(TEMPLATES.values()):
            for notice in notices:
                examples += [(self._varied(notice, noise, rng), label) for _ in range(24)] + [(notice, label)] * 4
        unknown = len(TEMPLATES)
        examples += [(line, unknown) for line in other_lines] + [(line, unknown) for line in OTHER for _ in range(12)]
        # single words of the notices in other surroundings
        words = [k for k in known if " " not in k]
        examples += [(" ".join(rng.permutation([*rng.choice(words, 2), *rng.choice(noise, 12)])), unknown) for _ in range(1500)]
        examples = [examples[k] for k in rng.permutation(len(examples))]
        x, y = np.array([self._row(t) for t, _ in examples]), np.array([label for _, label in examples])
        test = np.arange(len(y)) % 5 == 0
        self.weights = self._fit(x[~test], y[~test])
        self._calibrate(x[test], y[test])
        self.templates = [[{g for g in grams(t) if " " in g} for t in notices] for notices in TEMPLATES.values()]
        spaced = [np.frombuffer(k.encode(), np.uint8) for k in known if " " not in k]
        self.vocabulary = np.unique(np.concatenate([tx.words(b, np.array([0, len(b)]), tx.ALNUM).hash for b in spaced]))

    @staticmethod
    def _varied(notice: str, noise: list[str], rng: np.random.Generator) -> str:
        """Some words fewer at the ends, words of other texts around."""
        w = notice.split()
        if len(w) > 8:
            begin = int(rng.integers(0, len(w) // 3))
            w = w[begin : len(w) - int(rng.integers(0, len(w) // 3))]
        before, after = (list(rng.choice(noise, int(rng.integers(0, 7)))) for _ in range(2))
        return " ".join([*before, *w, *after])

    def _row(self, line: str) -> np.ndarray:
        row = np.zeros(len(self.place) + 1, np.float32)
        for g in grams(line):
            if (k := self.place.get(g)) is not None:
                row[k] = 1
        row[-1] = 1
        return row

    def _fit(self, x: np.ndarray, y: np.ndarray, steps: int = 250) -> np.ndarray:
        want = np.eye(len(self.families), dtype=np.float32)[y]
        w = np.zeros((x.shape[1], want.shape[1]), np.float32)
        first, second = np.zeros_like(w), np.zeros_like(w)
        for t in range(1, steps + 1):
            slope = x.T @ (self._softmax(x @ w) - want) / len(x) + 1e-5 * w
            first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
            w -= 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
        return w

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def _calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Temperature of the best likelihood; the least probability that lets 1 in 200 unknown lines through."""
        z = x @ self.weights
        picked = np.arange(len(y))
        self.temperature = min((0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 5.0), key=lambda t: -np.log(self._softmax(z / t)[picked, y] + 1e-12).mean())
        p = self._softmax(z / self.temperature)
        of_unknown = p[y == len(self.families) - 1][:, :-1].max(1)
        self.least = max(0.5, float(np.quantile(of_unknown, 0.995))) if len(of_unknown) else 0.5
        self.accuracy = float((p.argmax(1) == y).mean())

    def agreement(self, line: str, family: int) -> float:
        own = {g for g in grams(line) if " " in g and g in self.place}
        return max((max(len(own & t) / len(t), len(own & t) / max(len(own), 3)) for t in self.templates[family]), default=0.0) if own else 0.0

    def predict(self, lines: list[str]) -> list[tuple[str, float, float]]:
        """Family, probability and agreement with its best template of each line."""
        if not lines:
            return []
        p = self._softmax(np.array([self._row(t) for t in lines]) @ self.weights / self.temperature)
        out = []
        for line, own in zip(lines, p, strict=True):
            best = int(own[:-1].argmax())
            agreed = self.agreement(line, best)
            stands = own[best] >= self.least and agreed >= AGREEMENT
            out.append((self.families[best] if stands else UNKNOWN, float(own[best] if stands else own[-1]), agreed))
        return out


def train(docs: DataFrame, text: str = "text", sample: int = SAMPLE_LINES) -> Classifier:
    """Classifier whose unknown class also learns from at most ``sample`` lines of ``docs``, cut to 300 characters."""
    line = F.substring(F.regexp_substr(quoted(text), F.lit(r"[^\n]{20,}")), 1, 300)
    lines = docs.select(line.alias("l")).where("l is not null and not lower(l) rlike 'licen[cs]|copyright|rights reserved|spdx|creative commons'")
    # one line per class of hashes, the one of the least hash: no task and not the driver gets more than ``sample`` lines
    least = F.min(F.struct(F.xxhash64("l").alias("h"), "l")).alias("least")
    drawn = lines.groupBy(F.pmod(F.xxhash64("l"), F.lit(sample))).agg(least).select("least.*")
    return Classifier([line for _, line in sorted(map(tuple, drawn.collect()))])


def _candidate_lines(data: np.ndarray, offsets: np.ndarray, vocabulary: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Document and byte range of lines that hold at least two words of the notices side by side."""
    w = tx.words(data, offsets, tx.ALNUM)
    if len(w.hash) < 2:
        return
    at = np.searchsorted(vocabulary, w.hash)
    at[at == len(vocabulary)] = 0
    known = vocabulary[at] == w.hash
    breaks = np.unique(np.concatenate((np.flatnonzero(data == 10), offsets)))
    line = np.searchsorted(breaks, w.start, side="right")
    pair = known[1:] & known[:-1] & (line[1:] == line[:-1])
    for k in np.unique(line[1:][pair]).tolist():
        begin = int(breaks[k - 1]) + int(data[breaks[k - 1]] == 10 if breaks[k - 1] < len(data) else 0)
        yield int(np.searchsorted(offsets, breaks[k - 1], side="right")) - 1, begin, int(breaks[k]) if k < len(breaks) else len(data)


def find_licences(docs: DataFrame, model: Classifier, text: str = "text") -> DataFrame:
    """``docs`` with an array column ``licences`` (renamed with ``_`` where taken).

    One element per paragraph with a licence: family, probability, agreement with the template, and the
    UTF-8 byte range of the line.
    """
    out = fresh(docs, "licences")
    name = docs.columns.index(text)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("family", pa.string()), ("probability", pa.float64()), ("agreement", pa.float64()), ("start", pa.int64()), ("end", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for first, data, offsets in tx.groups(pc.fill_null(batch.column(name), "")):
                spots = list(_candidate_lines(data, offsets, own.vocabulary))
                for k in range(0, len(spots), 512):
                    part = spots[k : k + 512]
                    lines = [data[b:e].tobytes().decode("utf-8", "replace") for _, b, e in part]
                    for (d, b, e), (family, probability, agreed) in zip(part, own.predict(lines), strict=True):
                        if family != UNKNOWN:
                            at = int(offsets[d])
                            found[first + d].append({"family": family, "probability": probability, "agreement": agreed, "start": b - at, "end": e - at})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(kind))], names=[*batch.schema.names, out])

    element = T.StructType([T.StructField("family", T.StringType()), T.StructField("probability", T.DoubleType()), T.StructField("agreement", T.DoubleType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    return docs.mapInArrow(task, T.StructType([*docs.schema.fields, T.StructField(out, T.ArrayType(element))]))
