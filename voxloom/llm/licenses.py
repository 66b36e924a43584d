"""Licence scan: a trained paragraph classifier, confirmed by comparison with templates.

A paragraph is a line.  Sparse word one- and two-grams feed a multinomial logistic regression over the
licence families and ``none``.  It is trained here, on statements made from :data:`TEMPLATES` with words
left out and corpus words around them, on body paragraphs of known licences (:data:`BODIES`), on statements
of licences outside the families, and on paragraphs of a bounded sample of texts.  A licence paragraph whose best family falls under a calibrated probability
is ``unknown``; so is one that shares too little with every template of the predicted family.

Every paragraph with an n-gram of the statements is scored; the trained class ``none`` decides.  Only
paragraphs without any of them, whose score would be that of an empty one, are ``none`` at once.

Nulls: a null text is empty and has no licences; ids are passed through, repeated rows give repeated
results, texts and paragraphs of any length are read whole, an empty table gives an empty result.  Extra
columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import bounded_sample, ids_and_texts, per_text

TEMPLATES = {
    "apache-2.0": ("Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    "mit": ("Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.",
            "This software is distributed under the terms of the MIT license."),
    "bsd": ("Licensed under the BSD 3-Clause License.", "Redistribution and use in source and binary forms, with or without modification, are permitted.",
            "Distributed under the BSD license."),
    "gpl": ("This work is licensed under the GNU General Public License, version 3.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License.",
            "Licensed under the GPL version 2 or later."),
    "lgpl": ("Licensed under the GNU Lesser General Public License, version 2.1.", "Released under the LGPL version 3."),
    "agpl": ("Licensed under the GNU Affero General Public License, version 3.", "Released under the AGPL version 3."),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the MPL 2.0."),
    "cc-by": ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."),
    "cc-by-sa": ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Licensed under CC BY-SA 4.0."),
    "cc-by-nc": ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC 4.0."),
    "cc0": ("To the extent possible under law, the author has waived all copyright and related rights to this work.", "Released under CC0 1.0."),
}
#: Paragraphs from the body of licences, also compared with.
BODIES = {
    "mit": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
            "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
            "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    "bsd": ("Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
            "in the documentation and/or other materials provided with the distribution.",
            "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
            "from this software without specific prior written permission."),
    "apache-2.0": ("Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
                   "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",),
    "gpl": ("This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
            "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",),
}
#: Licence statements of no family: they teach the model what an unknown licence looks like.
OTHERS = ("Licensed under the terms of our own licence agreement.", "This work is licensed under the European Union Public Licence.",
          "All rights reserved.", "Distributed under the Eclipse Public License.", "Use is subject to the licence terms of the vendor.",
          "Released under the Artistic License.",
          # Disclaimers that several families share.
          "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
          "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
          "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
          "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE.")
MAX_TEXTS = 300
CONFIRM = 0.5
#: Share of held-out family statements that may be called unknown by the calibrated probability.
UNKNOWN_MISS = 0.02

_WORD = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")


def words_of(paragraph: str) -> list[str]:
    return _WORD.findall(paragraph.lower())


def grams(words: list[str]) -> list[str]:
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


class Model:
    """Classifier, templates and limits; small, so it travels with the tasks."""

    def __init__(self, texts: list[str], steps: int = 300):
        r = np.random.default_rng(3)
        self.families = [*TEMPLATES, "other", "none"]
        plain = [p for t in texts for p in t.split("\n") if p.strip()][:4000]
        known = {k: (*ts, *BODIES.get(k, ())) for k, ts in TEMPLATES.items()}
        statements = [t for ts in known.values() for t in ts] + list(OTHERS)
        licence_words = {w for s in statements for w in words_of(s)}
        # Corpus lines that look like statements are left out of the plain examples.
        strong = {w for w in licence_words if re.search("licen[sc]|gnu|gpl|apache|mozilla|creative|copyright|warrant", w)}
        plain = [p for p in plain if strong.isdisjoint(words_of(p))]
        common = {w for p in plain for w in set(words_of(p))}
        self.signal = licence_words - common
        filler = sorted(common - licence_words) or ["word"]
        samples: list[tuple[list[str], int]] = []
        for k, statements in enumerate([*known.values(), OTHERS]):
            for s in statements:
                for j in range(60):
                    w = words_of(s)
                    if j:
                        w = [x for x in w if x in self.signal or r.random() > 0.15]
                        before, after = (list(r.choice(filler, r.integers(0, 12))) for _ in range(2))
                        w = (before if j % 3 else []) + w + (after if j % 2 else [])
                    samples.append((w, k))
        # Plain lines, some with single licence words strewn in.
        loose = sorted(licence_words)
        for j, p in enumerate(plain[:1500]):
            w = words_of(p)
            if j % 2 and w:
                w.insert(int(r.integers(0, len(w) + 1)), loose[int(r.integers(len(loose)))])
            samples.append((w, len(self.families) - 1))
        names = sorted({g for s in [*sum(map(list, known.values()), []), *OTHERS] for g in grams(words_of(s))})
        self.feature = {g: i for i, g in enumerate(names)}
        x = np.stack([self.vector(w) for w, _ in samples])
        y = np.array([k for _, k in samples])
        held = np.arange(len(y)) % 5 == 0
        self.w, self.b = np.zeros((len(names), len(self.families))), np.zeros(len(self.families))
        target = np.eye(len(self.families))[y]
        weight = (1 / np.bincount(y, minlength=len(self.families)).clip(1))[y][~held][:, None]
        weight /= weight.sum()
        for _ in range(steps):
            gap = (self._softmax(x[~held]) - target[~held]) * weight
            self.w -= 20.0 * (x[~held].T @ gap + 1e-5 * self.w)
            self.b -= 2.0 * gap.sum(axis=0)
        p = self._softmax(x[held])
        family = y[held] < len(TEMPLATES)
        right = np.sort(p[family, y[held][family]])
        self.least = float(min(0.6, right[int(len(right) * UNKNOWN_MISS)])) if len(right) else 0.5
        self.templates = {k: [set(words_of(t)) for t in ts] for k, ts in known.items()}

    def vector(self, words: list[str]) -> np.ndarray:
        v = np.zeros(len(self.feature))
        for g in set(grams(words)):
            i = self.feature.get(g)
            if i is not None:
                v[i] = 1.0
        return v

    def _softmax(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.w + self.b
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def classify(self, paragraph: str) -> str:
        """A family, ``unknown`` or ``none``."""
        words = words_of(paragraph)
        here = set(words)
        columns = [i for i in map(self.feature.get, here.union(grams(words))) if i is not None]
        if not columns:
            return "none"
        z = self.w[columns].sum(axis=0) + self.b
        p = np.exp(z - z.max())
        p /= p.sum()
        k = int(p.argmax())
        name = self.families[k]
        if name == "none":
            return "none"
        if name == "other" or p[k] < self.least:
            return "unknown"
        # Share of the template found here: the paragraph may go on around it.
        likeness = max(len(t & here) / len(t) for t in self.templates[name])
        return name if likeness >= CONFIRM else "unknown"


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Plain examples come from at most :data:`MAX_TEXTS` texts (smallest hash of id, first 4,000 characters)."""
    d = ids_and_texts(docs, id_col, text_col)
    rows = bounded_sample(d, "doc_id", MAX_TEXTS).select(F.substring("text", 1, 4000).alias("text")).filter("length(text) > 0").collect()
    return Model([r.text for r in rows])


def scan(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_licenses, families, findings`` for every row: paragraphs that are licences, their families
    sorted, and ``line:family`` in order (lines from 0)."""
    model = model or train(docs, id_col, text_col)

    def row():
        kept: dict[str, str] = {}

        def one(text: str):
            found = []
            for n, line in enumerate(text.split("\n")):
                if line:
                    kind = kept.get(line)
                    if kind is None:
                        kind = model.classify(line)
                        # Statements repeat word for word; only they are kept.
                        if kind != "none" and len(line) < 1000 and len(kept) < 10_000:
                            kept[line] = kind
                    if kind != "none":
                        found.append((n, kind))
            return (len(found), ",".join(sorted({k for _, k in found})), ",".join(f"{n}:{k}" for n, k in found))
        return one

    scanned = per_text(row, "n_licenses long, families string, findings string")
    return ids_and_texts(docs, id_col, text_col).select("doc_id", scanned(F.col("text")).alias("s")).select("doc_id", "s.*")
