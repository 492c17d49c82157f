"""Licence scan: a trained paragraph classifier, confirmed by comparison with templates.

Paragraphs (non-empty lines) are hashed into sparse vectors of word 1- and 2-grams, on which a
multinomial logistic regression tells the licence families and ``none`` apart.  It learns from
the templates below, cut down and varied, and from a bounded sample of the corpus's own
paragraphs as ``none`` (``SAMPLE``; those that speak of licences are left out).  A paragraph
whose best family has too little probability is ``unknown`` if it speaks of a licence; the
bound is calibrated on held-back paragraphs.  A prediction stands if the paragraph shares
enough of its words with a template of the family, words it has beyond them counting against it.
Templates are the usual references, SPDX lines and the paragraphs of whole notices.

Scored are the sentences that hold a cue, and those that hold so many words of a template that
they can be confirmed (``HINTS`` follow from the templates and leave none of these out).  A
notice wrapped over lines up to a blank one is judged on the lines together.  Nulls count as
empty texts, without notices; very long texts are read whole.  Repeated rows are scanned alike; of equally alike notices
the shortest and then the first is kept.  An empty table gives an empty result, and without a corpus the templates alone
are learnt from.  Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most paragraphs of the corpus that are learnt from, taken by the hash of their text.
SAMPLE = 4_000
#: Buckets of hashed n-grams.
WIDTH = 1 << 12
#: Share of a template's words that a paragraph must hold to confirm a family.
CONFIRM = 0.6
#: Likeness to a template from which on it decides alone.
SURE = 0.8
#: Share of held-back paragraphs of none that may exceed the bound of the unknown class.
MISTAKEN = 0.001

#: Wordings by which texts name their licence, and the paragraphs of whole notices, by
#: family.  Paragraphs that several licences have in common stand with the most usual one.
TEMPLATES = {
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without"
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the"
        " Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions"
        " of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED"
        " TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,"
        " WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE"
        " OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "SPDX-License-Identifier: MIT",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License 2.0.",
        "you may not use this file except in compliance with the License",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed"
        " on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "See the License for the specific language governing permissions and limitations under the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "gpl": (
        "Licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "Released under the GPL.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the"
        " implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
        "See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0-or-later",
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "Released under the LGPL.",
        "See the GNU Lesser General Public License for more details.",
        "You should have received a copy of the GNU Lesser General Public License along with this program.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "SPDX-License-Identifier: LGPL-3.0-only",
    ),
    "agpl": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "Released under the AGPL.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
        "See the GNU Affero General Public License for more details.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "bsd": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following"
        " disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the"
        " following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED"
        " WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A"
        " PARTICULAR PURPOSE ARE DISCLAIMED.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "SPDX-License-Identifier: BSD-2-Clause",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "isc": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.", "Licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.", "Licensed under Creative Commons Attribution-ShareAlike 4.0.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.", "Licensed under Creative Commons Attribution-NonCommercial 4.0.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "cc0": (
        "Released under CC0 1.0.", "To the extent possible under law, the author has dedicated this work to the public domain.",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "reserved": ("All rights reserved.", "Copyright 2020. All rights reserved.", "No part may be reproduced without permission."),
}
NONE, UNKNOWN = "none", "unknown"
#: Words of which a licence notice holds one.
CUE = re.compile(
    r"(?i)licen[cs]|lizenz|licencia|copyright|rights reserved|creative commons|\bcc[ -]?(?:by|0)"
    r"|\b[al]?gpl\b|redistribut|hereby granted|public domain|may be reproduced|source code form"
)
WORD = re.compile(r"[a-z0-9][a-z0-9.+-]*[a-z0-9+]|[a-z0-9]")


def words_of(paragraph: str) -> list[str]:
    return WORD.findall(paragraph.lower())


def grams(paragraph: str) -> np.ndarray:
    """Buckets of the distinct word 1- and 2-grams."""
    words = words_of(paragraph)
    told = set(words) | {f"{a} {b}" for a, b in zip(words, words[1:])}
    return np.array(sorted({xxhash.xxh32_intdigest(t) % WIDTH for t in told}), dtype=np.int64)


def _matrix(paragraphs: list[str]) -> np.ndarray:
    x = np.zeros((len(paragraphs), WIDTH), dtype=np.float32)
    for k, p in enumerate(paragraphs):
        at = grams(p)
        if len(at):
            x[k, at] = 1 / np.sqrt(len(at))
    return x


@dataclass(frozen=True)
class Model:
    """Weights per family (the last row's are ``none``) and the bound of the unknown class."""

    families: tuple[str, ...]
    weights: np.ndarray
    bound: float

    def probabilities(self, paragraph: str) -> np.ndarray:
        at = grams(paragraph)
        score = self.weights[:, -1].copy()
        if len(at):
            score += self.weights[:, at].sum(axis=1) / np.sqrt(len(at))
        score = np.exp(score - score.max())
        return score / score.sum()


def varied() -> tuple[list[str], list[str]]:
    """Paragraphs and families to learn: each template, its openings and other wordings."""
    paragraphs, families = [], []
    for family, templates in TEMPLATES.items():
        for t in templates:
            words = t.split()
            forms = {t, t.upper(), t.rstrip("."), f"This text: {t}", f"{t} See the notice."}
            for verb in ("Licensed", "Released", "Distributed", "Published", "Available", "Used"):
                if words[0] in ("Licensed", "Released"):
                    forms.add(" ".join([verb, *words[1:]]))
            if len(words) > 8:
                forms |= {" ".join(words[:k]) for k in range(8, len(words), 3)}
            for form in sorted(forms):
                paragraphs.append(form)
                families.append(family)
    return paragraphs, families


def fit(clean: list[str], steps: int = 300, rate: float = 4.0, ridge: float = 1e-4) -> Model:
    """Multinomial logistic regression by gradient steps; a quarter of ``clean`` calibrates."""
    families = (*TEMPLATES, NONE)
    texts, told = varied()
    learn, back = clean[: len(clean) * 3 // 4], clean[len(clean) * 3 // 4:]
    x = _matrix(texts + learn)
    x = np.concatenate([x, np.ones((len(x), 1), dtype=np.float32)], axis=1)
    y = np.array([families.index(f) for f in told] + [len(families) - 1] * len(learn))
    # Families and none weigh alike, however many paragraphs there are of each.
    weigh = (1 / np.maximum(np.bincount(y, minlength=len(families)), 1))[y].astype(np.float32)
    weigh /= weigh.sum()
    w = np.zeros((len(families), WIDTH + 1), dtype=np.float32)
    speed = np.zeros_like(w)
    target = np.eye(len(families), dtype=np.float32)[y]
    for _ in range(steps):
        score = x @ w.T
        p = np.exp(score - score.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        speed = 0.9 * speed + ((target - p) * weigh[:, None]).T @ x - ridge * w
        w += rate * speed
    model = Model(families, w, 0.5)
    # Paragraphs like those that are scored, if there are any.
    back = [p for p in back if hinted(p)] or back
    mistaken = [float(model.probabilities(p)[:-1].max()) for p in back]
    bound = float(np.quantile(mistaken, 1 - MISTAKEN)) if mistaken else 0.0
    return Model(families, w, min(max(0.5, bound), 0.95))


_WORDS = {f: [frozenset(words_of(t)) for t in templates] for f, templates in TEMPLATES.items()}


def resemblance(paragraph: str, family: str) -> float:
    """The largest share of a template's words that the paragraph holds."""
    words = set(words_of(paragraph))
    return max(len(words & t) / len(t) for t in _WORDS[family])


def likeness(paragraph: str, family: str) -> float:
    """Words in common among those of both, of the most alike template that CONFIRM allows.

    Words of the paragraph that the template lacks count against it.
    """
    words = set(words_of(paragraph))
    return max(
        (2 * len(words & t) / (len(words) + len(t)) for t in _WORDS[family] if len(words & t) >= CONFIRM * len(t)), default=0.0
    )


def _hints() -> tuple[str, ...]:
    """Words of which a text holds one if it has CONFIRM of any template's words."""
    common = set(
        "a all and any be by can can except file free from general has in is it may no not of or part person public"
        " source the this to under use used with without work you".split()
    )
    hints = set()
    for templates in _WORDS.values():
        for t in templates:
            least = next(m for m in range(1, len(t) + 1) if m / len(t) >= CONFIRM)
            hints |= set(sorted(t, key=lambda w: (w in common, -len(w), w))[:len(t) - least + 1])
    # A word that contains another hint adds nothing.
    return tuple(sorted(w for w in hints if not any(v != w and v in w for v in hints)))


HINTS = _hints()
_finder: list = []
#: Words of the longest run of lines that is judged as one notice.
WRAPPED = 2 * max(len(t) for templates in _WORDS.values() for t in templates)


def hinted(text: str) -> bool:
    if not _finder:
        # All hints are sought in one pass over the text.
        finder = ahocorasick.Automaton()
        for hint in HINTS:
            finder.add_word(hint, hint)
        finder.make_automaton()
        _finder.append(finder)
    return next(_finder[0].iter(text.lower()), None) is not None


def resembling(paragraph: str) -> bool:
    """Whether the paragraph can be confirmed as one of the families."""
    words = set(words_of(paragraph))
    return any(len(words & t) / len(t) >= CONFIRM for templates in _WORDS.values() for t in templates)


def classify(paragraph: str, model: Model) -> tuple[str, float, float]:
    """(family, probability, resemblance) of a paragraph that holds a cue or resembles a template."""
    p = model.probabilities(paragraph)
    best = int(p[:-1].argmax())
    family, likely = model.families[best], float(p[best])
    if p[-1] > likely:
        return NONE, float(p[-1]), 0.0
    # Of the families whose templates agree the paragraph must be most alike to the predicted one, or so
    # alike to another that there is no doubt.
    alike = {f: likeness(paragraph, f) for f in TEMPLATES}
    nearest = max(alike, key=lambda f: (alike[f], f == family))
    like = resemblance(paragraph, nearest if alike[nearest] else family)
    if alike[nearest] >= SURE or (nearest == family and likely >= model.bound and like >= CONFIRM):
        return nearest, float(p[model.families.index(nearest)]), like
    return UNKNOWN, likely, like


def held(paragraph: str, family: str) -> int:
    """Words in common with the family's template that has most, among those that CONFIRM allows."""
    words = set(words_of(paragraph))
    return max((len(words & t) for t in _WORDS.get(family, ()) if len(words & t) >= CONFIRM * len(t)), default=0)


def _clean_paragraphs(batches):
    for batch in batches:
        told = []
        for text in batch.column("text"):
            told.extend(p for p in (text.as_py() or "").split("\n") if p.strip() and not CUE.search(p) and not (hinted(p) and resembling(p)))
        yield pa.RecordBatch.from_arrays([pa.array(told, pa.string())], names=["paragraph"])


def learn(docs: DataFrame) -> Model:
    """A model whose ``none`` is learnt from at most SAMPLE of the corpus's paragraphs."""
    # Ids are picked without their texts, which stay where they are.
    ids = docs.select("doc_id").where("doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = docs.select("doc_id", "text").join(
        F.broadcast(ids.limit(SAMPLE // 4)), "doc_id", "left_semi"
    )
    rows = (
        picked.mapInArrow(_clean_paragraphs, "paragraph string").distinct()
        .orderBy(F.xxhash64("paragraph"), "paragraph").limit(SAMPLE).collect()
    )
    return fit([r["paragraph"] for r in rows])


FOUND = "doc_id long, notices array<struct<start:long,end:long,family:string,probability:double,resemblance:double>>"


SENTENCE = re.compile(r"(?<=[.!?])(?=\s+[A-Z])")


def _judged(sentence: str, model: Model, seen: dict, cues: bool) -> tuple[str, float, float]:
    """What a sentence is; without a cue it is none unless it is confirmed.  ``cues``: its text holds some."""
    kind = seen.get(sentence)
    if kind is None:
        cue = cues and CUE.search(sentence)
        kind = (NONE, 1.0, 0.0)
        if cue or hinted(sentence) and resembling(sentence):
            kind = classify(sentence, model)
            if kind[0] == UNKNOWN and not cue:
                kind = (NONE, 1.0, 0.0)
        if len(seen) < 50_000:
            seen[sentence] = kind
    return kind


def _wrapped(sentence: str, start: int, model: Model, seen: dict, cues: bool) -> list[tuple]:
    """Confirmed notices over two or more lines of a sentence, those that hold most first, none overlapping."""
    lines, at = [], start
    for line in sentence.split("\n"):
        if line.strip():
            skip = len(line) - len(line.lstrip())
            lines.append((at + skip, at + len(line.rstrip()), max(1, len(words_of(line)))))
        at += len(line) + 1
    found = []
    for i in range(len(lines)):
        words = lines[i][2]
        for j in range(i + 1, len(lines)):
            words += lines[j][2]
            # Two lines are always tried, however long.
            if words > WRAPPED and j > i + 1:
                break
            begin, end = lines[i][0], lines[j][1]
            kind = _judged(sentence[begin - start:end - start], model, seen, cues)
            if kind[0] not in (NONE, UNKNOWN):
                found.append((begin, end, *kind))
    kept: list[tuple] = []
    for n in sorted(found, key=lambda n: (-held(sentence[n[0] - start:n[1] - start], n[2]), n[1] - n[0], n[0])):
        if all(n[1] <= k[0] or k[1] <= n[0] for k in kept):
            kept.append(n)
    return kept


def notices_in(text: str | None, model: Model, seen: dict) -> list[tuple]:
    """(start, end, family, probability, resemblance) per notice, in code points."""
    cues = bool(text and CUE.search(text))
    if not text or not (cues or hinted(text)):
        return []
    found, start = [], 0
    for paragraph in text.split("\n"):
        if hinted(paragraph) or cues and CUE.search(paragraph):
            # The sentence is judged, so a notice inside a longer line counts.
            at = 0
            for sentence in SENTENCE.split(paragraph):
                kind = _judged(sentence, model, seen, cues)
                if kind[0] != NONE:
                    skip = len(sentence) - len(sentence.lstrip())
                    found.append((start + at + skip, start + at + len(sentence.rstrip()), *kind))
                at += len(sentence)
        start += len(paragraph) + 1
    # Sentences that go on over a line's end, up to a blank line.
    start = 0
    for block in re.split(r"(\n[^\S\n]*(?=\n))", text):
        if "\n" in block.strip() and hinted(block):
            at = start
            for sentence in SENTENCE.split(block):
                if "\n" in sentence.strip() and hinted(sentence) and resembling(sentence):
                    for n in _wrapped(sentence, at, model, seen, cues):
                        # A notice over several lines stands for what its lines alone were taken for.
                        beside = [f for f in found if f[0] < n[1] and n[0] < f[1]]
                        if all(held(text[f[0]:f[1]], f[2]) < held(text[n[0]:n[1]], n[2]) for f in beside):
                            found = [f for f in found if f not in beside] + [n]
                at += len(sentence)
        start += len(block)
    return sorted(found)


def _found(model: Model):
    def run(batches):
        seen: dict = {}
        for batch in batches:
            told = [
                [dict(zip(("start", "end", "family", "probability", "resemblance"), n))
                 for n in notices_in(text.as_py(), model, seen)]
                for text in batch.column("text")
            ]
            kind = pa.list_(pa.struct([
                ("start", pa.int64()), ("end", pa.int64()), ("family", pa.string()),
                ("probability", pa.float64()), ("resemblance", pa.float64()),
            ]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(told, kind)], names=["doc_id", "notices"]
            )

    return run


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, notices) per row of ``docs``."""
    model = model or learn(docs)
    return docs.select("doc_id", "text").mapInArrow(_found(model), FOUND)


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_notices, licences, spans): families sorted and comma-joined, spans as text."""
    families = F.array_sort(F.array_distinct(F.transform("notices", lambda n: n["family"])))
    spans = F.transform("notices", lambda n: F.concat_ws(":", n["family"], n["start"], n["end"]))
    return scan(docs).select(
        "doc_id", F.size("notices").cast("long").alias("n_notices"),
        F.array_join(families, ",").alias("licences"), F.array_join(spans, ",").alias("spans"),
        F.round(F.array_min(F.transform("notices", lambda n: n["probability"])), 4).alias("least_probability"),
    )
