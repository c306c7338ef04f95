"""Licence scan: passages of a text against licence templates by the Dice coefficient over word bigrams.

Text and templates are normalised alike: words of letters and digits in lower case, all
else separates. A passage matches a template if twice the shared bigrams (as bags) over
all bigrams of both is at least ``least``. Then a passage has between least / (2 - least)
and (2 - least) / least times the bigrams of the template; these size bounds prune the
templates and the passages that are compared. Passages begin and end with a
bigram of the template, as others can only lower the coefficient.

Every text is read whole. Null and empty texts match nothing, a template of one word is not
used. Of overlapping passages of one template the one of the highest coefficient stays; between templates
the one with the most shared bigrams, less half of those that only one side has, so that a text
goes to the larger of two templates that begin alike if it holds more than half of the rest.
Rows with null or repeated ids are reported with their id as it is.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm import common as K

LEAST = 0.8
WORD = re.compile(rb"[a-z0-9]+")
FILTER_BITS = 1 << 20

WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD_TERMS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and
the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
the following disclaimer in the documentation and/or other materials provided with the distribution."""

# Public licence texts and notices, by SPDX name.
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
        License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law
        or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
        limitations under the License.""",
    ],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License.", BSD_TERMS],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.",
        BSD_TERMS
        + """ 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
        derived from this software without specific prior written permission.""",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.""",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
    ],
    "ISC": [
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies."""
    ],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "MIT": [
        "Released under the MIT License.",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
        files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
        modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
        is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be
        included in all copies or substantial portions of the Software. """
        + WARRANTY,
    ],
    "MPL-2.0": [
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
        with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}


def normalised(raw: bytes | None) -> list[bytes]:
    return WORD.findall(raw.translate(K.LOWER)) if raw else []


def bigram_hashes(words: list[bytes], cache: K.WordHashes) -> np.ndarray:
    """A hash per pair of neighbouring words; none for fewer than two."""
    return K.window_hashes(K.hash_words(words, cache), 2) if len(words) > 1 else np.zeros(0, np.uint64)


@dataclass
class Template:
    license: str
    bag: Counter
    size: int

    def bounds(self, least: float) -> tuple[int, int]:
        """Bigrams a passage has at least and at most."""
        return int(np.ceil(self.size * least / (2 - least) - 1e-9)), int(np.floor(self.size * (2 - least) / least + 1e-9))


@dataclass
class Match:
    license: str
    dice: float
    start: int
    end: int
    net: float  # shared bigrams, less half of those that only the passage or the template has


def apart(found: list[list[Match]]) -> list[Match]:
    """Matches that do not overlap, from the matches of each template: the best left of each template, then of these the largest."""
    queues = [sorted(part, key=lambda m: (m.dice, -m.start, -m.end)) for part in found]
    out: list[Match] = []
    taken: list[tuple[int, int]] = []
    while True:
        for queue in queues:
            while queue:
                k = bisect_left(taken, (queue[-1].end, 0))
                if not k or taken[k - 1][1] <= queue[-1].start:
                    break
                queue.pop()
        queues = [queue for queue in queues if queue]
        if not queues:
            return out
        best = min(queues, key=lambda q: (-q[-1].net, -q[-1].dice, q[-1].start, q[-1].end, q[-1].license)).pop()
        out.append(best)
        insort(taken, (best.start, best.end))


class Scanner:
    def __init__(self, templates: dict[str, list[str]], least: float):
        self.least, self.cache = least, K.WordHashes()
        self.templates = []
        self.of: dict[int, list[int]] = {}
        for name in sorted(templates):
            for text in templates[name]:
                bag = Counter(bigram_hashes(normalised(text.encode()), self.cache).tolist())
                if bag:
                    for h in bag:
                        self.of.setdefault(h, []).append(len(self.templates))
                    self.templates.append(Template(name, bag, sum(bag.values())))
        self.filter = np.zeros(FILTER_BITS, bool)
        self.filter[[h % FILTER_BITS for h in self.of]] = True

    def scan(self, raw: bytes | None) -> list[tuple[str, float, int, int]]:
        """(license, dice, start, end) in normalised words, by license and start."""
        h = bigram_hashes(normalised(raw), self.cache)
        hits = np.flatnonzero(self.filter[(h % np.uint64(FILTER_BITS)).astype(np.int64)])
        places: dict[int, list[tuple[int, int]]] = {}
        for p in hits.tolist():
            for t in self.of.get(int(h[p]), ()):
                places.setdefault(t, []).append((p, int(h[p])))
        found: list[list[Match]] = []
        for t, marks in places.items():
            template = self.templates[t]
            low, high = template.bounds(self.least)
            if 2 * len(marks) < self.least * (low + template.size):
                continue
            found.append([])
            for i, (start, _) in enumerate(marks):
                left, shared, best = dict(template.bag), 0, (0.0, 0, 0.0)
                for p, value in marks[i:]:
                    size = p - start + 1
                    if size > high:
                        break
                    if left[value]:
                        left[value] -= 1
                        shared += 1
                        dice = 2 * shared / (size + template.size)
                        if size >= low and dice > best[0]:
                            best = (dice, p + 2, 2 * shared - (size + template.size) / 2)
                if best[0] >= self.least:
                    found[-1].append(Match(template.license, best[0], start, best[1], best[2]))
        return sorted(((m.license, m.dice, m.start, m.end) for m in apart(found)), key=lambda x: (x[0], x[2]))


def scan(docs: DataFrame, templates: dict[str, list[str]] | None = None, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """(id, license, dice, start, end): every passage of a document that matches a licence."""
    held = templates or TEMPLATES

    def make():
        scanner = Scanner(held, least)

        def step(batch: pa.RecordBatch):
            found = []
            for row, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found.extend((row, *m) for m in scanner.scan(raw))
            kinds = [pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], kinds[k]) for k in range(5)], names=["id", "license", "dice", "start", "end"])

        return step

    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return slim.mapInArrow(K.per_batch(make), "id long, license string, dice double, start int, end int")
