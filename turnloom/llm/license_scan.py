"""Licence texts and notices by Dice coefficient over word bigrams.

Text is normalised: A-Z lower-cased, every ASCII character but letters and digits a separator.
Units of five levels are compared with the templates: sentences, lines, paragraphs, the whole text
and windows. The coefficient is 2 x shared bigrams / (bigrams of both), counting repeats. To reach
the threshold t, a unit of n bigrams needs a template of n t / (2 - t) to n (2 - t) / t bigrams;
other templates are pruned by size, and units with too few bigrams of any template before that.

A window is as long as its template (WINDOW_BIGRAMS or more), starts at a bigram of the template
and may cross paragraphs, so a licence is found with a title before it and code behind it. A
window beyond the end of the text counts in full length. Windows with too few bigrams of the template are
pruned by a count over positions; of neighbouring starts the one that shares most is kept.
A template of fewer than WHOLE_BIGRAMS bigrams has to be there whole.

Licences quote each other, so units compete: the one with the most evidence (score x shared
bigrams) is taken first, and what overlaps it is left out. Reported is the first unit per licence.

Cases: NULL and empty texts match nothing; units of one word have no bigram. Equal evidence gives
the earliest unit, then the finest level, then the licence by name. Repeated rows are reported
each. An empty table gives an empty result. Other columns than the key are left out.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.llm.common import group_starts, mixed, small_batches, text_chunks, text_or_empty
from turnloom.llm.words import LOWER, Words, join_texts

THRESHOLD = 0.8
LEVELS = ("sentence", "line", "paragraph", "text", "window")
WINDOW_BIGRAMS, WHOLE_BIGRAMS = 16, 4
# Bounds that prune leave room for rounding; the coefficient decides.
ROUNDING = 1e-6

# Public licence notices and texts.
_GPL_GRANT = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "{name} Public License as published by the Free Software Foundation, either {version}, or (at your "
    "option) any later version."
)
_BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: 1. Redistributions of source code must retain the "
    "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
    "binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
    "or promote products derived from this software without specific prior written permission."
)
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR "
    "ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
    "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
    "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF "
    "ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR "
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
        "Released under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation, either version 3 of "
        "the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See "
        "the GNU General Public License for more details.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
        "License.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License.",
    ],
    "BSD-3-Clause": [
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE "
        "file.",
        f"{_BSD_START} {_BSD_NAMES} {_BSD_END}",
    ],
    "BSD-2-Clause": [f"{_BSD_START} {_BSD_END}"],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice "
        "appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES "
        "WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN "
        "NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES "
        "OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
        "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
        "modify, publish, use, compile, sell, or distribute this software, either in source code form or "
        "as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the "
        "authors be held liable for any damages arising from the use of this software. Permission is "
        "granted to anyone to use this software for any purpose, including commercial applications, and "
        "to alter it and redistribute it freely, subject to the following restrictions:",
    ],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file "
        "LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)",
    ],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse "
        "Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    ],
    "CC0-1.0": [
        "To the extent possible under law, the author(s) have dedicated all copyright and related and "
        "neighboring rights to this software to the public domain worldwide. This software is "
        "distributed without any warranty.",
    ],
    "GPL-2.0": [
        "Licensed under the GNU General Public License, version 2.",
        _GPL_GRANT.format(name="General", version="version 2 of the License"),
    ],
    "LGPL-2.1": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        _GPL_GRANT.replace("program", "library").format(name="Lesser General", version="version 2.1 of the License"),
    ],
    "LGPL-3.0": [
        "Licensed under the GNU Lesser General Public License, version 3.",
        _GPL_GRANT.format(name="Lesser General", version="version 3 of the License"),
    ],
    "AGPL-3.0": [
        "Licensed under the GNU Affero General Public License, version 3.",
        _GPL_GRANT.format(name="Affero General", version="version 3 of the License"),
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
        "of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/.",
    ],
}

for _name, _texts in TEMPLATES.items():
    _texts.append(f"SPDX-License-Identifier: {_name}")

_WORD = np.ones(256, bool)
_WORD[:128] = False
for _low, _high in ((48, 58), (65, 91), (97, 123)):
    _WORD[_low:_high] = True


def normalised_words(texts: list[bytes]) -> tuple[Words, dict[str, np.ndarray]]:
    """Words of the texts, and for each level the unit that a word is in."""
    data, offset = join_texts(texts)
    inside = np.zeros(len(data) + 1, np.int8)
    inside[1:] = _WORD[data]
    edge = np.diff(inside)
    first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    text = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(first, offset)))
    feeds = np.concatenate([[0], np.cumsum(data == 10)])
    stop = np.isin(data, np.frombuffer(b".!?", np.uint8))
    stop[:-1] &= np.isin(data[1:], np.frombuffer(b" \t\r\n", np.uint8))
    stops = np.concatenate([[0], np.cumsum(stop)])
    lines = feeds[first[1:]] - feeds[end[:-1]]
    other = text[1:] != text[:-1]
    breaks = {
        "sentence": other | (lines > 0) | (stops[first[1:]] > stops[end[:-1]]),
        "line": other | (lines > 0),
        "paragraph": other | (lines > 1),
        "text": other,
    }
    units = {k: np.concatenate([[0], np.cumsum(b)])[: len(first)] for k, b in breaks.items()}
    return Words(LOWER[data], first, end, text, offset), units


def bigrams(hashes: np.ndarray) -> np.ndarray:
    return mixed(mixed(hashes[:-1]) + hashes[1:])


def template_counts(templates: dict[str, list[str]]) -> list[tuple[str, Counter, int]]:
    found = []
    for name, texts in templates.items():
        for text in texts:
            words, _ = normalised_words([text.encode()])
            counts = Counter(bigrams(words.hashes()).tolist())
            if counts:
                found.append((name, counts, sum(counts.values())))
    return found


def _enough(shared: int, size: int, template: int, threshold: float) -> bool:
    whole = template >= WHOLE_BIGRAMS or shared == template
    return whole and 2 * shared >= threshold * (size + template)


def _windows(
    at: np.ndarray, ids: list[int], counts: dict[int, int], size: int, threshold: float
) -> Iterator[tuple[int, int, int]]:
    """Shared bigrams, first and last bigram of the best windows in one text.

    `at` are the places of the template's bigrams `ids`; a window starts at each of them.
    """
    seen: Counter[int] = Counter()
    shared = end = 0
    before = None  # the window at the start before, and whether it may still be kept
    for first, start in enumerate(at.tolist()):
        while end < len(at) and at[end] < start + size:
            seen[ids[end]] += 1
            shared += seen[ids[end]] <= counts[ids[end]]
            end += 1
        if before and before[0] < shared:
            before = None
        elif before and before[3]:
            yield before[:3]
        rising = before is None or before[0] < shared
        if _enough(shared, size, size, threshold):
            before = (shared, start, int(at[end - 1]), rising)
        else:
            before = None
        shared -= seen[ids[first]] <= counts[ids[first]]
        seen[ids[first]] -= 1
    if before and before[3]:
        yield before[:3]


def matches(
    texts: list[bytes], templates: list[tuple[str, Counter, int]], threshold: float
) -> Iterator[tuple[int, str, float, str, int, int]]:
    """Per text and licence the first unit taken: text, licence, score, level, first byte, end byte."""
    words, units = normalised_words(texts)
    if len(words.first) < 2 or not templates:
        return
    pairs = bigrams(words.hashes())
    known = np.unique(np.array([b for _, c, _ in templates for b in c], np.uint64))
    number = np.minimum(np.searchsorted(known, pairs), len(known) - 1)
    hit = known[number] == pairs
    found: dict[int, list[tuple]] = defaultdict(list)

    def add(text: int, first: int, last: int, rank: int, name: str, score: float, shared: int) -> None:
        begin, end = int(words.first[first] - words.offset[text]), int(words.end[last] - words.offset[text])
        found[text].append((-score * shared, begin, rank, name, end, score))

    shortest = min(m for _, _, m in templates)
    for rank, level in enumerate(LEVELS[:-1]):
        unit = units[level]
        starts = group_starts(unit)
        ends = np.append(starts[1:], len(unit))
        hits = np.concatenate([[0], np.cumsum(hit)])
        size = ends - starts - 1
        shared = hits[ends - 1] - hits[starts]
        # 2 shared / (size + template) >= t and shared <= template
        likely = (size * (2 - threshold) >= threshold * shortest - ROUNDING) & (
            shared * (2 - threshold) >= threshold * size - ROUNDING
        )
        for i in np.flatnonzero((size > 0) & likely):
            own = Counter(pairs[starts[i] : ends[i] - 1].tolist())
            n = int(size[i])
            for name, counts, m in templates:
                if threshold * max(n, m) > (2 - threshold) * min(n, m) + ROUNDING:
                    continue
                both = sum((own & counts).values())
                if _enough(both, n, m, threshold):
                    add(int(words.text[starts[i]]), starts[i], ends[i] - 1, rank, name, 2 * both / (n + m), both)

    places = np.flatnonzero(hit & (words.text[1:] == words.text[:-1]))
    numbers, owner = number[places], words.text[places]
    limit = np.searchsorted(owner, owner, "right")
    for name, counts, m in templates:
        if m < WINDOW_BIGRAMS or not len(places):
            continue
        wanted = np.isin(known, np.array(list(counts), np.uint64))[numbers]
        some = np.flatnonzero(wanted)
        at, text = places[some], owner[some]
        last = np.minimum(np.searchsorted(at, at + m), np.searchsorted(some, limit[some]))
        dense = last - np.arange(len(at)) >= threshold * m - ROUNDING
        by_number = {int(np.searchsorted(known, np.uint64(b))): c for b, c in counts.items()}
        for one in np.unique(text[dense]):
            first, end = np.searchsorted(text, [one, one + 1])
            ids = numbers[some[first:end]].tolist()
            for both, a, b in _windows(at[first:end], ids, by_number, m, threshold):
                add(int(one), a, b + 1, len(LEVELS) - 1, name, both / m, both)

    for text in sorted(found):
        taken: list[tuple[int, int]] = []
        best: dict[str, tuple] = {}
        for _, begin, rank, name, end, score in sorted(found[text]):
            i = bisect_left(taken, (begin, begin))
            if (i and taken[i - 1][1] > begin) or (i < len(taken) and taken[i][0] < end):
                continue
            taken.insert(i, (begin, end))
            best.setdefault(name, (score, LEVELS[rank], begin, end))
        for name in sorted(best):
            yield text, name, *best[name]


def scan_licenses(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    templates: dict[str, list[str]] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """key, license, score, level, start, end (bytes): the first unit taken per document and licence."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    small_batches(docs.sparkSession)
    counted = template_counts(TEMPLATES if templates is None else templates)
    names = [key, "license", "score", "level", "start", "end"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, "_text"):
            found = list(matches(texts, counted, threshold))
            columns = list(zip(*found)) or [[]] * 6
            types = [pa.int64(), pa.string(), pa.float64(), pa.string(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            arrays[0] = batch.column(0).take(arrays[0])
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = (
        f"`{key}` {docs.schema[key].dataType.simpleString()}, "
        "license string, score double, level string, start bigint, end bigint"
    )
    return docs.select(F.col(key), text_or_empty(text).alias("_text")).mapInArrow(scan, schema)
