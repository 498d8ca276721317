"""Operator 3: licence notices by winnowed fingerprints and banded alignment.

Templates and texts become lower-case alphanumeric words. The templates' hashes of up to
three neighbouring words are winnowed (the smallest of some in a row is kept) into an inverted index, and
every such hash of a text is looked up there. For each template run length and window are such that they
fit the run of words that is left when as many words are changed as the coverage allows, so that it hits.

A hit tells where its template would begin. The hits of a template within its own length of that place make a
candidate; its band is as wide as their beginnings differ (and some words more), so that words put into
a notice, up to as many as it has, stay inside. Candidates whose words can't suffice are dropped by a count; the
others are aligned word by word inside the band (local alignment: match 2, mismatch or gap -1) and reported
if enough of the template matches. Then the words before and after are searched again, so that no word serves
one template twice.

The index holds templates only, a parameter whose size does not depend on the corpus, and travels
with the task. Texts are read once, block by block, and nothing is shuffled.

Defined results. Null or empty text: no rows. Null doc_id: like any. Very long texts: read whole, a text at a time.
A notice found twice: two rows, which don't overlap. A notice that contains another template: a row for each, but
of sibling licences (versions, kinds of one family) on one span only the best covered; of equals the longer
match, then the template listed first. Of equal alignments the leftmost. Repeated rows: equal rows. Empty table: no
rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import TextBlock, mix, prepare, sliding_min, text_blocks, word_hashes

# Public licence notices.
_GNU = (
    "{lead}; you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation; "
    "either version {version} of the License, or (at your option) any later version. "
)
_GNU_WARRANTY = (
    "This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details. "
    "You should have received a copy of the GNU {name} along with this {what}."
)
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal "
    "in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
)
_MIT_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_CONDITIONS = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
_BSD_2 = (
    ": 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution. "
)
_BSD_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission. "
)
_BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE "
    "FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
    "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_GPL, _LESSER, _AFFERO = "General Public License", "Lesser General Public License", "Affero General Public License"
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-permission": f"{_MIT_GRANT}.",
    "MIT-whole": f"{_MIT_GRANT}, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. {_MIT_WARRANTY}",
    **{
        f"{short}-{v}-{part}": text.format(name=name, version=v.removesuffix(".0"), what=what, lead=f"This {what} is free software")
        for short, name, what, vs in (("GPL", _GPL, "program", ("2.0", "3.0")), ("LGPL", _LESSER, "library", ("2.1", "3.0")), ("AGPL", _AFFERO, "program", ("3.0",)))
        for v in vs
        for part, text in (("header", _GNU + _GNU_WARRANTY), ("grant", _GNU))
    },
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "EPL-1.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright "
        "notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
        "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING "
        "OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "BSD-conditions": f"{_BSD_CONDITIONS}.",
    "BSD-2-Clause": _BSD_CONDITIONS + _BSD_2 + _BSD_WARRANTY,
    "BSD-3-Clause": _BSD_CONDITIONS + _BSD_2 + _BSD_3 + _BSD_WARRANTY,
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, "
        "either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    **{f"{short}-{v}": f"This work is licensed under the GNU {name}, version {v.removesuffix('.0')}." for short, name, vs in (("GPL", _GPL, ("2.0", "3.0")), ("LGPL", _LESSER, ("2.1", "3.0")), ("AGPL", _AFFERO, ("3.0",))) for v in vs},
    **{f"CC-{x}-{v}": f"Licensed under CC {x} {v}." for x in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND") for v in ("3.0", "4.0")},
    "All-rights-reserved": "All rights reserved.",
}
#: Templates that may be taken for one another: of those on one span only the best covered is reported.
SIBLINGS = [
    {n for n in TEMPLATES if "GPL-" in n and n.endswith("-header")},
    {n for n in TEMPLATES if "GPL-" in n and n.endswith("-grant")},
    {n for n in TEMPLATES if "GPL-" in n and n.endswith((".0", ".1"))},
    {n for n in TEMPLATES if n.startswith("CC-")},
    {"BSD-2-Clause", "BSD-3-Clause"},
    {"EPL-1.0", "EPL-2.0"},
]
GRAM, WINNOW, COVERAGE = 3, 3, 0.8
_STEPS = mix(np.arange(11, 11 + GRAM, dtype=np.uint64)) | np.uint64(1)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def folded_words(block: TextBlock) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, byte start and byte end of each word of letters and digits, and where each row's words begin."""
    inside = np.zeros(len(block.data) + 2, dtype=bool)
    inside[1:-1] = _WORD[block.data]
    cut = np.zeros(len(block.data) + 1, dtype=bool)
    cut[block.offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
    return word_hashes(TextBlock(_FOLD[block.data], block.offsets, 0), starts, ends), starts, ends, np.searchsorted(starts, block.offsets)


def runs(words: np.ndarray, first: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``gram`` words inside rows, and the word each begins at."""
    n = len(words) - gram + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    grams = np.zeros(n, dtype=np.uint64)
    for j in range(gram):
        grams += words[j : j + n] * _STEPS[j]
    at = np.flatnonzero(np.arange(n) + gram <= np.repeat(first[1:], np.diff(first))[:n])
    return mix(grams[at]), at


def winnowed(grams: np.ndarray, window: int) -> np.ndarray:
    """Places of the runs that are the least of some ``window`` neighbours; all of them if there are fewer."""
    if len(grams) <= window:
        return np.arange(len(grams))
    least = sliding_min(grams, window)
    kept = np.zeros(len(grams), dtype=bool)
    for k in range(window):
        kept[k : k + len(least)] |= grams[k : k + len(least)] == least
    return np.flatnonzero(kept)


def sure_run(m: int, coverage: float) -> int:
    """Length of the longest unchanged run that is left at least of ``m`` words when ``coverage`` of them still match."""
    matched = max(1, math.ceil(coverage * m - 1e-9))
    return -(-matched // (m - matched + 1))


class GramTable:
    """Hashes of the templates' runs of one length: template and place of each."""

    def __init__(self, hashes: np.ndarray, owner: np.ndarray, place: np.ndarray):
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owner, self.place = hashes[order], owner[order], place[order]
        self.seen = np.zeros(1 << 16, dtype=bool)
        self.seen[(self.hashes >> np.uint64(48)).astype(np.int64)] = True

    def hits(self, grams: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word, template and place in it of each hit."""
        near = np.flatnonzero(self.seen[(grams >> np.uint64(48)).astype(np.int64)])
        lo, hi = np.searchsorted(self.hashes, grams[near]), np.searchsorted(self.hashes, grams[near], "right")
        size = hi - lo
        entry = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())
        return np.repeat(at[near], size), self.owner[entry], self.place[entry]


class TemplateIndex:
    def __init__(self, templates: dict[str, str], coverage: float):
        self.names = list(templates)
        self.family = [next((i for i, names in enumerate(SIBLINGS) if n in names), -1) for n in self.names]
        self.words, found = [], {}
        for t, text in enumerate(templates.values()):
            raw = np.frombuffer(text.encode(), np.uint8)
            words, *_ = folded_words(TextBlock(raw, np.array([0, len(raw)]), 0))
            self.words.append(words.tolist())
            sure = sure_run(len(words), coverage)
            gram = min(GRAM, sure)
            grams, _ = runs(words, np.array([0, len(words)]), gram)
            at = winnowed(grams, min(WINNOW, sure - gram + 1))
            found.setdefault(gram, []).append((grams[at], np.full(len(at), t), at))
        self.tables = {gram: GramTable(*map(np.concatenate, zip(*parts, strict=True))) for gram, parts in found.items()}

        self.sets = [set(w) for w in self.words]

    def margin(self, t: int) -> int:
        """Words by which an alignment may leave the beginnings that hits tell."""
        return min(16, max(2, len(self.words[t]) // 4))


def align(template: list[int], words: list[int], low: int, width: int) -> tuple[int, int, int]:
    """Matched words, and first and last place in ``words``, of the best local alignment; template word i meets places i + low to i + low + width - 1."""
    above = [(0, 0, -1)] * (width + 1)  # score, matches, first place; a column more on the right
    best = (0, 0, -1, -1)
    for i, own in enumerate(template):
        row, left = [], (0, 0, -1)
        for j in range(width):
            at = i + j + low
            if not 0 <= at < len(words):
                row.append((0, 0, -1))
                left = (0, 0, -1)
                continue
            # One template word on, a place stays in the same column when the text moves on too.
            s, n, f = above[j]
            if words[at] == own:
                cell = (s + 2, n + 1, f if f >= 0 else at)
                if (cell[0], cell[1]) > best[:2]:
                    best = (cell[0], cell[1], cell[2], at)
            else:
                cell = (s - 1, n, f)
            up, back = above[j + 1], left
            cell = max(cell, (up[0] - 1, up[1], up[2]), (back[0] - 1, back[1], back[2]), key=lambda c: (c[0], c[1]))
            left = cell if cell[0] > 0 else (0, 0, -1)
            row.append(left)
        row.append((0, 0, -1))
        above = row
    return best[1], best[2], best[3]


def notices(index: TemplateIndex, t: int, hits: list[tuple[int, int]], words: list[int], lo: int, hi: int, coverage: float) -> list[tuple[int, int, int]]:
    """Matched words, first and last word of each notice of template ``t`` in words[lo:hi]; hits are (word, beginning), sorted."""
    template, margin, m = index.words[t], index.margin(t), len(index.words[t])
    need, found, failed = coverage * m - 1e-9, [], None
    start = i = 0
    while i < len(hits):
        guess = hits[i][1]
        i += 1
        if failed is not None and abs(guess - failed) <= margin // 2:
            continue
        if lo <= guess and guess + m <= hi and words[guess : guess + m] == template:
            n, f, e = m, guess, guess + m - 1
        else:
            begin, end = max(lo, guess - m), min(hi, guess + 2 * m)
            piece = words[begin:end]
            there = set(piece) & index.sets[t]
            n = min(sum(w in there for w in template), sum(w in there for w in piece))
            if n >= need:
                near = hits[max(start, bisect_left(hits, (begin,))) : bisect_left(hits, (end,))]
                guesses = [g for _, g in near if abs(g - guess) <= m]
                low = min(guesses) - margin
                n, f, e = align(template, piece, low - begin, max(guesses) + margin - low + 1)
                f, e = f + begin, e + begin
            if n < need:
                failed = guess
                continue
        found += notices(index, t, hits[start : bisect_left(hits, (f,))], words, lo, f, coverage)
        found.append((n, f, e))
        lo, failed = e + 1, None
        start = i = bisect_left(hits, (lo,))
    return found


def best_siblings(found: list[tuple[int, int, int, int, int]], index: TemplateIndex) -> list[tuple[int, int, int, int, int]]:
    """(row, template, matched words, first and last word) without those overlapping a sibling that is covered better; of equals the longer match, then the first template stays."""
    kept: list[tuple[int, int, int, int, int]] = []
    spans: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    for x in sorted(found, key=lambda x: (-x[2] / len(index.words[x[1]]), -x[2], x[1], x[3])):
        d, own, _, f, e = x
        family = index.family[own]
        rivals = spans.setdefault((d, family), [])
        if family < 0 or not any(t != own and a <= e and f <= b for t, a, b in rivals):
            rivals.append((own, f, e))
            kept.append(x)
    return sorted(kept)


def _scan(batches: Iterator[pa.RecordBatch], index: TemplateIndex, coverage: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, name, start, end, matched, share = [], [], [], [], [], []
        for block in text_blocks(batch.column(1)):
            words, starts, ends, first = folded_words(block)
            place, t, inside = map(np.concatenate, zip(*(table.hits(*runs(words, first, gram)) for gram, table in index.tables.items()), strict=True))
            if not len(place):
                continue
            doc = np.searchsorted(first, place, "right") - 1
            order = np.lexsort((inside, place, t, doc))
            doc, t, place, guess = doc[order], t[order], place[order], (place - inside)[order]
            cuts = np.flatnonzero((np.diff(doc) != 0) | (np.diff(t) != 0)) + 1
            found, last, text = [], -1, []
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(doc)], strict=True):
                d, own, base = int(doc[a]), int(t[a]), int(first[doc[a]])
                if d != last:
                    last, text = d, words[base : first[d + 1]].tolist()
                hits = list(zip((place[a:b] - base).tolist(), (guess[a:b] - base).tolist(), strict=True))
                found += [(d, own, n, base + f, base + e) for n, f, e in notices(index, own, hits, text, 0, len(text), coverage)]
            for d, own, n, f, e in best_siblings(found, index):
                base = block.offsets[d]
                points = block.data[base : ends[e]] & 0xC0 != 0x80
                row.append(block.first + d)
                name.append(index.names[own])
                start.append(int(points[: starts[f] - base].sum()))
                end.append(int(points.sum()))
                matched.append(n)
                share.append(n / len(index.words[own]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(row, pa.int64())), pa.array(name, pa.string()), *(pa.array(x, pa.int64()) for x in (start, end, matched)), pa.array(share, pa.float64())],
            names=["doc_id", "license", "start", "end", "matched_words", "coverage"],
        )


def find_licenses(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, license, start, end (code points), matched_words, coverage of each notice found."""
    prepare(docs.sparkSession)
    index = TemplateIndex(TEMPLATES if templates is None else templates, coverage)
    return docs.select("doc_id", "text").mapInArrow(partial(_scan, index=index, coverage=coverage), "doc_id long, license string, start long, end long, matched_words long, coverage double")
