"""License scans: winnowed fingerprints find candidates, banded alignment measures them.

Templates and documents are sequences of lower-cased words (runs of ASCII letters and digits and non-ASCII
characters). Every K words in a row have a hash; winnowing keeps the least hash of every W neighbours, so that any
K + W - 1 words in common share a fingerprint. The templates' fingerprints form an inverted index from hash to
(template, position); the templates are a fixed parameter, and so is the size of the index that travels with the
task. Winnowed hashes of a document that are in the index are its hits; for templates of fewer than K + W - 1 words all
hashes are looked up, and for those of fewer than K words the hashes of so many words as they have. Hits of one template that lie on nearby
diagonals and not farther apart than the template is long are one candidate, and its stretch of the document is
aligned with the template by a local alignment (match 1, mismatch and gap -1) within a band around those
diagonals. Matches are reported when they cover ``min_coverage`` of the template; a match whose words lie wholly in a
longer one of the same document goes.

One scan; documents without hits cost only their hashes, and nothing is shuffled.

Result: (doc_id, template, coverage, n_matched, start_token, end_token, start_char, end_char), ends exclusive; tokens
are words, characters are code points of the text.

Defined results: null and empty texts match nothing; a null doc_id is reported as null; repeated rows give repeated
matches; ties between equally good alignments go to the earliest end, then to the shorter path; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import id_text
from .kernels import U, WORD, pieces, sliding_min, span_hashes, tokens, utf8, windows

K = 3
W = 2
BAND = 16
MIN_COVERAGE = 0.7
MIN_MATCHED = 4

#: Notices and license texts in common use.
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved-notice": "All rights reserved.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of '
        "the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is "
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing '
        "permissions and limitations under the License."
    ),
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software "
        "Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT "
        "ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this "
        'permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING "
        "FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: "
        "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product "
        "documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. "
        "3. This notice may not be removed or altered from any source distribution."
    ),
    "bsl-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "
        '"Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is '
        "furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following "
        "disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of "
        "machine-executable object code generated by a source language processor."
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form "
        "or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any "
        "and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors."
    ),
    "mpl-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "lgpl-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 "
        "of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."
    ),
    "agpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of "
        "the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details."
    ),
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc0-1.0-notice": "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this software to the public domain worldwide.",
    "bsd-disclaimer": (
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND '
        "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
        "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
        "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "bsd-3-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of "
        "source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of "
        "the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    ),
}


def words(text: str) -> np.ndarray:
    data = np.frombuffer(text.lower().encode(), np.uint8)
    start, end, _ = tokens(data, np.array([0, len(data)]), WORD)
    return span_hashes(data, start, end)


def winnow(hashed: np.ndarray, row: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of its first word) of the hashes that are least among some w neighbours of their row; of rows with
    fewer than w hashes, the least of all."""
    grams, first = windows(hashed, row, k)
    if not len(grams):
        return grams, first
    owner = row[first]
    keep = np.zeros(len(grams), bool)
    if len(grams) >= w:
        full = owner[: len(grams) - w + 1] == owner[w - 1 :]
        least = sliding_min(grams, w)
        for j in range(w):
            at = np.flatnonzero(full & (grams[j : len(grams) - w + 1 + j] == least)) + j
            keep[at] = True
    edge = np.flatnonzero(np.diff(owner, prepend=-1))
    size = np.diff(np.append(edge, len(owner)))
    for s, n in zip(edge[size < w], size[size < w]):
        keep[s + int(np.argmin(grams[s : s + n]))] = True
    return grams[keep], first[keep]


def index(templates: dict[str, str], k: int = K, w: int = W):
    """Sorted fingerprint hashes with (template number, position), and each template's words."""
    hashes, which, place, texts = [], [], [], []
    for number, text in enumerate(templates.values()):
        own = words(text)
        texts.append(own)
        if not len(own):
            raise ValueError("a template has no words")
        hashed, first = winnow(own, np.zeros(len(own), np.int64), min(k, len(own)), w)
        hashes.append(hashed)
        which.append(np.full(len(hashed), number))
        place.append(first)
    hashed, which, place = (np.concatenate(x) if x else np.zeros(0, U) for x in (hashes, which, place))
    order = np.argsort(hashed, kind="stable")
    return hashed[order], which[order], place[order], texts


def align(doc: np.ndarray, template: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """(matched words, start, end) of the best local alignment with doc position - template position in [low, high]."""
    best, best_at = 0, None
    width = high - low + 1
    before = [(0, 0, -1)] * (width + 1)  # (score, matched, start) by doc position - template position - low
    for i, token in enumerate(template.tolist()):
        now, left = [(0, 0, -1)] * (width + 1), (0, 0, -1)
        for d in range(width):
            j = i + low + d
            if not 0 <= j < len(doc):
                left = (0, 0, -1)
                continue
            score, matched, start = before[d]
            diagonal = (score + 1, matched + 1, start if start >= 0 else j) if doc[j] == token else (score - 1, matched, start)
            up = before[d + 1]
            cell = max(diagonal, (up[0] - 1, up[1], up[2]), (left[0] - 1, left[1], left[2]), key=lambda c: (c[0], c[1]))
            if cell[0] <= 0:
                cell = (0, 0, -1)
            now[d] = left = cell
            if cell[0] > best or (cell[0] == best and best and j + 1 < best_at[1]):
                best, best_at = cell[0], (cell[2], j + 1, cell[1])
        before = now
    return (best_at[2], best_at[0], best_at[1]) if best else (0, 0, 0)


def matches(doc: np.ndarray, hits: list[tuple[int, int, int]], texts: list[np.ndarray], band: int, min_coverage: float, min_matched: int) -> list[tuple[int, int, int, int]]:
    """(template, matched, start, end) of a document, from its hits (template, template position, document position)."""
    found = []
    by: dict[int, list[tuple[int, int]]] = {}
    for t, p, j in hits:
        by.setdefault(t, []).append((j, j - p))
    for t, own in by.items():
        size = len(texts[t])
        own.sort()
        groups: list[list[tuple[int, int]]] = []
        near: list[list[tuple[int, int]]] = []
        for j, d in own:
            near = [g for g in near if j - g[-1][0] <= size]
            for group in reversed(near):
                if abs(d - group[-1][1]) <= band:
                    group.append((j, d))
                    break
            else:
                groups.append([(j, d)])
                near.append(groups[-1])
        for group in groups:
            low, high = min(d for _, d in group) - band, max(d for _, d in group) + band
            rest = [(max(0, low), min(len(doc), max(0, high + size)), group)]
            while rest:  # what lies before and after a match may hold more of them
                begin, stop, left = rest.pop()
                if not left:
                    continue
                # a match that holds the first hit is shorter than two templates
                a, b = max(begin, left[0][0] - 2 * size), min(stop, left[0][0] + 2 * size)
                near_by = [d for j, d in left if a <= j < b] or [left[0][1]]
                matched, start, end = align(doc[a:b], texts[t], min(near_by) - band - a, max(near_by) + band - a)
                if matched >= min(min_matched, size) and matched >= min_coverage * size:
                    found.append((t, matched, a + start, a + end))
                    rest.append((begin, a + start, [x for x in left if x[0] < a + start]))
                    rest.append((a + end, stop, [x for x in left if x[0] >= a + end]))
                elif b < stop:
                    rest.append((begin, stop, left[1:]))
    kept, reach = [], 0
    for m in sorted(set(found), key=lambda m: (m[2], -m[3], -m[1], m[0])):
        if m[3] > reach:  # else it lies in one that starts no later
            kept.append(m)
            reach = m[3]
    return kept


def scan(docs: DataFrame, templates: dict[str, str] | None = None, k: int = K, w: int = W, band: int = BAND, min_coverage: float = MIN_COVERAGE, min_matched: int = MIN_MATCHED) -> DataFrame:
    """The matches as said above. A template without words is an error."""
    templates = TEMPLATES if templates is None else templates
    hashed, which, place, texts = index(templates, k, w)
    names = list(templates)
    short = {n: hashed[np.isin(which, [t for t, x in enumerate(texts) if len(x) < k + w - 1 and min(k, len(x)) == n])] for n in range(1, k + 1)}

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                raw, raw_offsets = utf8(piece.column("text"))
                lowered = pc.utf8_lower(piece.column("text").cast(pa.large_string()))
                data, offsets = utf8(lowered)
                start, end, row = tokens(data, offsets, WORD)
                word = span_hashes(data, start, end)
                grams, first = winnow(word, row, k, w)
                for n in range(1, k + 1):  # winnowing may pass over what is shorter than K + W - 1 words
                    if len(short[n]):
                        every, place_of = windows(word, row, n)
                        extra = np.isin(every, short[n])
                        grams, first = np.concatenate([grams, every[extra]]), np.concatenate([first, place_of[extra]])
                at = np.searchsorted(hashed, grams)
                hit = np.flatnonzero(np.isin(grams, hashed))
                by_row: dict[int, set] = {}
                for g in hit:
                    a = at[g]
                    while a < len(hashed) and hashed[a] == grams[g]:
                        by_row.setdefault(int(row[first[g]]), set()).add((int(which[a]), int(place[a]), int(first[g])))
                        a += 1
                out = {n: [] for n in ("doc_id", "template", "coverage", "n_matched", "start_token", "end_token", "start_char", "end_char")}
                for r, hits in by_row.items():
                    lo, hi = np.searchsorted(row, [r, r + 1])
                    hits = sorted((t, p, j - int(lo)) for t, p, j in hits)
                    found = matches(word[lo:hi], hits, texts, band, min_coverage, min_matched)
                    # lower-casing keeps the number of words, but not always of bytes: characters come from the text itself
                    own = raw[raw_offsets[r] : raw_offsets[r + 1]]
                    b, c, _ = tokens(own, np.array([0, len(own)]), WORD)
                    chars = np.cumsum((own & 0xC0) != 0x80)
                    for t, matched, s, e in found:
                        values = (piece.column("doc_id")[r].as_py(), names[t], matched / len(texts[t]), matched, s, e, int(chars[b[s]]) - 1, int(chars[c[e - 1] - 1]))
                        for n, v in zip(out, values):
                            out[n].append(v)
                yield pa.RecordBatch.from_pydict({n: pa.array(v, t) for (n, v), t in zip(out.items(), (pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32()))})

    return id_text(docs).mapInArrow(search, "doc_id long, template string, coverage double, n_matched int, start_token int, end_token int, start_char int, end_char int")
