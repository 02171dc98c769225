"""License scans: winnowed fingerprints find candidates in an inverted index, banded alignment reports coverage and spans."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Wording of common public licenses and notices, by SPDX-like name.
_BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution. ")
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission. ")
_BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_GNU_HEADER = (
    "{what} is free software: you can redistribute it and/or modify it under the terms of the {license} as published by the Free Software "
    "Foundation, either version {version} of the License, or (at your option) any later version. {what} is distributed in the hope that it "
    "will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See "
    "the {license} for more details.")
_CC_LINE = "This work is licensed under a Creative Commons {kind} International License."
_CC_KINDS = {
    "CC-BY-4.0": "Attribution 4.0", "CC-BY-SA-4.0": "Attribution-ShareAlike 4.0", "CC-BY-NC-4.0": "Attribution-NonCommercial 4.0",
    "CC-BY-ND-4.0": "Attribution-NoDerivatives 4.0", "CC-BY-NC-SA-4.0": "Attribution-NonCommercial-ShareAlike 4.0",
    "CC-BY-NC-ND-4.0": "Attribution-NonCommercial-NoDerivatives 4.0",
}
_GNU = {
    "GPL-2.0": ("GNU General Public License", "2"), "GPL-3.0": ("GNU General Public License", "3"),
    "LGPL-2.1": ("GNU Lesser General Public License", "2.1"), "LGPL-3.0": ("GNU Lesser General Public License", "3"),
    "AGPL-3.0": ("GNU Affero General Public License", "3"),
}
_SPDX = (
    "0BSD", "AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0",
    "EPL-2.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MIT-0", "MPL-2.0", "Unlicense", "Zlib",
)
TEMPLATES = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "MIT-line": "Released under the MIT License.",
    "BSD-line": "Released under the BSD License.",
    "ISC-line": "Released under the ISC License.",
    **{f"{name}-line": f"This work is licensed under the {text}, version {version}." for name, (text, version) in _GNU.items()},
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    **{f"{name}-short": f"Licensed under {name.removesuffix('-4.0').replace('-', ' ', 1)} 4.0." for name in _CC_KINDS if name != "CC-BY-NC-4.0"},
    **{f"{name}-{'sentence' if name == 'CC-BY-NC-4.0' else 'line'}": _CC_LINE.format(kind=kind) for name, kind in _CC_KINDS.items()},
    "CC0-1.0-line": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0."),
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING '
        "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR "
        "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    **{f"{name}-header": _GNU_HEADER.format(what="This program" if name != "LGPL-2.1" else "This library", license=text, version=version)
       for name, (text, version) in _GNU.items()},
    "BSD-2-Clause": _BSD_CONDITIONS + _BSD_DISCLAIMER,
    "BSD-3-Clause": _BSD_CONDITIONS + _BSD_THIRD + _BSD_DISCLAIMER,
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
        "this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, "
        "or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and "
        "by any means."),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
        "damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including "
        "commercial applications, and to alter it and redistribute it freely."),
    "BSL-1.0-line": "Distributed under the Boost Software License, Version 1.0.",
    "EPL-2.0-header": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available "
        "at http://www.eclipse.org/legal/epl-2.0."),
    **{f"{name}-spdx": f"SPDX-License-Identifier: {name}" for name in _SPDX},
}
#: Runs of words that tell a license from its kin: a match needs each of them without a gap.
TELLING = {
    "Apache-2.0-line": ("apache license", "2 0"), "Apache-2.0-header": ("apache license version 2 0",), "MIT-line": ("mit license",),
    "BSD-line": ("bsd license",), "ISC-line": ("isc license",), "MIT": ("sublicense", "dealings in the software"),
    "ISC": ("with or without fee",), "BSD-2-Clause": ("redistributions in binary form",), "BSD-3-Clause": ("endorse or promote",),
    "MPL-2.0-header": ("mozilla public license v 2 0",), "Unlicense": ("free and unencumbered",), "Zlib": ("alter it and redistribute it freely",),
    "BSL-1.0-line": ("boost software license version 1 0",), "EPL-2.0-header": ("eclipse public license 2 0",), "CC0-1.0-line": ("cc0 1 0",),
    **{f"{name}-line": (text.lower() + " version " + version.replace(".", " "),) for name, (text, version) in _GNU.items()},
    **{f"{name}-header": (f"terms of the {text.lower()} as published", f"either version {version.replace('.', ' ')} of") for name, (text, version) in _GNU.items()},
    **{f"{name}-{'sentence' if name == 'CC-BY-NC-4.0' else 'line'}": ("creative commons " + kind.lower().replace("-", " ").replace(".", " "),) for name, kind in _CC_KINDS.items()},
    **{f"{name}-{'line' if name == 'CC-BY-NC-4.0' else 'short'}": (name.lower().replace("-", " ").replace(".", " "),) for name in _CC_KINDS},
    **{f"{name}-spdx": ("license identifier " + name.lower().replace("-", " ").replace(".", " "),) for name in _SPDX},
}
#: Words of a fingerprint, fingerprints of a winnowing window: what shares GRAM + WINNOW - 1 words is a candidate.
GRAM, WINNOW = 2, 2
BAND = 8
COVERAGE = 0.8
_WORD = re.compile(r"[^\W_]+")
_BIG = np.iinfo(np.int64).max


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower()) if text.isascii() else [w.lower() for w in _WORD.findall(text)]


def _winnow(grams: np.ndarray) -> np.ndarray:
    """Places of the smallest fingerprint of each window, the last one of equal ones."""
    if len(grams) < WINNOW:
        return np.arange(len(grams))
    windows = np.lib.stride_tricks.sliding_window_view(grams, WINNOW)
    return np.unique(np.arange(len(windows)) + WINNOW - 1 - windows[:, ::-1].argmin(axis=1))


class Index:
    """Inverted index of template fingerprints. Words that no template has cannot be part of a shared fingerprint."""

    def __init__(self, templates: dict[str, str], telling: dict[str, tuple[str, ...]] | None = None):
        self.names = list(templates)
        self.words = [words(t) for t in templates.values()]
        self.telling = [self._places(own, (telling or {}).get(name, ())) for name, own in zip(self.names, self.words)]
        vocabulary = sorted({w for t in self.words for w in t})
        # The rarest words of the templates get the smallest numbers, so that winnowing selects telling fingerprints.
        often = {w: sum(t.count(w) for t in self.words) for w in vocabulary}
        self.number = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (often[w], w)))}
        postings = defaultdict(list)
        for t, own in enumerate(self.words):
            grams = self.grams(np.array([self.number[w] for w in own], np.int64))
            for place in _winnow(grams):
                postings[int(grams[place])].append((t, int(place)))
        self.postings = dict(postings)
        self.keys = np.array(sorted(postings), np.int64)

    @staticmethod
    def _places(own: list[str], runs: tuple[str, ...]) -> list[range]:
        """Where the telling runs are in a template: the first place of each."""
        out = []
        for run in runs:
            parts = run.split()
            at = next((i for i in range(len(own) - len(parts) + 1) if own[i:i + len(parts)] == parts), None)
            if at is None:
                raise ValueError(f"{run!r} is not in the template")
            out.append(range(at, at + len(parts)))
        return out

    def tells(self, template: int, pairs: list[tuple[int, int]]) -> bool:
        """Whether every telling run of the template is matched word after word."""
        met = dict(pairs)
        return all(run[0] in met and all(met.get(i) == met[run[0]] + i - run[0] for i in run) for run in self.telling[template])

    def grams(self, numbers: np.ndarray) -> np.ndarray:
        n = max(0, len(numbers) - GRAM + 1)
        out, known = np.zeros(n, np.int64), np.ones(n, bool)
        for k in range(GRAM):
            out = out * len(self.number) + numbers[k:k + n]
            known &= numbers[k:k + n] >= 0
        return np.where(known, out, _BIG)

    def candidates(self, found: list[str], coverage: float) -> dict[int, list[int]]:
        """For each template the places in the text at which it seems to start.

        A part of GRAM + WINNOW - 1 words without a gap has a fingerprint in common. If a share ``coverage`` of n words
        is there, the other words make at most that many gaps plus one parts, and so there are at least
        (coverage - 2 (1 - coverage)) n / 2 - 1 different fingerprints; places with fewer are no candidates.
        """
        get = self.number.get
        numbers = np.array([get(w, -1) for w in found], np.int64)
        if len(numbers) < GRAM or (numbers >= 0).sum() < GRAM:
            return {}
        grams = self.grams(numbers)
        places = _winnow(grams)
        places = places[np.isin(grams[places], self.keys)]
        starts = defaultdict(list)
        for place in places.tolist():
            for template, at in self.postings[int(grams[place])]:
                starts[template].append((place - at, at))
        out = {}
        for template, own in starts.items():
            least = max(1, int((3 * coverage - 2) * len(self.words[template]) / 2) - 1)
            merged: list[tuple[int, set[int]]] = []
            for start, at in sorted(own):
                if not merged or start - merged[-1][0] > BAND:
                    merged.append((start, set()))
                merged[-1][1].add(at)
            near = [start for i, (start, seen) in enumerate(merged) if sum(len(s) for _, s in merged[max(0, i - 1):i + 2]) >= least]
            if near:
                out[template] = near
        return out


def align(template: list[str], text: list[str], start: int, band: int) -> list[tuple[int, int]]:
    """Longest common subsequence of the template and the text within ``band`` + ``BAND`` of the diagonal from ``start``:
    pairs of places."""
    reach = band + BAND
    n, width = len(template), 2 * reach + 1
    best = np.zeros((n + 1, width + 1), np.int32)
    for i in range(n - 1, -1, -1):
        row, below = best[i], best[i + 1]
        for b in range(width - 1, -1, -1):
            j = i + start + b - reach
            if 0 <= j < len(text) and text[j] == template[i]:
                row[b] = below[b] + 1
            else:
                row[b] = max(row[b + 1], below[b - 1] if b else 0)
    pairs, i, b = [], 0, 0
    while i < n and b < width and best[i, b]:
        j = i + start + b - reach
        if 0 <= j < len(text) and text[j] == template[i]:
            pairs.append((i, j))
            i += 1
        elif best[i, b + 1] == best[i, b]:
            b += 1
        else:
            i, b = i + 1, b - 1
    return pairs


@lru_cache(maxsize=4)
def _index(templates: tuple[tuple[str, str], ...]) -> Index:
    known = dict(templates)
    return Index(known, {name: runs for name, runs in TELLING.items() if known.get(name) == TEMPLATES[name]})


def scan_text(text: str, index: Index, coverage: float) -> list[tuple[str, int, float, int, int]]:
    """License, matched words, coverage, start and end in characters of the text for every place where a template is."""
    found = words(text)
    out, spans = [], None
    for template, starts in index.candidates(found, coverage).items():
        own = index.words[template]
        end = -1
        for start in starts:
            if start + BAND + len(own) < end:
                continue
            pairs = align(own, found, start, BAND)
            if len(pairs) < coverage * len(own) or pairs[0][1] < end or not index.tells(template, pairs):
                continue
            spans = spans or [m.span() for m in _WORD.finditer(text)]
            end = pairs[-1][1] + 1
            out.append((index.names[template], len(pairs), len(pairs) / len(own), spans[pairs[0][1]][0], spans[pairs[-1][1]][1]))
    return _best(out)


def _best(matches: list[tuple[str, int, float, int, int]]) -> list[tuple[str, int, float, int, int]]:
    """Of matches that overlap the one with the most words, then the best covered, then the first by name."""
    taken: list[tuple[str, int, float, int, int]] = []
    for match in sorted(matches, key=lambda x: (-x[1], -x[2], x[0], x[3])):
        if all(match[4] <= other[3] or other[4] <= match[3] for other in taken):
            taken.append(match)
    return sorted(taken, key=lambda x: (x[3], x[4], x[0]))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """``doc_id``, ``license``, ``n_matched`` (words), ``coverage``, ``start``, ``end`` (characters), one row per match.

    ``docs`` has ``doc_id``, ``text``. A match holds ``coverage`` of a template's words in their order, and the runs of words that
    tell it from its kin (:data:`TELLING`) without a gap: a version, "Lesser", a third clause. Matches do not overlap; of those
    that would, the one with the most words stays. A null or empty text has none; a row that is repeated
    has its matches repeated. The index goes to the tasks: it has the size of ``templates``. Other columns are left behind.
    """
    key = tuple((templates or TEMPLATES).items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(key)
        for batch in batches:
            rows = [(i, *m) for i, t in zip(batch.column(0).to_pylist(), batch.column(1)) for m in scan_text(t.as_py() or "", index, coverage)]
            columns = list(zip(*rows)) or [[]] * 6
            types = (pa.int64(), pa.string(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "license", "n_matched", "coverage", "start", "end"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, license string, n_matched long, coverage double, start long, end long")
