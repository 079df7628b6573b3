"""License scans by patience alignment.

A license text is looked for where enough of its words lie close together. There the window and
the template are aligned: words that are unique in both anchor the alignment, their longest
increasing subsequence is kept, and the gaps between anchors are aligned in the same way; a gap
without anchors matches what its two sides have in common at both ends. Coverage is the share of
the template's words that are matched. What tells a license from its neighbours (name, version,
variant) has to be matched besides, word after word.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetfold.llm.words import chunks, digests_of, words_of

#: Least share of a template's words that a text must hold.
COVERAGE = 0.8
#: Words from which a template is long: its places are then tried in strides, not word by word.
LONG = 200
#: Words that a license may stretch over, against the template's own.
STRETCH = 1.4

#: Notices and grants that licenses ask to be placed in works under them.
TEMPLATES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES "
        "OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."),
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This "
        "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        "shall be included in all copies or substantial portions of the Software."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

#: Whole licenses: name and "-body" → text.
BODIES: dict[str, str] = {f"{f.stem}-body": f.read_text() for f in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}

#: Phrases that a place has to hold without a word between, besides the coverage.
PHRASES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": ("Apache License, Version 2.0",),
    "Apache-2.0-notice": ("Apache License, Version 2.0",),
    "BSD-3-Clause": ("BSD-style license",),
    "CC-BY-4.0": ("Creative Commons Attribution 4.0",),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0",),
    "CC-BY-SA-4.0": ("Creative Commons Attribution-ShareAlike 4.0",),
    "GPL-3.0": ("GNU General Public License", "version 3"),
    "GPL-3.0-notice": ("GNU General Public", "version 3"),
    "MIT": ("MIT License",),
    "MPL-2.0": ("Mozilla Public License, v. 2.0",),
    "Unlicense": ("unencumbered software", "public domain"),
    "Apache-2.0-body": ("Apache License Version 2.0",),
    "Artistic-1.0-Perl-body": ("Artistic License",),
    "BSD-3-Clause-body": ("Neither the name of",),
    "BSD-4-Clause-body": ("advertising materials", "Neither the name of"),
    "CC0-1.0-body": ("CC0 1.0",),
    "GFDL-1.2-body": ("GNU Free Documentation License Version 1.2",),
    "GFDL-1.3-body": ("GNU Free Documentation License Version 1.3",),
    "GPL-1.0-body": ("GNU GENERAL PUBLIC LICENSE Version 1",),
    "GPL-2.0-body": ("GNU GENERAL PUBLIC LICENSE Version 2",),
    "GPL-3.0-body": ("GNU GENERAL PUBLIC LICENSE Version 3",),
    "LGPL-2.0-body": ("GNU LIBRARY GENERAL PUBLIC LICENSE Version 2",),
    "LGPL-2.1-body": ("GNU LESSER GENERAL PUBLIC LICENSE Version 2.1",),
    "LGPL-3.0-body": ("GNU LESSER GENERAL PUBLIC LICENSE Version 3",),
    "MPL-1.1-body": ("MOZILLA PUBLIC LICENSE Version 1.1",),
    "MPL-2.0-body": ("Mozilla Public License Version 2.0",),
}


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Matched positions of two sequences, increasing in both."""
    out: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        i, m, j, n = work.pop()
        while i < m and j < n and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            out.append((m, n))
        if i == m or j == n:
            continue
        in_a, in_b = Counter(a[i:m]), Counter(b[j:n])
        place = {w: q for q, w in enumerate(b[j:n], j) if in_b[w] == 1}
        unique = [(p, place[w]) for p, w in enumerate(a[i:m], i) if in_a[w] == 1 and w in place]
        anchors = _longest_increasing(unique)
        if not anchors:
            continue
        out += anchors
        for (p, q), (r, s) in zip([(i - 1, j - 1), *anchors], [*anchors, (m, n)]):
            if p + 1 < r and q + 1 < s:
                work.append((p + 1, r, q + 1, s))
    return sorted(out)


def _longest_increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of pairs (sorted by the first) whose second parts increase, by piles of patience."""
    tops: list[int] = []
    last: list[int] = []
    back = [-1] * len(pairs)
    for x, (_, q) in enumerate(pairs):
        pile = bisect_left(tops, q)
        if pile == len(tops):
            tops.append(q), last.append(x)
        else:
            tops[pile], last[pile] = q, x
        back[x] = last[pile - 1] if pile else -1
    out, x = [], last[-1] if last else -1
    while x >= 0:
        out.append(pairs[x])
        x = back[x]
    return out[::-1]


def _normal(w):
    """Words' digests without the ASCII punctuation around them; 0 for words of punctuation alone."""
    mark = np.zeros(256, bool)
    mark[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True
    plain = ~mark[w.buffer]
    before = np.concatenate([[0], np.cumsum(plain)])
    where = np.flatnonzero(plain)
    has = before[w.ends] > before[w.starts]
    out = np.zeros(len(w.starts), np.uint64)
    if has.any():
        first, last = where[before[w.starts[has]]], where[before[w.ends[has]] - 1] + 1
        out[has] = digests_of(w.buffer, first, last, lower=True)
    return out


class Templates:
    """License texts as sequences of words' digests."""

    def __init__(self, texts: dict[str, str], phrases: dict[str, tuple[str, ...]] | None = None):
        self.names = sorted(texts)
        self.words = self._words([texts[n] for n in self.names])
        # the places of each phrase in its template, of which one has to be matched
        self.phrases = [[[range(i, i + len(p)) for i in range(len(t)) if t[i:i + len(p)] == p]
                         for p in self._words(list((phrases or {}).get(n, ())))] for n, t in zip(self.names, self.words)]
        self.vocabulary = np.unique(np.array([x for t in self.words for x in t], np.uint64))
        self.counts = np.array([np.bincount(np.searchsorted(self.vocabulary, np.array(t, np.uint64)), minlength=len(self.vocabulary))
                                for t in self.words]).reshape(len(self.words), len(self.vocabulary))

    @staticmethod
    def _words(texts: list[str]) -> list[list[int]]:
        if not texts:
            return []
        w = words_of([t.encode() for t in texts], digests=False)
        words = _normal(w)
        return [[x for x in words[a:b].tolist() if x] for a, b in zip(w.first[:-1], w.first[1:])]

    def scan(self, texts: list[bytes], coverage: float):
        """``(text, name, coverage, start, end)`` with byte offsets, in order of place; where licenses overlap, the one with
        most matched words stays."""
        w = words_of(texts, digests=False)
        words = _normal(w)
        at = np.flatnonzero(words)
        if not len(at) or not len(self.vocabulary):
            return
        found = np.searchsorted(self.vocabulary, words[at]).clip(max=len(self.vocabulary) - 1)
        hit = self.vocabulary[found] == words[at]
        number = np.searchsorted(at, w.first)  # words that are more than punctuation, per text
        for d, (a, b) in enumerate(zip(number[:-1].tolist(), number[1:].tolist())):
            if not hit[a:b].any():
                continue
            hits = np.flatnonzero(hit[a:b])
            # no alignment can match more of a template than the words that the text holds of it
            held = np.bincount(found[a + hits], minlength=len(self.vocabulary))
            most = np.minimum(self.counts, held).sum(axis=1)
            likely = [i for i, t in enumerate(self.words) if most[i] >= coverage * len(t)]
            if not likely:
                continue
            own = words[at[a:b]].tolist()
            some = words[at[a + hits]]
            matches = []
            for i in likely:
                matches += self._matches(self.names[i], self.words[i], self.phrases[i], own, hits, some, coverage)
            taken: list[tuple[int, int]] = []
            for matched, name, share, i, j in sorted(matches, key=lambda m: (-m[0], m[1], m[3])):
                if all(j <= x or y <= i for x, y in taken):
                    taken.append((i, j))
                    yield d, name, share, int(w.starts[at[a + i]] - w.base[d]), int(w.ends[at[a + j - 1]] - w.base[d])

    @staticmethod
    def _matches(name, template, phrases, own, hits, some, coverage):
        """Matches of one template: windows that hold enough of its words, aligned from left to right."""
        need = int(np.ceil(coverage * len(template)))
        wide = int(len(template) * STRETCH) + 2
        mine = hits[np.isin(some, np.array(template, np.uint64))]
        if len(mine) < need:
            return
        within = np.searchsorted(mine, mine + wide) - np.arange(len(mine))
        after = 0
        for x in np.flatnonzero(within >= need).tolist():
            i = int(mine[x])
            if i < after:
                continue
            pairs = patience(own[i:i + wide], template)
            if len(pairs) >= need:
                begin = i + pairs[0][0]  # the window may have opened before the license: once more from its first word
                again = patience(own[begin:begin + wide], template)
                if len(again) >= len(pairs):
                    i, pairs = begin, again
                at = {q: p for p, q in pairs}
                if not all(any(all(at.get(q, -1) == at.get(place[0], -2) + q - place[0] for q in place) for place in places)
                           for places in phrases):
                    after = i + pairs[-1][0] + 1 if len(template) >= LONG else after  # another license's body
                    continue
                first, last = i + pairs[0][0], i + pairs[-1][0] + 1
                yield len(pairs), name, len(pairs) / len(template), first, last
                after = last
            elif len(template) >= LONG:  # a window further by x words holds at most x more of the template
                after = i + max(1, (need - len(pairs)) // 2)


SCHEMA = "doc_id long, license string, coverage double, start long, end long"


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """``doc_id, license, coverage, start, end``: every license found in whole texts, with the share
    of its template's words that the place holds in order, and the place in code points.

    Case of A-Z, white space and punctuation around words do not count. A null or empty text
    holds none; rows that share an id are documents of their own; an empty table gives no rows.
    ``templates`` (name → text) is a bounded list that goes to every task; by default it is
    ``TEMPLATES`` and ``BODIES``, and ``PHRASES`` have to be matched."""
    known = Templates(TEMPLATES | BODIES, PHRASES) if templates is None else Templates(templates)

    def run(batches):
        for batch in batches:
            ids, rows = batch.column("doc_id"), []
            for begin, some in chunks(batch.column("text").to_pylist()):
                for d, name, share, a, b in known.scan(some, coverage):
                    start = len(some[d][:a].decode())
                    rows.append((begin + d, name, share, start, start + len(some[d][a:b].decode())))
            cols = list(zip(*rows)) or [()] * 5
            kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(cols[0], pa.int64())), *(pa.array(c, k) for c, k in zip(cols[1:], kinds))],
                                             names=["doc_id", "license", "coverage", "start", "end"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, SCHEMA)
