"""License notices by Patience alignment.

Word positions that a template also has are counted in windows; only windows
with enough of them are aligned.  The alignment anchors on words that are
unique in the window and in the template, keeps the longest increasing
subsequence of the anchors, and aligns the gaps between them in the same way.
Coverage is the share of the template's words that are aligned.

A window begins at a template word.  The first one with enough coverage is held
against those that begin inside its match and overlap it; the one with most aligned words
is reported (ties: the shortest match, then the first), and the search goes on
behind it.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import texts

COVERAGE = 0.8
#: A window is this many times as long as the template.
STRETCH = 1.5

# Short notices, the opening words of public licenses, and the whole texts of the short ones.
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files, to deal in the Software without restriction",
    "apache-2.0": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
           "the following conditions are met",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
           "Public License as published by the Free Software Foundation",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "cc-by": "This work is licensed under a Creative Commons Attribution",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
                "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
                "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
                "notice and this permission notice shall be included in all copies or substantial portions of the Software. " + (_AS_IS := (
                    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
                    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
                    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
                    "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
                    "SOFTWARE.")),
    "mit-warranty": _AS_IS,
    "isc-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
                "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "
                "\"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
                "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
                "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
                "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "bsd-2-clause-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                         "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
                         "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
                         "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
                         "materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "
                         "\"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
                         "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
                         "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
                         "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
                         "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
                         "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF "
                         "THE POSSIBILITY OF SUCH DAMAGE.",
}
_WORD = re.compile(r"\w+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence."""
    tails, ends, back = [], [], [0] * len(values)
    for i, v in enumerate(values):
        at = bisect_left(tails, v)
        back[i] = ends[at - 1] if at else -1
        if at == len(tails):
            tails.append(v)
            ends.append(i)
        else:
            tails[at], ends[at] = v, i
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def patience(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned index pairs of equal words, increasing in both."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        while alo < ahi and blo < bhi and a[alo] == b[blo]:
            out.append((alo, blo))
            alo, blo = alo + 1, blo + 1
        while alo < ahi and blo < bhi and a[ahi - 1] == b[bhi - 1]:
            ahi, bhi = ahi - 1, bhi - 1
            out.append((ahi, bhi))
        if alo >= ahi or blo >= bhi:
            continue
        in_a, in_b = Counter(a[alo:ahi]), Counter(b[blo:bhi])
        at_b = {w: i for i, w in enumerate(b[blo:bhi], blo) if in_b[w] == 1}
        pairs = [(i, at_b[w]) for i, w in enumerate(a[alo:ahi], alo) if in_a[w] == 1 and w in at_b]
        anchors = [pairs[k] for k in increasing([j for _, j in pairs])]
        if not anchors:
            continue
        i0, j0 = alo, blo
        for i, j in anchors:
            out.append((i, j))
            todo.append((i0, i, j0, j))
            i0, j0 = i + 1, j + 1
        todo.append((i0, ahi, j0, bhi))
    return sorted(out)


class Scanner:
    def __init__(self, templates: dict[str, str], coverage: float = COVERAGE):
        self.names = list(templates)
        self.words = [words(t) for t in templates.values()]
        self.need = [max(1, int(np.ceil(coverage * len(w)))) for w in self.words]
        self.of: dict[str, list[int]] = {}
        for n, own in enumerate(self.words):
            for w in set(own):
                self.of.setdefault(w, []).append(n)

    def aligned(self, n: int, own: list[str], first: int, width: int, least: int = 0) -> tuple[int, int, int] | None:
        """(words, first, last) of template ``n`` aligned with the window at ``first``, if enough and ``least`` at least."""
        window, left = own[first:first + width], Counter(self.words[n])
        least = max(least, self.need[n])
        if sum(min(c, left[w]) for w, c in Counter(window).items()) < least:
            return None
        pairs = patience(self.words[n], window)
        return (len(pairs), first + pairs[0][1], first + pairs[-1][1]) if len(pairs) >= least else None

    def scan(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(template, coverage, start, end) of the matches, which do not overlap for one template."""
        text = text or ""
        low = text.lower()
        if len(low) == len(text):
            own = _WORD.findall(low)
            spans = None
        else:  # a letter changed its length: take the words as written
            spans = [m.span() for m in _WORD.finditer(text)]
            own = [text[a:b].lower() for a, b in spans]
        hits: dict[int, list[int]] = {}
        for i, w in enumerate(own):
            for n in self.of.get(w, ()):
                hits.setdefault(n, []).append(i)
        out = []
        for n, at in sorted(hits.items()):
            need, width = self.need[n], int(STRETCH * len(self.words[n])) + 1
            at = np.array(at)
            if len(at) < need:
                continue
            enough = np.flatnonzero(np.searchsorted(at, at + width) - np.arange(len(at)) >= need)
            past, starts = -1, at[enough]
            for k, first in enumerate(starts):
                if first < past or not (found := self.aligned(n, own, first, width)):
                    continue
                # of the windows that begin in this match and overlap it: most words, then the shortest, then the first
                best, last = found, found[2]
                for other in starts[k + 1:]:
                    if other > last or best[0] == best[2] - best[1] + 1 == len(self.words[n]):
                        break
                    more = self.aligned(n, own, other, width, best[0])
                    if more and more[1] <= last and (more[0], more[1] - more[2]) > (best[0], best[1] - best[2]):
                        best = more
                spans = spans or [m.span() for m in _WORD.finditer(low)]
                out.append((self.names[n], best[0] / len(self.words[n]), spans[best[1]][0], spans[best[2]][1]))
                past = best[2] + 1
        return out


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """A row (doc_id, template, coverage, start, end) per notice found, in every row's whole text.

    Offsets are code points.  Null and empty texts have none, very long ones are
    scanned whole; templates without words match nothing; repeated rows give
    their matches again; a place may match several templates.
    """
    model = docs.sparkSession.sparkContext.broadcast(Scanner({k: v for k, v in templates.items() if words(v)}, coverage))

    def run(batches):
        for batch in batches:
            rows = [(i, *m) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for m in model.value.scan(t)]
            cols = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "template", "coverage", "start", "end"])

    return texts(docs).mapInArrow(run, "doc_id long, template string, coverage double, start long, end long")
