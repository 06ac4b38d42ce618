"""License scans by patience alignment of texts against license templates.

A template is found where its words stand in a text in order.  Two word lists
are aligned by patience: words that occur exactly once in both are anchors,
the longest increasing subsequence of their positions is kept, and the gaps
between kept anchors are aligned in the same way (equal words at both ends of
a gap are matched first).  Coverage is the share of the template's words that
are matched.

Where to align: a text can only reach ``min_coverage`` when it holds enough of
the template's words, which is counted first for all texts at once and is
exact for texts whose foreign words fit a window (below).  In such a text every occurrence of the template's word that is rarest
there marks a window around the place where the template would stand; each
window is aligned on its own, so a license that is repeated in a text is found
each time.  Of overlapping finds of one template the best, then the first,
stays.  Templates that hold one another's words are all found; of such
overlapping finds the one with most matched words, then the best, names the
text (``name``).

Largest gap: a window has max(4, n // 4) words more than a template of n words
on each side.  A template with more foreign words than that inside, where no
window holds ``min_coverage`` of it, is not found.

Defined cases: words are lower-cased runs of ASCII letters, digits and
non-ASCII characters; null and empty texts have no finds; templates without
words are refused; equal templates under two names are both reported; extra
columns stay; whole texts are read, whatever their length.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from shelfwise.llm.arrowtext import LOWER, byte_table, free, hash_spans, map_rows, spans

#: License notices and texts to look for, by SPDX identifier; ``-full`` are whole texts with their disclaimers.
TEMPLATES = {
    "0BSD-full": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY "
        "SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA "
        "OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    "AGPL-3.0-only": "This work is licensed under the GNU Affero General Public License, version 3",
    "AGPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version."),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required "
        "by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution."),
    "BSD-2-Clause-full": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" "
        "AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY "
        "AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE "
        "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
        "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
        "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
        "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
        "POSSIBILITY OF SUCH DAMAGE."),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may "
        "be used to endorse or promote products derived from this software without specific prior written permission."),
    "BSD-3-Clause-full": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may "
        "be used to endorse or promote products derived from this software without specific prior written permission. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
        "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
        "DAMAGE."),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "GPL-2.0-only": "This work is licensed under the GNU General Public License, version 2",
    "GPL-2.0-or-later": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."),
    "GPL-3.0-only": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "ISC-full": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        "IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
        "USE OR PERFORMANCE OF THIS SOFTWARE."),
    "LGPL-2.0-or-later": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library "
        "General Public License as published by the Free Software Foundation; either version 2 of the License, or (at "
        "your option) any later version."),
    "LGPL-2.1-only": "This work is licensed under the GNU Lesser General Public License, version 2.1",
    "LGPL-2.1-or-later": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
        "your option) any later version."),
    "LGPL-3.0-only": "This work is licensed under the GNU Lesser General Public License, version 3",
    "LGPL-3.0-or-later": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version."),
    "MIT": "Released under the MIT License",
    "MIT-0-full": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so. THE SOFTWARE IS PROVIDED \"AS IS\", "
        "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "MIT-full": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
        "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN "
        "NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN "
        "AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
        "OTHER DEALINGS IN THE SOFTWARE."),
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "Unlicense": "This is free and unencumbered software released into the public domain",
    "all-rights-reserved": "All rights reserved",
}

FINDS = ArrayType(StructType([
    StructField("license", StringType(), False), StructField("coverage", DoubleType(), False),
    StructField("matched", IntegerType(), False), StructField("start_word", LongType(), False),
    StructField("end_word", LongType(), False)]), False)

_GAP = np.ones(256, bool)
_GAP[48:58] = _GAP[65:91] = _GAP[97:123] = False
_GAP[128:] = False
_TABLE = byte_table(41, LOWER)


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of each word."""
    starts, ends, row = spans(data, off, _GAP)
    return hash_spans(data, starts, ends, _TABLE), row


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest subsequence of ``pairs`` (ascending in the first) whose second parts ascend: patience sorting."""
    tops: list[int] = []                       # the second part on top of each pile
    at: list[int] = []                         # which pair that is
    back: list[int] = []
    for i, (_, b) in enumerate(pairs):
        k = bisect_left(tops, b)
        back.append(at[k - 1] if k else -1)
        if k == len(tops):
            tops.append(b)
            at.append(i)
        else:
            tops[k], at[k] = b, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def align(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Matched positions (in a, in b), ascending in both, by patience."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        na, nb = Counter(a[a0:a1]), Counter(b[b0:b1])
        once = {w: j for j, w in enumerate(b[b0:b1], b0) if nb[w] == 1 and na.get(w) == 1}
        anchors = increasing([(i, once[a[i]]) for i in range(a0, a1) if a[i] in once])
        if not anchors:
            continue
        out += anchors
        ends = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        todo += [(p[0] + 1, q[0], p[1] + 1, q[1]) for p, q in zip(ends[:-1], ends[1:])]
    return sorted(out)


@dataclass
class Template:
    name: str
    words: list[int]
    count: Counter

    def find(self, text: list[int], min_coverage: float) -> list[tuple[float, int, int, int]]:
        """(coverage, matched, first word, end) of the finds in a text that holds enough of the words."""
        n = len(self.words)
        here = Counter(w for w in text if w in self.count)
        if sum(min(c, here[w]) for w, c in self.count.items()) < min_coverage * n:
            return []
        # Any word of the template can be the missing one, so windows are laid
        # around the rarest words of which one at least has to be matched.
        spare = n - int(np.ceil(min_coverage * n))
        marks, left = [], spare + 1
        for w in sorted(self.count, key=lambda w: (here[w], self.words.index(w))):
            marks.append(w)
            left -= self.count[w]
            if left <= 0:
                break
        marks = set(marks)
        slack = max(4, n // 4)
        places = [i for i, w in enumerate(text) if w in marks]
        found, seen = [], set()
        offsets = {w: [j for j, x in enumerate(self.words) if x == w] for w in marks}
        for i in places:
            for j in offsets[text[i]]:
                # Just the template's place, where copies may stand side by side, and a wider one for changed texts.
                for wide in (0, slack):
                    lo, hi = max(0, i - j - wide), min(len(text), i - j + n + wide)
                    if (lo, hi) in seen:
                        continue
                    seen.add((lo, hi))
                    m = align(text[lo:hi], self.words)
                    if len(m) >= min_coverage * n:
                        found.append((len(m) / n, len(m), lo + m[0][0], lo + m[-1][0] + 1))
        found.sort(key=lambda f: (-f[0], f[3] - f[2], f[2]))
        kept: list[tuple[float, int, int, int]] = []
        for f in found:
            if all(f[3] <= k[2] or f[2] >= k[3] for k in kept):
                kept.append(f)
        return sorted(kept, key=lambda f: f[2])


def templates(texts: dict[str, str]) -> list[Template]:
    out = []
    for name, text in sorted(texts.items()):
        raw = np.frombuffer(text.encode(), np.uint8)
        words = word_hashes(raw, np.array([0, len(raw)]))[0].tolist()
        if not words:
            raise ValueError(f"template {name} has no words")
        out.append(Template(name, words, Counter(words)))
    return out


def find_block(known: list[Template], data: np.ndarray, off: np.ndarray, min_coverage: float) -> list[list[tuple]]:
    """The finds in each row."""
    n = len(off) - 1
    words, row = word_hashes(data, off)
    vocabulary = np.array(sorted({w for t in known for w in t.words}), np.uint64)
    at = np.searchsorted(vocabulary, words)
    at[at == len(vocabulary)] = 0
    hit = vocabulary[at] == words
    # The words of templates that each row holds, each once.
    pairs = np.unique(row[hit] * np.int64(len(vocabulary)) + at[hit])
    rows, which = pairs // len(vocabulary), pairs % len(vocabulary)
    cut = np.searchsorted(row, np.arange(n + 1))
    out: list[list[tuple]] = [[] for _ in range(n)]
    for t in known:
        weight = np.array([t.count.get(w, 0) for w in vocabulary.tolist()], float)
        most = np.bincount(rows, weights=weight[which], minlength=n)
        for r in np.flatnonzero(most >= min_coverage * len(t.words)).tolist():
            text = words[cut[r]: cut[r + 1]].tolist()
            out[r] += [(t.name, *f) for f in t.find(text, min_coverage)]
    return [sorted(x, key=lambda f: (f[3], -f[1], f[0])) for x in out]


def name(finds: list[tuple]) -> tuple | None:
    """The find that names a text: overlapped by none with more matched words, then the best, then the first."""
    kept, starts, ends = [], [], []                # starts and ends of disjoint finds, ascending
    for f in sorted(finds, key=lambda f: (-f[2], -f[1], f[3], f[0])):
        i = bisect_left(starts, f[4])
        if i and ends[i - 1] > f[3]:
            continue
        starts.insert(i, f[3])
        ends.insert(i, f[4])
        kept.append(f)
    return min(kept, key=lambda f: (-f[1], f[3], f[0]), default=None)


def scan(docs: DataFrame, texts: dict[str, str] | None = None, min_coverage: float = 0.8, out: str = "licenses",
         text_col: str = "text", keep: list[str] | None = None, best: str | None = None) -> DataFrame:
    """``docs`` with an array of finds (license, coverage, matched, start_word, end_word), by place.

    ``best`` names a column for the find that names the text.  Columns of these names stay, and the new ones get
    underscores until their names are free.
    """
    kept = docs.columns if keep is None else keep
    out = free(out, kept)
    best = None if best is None else free(best, [*kept, out])
    known = templates(TEMPLATES if texts is None else texts)
    names = ["license", "coverage", "matched", "start_word", "end_word"]
    kind = pa.struct([pa.field("license", pa.string(), False), pa.field("coverage", pa.float64(), False),
                      pa.field("matched", pa.int32(), False), pa.field("start_word", pa.int64(), False),
                      pa.field("end_word", pa.int64(), False)])

    def row(f):
        return dict(zip(names, (f[0], round(f[1], 6), *f[2:])))

    def fn(rows, data, off):
        finds = find_block(known, data, off, min_coverage)
        found = [pa.array([[row(f) for f in x] for x in finds], pa.list_(kind))]
        if best is not None:
            found.append(pa.array([row(name(x)) if x else None for x in finds], kind))
        return found

    fields = [StructField(out, FINDS)] + ([] if best is None else [StructField(best, FINDS.elementType)])
    return map_rows(docs, fn, fields, text_col, keep)
