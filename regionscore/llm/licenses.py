"""Licence scans: texts against licence templates by the Dice coefficient over word bigrams.

Words are runs of letters and digits in lower case. A stretch of a text matches a template when twice the common
bigrams (with their numbers) reach a share of the bigrams of both. That share bounds how long a stretch can be for a
template and how many of its bigrams must lie in so short a stretch; places that fail the bounds are left out
before any coefficient is worked out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from regionscore.llm.common import as_bytes, blocks, key_and_text, mixed, span_hashes, text_column

_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
    '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so")
_NOTICE = ", subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_MIT_WARRANTY = (
    ' THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
    "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE "
    "OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_CLAUSES = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
    "met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution.")
_NAMES = (
    " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission.")
_ADVERTISING = (
    " 3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes "
    "software developed by the organization.")
_BSD_WARRANTY = (
    ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED '
    "TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_NOTICE = ", provided that the above copyright notice and this permission notice appear in all copies."
_ISC_WARRANTY = (
    ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
    "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")


def _gnu() -> dict[str, tuple[str, ...]]:
    """Wordings of the GNU licences by kind and version, and of each kind without a version."""
    out = {}
    for name, kind, versions in (("GPL", "General", ("1", "2", "3")), ("LGPL", "Lesser General", ("2.1", "3")), ("LGPL", "Library General", ("2",)), ("AGPL", "Affero General", ("3",))):
        title = f"GNU {kind} Public License"
        if kind != "Library General":
            out[name] = (f"This work is licensed under the {title}.",)
        for v in versions:
            terms = f"is free software; you can redistribute it and/or modify it under the terms of the {title}"
            out[f"{name}-{v if '.' in v else v + '.0'}"] = (
                f"This work is licensed under the {title}, version {v}.",
                *(f"This {what} {terms} as published by the Free Software Foundation; either version {v} of the License, or (at your option) any later version." for what in ("program", "library")),
                *(f"This {what} {terms} version {v} as published by the Free Software Foundation." for what in ("program", "library")))
    return out


def _creative_commons() -> dict[str, tuple[str, ...]]:
    """Wordings of the Creative Commons licences by conditions and version, and without a version."""
    out = {}
    for short, title in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"),
                         ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")):
        work = f"This work is licensed under a Creative Commons {title}"
        out[f"CC-{short}"] = (f"Licensed under CC {short}.", f"{work} License.")
        for v, where in (("1.0", "Generic"), ("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International")):
            out[f"CC-{short}-{v}"] = (f"Licensed under CC {short} {v}.", f"{work} {v} {where} License.", f"{work} {v} License.")
    return out


# Names of licences with the wording of their notices, or of the whole text where it is short.
TEMPLATES: dict[str, tuple[str, ...]] = {
    **_gnu(),
    **_creative_commons(),
    "0BSD": ("Licensed under the BSD Zero Clause License.", _ISC + "." + _ISC_WARRANTY),
    "Apache-1.1": (
        "Licensed under the Apache License, Version 1.1.",
        _CLAUSES + " 3. The end-user documentation included with the redistribution, if any, must include the following acknowledgment: "
        '"This product includes software developed by the Apache Software Foundation (http://www.apache.org/)." Alternately, this acknowledgment may '
        "appear in the software itself, if and wherever such third-party acknowledgments normally appear. 4. The names \"Apache\" and \"Apache Software "
        'Foundation" must not be used to endorse or promote products derived from this software without prior written permission.',
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either '
        "express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License.", _CLAUSES, _CLAUSES + _BSD_WARRANTY),
    "BSD-3-Clause": ("Licensed under the BSD 3-Clause License.", _CLAUSES + " 3." + _NAMES, _CLAUSES + " 3." + _NAMES + _BSD_WARRANTY),
    "BSD-4-Clause": ("Licensed under the BSD 4-Clause License.", _CLAUSES + _ADVERTISING + " 4." + _NAMES, _CLAUSES + _ADVERTISING + " 4." + _NAMES + _BSD_WARRANTY),
    "BSL-1.0": (
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation "
        'covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative '
        "works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright "
        "notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be "
        "included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works "
        "are solely in the form of machine-executable object code generated by a source language processor.",
    ),
    "CC0-1.0": (
        "Licensed under CC0 1.0.",
        "This work is licensed under a Creative Commons Zero v1.0 Universal License.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the "
        "public domain worldwide. This software is distributed without any warranty.",
    ),
    "EPL-1.0": (
        "Licensed under the Eclipse Public License, Version 1.0.",
        "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which "
        "accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    ),
    "EPL-2.0": (
        "Licensed under the Eclipse Public License, Version 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
        "https://www.eclipse.org/legal/epl-2.0/",
    ),
    "ISC": ("Licensed under the ISC License.", _ISC + _ISC_NOTICE, _ISC + _ISC_NOTICE + _ISC_WARRANTY),
    "MIT": ("Released under the MIT License.", _GRANT + _NOTICE, _GRANT + _NOTICE + _MIT_WARRANTY),
    "MIT-0": ("Released under the MIT No Attribution License.", _GRANT + "." + _MIT_WARRANTY),
    "MPL-1.1": (
        'The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/ Software distributed under the License is "
        'distributed on an "AS IS" basis, WITHOUT WARRANTY OF ANY KIND, either express or implied. See the License for the specific language governing '
        "rights and limitations under the License.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
        "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    "Zlib": (
        "Licensed under the zlib License.",
        'This software is provided "as-is", without any express or implied warranty. In no event will the authors be held liable for any damages arising '
        "from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
        "alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must "
        "not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be "
        "appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original "
        "software. 3. This notice may not be removed or altered from any source distribution.",
    ),
}

_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER_TABLE = np.random.default_rng(31).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER_TABLE[65:91] = _LOWER_TABLE[97:123]


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text number, start and end (bytes within the text) of every word."""
    data, offsets = as_bytes(texts)
    if not len(data):
        return (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 3
    inside = _WORD_BYTE[data]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    before, after = np.concatenate(([False], inside[:-1])), np.concatenate((inside[1:], [False]))
    before[edge] = False
    after[edge - 1] = False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    doc = np.searchsorted(offsets, start, "right") - 1
    return span_hashes(data, start, end, _LOWER_TABLE), doc, start - offsets[doc], end - offsets[doc]


def bigrams(hashes: np.ndarray) -> np.ndarray:
    """Hash of each word with the next one."""
    return mixed(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])


class Templates:
    """Bigrams of all templates, and where they occur."""

    def __init__(self, texts: Mapping[str, tuple[str, ...]], percent: int):
        self.percent, self.names, self.parts = percent, [], []
        where: dict[int, list[int]] = {}
        for name, wordings in texts.items():
            for wording in wordings:
                own = Counter(bigrams(words(pa.array([wording]))[0]).tolist())
                if own:
                    for b in own:
                        where.setdefault(b, []).append(len(self.names))
                    self.names.append(name)
                    self.parts.append(own)
        self.sizes = [sum(p.values()) for p in self.parts]
        self.where = where
        # Templates of other licences that have all of a template's bigrams: of the clauses of BSD-2-Clause, those of BSD-3-Clause.
        self.wider = [[u for u, other in enumerate(self.parts) if self.names[u] != name and self.sizes[u] > size and own <= other]
                      for name, own, size in zip(self.names, self.parts, self.sizes)]
        self.sorted = np.array(sorted(where), np.uint64)
        self.marked = np.zeros(1 << 16, bool)
        self.marked[(self.sorted >> np.uint64(48)).astype(np.int64)] = True

    def known(self, found: np.ndarray) -> np.ndarray:
        """Places of bigrams that some template has."""
        at = np.flatnonzero(self.marked[(found >> np.uint64(48)).astype(np.int64)])
        i = np.minimum(np.searchsorted(self.sorted, found[at]), len(self.sorted) - 1)
        return at[self.sorted[i] == found[at]]

    def matches(self, at: list[int], found: list[int]) -> list[tuple[float, int, int, int]]:
        """(coefficient, template, first, last bigram) of disjoint stretches of one text, best first.

        `at`: places of the known bigrams, `found`: the bigrams there. Of equal coefficients the longer template, then
        the earlier place wins; a stretch that overlaps a better one is left out, and so is one inside a longer match of
        another licence's template that has the whole of its own template as a part.
        """
        by_template: dict[int, list[int]] = {}
        for k, b in enumerate(found):
            for t in self.where[b]:
                by_template.setdefault(t, []).append(k)
        candidates = []
        for t, hits in by_template.items():
            m, p = self.sizes[t], self.percent
            least, longest = -(-p * m // (200 - p)), (200 - p) * m // p  # common bigrams needed; bigrams of a stretch
            if len(hits) < least:
                continue
            for i in range(len(hits) - least + 1):
                start = at[hits[i]]
                if at[hits[i + least - 1]] - start + 1 > longest:
                    continue
                left, common, best = dict(self.parts[t]), 0, None
                for k in hits[i:]:
                    size = at[k] - start + 1
                    if size > longest:
                        break
                    if left[found[k]] > 0:
                        left[found[k]] -= 1
                        common += 1
                        # The shorter of two stretches that are equally alike.
                        if 200 * common >= p * (size + m) and (best is None or 2 * common / (size + m) > best[0]):
                            best = (2 * common / (size + m), t, start, at[k])
                if best:
                    candidates.append(best)
        candidates.sort(key=lambda c: (-c[0], -self.sizes[c[1]], c[2], c[1]))
        spans: dict[int, list[tuple[int, int]]] = {}
        for _, t, start, end in candidates:
            spans.setdefault(t, []).append((start, end))
        out: list[tuple[float, int, int, int]] = []
        for c in candidates:
            if any(a <= c[2] and c[3] <= b and b - a > c[3] - c[2] for u in self.wider[c[1]] for a, b in spans.get(u, ())):
                continue
            if all(c[3] + 1 < o[2] or o[3] + 1 < c[2] for o in out):
                out.append(c)
        return out


FOUND = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("license", T.StringType()), T.StructField("score", T.DoubleType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("license", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])


def scan(df: DataFrame, templates: Mapping[str, tuple[str, ...]] | None = None, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, license, score, spans` of every row: the best match, and all disjoint matches as byte spans of the text in order.

    `TEMPLATES` are what is known: a licence beside them is missed, or named after one whose wording it shares.
    Without a match, for NULL and for empty texts, `license` is NULL, `score` 0 and `spans` empty. Equal matches go by
    the longer template, then the earlier place. Repeated rows and NULL keys stay as they are; other columns are left out.
    """
    known = Templates(TEMPLATES if templates is None else templates, percent)
    shared = df.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        for batch in blocks(batches):
            hashes, doc, start, end = words(text_column(batch, "text"))
            names: list[str | None] = [None] * batch.num_rows
            scores, spans = [0.0] * batch.num_rows, [[] for _ in names]
            if len(hashes) > 1 and len(t.sorted):
                pairs = bigrams(hashes)
                at = t.known(pairs)
                at = at[doc[at] == doc[at + 1]]
                edges = np.flatnonzero(np.concatenate(([True], doc[at][1:] != doc[at][:-1]))) if len(at) else np.zeros(0, np.int64)
                for a, b in zip(edges.tolist(), np.append(edges[1:], len(at)).tolist()):
                    row, places = int(doc[at[a]]), at[a:b].tolist()
                    if found := t.matches(places, pairs[at[a:b]].tolist()):
                        names[row], scores[row] = t.names[found[0][1]], found[0][0]
                        spans[row] = sorted(({"license": t.names[k], "score": s, "start": int(start[i]), "end": int(end[j + 1])} for s, k, i, j in found), key=lambda x: x["start"])
            kind = pa.list_(pa.struct([("license", pa.string()), ("score", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(spans, kind)], FOUND.names)

    return key_and_text(df, id_col, text_col).mapInArrow(run, FOUND)
