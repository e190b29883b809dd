"""Operator 9: licence scans by MinHash bands over overlapping text windows.

A text's words, without the punctuation around them, are cut into overlapping windows as long as a template. The MinHashes of a
window's shingles, in 40 bands of 2, retrieve templates of that length: a window with 0.8 of a template's shingles has a Jaccard
similarity of 2/3 or more and is retrieved with a probability over 1 - 1e-10. Only for retrieved templates the share of
the template's shingles that the window has is counted exactly. Windows without enough shingles of the templates at all
(whichever they are of) are not hashed: no template could have the share there, so none is lost by it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoweave.llm.common import WordHashes, mix, slices, words_of
from genoweave.llm.windows import Passages, in_parts, permuted

PERMISSION = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
NOT_LIABLE = "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
BSD_3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, " + NOT_LIABLE
GNU = "This program is free software{}you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation{}either version {} of the License, or (at your option) any later version."
NO_WARRANTY = "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {} for more details."
#: Fixed identifiers of licences, for tags and one-line notices.
IDENTIFIERS = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-NC-ND-4.0",
    "CC-BY-NC-SA-4.0", "CC-BY-ND-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "EUPL-1.2", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC",
    "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0", "OFL-1.1", "Unlicense", "WTFPL", "Zlib",
)
#: Fixed texts: whole short licences, the notices by which longer ones are applied, and common one-line declarations.
TEMPLATES = (
    ("MIT", PERMISSION + " (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-2-Clause", f"{BSD} {BSD_END}"),
    ("BSD-3-Clause", f"{BSD} {BSD_3} {BSD_END}"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("WTFPL", "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-2.0-or-later", GNU.format("; ", "General Public License", "; ", "2")),
    ("GPL-3.0-or-later", GNU.format(": ", "General Public License", ", ", "3")),
    ("AGPL-3.0-or-later", GNU.format(": ", "Affero General Public License", ", ", "3")),
    ("LGPL-3.0-or-later", GNU.format(": ", "Lesser General Public License", ", ", "3")),
    ("LGPL-2.1-or-later", GNU.format("; ", "Lesser General Public License", "; ", "2.1").replace("program", "library")),
    ("GPL", NO_WARRANTY.format("General Public License")),
    ("LGPL", NO_WARRANTY.format("Lesser General Public License").replace("program", "library")),
    *((f"{short}GPL-{version}", f"GNU {kind}General Public License, version {version}") for short, kind, version in (("", "", "2"), ("", "", "3"), ("L", "Lesser ", "2.1"), ("L", "Lesser ", "3"), ("A", "Affero ", "3"))),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("OFL-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("All-rights-reserved", "All rights reserved."),
    *((f"CC-{kind}-4.0", f"This work is licensed under a Creative Commons {name} 4.0 International License.") for kind, name in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))),
    *((f"CC-{kind}-4.0", f"Licensed under CC {kind} 4.0.") for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")),
    *((name, f"SPDX-License-Identifier: {name}") for name in IDENTIFIERS),
)
BANDS, ROWS = 40, 2
MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def bare(word: bytes) -> bytes:
    """A word without the ASCII punctuation around it; nothing of comment signs and bullets."""
    return word.strip(MARKS)


def band_keys(least: np.ndarray) -> np.ndarray:
    """Band keys (bands x windows) of MinHashes (functions x windows); no two bands share a key."""
    out = np.arange(BANDS, dtype=np.uint64)[:, None] * np.uint64(0xC2B2AE3D27D4EB4F) + np.zeros(least.shape[1], np.uint64)
    for r in range(ROWS):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + least[r::ROWS])
    return out


class Bands:
    """Templates of one length by the bands of their MinHashes."""

    def __init__(self, sets: list[np.ndarray]):
        keys = np.stack([band_keys(permuted(s, BANDS * ROWS).min(axis=1)[:, None])[:, 0] for s in sets])
        order = np.argsort(keys, axis=None, kind="stable")
        self.keys, self.owner, self.n = keys.ravel()[order], order // BANDS, len(sets)

    def near(self, s: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(start, template): the templates that share a band with the window of `size` shingles at each start."""
        lo = int(starts.min())
        mins = np.lib.stride_tricks.sliding_window_view(permuted(s[lo : int(starts.max()) + size], BANDS * ROWS), size, axis=1)
        keys = band_keys(np.stack([mins[:, i - lo].min(axis=1) for i in starts.tolist()], axis=1))
        left, right = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        n = (right - left).ravel()
        at = np.repeat(left.ravel(), n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        met = np.unique(np.repeat(np.arange(n.size) % len(starts), n) * self.n + self.owner[at])
        return starts[met // self.n], met % self.n


class Scanner:
    def __init__(self, templates: list[tuple[str, str]], share: float):
        self.names = [n for n, _ in templates]
        self.passages, self.share = Passages([(i, t) for i, (_, t) in enumerate(templates)], bare), share
        items = self.passages.items
        self.index = {(words, n): Bands([items[i].distinct for i in own]) for words, lengths in self.passages.by_size.items() for n, own in lengths.items()}
        self.least = {n: min(len(p.distinct) for p in items if len(p.shingles) == n) for n in {len(p.shingles) for p in items}}
        self.known = WordHashes(plain=bare)

    def find(self, text: str | None) -> list[tuple[str, int, int, float]]:
        """(licence, start word, words, share of the template's shingles) of the best window of each template, the first of equals.

        Licences share passages: a window of which over a half lies in one with a larger share, of another licence, is left out."""
        h = self.known.of(words_of(text, lower=True))
        places = np.flatnonzero(h)
        h = h[places]
        best: dict[int, tuple[float, int]] = {}
        # a text that is shorter than a template can still hold the share of its shingles
        for words, n, s, starts, size in self.passages.windows(h, lambda n, _: self.share * self.least[n], 1 / self.share):
            own = self.passages.by_size[words][n]
            for part in in_parts(starts, 1 << 12):
                for at, k in zip(*(x.tolist() for x in self.index[words, n].near(s, part, size)), strict=True):
                    i = int(own[k])
                    if i in best and best[i][0] >= 1:
                        continue
                    p = self.passages.items[i]
                    share = len(np.intersect1d(p.distinct, s[at : at + size])) / len(p.distinct)
                    if share >= self.share - 1e-9 and share > best.get(i, (0.0, 0))[0]:
                        best[i] = (share, at)
        found = []
        for i, (share, at) in best.items():
            p = self.passages.items[i]
            first, last = places[at], places[min(at + p.words, len(h)) - 1]
            found.append((-share, int(first - last) - 1, int(first), i))
        kept: list[tuple[float, int, int, int]] = []
        for share, words, first, i in sorted(found):  # larger shares first
            inside = (2 * (min(first - words, b - n) - max(first, b)) > -words and s < share and self.names[self.passages.items[j].key] != self.names[self.passages.items[i].key] for s, n, b, j in kept)
            if not any(inside):
                kept.append((share, words, first, i))
        return [(self.names[self.passages.items[i].key], first, -words, -share) for share, words, first, i in kept]


def matches(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, share: float = 0.8, key: str = "doc_id") -> DataFrame:
    """(doc_id, licence, start, words, containment): for each document the best window of each licence found in it.

    Containment is the share of a template's distinct five-word shingles in a window of as many shingles; a template of
    fewer words is one shingle. Words are lower-cased (A-Z), cut at white space and freed of the ASCII punctuation around them;
    words of punctuation alone (comment signs) do not count, but start and words are told in the text's own words. Null and
    blank texts give nothing; repeated documents each give rows. Very long texts are searched whole, in parts. Of several
    templates of a licence the one with the largest containment counts, of equals the one that starts first, then the longest; a window that lies mostly in one of
    another licence with a larger containment is left out. Templates without
    words are left out; without templates there are no rows. Other columns, of any names, take no part.
    """
    rows = list(templates)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rows, share)
        for batch in batches:
            for part in slices(batch):
                out = []
                for d, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    best: dict[str, tuple] = {}
                    for m in scanner.find(t):
                        if m[0] not in best or (m[3], -m[1], m[2]) > (best[m[0]][3], -best[m[0]][1], best[m[0]][2]):
                            best[m[0]] = m
                    out += [(d, *m) for m in best.values()]
                kinds = (("key", pa.int64()), ("licence", pa.string()), ("start", pa.int32()), ("words", pa.int32()), ("containment", pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, (_, k) in enumerate(kinds)], [n for n, _ in kinds])

    source = docs.select(F.col(key).cast("long").alias("key"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, "key long, licence string, start int, words int, containment double").withColumnRenamed("key", key)
