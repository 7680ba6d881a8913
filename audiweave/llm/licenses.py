"""License notices by MinHash bands over overlapping windows.

For every template of ``m`` shingles, windows of ``m`` shingles start every
``m // 8`` shingles of a text (at every one for short templates), so some
window stands within a sixteenth of the template's place on either side, and
its Jaccard similarity with a template that is there by four fifths is 0.65 or
more. With ``BANDS`` bands of ``ROWS`` minima such a window meets its template
in some band with a probability of 1 - (1 - 0.65**2)**10 > 0.995. Every meeting
is verified by the exact containment of the template's shingles around it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from audiweave.llm.textbytes import LOWER, U, Words, chunks, mix

SHINGLE, BANDS, ROWS, CONTAINED = 5, 10, 2, 0.8
LETTER_OR_DIGIT = np.zeros(256, bool)
LETTER_OR_DIGIT[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
SALTS = np.random.default_rng(23).integers(1, 2**63, BANDS * ROWS, dtype=np.uint64)

_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
)
_HOLDERS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
    "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, "
    "INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR "
    "PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_REDISTRIBUTE = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution. "
)
#: Public license texts, and notices that stand for longer ones.
TEMPLATES = {
    "0bsd": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR "
    "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER "
    "TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "agpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software "
    "Foundation, either version 3 of the License, or (at your option) any later version.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the "
    "License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
    "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under "
    "the License.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-2-clause": _REDISTRIBUTE + _HOLDERS,
    "bsd-3-clause": _REDISTRIBUTE + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission. " + _HOLDERS,
    "bsl-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "
    "\"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the "
    "Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction "
    "and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works "
    "are solely in the form of machine-executable object code generated by a source language processor.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "gpl-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software "
    "Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software "
    "Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
    "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this "
    "permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES "
    "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
    "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "lgpl-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software "
    "Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software "
    "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
    "to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial "
    "portions of the Software. " + _AS_IS + "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT "
    "OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mit-notice": "Released under the MIT License",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at "
    "http://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either "
    "in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors "
    "of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of "
    "our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. "
    + _AS_IS + "IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
    "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
    "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an "
    "acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as "
    "being the original software. 3. This notice may not be removed or altered from any source distribution.",
}


def _words(column: pa.Array) -> Words:
    return Words(column, member=LETTER_OR_DIGIT, fold=LOWER)


def _band(minima: list[np.ndarray]) -> np.ndarray:
    """Key of a band from its minima."""
    out = minima[0]
    for other in minima[1:]:
        out = out * U(0x9E3779B97F4A7C15) + other
    return out


class Catalogue:
    """Shingle sets and band keys of templates."""

    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        words = _words(pa.array([templates[n] for n in self.names], pa.string()))
        doc, gram = words.grams(SHINGLE)
        self.sets = [np.unique(gram[doc == k]) for k in range(len(self.names))]
        if not all(len(x) for x in self.sets):
            raise ValueError(f"a template needs {SHINGLE} words at least")
        self.keys = [[_band([mix(x ^ s).min(keepdims=True) for s in SALTS[b * ROWS : (b + 1) * ROWS]])[0] for b in range(BANDS)] for x in self.sets]


def _starts(first: np.ndarray, m: int) -> np.ndarray:
    """Starts of windows of ``m`` shingles, every ``m // 8`` and at the end of each text of ``m`` or more."""
    count = np.diff(first)
    step = max(1, m // 8)
    n = np.where(count >= m, -(-(count - m) // step) + 1, 0)
    row = np.repeat(np.arange(len(count)), n)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return first[:-1][row] + np.minimum(k * step, count[row] - m)


def _sliding(base: np.ndarray, sizes: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(m, minima of every m consecutive entries), for sizes in rising order."""
    width = 1
    for m in sizes:
        while width * 2 <= m:
            base = np.minimum(base[:-width], base[width:])
            width *= 2
        yield m, base if width == m else np.minimum(base[: len(base) - (m - width)], base[m - width :])


def scan(column: pa.Array, catalogue: Catalogue) -> tuple[np.ndarray, list[list[tuple[str, int, int, float]]]]:
    """Words of each text, and its verified (license, first word, past the last word, containment)."""
    words = _words(column)
    doc, gram = words.grams(SHINGLE)
    first = np.searchsorted(doc, np.arange(len(column) + 1))
    found: list[list[tuple[str, int, int, float]]] = [[] for _ in range(len(column))]
    by_size: dict[int, list[int]] = {}
    for t, own in enumerate(catalogue.sets):
        by_size.setdefault(len(own), []).append(t)
    sizes = [m for m in sorted(by_size) if m <= len(gram)]
    starts = {m: _starts(first, m) for m in sizes}
    near: dict[int, list[np.ndarray]] = {t: [] for t in range(len(catalogue.sets))}
    count = np.diff(first)
    few = np.flatnonzero((count > 0) & (count < max(by_size)))
    for b in range(BANDS):
        hashed = [mix(gram ^ s) for s in SALTS[b * ROWS : (b + 1) * ROWS]]
        for together in zip(*(_sliding(x, sizes) for x in hashed), strict=True):
            m = together[0][0]
            keys = _band([x if m < 16 else x[starts[m]] for _, x in together])
            for t in by_size[m]:
                hit = np.flatnonzero(keys == catalogue.keys[t][b])
                near[t].append(hit if m < 16 else starts[m][hit])
        if len(few):
            # a text shorter than a template is one window
            keys = _band([np.minimum.reduceat(x, first[:-1][count > 0])[np.searchsorted(np.flatnonzero(count), few)] for x in hashed])
            for t, own in enumerate(catalogue.sets):
                near[t].append(first[:-1][few[(keys == catalogue.keys[t][b]) & (count[few] < len(own))]])
    for t, at in near.items():
        if at:
            _verify(catalogue, t, np.unique(np.concatenate(at)), gram, doc, first, found)
    return words.count, found


def _verify(catalogue: Catalogue, t: int, near: np.ndarray, gram, doc, first, found: list) -> None:
    """Keeps windows with enough of template ``t``. From the first of its shingles
    near a window, the template's length and some slack is looked through, so a
    window that stands early doesn't cut its end off."""
    own, past = catalogue.sets[t], -1
    slack = max(1, len(own) // 8)
    for w in near.tolist():
        row = int(doc[w])
        lo, end = max(int(first[row]), w - slack, past), int(first[row + 1])
        at = np.flatnonzero(np.isin(gram[lo : min(end, w + len(own) + slack)], own))
        if not len(at):
            continue
        hi = min(end, lo + int(at[0]) + len(own) + slack)
        at = np.flatnonzero(np.isin(gram[lo:hi], own))
        share = len(np.unique(gram[lo:hi][at])) / len(own)
        if share >= CONTAINED:
            begin, past = lo + int(at[0]), lo + int(at[-1]) + 1
            found[row].append((catalogue.names[t], begin - int(first[row]), past - int(first[row]) + SHINGLE - 1, share))


def _license_rows(templates: dict[str, str]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        catalogue = Catalogue(templates)
        kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("containment", pa.float64())]))
        for batch in batches:
            for part in chunks(batch, "text", 1 << 19):
                count, found = scan(part.column("text"), catalogue)
                spans = [[dict(zip(("license", "start", "end", "containment"), x, strict=True)) for x in sorted(f, key=lambda x: (x[1], x[0]))] for f in found]
                names = [",".join(sorted({x[0] for x in f})) for f in found]
                yield pa.record_batch([part.column("doc_id"), pa.array(count.astype(np.int64)), pa.array(names, pa.string()), pa.array(spans, kind)], names=["doc_id", "n_words", "licenses", "spans"])

    return rows


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """License notices in every row's whole text (doc_id, text; others ignored).

    Returns doc_id, n_words, licenses (names found, sorted, comma-joined; empty
    where none) and spans (license, start, end in words, containment). Words
    are runs of letters and digits in lower case. A null text and a text of
    fewer than five words have none. Repeated rows get equal results.
    """
    kinds = "doc_id long, n_words long, licenses string, spans array<struct<license:string,start:long,end:long,containment:double>>"
    return docs.select("doc_id", "text").mapInArrow(_license_rows(templates or TEMPLATES), kinds)


def op8_license_scan(spark, sf_dir: str) -> DataFrame:
    return license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
