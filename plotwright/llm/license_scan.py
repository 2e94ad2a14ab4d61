"""License scans: MinHash bands over overlapping text windows, then exact containment (operator 8).

Every text's words (lower-cased, punctuation dropped) are cut into overlapping windows as long as each size of template.  A
window's MinHash signature over five-word shingles retrieves the templates that share a band with it.  Band settings follow
from the wanted certainty.  A template matches where the share of its shingles that the window holds exactly is ``SIMILAR`` or
more; the window has no more shingles than the template has places for them, so their Jaccard similarity is at least
``JACCARD`` (0.667).  With ``BANDS`` bands of ``ROWS`` rows such a window is retrieved with a probability of at least
``1 - (1 - JACCARD**ROWS) ** BANDS``; here over 0.9999.

Every window is meant, but a window without any shingle of the templates of its size cannot share a band with them, as a band's
rows are hashes of shingles; so signatures are only computed for windows that hold one.  Templates have five words at least; short
license lines are templates like full texts.  The template table has a fixed size, so its bands go out with the function.

Null or empty text matches nothing.  Repeated rows and rows of one id are scanned each; a null id is kept.  Very long texts are
scanned whole.  Of overlapping matches of one template the one with the greatest share stays, the first on a tie.  Extra columns,
also ones whose names clash, are ignored.  Empty table: no rows.
"""

from __future__ import annotations

import bisect
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .tables import only

SHINGLE, SIMILAR = 5, 0.8
#: The least Jaccard similarity of a match whose shingles are all different.
JACCARD = SIMILAR / (2 - SIMILAR)
BANDS, ROWS = 48, 4
SEED = 11
#: Windows whose signatures are computed at once.
STEP = 4096

_WORD = re.compile(r"[0-9a-z]+(?:[.'-][0-9a-z]+)*")

# Fixed texts that several licenses share.
_AS_IS_MIT = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
_AS_IS_ISC = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_AS_IS_BSD = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'

#: Well-known license lines, notices and texts (fixed texts, by their public identifiers).
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. ' + _AS_IS_MIT),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("BSD-2-Clause", f"{_BSD} {_AS_IS_BSD}"),
    ("BSD-3-Clause", f"{_BSD} {_BSD_NAMES} {_AS_IS_BSD}"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", f"Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. {_AS_IS_ISC}"),
    ("0BSD", f"Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. {_AS_IS_ISC}"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law."),
)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def shingles(words: list[str]) -> list[str]:
    return [" ".join(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))] if words else []


@functools.cache
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1), rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def _hashes(items: list[str]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, items), np.uint64, len(items))


def _mixed(hashes: np.ndarray) -> np.ndarray:
    """Each hash under each permutation: (permutation, hash)."""
    a, b = _permutations()
    x = hashes[None, :] * a[:, None] + b[:, None]
    return x ^ x >> np.uint64(32)


class Templates:
    """Band keys -> templates, and every template's exact shingles, by the template's length in words."""

    def __init__(self, templates: tuple[tuple[str, str], ...] = TEMPLATES):
        self.names = [n for n, _ in templates]
        words = [words_of(t) for _, t in templates]
        if any(len(w) < SHINGLE for w in words):
            raise ValueError(f"a template has fewer than {SHINGLE} words")
        self.sizes = sorted({len(w) for w in words})
        self.shingles = [frozenset(shingles(w)) for w in words]
        self.hashes = {n: np.unique(np.concatenate([_hashes(sorted(s)) for s, w in zip(self.shingles, words, strict=True) if len(w) == n])) for n in self.sizes}
        self.any_hash = np.unique(np.concatenate(list(self.hashes.values())))
        self.bands: dict[tuple[int, int, bytes], list[int]] = {}
        for t, w in enumerate(words):
            signature = _mixed(_hashes(sorted(self.shingles[t]))).min(axis=1)
            for k in range(BANDS):
                self.bands.setdefault((len(w), k, signature[k * ROWS : (k + 1) * ROWS].tobytes()), []).append(t)

    def find(self, text: str | None) -> list[tuple[int, int, int, float]]:
        """(template, first word, words, containment) of the best window of each match, in order; matches of one template do not overlap."""
        words = words_of(text or "")
        if len(words) < SHINGLE:
            return []
        every = _hashes(shingles(words))
        found: dict[int, set[tuple[float, int, int]]] = {}
        if not np.isin(every, self.any_hash).any():
            return []
        for size in self.sizes:
            hot = np.nonzero(np.isin(every, self.hashes[size]))[0]
            if not len(hot):
                continue
            per = min(size - SHINGLE + 1, len(every))
            starts = np.unique(np.clip((hot[:, None] - np.arange(per)[None, :]).ravel(), 0, len(every) - per))
            step = max(1, STEP // per)
            for at in range(0, len(starts), step):
                part = starts[at : at + step]
                held = every[part[:, None] + np.arange(per)]
                signature = _mixed(held.ravel()).reshape(BANDS * ROWS, len(part), per).min(axis=2).T
                for i, start in enumerate(part.tolist()):
                    row = np.ascontiguousarray(signature[i])
                    near = {t for k in range(BANDS) for t in self.bands.get((size, k, row[k * ROWS : (k + 1) * ROWS].tobytes()), ())}
                    for t in near:
                        width = per + SHINGLE - 1
                        share = len(self.shingles[t] & set(shingles(words[start : start + width]))) / len(self.shingles[t])
                        if share >= SIMILAR:
                            found.setdefault(t, set()).add((-share, start, width))
        out = []
        for t, hits in found.items():
            taken: list[int] = []  # beginnings in order; all hits of a template are equally long
            for share, start, width in sorted(hits):
                k = bisect.bisect_left(taken, start)
                if (k == 0 or taken[k - 1] + width <= start) and (k == len(taken) or start + width <= taken[k]):
                    taken.insert(k, start)
                    out.append((t, start, width, -share))
        return sorted(out, key=lambda m: (m[1], -m[2], m[0]))


@functools.cache
def templates() -> Templates:
    return Templates()


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_matches, licenses (identifiers in order, joined by commas) and matches (identifier:first word:words:share)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = templates()
        for batch in batches:
            got = [known.find(t.as_py()) for t in batch.column(1)]
            names = [",".join(dict.fromkeys(known.names[m[0]] for m in ms)) for ms in got]
            said = [",".join(f"{known.names[t]}:{a}:{n}:{share:.4f}" for t, a, n, share in ms) for ms in got]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array([len(ms) for ms in got], pa.int64()), pa.array(names, pa.string()), pa.array(said, pa.string())], names=["doc_id", "n_matches", "licenses", "matches"])

    return only(docs, "doc_id", "text").mapInArrow(run, "doc_id long, n_matches long, licenses string, matches string")
