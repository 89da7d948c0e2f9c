"""License scans: MinHash bands over overlapping windows, then exact containment (operator 3).

Templates are grouped by length; a class of up to L words uses windows of 2 L words every
L words, so that any occurrence lies whole in some window. A band is one minwise token.
The number of bands of a class follows from the least possible similarity of a window and
a template in it: a whole occurrence is missed with a probability of at most MISS. A window
that shares a band with a template is verified on the exact share of the template's
5-word shingles. Texts are scanned row by row, without a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeframe.llm import textops
from cladeframe.session import read_table

SHINGLE = 5
MISS = 1e-4
CONTAINED = 80  # per cent of a template's shingles
CLASSES = (5, 8, 12, 32, 128, 256, 512)

# Licenses and notices as their publishers word them.
_MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_BSD_TERMS = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_WAIVER = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        _MIT,
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        f"{_BSD_TERMS} {_BSD_NAMES} {_BSD_WAIVER}",
    ),
    "BSD-2-Clause": (f"{_BSD_TERMS} {_BSD_WAIVER}",),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.",
    ),
    "LGPL-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    "AGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty.",
        "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law, including all related and neighboring rights, to the extent allowed by law.",
    ),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
}

_U = np.uint64
#: Letters and digits of ASCII and all other bytes stay; the rest parts words.
_WORD = np.full(256, 32, np.uint8)
for _c in (*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)):
    _WORD[_c] = _c


class Bands:
    """The templates of one length class, as minwise tokens and shingle sets."""

    def __init__(self, words: int, templates: list[tuple[str, np.ndarray]]):
        self.words, self.names, self.sets = words, [n for n, _ in templates], [np.unique(s) for _, s in templates]
        least = min(len(s) for s in self.sets) * CONTAINED / 100
        share = min(1.0, max(1.0, math.floor(least)) / (2 * words - SHINGLE + 1))
        self.bands = max(1, math.ceil(math.log(MISS) / math.log(1 - share))) if share < 1 else 1
        self.seeds = np.random.default_rng(words).integers(1, 2**62, self.bands, dtype=np.uint64) * _U(2) + _U(1)
        self.least = [[int(((s * k) >> _U(32)).min()) for k in self.seeds] for s in self.sets]

    def retrieve(self, h: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int]]:
        """(row, template, first shingle of the window), each where any band agrees."""
        n = np.diff(first)
        per = -(-n // self.words)
        row = np.repeat(np.arange(len(n)), per)
        start = first[:-1][row] + self.words * (np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per))
        end = np.minimum(start + 2 * self.words - SHINGLE + 1, first[1:][row])
        if not len(start):
            return []
        spans = np.stack([start, np.minimum(end, len(h) - 1)], 1).ravel()
        tail = end == len(h)  # reduceat can't end beyond the last element, so that one is added
        hit = np.zeros((len(self.sets), len(start)), bool)
        for c, k in enumerate(self.seeds):
            x = (h * k) >> _U(32)
            least = np.minimum.reduceat(x, spans)[::2]
            least[tail] = np.minimum(least[tail], x[-1])
            for t in range(len(self.sets)):
                hit[t] |= least == self.least[t][c]
        return [(int(row[w]), t, int(start[w])) for t, w in zip(*np.nonzero(hit))]


def compile_templates(templates: dict[str, tuple[str, ...]] = TEMPLATES) -> list[Bands]:
    classes: dict[int, list] = {}
    for name, texts in templates.items():
        for text in texts:
            words = _words(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
            shingles, _ = textops.windows(words, SHINGLE, short=True)
            size = next((c for c in CLASSES if c >= len(words.hash)), len(words.hash))
            if len(words.hash) >= SHINGLE:
                classes.setdefault(size, []).append((name, shingles))
    return [Bands(size, some) for size, some in sorted(classes.items())]


def _words(buf: np.ndarray, offs: np.ndarray) -> textops.Words:
    return textops.Words(_WORD[buf], offs, True)


def scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES) -> DataFrame:
    """doc_id, matches: array<struct<license, start, end, contained>> in order of start.

    A match is a window of which a template's shingles are contained to CONTAINED per cent
    or more; start and end are the words from its first shingle to its last, contained the
    rounded-down per cent. Matches of one license that overlap are one, with the best share.
    One row per row of docs, null and repeated ids too; null texts have no matches. Other
    columns are ignored. Templates of fewer than 5 words are not looked for.
    """
    classes = compile_templates(templates)
    kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("contained", pa.int32())]))

    def verify(b: Bands, h: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, tuple]]:
        for row, t, start in b.retrieve(h, first):
            # Half a window more on either side, for occurrences with words put in.
            lo, hi = max(int(first[row]), start - b.words), min(int(first[row + 1]), start + 3 * b.words)
            own = np.flatnonzero(np.isin(h[lo:hi], b.sets[t]))
            share = 100 * len(np.unique(h[lo:hi][own])) // len(b.sets[t])
            if share >= CONTAINED:
                yield row, (b.names[t], lo + int(own[0]) - int(first[row]), lo + int(own[-1]) - int(first[row]) + SHINGLE, share)

    def merged(found: list[tuple]) -> list[dict]:
        out: list[list] = []
        for name, s, e, share in sorted(set(found)):
            if out and out[-1][0] == name and s < out[-1][2]:
                out[-1][2], out[-1][3] = max(e, out[-1][2]), max(share, out[-1][3])
            else:
                out.append([name, s, e, share])
        return [dict(zip(("license", "start", "end", "contained"), x)) for x in sorted(out, key=lambda x: (x[1], x[2], x[0]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, offs in textops.slices(b.column(1)):
                h, first = textops.windows(_words(buf, offs), SHINGLE)
                found: list[list] = [[] for _ in range(j - i)]
                for bands in classes:
                    for row, match in verify(bands, h, first):
                        found[row].append(match)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array([merged(x) for x in found], kind)], names=["doc_id", "matches"])

    schema = "doc_id long, matches array<struct<license:string,start:int,end:int,contained:int>>"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def op3_license_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(read_table(spark, sf_dir, "documents"))
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))
    spans = F.transform("matches", lambda m: F.concat_ws(":", m["license"], m["start"].cast("string"), m["end"].cast("string"), m["contained"].cast("string")))
    return found.select("doc_id", F.size("matches").cast("long").alias("n_matches"), F.concat_ws(",", names).alias("licenses"), F.concat_ws(",", spans).alias("spans"))


QUERIES = {"op3_license_bands": op3_license_bands}
ORACLES: dict[str, str] = {}
