"""Licence scans: Dice coefficient over word bigrams of normalised text against templates.

Text is lower-cased and everything but letters, digits and single full stops inside numbers
becomes a blank. The units compared are each line, each paragraph (lines up to a blank line),
the whole text, and for a licence that none of these shows, the windows of as many words as a
template that begin at a word pair of it. So a notice inside prose is found as well as a licence file. With
threshold t, Dice 2|A n B| / (|A| + |B|) can reach t only if t / (2 - t) <= |A| / |B| <=
(2 - t) / t; the sorted template sizes give the templates within those bounds, and the shared
bigrams are counted for these alone, through a table from bigram to templates.

Templates are notices and whole texts of short licences; others can be given, long texts too.
Bigram sets, so repeated bigrams count once; a unit of one word has its word as its only
gram. Null or empty text matches nothing. Equal scores go to the longer template, then the
first name. Repeated rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from arborlens.llm.common import fresh, in_chunks

WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*")

# Conditions and disclaimers that several licences share.
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC_START = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""

# The notices by which works name their licence, and whole texts of short licences.
TEMPLATES = {
    "MIT": [
        f"MIT License\n{_MIT}",
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "ISC": [f"{_ISC_START}, provided that the above copyright notice and this permission notice appear in all copies.\n{_ISC_END}"],
    "0BSD": [f"{_ISC_START}.\n{_ISC_END}"],
    "Zlib": [_ZLIB],
    "BSD-2-Clause": [f"{_BSD}\n{_BSD_END}"],
    "BSD-3-Clause": [f"{_BSD}\n{_BSD_THIRD}\n{_BSD_END}", "Licensed under the BSD 3-Clause License.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "LicenseRef-All-Rights-Reserved": ["All rights reserved."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
#: Licences whose terms bind derived works or forbid commercial use.
RESTRICTIVE = ("GPL-3.0", "GPL-2.0", "LGPL-3.0", "AGPL-3.0", "MPL-2.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "LicenseRef-All-Rights-Reserved")


def grams(words: list[str]) -> set[tuple[str, ...]]:
    return set(zip(words, words[1:], strict=False)) if len(words) > 1 else {tuple(words)} if words else set()


def normalise(text: str) -> list[str]:
    return WORD.findall(text.lower())


class LicenceMatcher:
    def __init__(self, templates: dict[str, list[str]], threshold: float = 0.8):
        if not 0 < threshold <= 1:
            raise ValueError("threshold must be over 0 and at most 1")
        self.threshold = threshold
        made = sorted((len(g), name, len(w), g) for name, texts in templates.items() for x in texts if (g := grams(w := normalise(x))))
        self.sizes, self.names, self.words = ([m[i] for m in made] for i in range(3))
        self.holding: dict[tuple[str, ...], list[int]] = {}
        for k, (_, _, _, g) in enumerate(made):
            for x in sorted(g):
                self.holding.setdefault(x, []).append(k)
        self.low, self.high = threshold / (2 - threshold), (2 - threshold) / threshold
        self.most_words = int(self.sizes[-1] * self.high) + 1 if made else 0

    def unit(self, words: list[str]) -> list[tuple[str, float, int]]:
        """Licences that reach the threshold: name, Dice, template size."""
        g = grams(words)
        a, b = bisect_left(self.sizes, len(g) * self.low - 1e-9), bisect_right(self.sizes, len(g) * self.high + 1e-9)
        if a >= b or not g:
            return []
        shared = Counter(k for x in g for k in self.holding.get(x, ()) if a <= k < b)
        return [(self.names[k], d, self.sizes[k]) for k, n in shared.items() if (d := 2 * n / (len(g) + self.sizes[k])) >= self.threshold]

    def units(self, text: str) -> Iterator[list[str]]:
        """Words of each line, of each paragraph of several lines, and of the whole text (last, if there are words)."""
        every: list[str] = []
        for paragraph in re.split(r"\n[^\S\n]*\n", text):
            lines = [w for line in paragraph.split("\n") if (w := normalise(line))]
            yield from lines
            words = [x for w in lines for x in w]
            if len(lines) > 1:
                yield words
            every += words
        if every:
            yield every

    def windows(self, words: list[str], known: set[str]) -> Iterator[tuple[str, float, int]]:
        """For licences not known, the windows of as many words as a template has that begin at a word pair of it and reach the threshold: name, Dice, template size. Windows that would pass the end are moved back."""
        places: dict[int, list[int]] = {}
        for i, pair in enumerate(zip(words, words[1:], strict=False)):
            for k in self.holding.get(pair, ()):
                places.setdefault(k, []).append(i)
        for k, at in places.items():
            size, n = self.sizes[k], self.words[k]
            # as many pairs must be shared as the size bound lets the smallest window have
            if self.names[k] in known or n < 2 or n > len(words) or len(at) < size * self.low - 1e-9:
                continue
            for i in at:
                start = min(i, len(words) - n)
                if bisect_left(at, start + n - 1) - bisect_left(at, start) < size * self.low - 1e-9:
                    continue
                g = grams(words[start : start + n])
                shared = sum(k in self.holding.get(x, ()) for x in g)
                if (d := 2 * shared / (len(g) + size)) >= self.threshold:
                    yield self.names[k], d, size

    def scan(self, text: str | None) -> list[tuple[str, float, int]]:
        """The best match of each licence found in the text: name, Dice and number of units (1 for one that only windows show); best first."""
        best: dict[str, tuple[float, int]] = {}
        count: Counter = Counter()
        words: list[str] = []
        last = None
        for words in self.units(text or ""):
            if words != last:  # a text of one paragraph or line is one unit
                for name, dice, size in self.unit(words):
                    best[name] = max(best.get(name, (0.0, 0)), (dice, size))
                    count[name] += 1
            last = words
        for name, dice, size in self.windows(words, set(best)):
            best[name] = max(best.get(name, (0.0, 0)), (dice, size))
            count[name] = 1
        return [(n, d, count[n]) for n, (d, size) in sorted(best.items(), key=lambda x: (-x[1][0], -x[1][1], x[0]))]


def scan(docs: DataFrame, templates: dict[str, list[str]] | None = None, threshold: float = 0.8, text: str = "text") -> DataFrame:
    """docs with license_id (null: none), dice, n_license_units, license_ids (all found, in order of name) and restrictive; names that clash get a leading underscore."""
    names = [fresh(docs.columns, x) for x in ("license_id", "dice", "n_license_units", "license_ids", "restrictive")]
    kinds = [T.StringType(), T.DoubleType(), T.LongType(), T.ArrayType(T.StringType()), T.BooleanType()]
    schema = T.StructType([*docs.schema.fields, *map(T.StructField, names, kinds)])
    matcher = LicenceMatcher(TEMPLATES if templates is None else templates, threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in in_chunks(batches, text):
            got = [matcher.scan(x) for x in texts]
            columns = [
                pa.array([g[0][0] if g else None for g in got], pa.string()),
                pa.array([g[0][1] if g else 0.0 for g in got], pa.float64()),
                pa.array([sum(x[2] for x in g) for g in got], pa.int64()),
                pa.array([sorted(x[0] for x in g) for g in got], pa.list_(pa.string())),
                pa.array([any(x[0] in RESTRICTIVE for x in g) for g in got], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=schema.names)

    return docs.mapInArrow(run, schema)
