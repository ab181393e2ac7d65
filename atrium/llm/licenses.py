"""License scans: MinHash bands over overlapping windows retrieve templates, exact containment verifies.

Texts and templates are words (lower case, without punctuation at their ends). Every window of `window`
words, at every word, is a set of two-word shingles; its MinHash signature is cut into bands. A window
that shares a band with a window of a template proposes the template at the place where the two windows
meet. There, the share of the template's distinct shingles that the text holds is counted exactly. A
window and a template's window of similarity s meet with probability 1 - (1 - s^rows)^bands: 1 where
they are equal, 0.9992 at 0.6, which is one changed word at a window's end.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from atrium.llm.shingles import mix64

PUNCTUATION = ".,;:!?\"'()[]{}<>|*#$%&-_/"
#: Notices and body paragraphs of common licenses; each has at least `window` words.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "Apache-1.1": "Licensed under the Apache License, Version 1.1.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-header": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "AGPL-header": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "CC-BY-NC-4.0-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary",
    "MIT-copies": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MIT-rights": "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "MIT-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "BSD-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "BSD-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-3-Clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "BSD-warranty": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "Apache-2.0-disclaimer": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "GPL-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "MPL-2.0-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at",
    "ISC-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
    "BSL-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so",
    "WTFPL": "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.",
}
#: Words that a match must hold, since they tell a license or version from its neighbours.
REQUIRED = {
    "AGPL-3.0": ("affero", "3"),
    "AGPL-header": ("affero",),
    "Apache-1.1": ("apache", "1.1"),
    "Apache-2.0": ("apache", "2.0"),
    "CC-BY-4.0": ("attribution", "4.0"),
    "CC-BY-NC-4.0": ("by-nc", "4.0"),
    "CC-BY-NC-4.0-notice": ("attribution-noncommercial", "4.0"),
    "CC-BY-SA-4.0": ("attribution-sharealike", "4.0"),
    "CC0-1.0": ("waived",),
    "EPL-2.0": ("eclipse", "2.0"),
    "GPL-2.0": ("general", "2"),
    "GPL-3.0": ("general", "3"),
    "GPL-header": ("general",),
    "GPL-warranty": ("general",),
    "LGPL-2.1": ("lesser", "2.1"),
    "LGPL-3.0": ("lesser", "3"),
    "LGPL-header": ("lesser",),
    "MIT": ("mit",),
    "MPL-2.0": ("mozilla", "2.0"),
}
SHINGLE_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
BITS = 20


@dataclass(frozen=True)
class Settings:
    window: int = 5
    bands: int = 16
    rows: int = 2
    containment: float = 0.8


class Words(dict):
    """Hashes of words without case and outer punctuation, 0 for none, at most `keep` at a time."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 400_000:
            self.clear()
        bare = word.lower().strip(PUNCTUATION)
        self[word] = value = xxhash.xxh3_64_intdigest(bare.encode("utf-8", "surrogatepass")) | 1 if bare else 0
        return value

    def of(self, text: str | None) -> np.ndarray:
        words = (text or "").split()
        out = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        return out[out != 0]


def shingles(words: np.ndarray) -> np.ndarray:
    return mix64(words[:-1] * SHINGLE_FACTORS[0] + words[1:] * SHINGLE_FACTORS[1])


def window_bands(pairs: np.ndarray, settings: Settings) -> Iterator[np.ndarray]:
    """Per band the key of every window, given the shingles of a word sequence in order."""
    span = settings.window - 1
    count = len(pairs) - span + 1
    low = (pairs >> np.uint64(32)).astype(np.uint32)
    for band in range(settings.bands):
        key = np.full(count, band + 1, np.uint64)
        for row in range(settings.rows):
            x = low * np.uint32(2 * (band * settings.rows + row) * 0x9E37 + 0x85EBCA6B)
            x ^= x >> np.uint32(15)
            x *= np.uint32(0x2C1B3C6D)
            x ^= x >> np.uint32(16)
            least = x[:count].copy()
            for i in range(1, span):
                np.minimum(least, x[i : i + count], out=least)
            key = key * np.uint64(0x100000001B3) + least
            key ^= key >> np.uint64(29)
        yield key * SHINGLE_FACTORS[0]


def least_cover(at: list[int], values: list[int], near: int) -> tuple[int, int]:
    """The shortest stretch of places (ascending) that holds every distinct value; of equal ones the nearest to `near`."""
    need, held, best, i = len(set(values)), defaultdict(int), None, 0
    for j, value in enumerate(values):
        held[value] += 1
        while held[values[i]] > 1:
            held[values[i]] -= 1
            i += 1
        if len(held) == need:
            size = (at[j] - at[i], abs(at[i] - near), at[i])
            best = min(best, size) if best else size
    return best[2], best[2] + best[0]


class Scanner:
    """Templates with their bands, and the matches of a text."""

    def __init__(self, templates: dict[str, str], settings: Settings = Settings()):
        self.settings, self.words = settings, Words()
        self.names = sorted(templates)
        sequences = [self.words.of(templates[n]) for n in self.names]
        if short := [n for n, s in zip(self.names, sequences) if len(s) < settings.window]:
            raise ValueError(f"templates of fewer than {settings.window} words: {short}")
        self.required = [self.words.of(" ".join(REQUIRED.get(n, ()))) for n in self.names]
        self.lengths = [len(s) for s in sequences]
        self.sets = [np.unique(shingles(s)) for s in sequences]
        # A superset of all templates' shingles by their top bits: what has too few of them near a place needs no exact look.
        self.any = np.zeros(1 << BITS, bool)
        self.any[np.concatenate(self.sets) >> np.uint64(64 - BITS)] = True
        self.where: list[dict[int, list[tuple[int, int]]]] = [defaultdict(list) for _ in range(settings.bands)]
        self.maps = np.zeros((settings.bands, 1 << BITS), bool)
        for t, s in enumerate(sequences):
            for band, keys in enumerate(window_bands(shingles(s), settings)):
                self.maps[band, keys >> np.uint64(64 - BITS)] = True
                for at, key in enumerate(keys.tolist()):
                    self.where[band][key].append((t, at))

    def proposals(self, sequences: list[np.ndarray]) -> dict[int, set[tuple[int, int]]]:
        """For each sequence the (template, first word) that a shared band proposes."""
        out: dict[int, set[tuple[int, int]]] = defaultdict(set)
        window = self.settings.window
        long = [i for i, s in enumerate(sequences) if len(s) >= window]
        if not long:
            return out
        ends = np.cumsum([len(sequences[i]) for i in long])
        flat = np.concatenate([sequences[i] for i in long])
        for band, keys in enumerate(window_bands(shingles(flat), self.settings)):
            for at in np.flatnonzero(self.maps[band][keys >> np.uint64(64 - BITS)]).tolist():
                for t, offset in self.where[band].get(int(keys[at]), ()):
                    n = int(np.searchsorted(ends, at, side="right"))
                    first = int(ends[n - 1]) if n else 0
                    if at + window <= ends[n]:
                        out[long[n]].add((t, at - first - offset))
        return out

    def contained(self, words: np.ndarray, pairs: np.ndarray, before: np.ndarray, t: int, start: int) -> tuple[float, int, int] | None:
        """The template's containment near a place, and the first and last word that take part.

        pairs are the words' shingles, before[i] counts those before i that may be of any template; too few of
        them near the place rule out the containment without an exact look.
        """
        slack = 1 + self.lengths[t] // 4
        low, high = max(0, start - slack), min(len(words), start + self.lengths[t] + slack)
        if (before[max(low, high - 1)] - before[low]) / len(self.sets[t]) < self.settings.containment:
            return None
        here = pairs[low : max(low, high - 1)]
        found = np.isin(here, self.sets[t])
        share = len(np.unique(here[found])) / len(self.sets[t])
        if share < self.settings.containment:
            return None
        first, last = least_cover(np.flatnonzero(found).tolist(), here[found].tolist(), start - low)
        if not np.isin(self.required[t], words[low + first : low + last + 2]).all():
            return None
        return share, low + first, low + last + 1

    def matches(self, words: np.ndarray, proposed: set[tuple[int, int]]) -> list[tuple[str, float, int, int]]:
        """(template, containment, first word, last word) of verified proposals; of overlapping ones the best, whatever its template."""
        pairs = shingles(words)
        before = np.concatenate([[0], np.cumsum(self.any[pairs >> np.uint64(64 - BITS)])])
        found = {(t, *got) for t, start in proposed if (got := self.contained(words, pairs, before, t, start))}
        taken: list[tuple[int, float, int, int]] = []
        for match in sorted(found, key=lambda m: (-m[1], -self.lengths[m[0]], m[3] - m[2], m[2], m[0])):
            if all(match[3] < m[2] or match[2] > m[3] for m in taken):
                taken.append(match)
        out = [(self.names[t], *m) for t, *m in taken]
        return sorted(out, key=lambda m: (m[2], m[0]))


def scan(documents: DataFrame, templates: dict[str, str] = TEMPLATES, settings: Settings = Settings()) -> DataFrame:
    """doc_id and `matches` of every row of (doc_id, text): license, containment, start and end in code points.

    Matches don't overlap, the best one wins; they are in the order of the text. Null and empty texts and
    texts shorter than a window have none; repeated rows and null doc_ids are scanned each; whole texts
    are taken, other columns ignored; an empty table gives an empty result. A template's
    `REQUIRED` words must stand in the match. The templates are a fixed
    table that goes with the task, and nothing is shuffled.
    """
    kind = pa.list_(pa.struct([("license", pa.string()), ("containment", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, settings)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            out: list[list[dict]] = [[] for _ in texts]
            for low, high in parts_of(texts):
                sequences = [scanner.words.of(t) for t in texts[low:high]]
                for i, proposed in scanner.proposals(sequences).items():
                    found = scanner.matches(sequences[i], proposed)
                    if found:
                        spans = [m.span() for m in re.finditer(r"\S+", texts[low + i]) if scanner.words[m[0]]]
                        out[low + i] = [{"license": n, "containment": c, "start": spans[a][0], "end": spans[b][1]} for n, c, a, b in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], names=["doc_id", "matches"])

    return documents.select(documents.doc_id.cast("long").alias("doc_id"), "text").mapInArrow(look, "doc_id long, matches array<struct<license:string,containment:double,start:long,end:long>>")


def parts_of(texts: list[str | None], chars: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about so many characters, which are hashed together."""
    low, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= chars:
            yield low, i + 1
            low, size = i + 1, 0
    if low < len(texts):
        yield low, len(texts)
