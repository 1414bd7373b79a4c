"""License scans: which license templates a text contains, and where.

Texts are cut into overlapping windows of shingles (five words). A window's MinHash signature is split into bands, and
a template becomes a candidate where one band of it equals one of the window's. The number of bands follows from the
smallest similarity that a window around a true match can have, so that the chance to miss it stays below `miss`.
Candidates are verified on the words themselves: a match needs 0.8 of the template's shingles.

Every text is scanned in the task that reads it; nothing is shuffled, and what tasks receive are the templates alone.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .common import arrow_map

SHINGLE, CONTAINMENT, ROWS, MISS = 5, 0.8, 2, 1e-6
#: Templates are sent to the tasks in groups of at most so many bytes, one scan a group.
GROUP_BYTES = 4 << 20
#: Texts are looked through in blocks of so many words, which bounds the arrays of very long ones.
BLOCK = 1 << 18
_MEMO, _MEMO_WORD = 1 << 18, 64
_EDGES = bytes(i for i in range(128) if not chr(i).isalnum())
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_MUL, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

# Notices and license texts as their publishers give them.
TEMPLATES: dict[str, str] = {
    "MIT notice": "Released under the MIT License.",
    "MIT notice, licensed": "Licensed under the MIT License.",
    "MIT notice, project": "This project is licensed under the MIT License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0 notice": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0 header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "MPL-2.0 header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "CC BY 4.0 notice": "Licensed under CC BY 4.0.",
    "CC BY-SA 4.0 notice": "Licensed under CC BY-SA 4.0.",
    "CC BY-NC 4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC BY 4.0 sentence": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC BY-SA 4.0 sentence": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC BY-NC 4.0 sentence": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
}


def plain(word: bytes) -> bytes:
    """A word with A-Z lower-cased and ASCII signs at its ends cut off."""
    return word.lower().strip(_EDGES)


def bands_for(similarity: float, rows: int = ROWS, miss: float = MISS) -> int:
    """The number of bands with which a pair of at least this similarity is missed with a chance of at most `miss`."""
    return 1 if similarity >= 1 else math.ceil(math.log(miss) / math.log1p(-(similarity**rows)))


class _Hashes(dict):
    """Word -> 64-bit hash of its plain form, 0 where nothing is left; it remembers a bounded number of short words."""

    def __missing__(self, word: bytes) -> int:
        p = plain(word)
        h = (xxhash.xxh64_intdigest(p) or 1) if p else 0
        if len(word) <= _MEMO_WORD:
            if len(self) >= _MEMO:
                self.clear()
            self[word] = h
        return h


def _shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    n = len(words) - k + 1
    if n < 1:
        return np.empty(0, np.uint64)
    h = words[:n].copy()
    for i in range(1, k):
        h *= _MUL
        h += words[i : i + n]
    h ^= h >> np.uint64(32)
    h *= _MIX
    return h ^ (h >> np.uint64(29))


class TemplateIndex:
    """Band tables of the templates. Those of similar length share a class of windows: `width` shingles wide, a window
    every `stride`, so wide that each span which can hold a match lies within one window of the class."""

    def __init__(self, templates: Mapping[str, str], k: int = SHINGLE, containment: float = CONTAINMENT, rows: int = ROWS, miss: float = MISS) -> None:
        self.k, self.rows, self.names = k, rows, list(templates)
        hashes = _Hashes()
        self.shingles, self.need, self.span, self.hashes = [], [], [], []
        classes = defaultdict(list)
        for t, text in enumerate(templates.values()):
            words = [p for w in text.encode().split() if (p := plain(w))]
            if len(words) < k:
                raise ValueError(f"a template needs at least {k} words: {self.names[t]}")
            places = defaultdict(list)
            for i in range(len(words) - k + 1):
                places[tuple(words[i : i + k])].append(i)
            self.shingles.append(dict(places))
            self.hashes.append(np.unique(_shingle_hashes(np.array([hashes[w] for w in words], np.uint64), k)))
            n = len(self.shingles[t])
            self.need.append(math.ceil(containment * n - 1e-9))
            self.span.append(max(n + n // 4, len(words) - k + 1))
            width, stride = 1, 1
            while width - stride + 1 < self.span[t]:
                width += max(1, width // 5)
                stride = max(1, width // 8)
            classes[width, stride].append(t)
        self.classes = []
        most = 0
        for (width, stride), members in sorted(classes.items()):
            similarity = min(self.need[t] / (len(self.shingles[t]) + width - self.need[t]) for t in members)
            bands = bands_for(similarity, rows, miss)
            most = max(most, bands * rows)
            self.classes.append((width, stride, bands, members))
        r = np.random.default_rng(42)  # fixed, so that reruns agree
        self._xor, self._odd = r.integers(0, 1 << 63, most, np.uint64), r.integers(0, 1 << 63, most, np.uint64) * np.uint64(2) + np.uint64(1)
        self.tables, self.keys = [], []
        for width, stride, bands, members in self.classes:
            table = defaultdict(list)
            for t in members:
                for key in self._bands(self.hashes[t], bands):
                    table[key].append(t)
            self.tables.append(dict(table))
            self.keys.append(np.unique(np.concatenate([self.hashes[t] for t in members])))
        self._quick = np.zeros(1 << 16, bool)
        for keys in self.keys:
            self._quick[(keys >> np.uint64(48)).astype(np.int64)] = True

    def _bands(self, h: np.ndarray, bands: int) -> list[tuple]:
        n = bands * self.rows
        x = (h[None, :] ^ self._xor[:n, None]) * self._odd[:n, None]
        least = (x ^ (x >> np.uint64(32))).min(1).tolist()
        return [(b, *least[b * self.rows : (b + 1) * self.rows]) for b in range(bands)]

    def candidates(self, h: np.ndarray) -> set[int]:
        """Templates that share a band with some window over h, a text's shingle hashes in their order.

        Signatures are worked out for windows that hold at least one shingle of the class's templates: any other
        window has similarity 0 with all of them and can agree in no band.
        """
        at = np.flatnonzero(self._quick[(h >> np.uint64(48)).astype(np.int64)])
        found: set[int] = set()
        if not len(at):
            return found
        for (width, stride, bands, members), table, keys in zip(self.classes, self.tables, self.keys):
            hits = at[keys[np.minimum(np.searchsorted(keys, h[at]), len(keys) - 1)] == h[at]]
            if not len(hits):
                continue
            last = hits // stride
            first = np.maximum(-(-(hits - width + 1) // stride), 0)
            starts = np.unique(np.concatenate([np.minimum(first + i, last) for i in range(-(-width // stride) + 1)])) * stride
            for s in starts.tolist():
                if found.issuperset(members):
                    break
                for key in self._bands(h[s : s + width], bands):
                    found.update(table.get(key, ()))
        return found

    def spans(self, t: int, h: np.ndarray, words: list[bytes]) -> list[tuple[int, int, int]]:
        """(first word, word after the last, different shingles found) of template t's matches, by the words themselves.

        From the left, without overlap: from a shingle of the template on, within as many shingles as the template
        has and a quarter more, those that follow each other as in the template; it is a match where these hold enough
        of the template's, and ends where they do. Of starts within a match the one that finds most counts, of equal
        ones the first, so that the beginning of a cut copy can be taken as that of a whole one after it. Between such matches the order is not asked for: moved
        paragraphs count too. Shingles of the template that follow within the span and begin no match belong to it.
        """
        k, wanted, keys, need, span = self.k, self.shingles[t], self.hashes[t], self.need[t], self.span[t]
        at = np.flatnonzero(keys[np.minimum(np.searchsorted(keys, h), len(keys) - 1)] == h).tolist()
        hits = [(p, s) for p in at if (s := tuple(words[p : p + k])) in wanted]
        starts = [i for i, _ in self._dense(hits, 0, len(hits), span, need)]
        runs, i = [], 0
        while i < len(starts):
            first = starts[i]
            i += 1
            if runs and first < runs[-1][1]:
                continue
            best = self._run(hits, first, wanted, span)
            if best[1] < need:
                continue
            begin, j = first, i
            while j < len(starts) and starts[j] < best[0]:
                other = self._run(hits, starts[j], wanted, span)
                if other[1] > best[1]:
                    begin, best = starts[j], other
                j += 1
            runs.append((begin, best[0]))
        out, free = list(runs), 0
        for begin, end in [*runs, (len(hits), len(hits))]:
            for first, last in self._dense(hits, free, begin, span, need):
                if first >= free:
                    out.append((first, last))
                    free = last
            free = end
        out.sort()
        for n, (a, b) in enumerate(out):
            stop = out[n + 1][0] if n + 1 < len(out) else len(hits)
            while b < stop and hits[b][0] < hits[a][0] + span:
                b += 1
            out[n] = (a, b)
        return [(hits[a][0], hits[b - 1][0] + k, len({s for _, s in hits[a:b]})) for a, b in out]

    @staticmethod
    def _dense(hits: list[tuple], a: int, b: int, span: int, need: int) -> list[tuple[int, int]]:
        """(start, end) for every start in hits[a:b] whose span holds enough different shingles; it ends after the last new one."""
        out, inside, j = [], Counter(), a
        for i in range(a, b):
            while j < b and hits[j][0] < hits[i][0] + span:
                inside[hits[j][1]] += 1
                j += 1
            if len(inside) >= need:
                firsts = {}
                for n in range(i, j):
                    firsts.setdefault(hits[n][1], n)
                out.append((i, max(firsts.values()) + 1))
            inside[hits[i][1]] -= 1
            if not inside[hits[i][1]]:
                del inside[hits[i][1]]
        return out

    @staticmethod
    def _run(hits: list[tuple], i: int, wanted: Mapping[tuple, list[int]], span: int) -> tuple[int, int]:
        """(end, different shingles up to there) of the longest run of hits from i on in the template's order."""
        first = wanted[hits[i][1]][0]
        ends, end, j = [first], i + 1, i + 1
        while j < len(hits) and hits[j][0] < hits[i][0] + span:
            for p in reversed(wanted[hits[j][1]]):
                if p > first:
                    n = bisect_left(ends, p)
                    if n == len(ends):
                        ends.append(p)
                        end = j + 1
                    else:
                        ends[n] = p
            j += 1
        return end, len({s for _, s in hits[i:end]})

    def scan(self, text: bytes, memo: dict | None = None) -> Iterator[tuple[int, int, int, int]]:
        """(template, start byte, end byte, different shingles found) of every match in the whole text."""
        memo = _Hashes() if memo is None else memo
        raw = text.split()  # of bytes: ASCII white space
        every = np.fromiter(map(memo.__getitem__, raw), np.uint64, len(raw))
        there = np.flatnonzero(every)
        h = _shingle_hashes(every[there], self.k)
        found: set[int] = set()
        overlap = max(w for w, *_ in self.classes) + max(s for _, s, *_ in self.classes)
        for a in range(0, len(h), BLOCK):
            found |= self.candidates(h[a : a + BLOCK + overlap])
        if not found:
            return
        words = [plain(raw[i]) for i in there.tolist()]
        places = None
        for t in sorted(found):
            for a, b, n in self.spans(t, h, words):
                if places is None:
                    places = [m.span() for m in _WORD.finditer(text)]
                yield t, places[there[a]][0], places[there[b - 1]][1], n


def _groups(templates: Mapping[str, str], most: int) -> list[dict[str, str]]:
    groups, used = [{}], 0
    for name, text in templates.items():
        if groups[-1] and used + len(text.encode()) > most:
            groups.append({})
            used = 0
        groups[-1][name] = text
        used += len(text.encode())
    return groups


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text", group_bytes: int = GROUP_BYTES, **how) -> DataFrame:
    """One row per match: id, license, start_byte and end_byte (in the text's UTF-8), found and shingles (different
    ones: found here, and of the template), containment, matched (the span itself).

    A text may match several templates and one template several times, without overlap. Null and empty texts and
    those of fewer than five words match nothing; a null id stays null; repeated rows are reported once each; other
    columns are ignored. No templates or no rows give an empty result. A template of fewer than five words is an error.
    how: k, containment, rows, miss (TemplateIndex).
    """
    schema = f"{id_col} long, license string, start_byte long, end_byte long, found int, shingles int, containment double, matched string"
    if not templates:
        return docs.sparkSession.createDataFrame([], schema)
    out = None
    for group in _groups(templates, group_bytes):
        index = TemplateIndex(group, **how)

        def run(batches: Iterator[pa.RecordBatch], index: TemplateIndex = index) -> Iterator[pa.RecordBatch]:
            memo = _Hashes()
            for b in batches:
                ids, rows = b.column(0).to_pylist(), []
                for i, text in zip(ids, b.column(1).cast(pa.large_binary())):
                    text = text.as_py() or b""
                    for t, start, end, n in index.scan(text, memo):
                        of = len(index.shingles[t])
                        rows.append((i, index.names[t], start, end, n, of, n / of, text[start:end].decode()))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names=names)

        names = [id_col, "license", "start_byte", "end_byte", "found", "shingles", "containment", "matched"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.string()]
        part = arrow_map(docs.select(docs[id_col].cast("long").alias(id_col), docs[text_col].alias("_text")), run, schema)
        out = part if out is None else out.unionByName(part)
    return out
