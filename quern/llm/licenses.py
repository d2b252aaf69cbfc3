"""License notices in texts by patience alignment.

Text and template are sequences of words (letters, digits and dots inside; lower case). Equal words at both ends match
first; words unique to both text and template are anchors, of which the longest run that ascends in both is taken; the
gaps between anchors are aligned in the same way. Coverage is the share of the template's words that match, density the
share of the text's span that does. Regions to align are found by the words that a template has: maximal stretches of
the text in which no more than GAP words in a row are foreign to it, and stretches made of all windows that hold COVERAGE
of the template's words within the longest span that DENSITY allows, whatever stands between."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text_arrays import U64, Words, slices, string_buffers

GAP = 2
COVERAGE, DENSITY = 0.8, 0.6

# Wording of public license notices.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "mit-line": "Released under the MIT License.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd-2-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "0bsd": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "bsd-3-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "gpl-2.0-notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl-2.1-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "agpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "epl-2.0-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "cc-by-sa-4.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "boost-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",
}

_KEEP = np.full(256, 32, np.uint8)
_KEEP[48:58] = np.arange(48, 58)
_KEEP[97:123] = np.arange(97, 123)
_KEEP[128:] = np.arange(128, 256)


def word_hashes(column: pa.Array) -> Words:
    data, offsets = string_buffers(pc.utf8_lower(column))
    kept = _KEEP[data]
    n = len(data)
    if n > 2:
        digit = (data >= 48) & (data <= 57)
        dots = np.flatnonzero((data[1:-1] == 46) & digit[:-2] & digit[2:]) + 1
        inner = dots[~np.isin(dots, offsets) & ~np.isin(dots + 1, offsets)]
        kept[inner] = 46
    return Words(kept, offsets, lower=False)


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Positions (in a, in b) matched, ascending in both."""
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
        once_a, once_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        where = {b[j]: j for j in range(b0, b1) if once_b[b[j]] == 1}
        pairs = [(i, where[a[i]]) for i in range(a0, a1) if once_a[a[i]] == 1 and a[i] in where]
        anchors = ascending(pairs)
        if not anchors:
            continue
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        out += anchors
        todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:], strict=False)]
    return sorted(out)


def ascending(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest run of pairs, given in order of the first, that ascends in the second, by patience sorting."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        back.append(piles[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(j)
            piles.append(k)
        else:
            tops[pile], piles[pile] = j, k
    out = []
    k = piles[-1] if piles else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def coverage(region: list[int], template: list[int]) -> tuple[float, float, int, int]:
    """Best coverage, its density, and the first and last matched word. Unmatched words at either end of the region
    don't count, nor do single matches that lie far from the rest."""
    best = (0.0, 0.0, 0, 0)
    start = 0
    while start < len(region):
        matched = patience(region[start:], template)
        if not matched:
            break
        # the densest stretch of matches: drop outer matches across gaps wider than the template
        positions = [i for i, _ in matched]
        lo, hi = 0, len(positions) - 1
        while hi > lo and (positions[hi] - positions[lo] + 1 > 2 * len(template) or (hi - lo >= COVERAGE * len(template) and hi - lo + 1 < DENSITY * (positions[hi] - positions[lo] + 1))):
            if positions[lo + 1] - positions[lo] >= positions[hi] - positions[hi - 1]:
                lo += 1
            else:
                hi -= 1
        n, span = hi - lo + 1, positions[hi] - positions[lo] + 1
        found = (n / len(template), n / span, start + positions[lo], start + positions[hi])
        best = max(best, found, key=lambda x: (enough(x), x[0] * x[1], -x[2]))
        if enough(best) or hi + 1 >= len(positions):
            break
        start += positions[lo] + 1
    return best if enough(best) else max(best, every_span(region, template), key=lambda x: (enough(x), x[0] * x[1], -x[2]))


def every_span(region: list[int], template: list[int]) -> tuple[float, float, int, int]:
    """The first span of a region whose alignment is enough, for regions whose own is not: words beside a notice can take
    anchors from it. Only spans are aligned whose longest common subsequence with the template allows it, which the bits of
    an integer give for all ends of a start in one sweep."""
    places: dict[int, int] = {}
    for k, word in enumerate(template):
        places[word] = places.get(word, 0) | 1 << k
    whole, need, longest = (1 << len(template)) - 1, COVERAGE * len(template), int(len(template) / DENSITY + 1e-9)
    for first, word in enumerate(region):
        if word not in places or len(region) - first < need:
            continue
        left = whole
        for last in range(first, min(first + longest, len(region))):
            mask = places.get(region[last])
            if mask is None:
                continue
            both = left & mask
            left = ((left + both) | (left - both)) & whole
            common = len(template) - left.bit_count()
            if common >= need - 1e-9 and common >= DENSITY * (last - first + 1):
                matched = patience(region[first : last + 1], template)
                span = matched[-1][0] - matched[0][0] + 1 if matched else 1
                found = (len(matched) / len(template), len(matched) / span, first + matched[0][0], first + matched[-1][0]) if matched else (0.0, 0.0, 0, 0)
                if enough(found):
                    return found
    return (0.0, 0.0, 0, 0)


def enough(found: tuple[float, float, int, int]) -> bool:
    return found[0] >= COVERAGE and found[1] >= DENSITY


def regions(mine: np.ndarray, need: float, length: int) -> Iterator[tuple[int, int]]:
    """First and last word of the stretches to align, given the places of a template's words in a text. Each span that
    can reach COVERAGE and DENSITY lies in one of them: it has `need` of the words, and at most length / DENSITY in all."""
    for run in np.split(mine, np.flatnonzero(np.diff(mine) > GAP + 1) + 1):
        if len(run) >= need:
            yield int(run[0]), int(run[-1])
    n, longest = max(1, ceil(need - 1e-9)), int(length / DENSITY + 1e-9)
    if len(mine) < n:
        return
    live = np.flatnonzero(mine[n - 1 :] - mine[: len(mine) - n + 1] < longest)
    if not len(live):
        return
    for own in np.split(live, np.flatnonzero(np.diff(live) >= n) + 1):
        first, last = int(mine[own[0]]), int(mine[own[-1] + n - 1])
        for at in range(first, max(first, last - longest) + 1, longest):  # each span lies whole in one part
            yield at, min(last, at + 2 * longest - 1)


class Templates:
    def __init__(self, templates: dict[str, str]):
        self.names = list(templates)
        words = word_hashes(pa.array([templates[n] for n in self.names], pa.string()))
        self.words = [words.hash[words.bounds[k] : words.bounds[k + 1]] for k in range(len(self.names))]
        self.lists = [[int(x) for x in w] for w in self.words]
        self.bags = [Counter(w) for w in self.lists]
        self.sets = [np.unique(w) for w in self.words]
        self.all = np.unique(np.concatenate(self.words)) if self.words else np.empty(0, U64)
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.all & U64(0xFFFF)).astype(np.int64)] = True

    def scan(self, column: pa.Array) -> Iterator[tuple[int, str, float, float, int, int]]:
        """row, license, coverage, density, first word and words of the span, for each license that a text holds."""
        words = word_hashes(column)
        likely = np.flatnonzero(self.maybe[(words.hash & U64(0xFFFF)).astype(np.int64)])
        known = likely[np.isin(words.hash[likely], self.all)]
        hashes, rows = words.hash[known], words.row[known]
        at = np.searchsorted(rows, np.arange(len(column) + 1))
        for row in np.flatnonzero(np.diff(at) > 0):
            own, where = hashes[at[row] : at[row + 1]], known[at[row] : at[row + 1]]
            distinct = np.unique(own)
            places = []
            for k in range(len(self.names)):
                need = len(self.lists[k]) - (1 - COVERAGE) * len(self.lists[k])
                spare = len(self.lists[k]) - len(self.sets[k])  # repeats of words in the template
                if len(distinct) + spare < need or len(np.intersect1d(distinct, self.sets[k], assume_unique=True)) + spare < need:
                    continue
                mine = where[np.isin(own, self.sets[k])]
                best = (0.0, 0.0, 0, 0)
                for first, last in dict.fromkeys(regions(mine, need, len(self.lists[k]))):
                    region = [int(x) for x in words.hash[first : last + 1]]
                    if (Counter(region) & self.bags[k]).total() < need:
                        continue
                    found = coverage(region, self.lists[k])
                    if enough(found) and found[:2] > best[:2]:
                        best = (*found[:2], found[2] + first, found[3] + first)
                if best[0]:
                    places.append((best, k))
            for best, k in self.told_apart(places):
                yield int(row), self.names[k], best[0], best[1], int(best[2] - words.bounds[row]), int(best[3] - best[2] + 1)

    def told_apart(self, places: list[tuple[tuple[float, float, int, int], int]]) -> list[tuple[tuple[float, float, int, int], int]]:
        """Of places of which one has most of its words in the other, the one with the greater coverage, or the longer template
        among equals: notices of one family share their wording."""
        kept: list[tuple[tuple[float, float, int, int], int]] = []
        for best, k in sorted(places, key=lambda x: (-x[0][0], -len(self.lists[x[1]]), x[1])):
            if all(2 * (min(best[3], other[3]) - max(best[2], other[2]) + 1) <= best[3] - best[2] + 1 for other, _ in kept):
                kept.append((best, k))
        return sorted(kept, key=lambda x: x[1])


def scan_licenses(docs: DataFrame, *, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, license, coverage, density, first_word, n_words: a row for each license found in a row of docs, with the
    span of its best place (the first of equal ones) in words of the text. Where licenses meet in one place, the one that
    covers it best is named.

    Null, empty and unlicensed texts have no row. Repeated rows return each. A null id stays null. Empty tables and
    empty templates give an empty result; other columns are ignored."""
    known = Templates({n: t for n, t in (templates if templates is not None else TEMPLATES).items() if t.strip()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                found = list(known.scan(piece.column("text")))
                columns = list(zip(*found, strict=True)) if found else [[]] * 6
                kinds = [pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id").take(pa.array(columns[0], pa.int64())), *[pa.array(c, t) for c, t in zip(columns[1:], kinds, strict=True)]], ["doc_id", "license", "coverage", "density", "first_word", "n_words"])

    chosen = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, "doc_id bigint, license string, coverage double, density double, first_word bigint, n_words bigint")
