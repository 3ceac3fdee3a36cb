"""Operator 1: license scan by MinHash bands over overlapping text windows.

Templates are license notices and texts, as sets of word 5-grams (a template
of fewer words has one n-gram of all of them).  Templates are classed by size;
for each class every document is cut into windows twice as long as the class's
templates may be, overlapping by half, so wherever a template stands, one
window holds all of it.  A window's similarity with a template it holds to
``CONTAINMENT`` is at least ``floor`` (computed from both sizes); the number of
one-row MinHash bands follows from it and ``RECALL``.  A window that shares a
band with a template retrieves it, and exact containment of the template's
n-grams in the window (share found, 0.8 or more) verifies the match.  The
n-grams found in all verified windows of a template are cut into its places: a
new one begins where an n-gram comes again after 0.8 of the template was there,
or farther than a window from the last.  Every place is a match, unless a
place of another license with a higher containment overlaps it, or one with the
same that holds it and more.  A template whose license has a number of its own
(a version) also needs one of the n-grams with that number, if there are some one
that no other license has.  The conditions that licenses share name the smaller one, and the larger
one where its telling clause follows (``LARGER``).

Defined results: null and empty texts match nothing; whole texts are scanned,
however long, in chunks of ``CHUNK`` n-grams; other places of equal containment
all stay; repeated rows give a row each; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Mapping

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, text_or_empty
from .shingles import PIECE, minhash_functions, pieces, shingle_hashes, word_hashes

WORDS = 5
CONTAINMENT = 0.8
RECALL = 0.9999
SEED = 17
#: n-grams of a long text that are looked at together, a power of two above all
#: templates.
CHUNK = 1 << 17

#: Notices and texts of public licenses.
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under "
        "the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
        "KIND, either express or implied.",
    ],
    "GPL-3.0": [
        "licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": [
        "licensed under the GNU General Public License, version 2",
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version.",
    ],
    "GPL-1.0": [
        "licensed under the GNU General Public License, version 1",
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation; either "
        "version 1, or (at your option) any later version.",
    ],
    "LGPL-3.0": [
        "licensed under the GNU Lesser General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ],
    "LGPL-2.1": [
        "licensed under the GNU Lesser General Public License, version 2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation; "
        "either version 2.1 of the License, or (at your option) any later version.",
    ],
    "AGPL-3.0": [
        "licensed under the GNU Affero General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Affero General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License 2.0 which is available at",
    ],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event "
        "will the authors be held liable for any damages arising from the use of this software.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at",
    ],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ],
    "BSD-3-Clause": [
        "Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written "
        "permission.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
        "License",
    ],
    "CC-BY-NC-ND-4.0": [
        "Licensed under CC BY-NC-ND 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 "
        "International License",
    ],
    "CC-BY-NC-SA-4.0": [
        "Licensed under CC BY-NC-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 "
        "International License",
    ],
    "CC-BY-ND-4.0": [
        "Licensed under CC BY-ND 4.0",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International "
        "License",
    ],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0",
        "Boost Software License - Version 1.0 - August 17th, 2003",
    ],
    "LGPL-2.0": [
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Library General Public License as published by the Free Software Foundation; "
        "either version 2 of the License, or (at your option) any later version.",
    ],
    "MIT-0": [],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related "
                "or neighboring rights to this work"],
    "proprietary": ["All rights reserved"],
}

#: How the full texts begin.
for _name, _opening in {
    "Apache-2.0": "Apache License Version 2.0, January 2004",
    "GPL-3.0": "GNU General Public License Version 3, 29 June 2007",
    "GPL-2.0": "GNU General Public License Version 2, June 1991",
    "GPL-1.0": "GNU General Public License Version 1, February 1989",
    "LGPL-3.0": "GNU Lesser General Public License Version 3, 29 June 2007",
    "LGPL-2.1": "GNU Lesser General Public License Version 2.1, February 1999",
    "LGPL-2.0": "GNU Library General Public License Version 2, June 1991",
    "AGPL-3.0": "GNU Affero General Public License Version 3, 19 November 2007",
    "MPL-2.0": "Mozilla Public License Version 2.0 1. Definitions",
    "EPL-2.0": "Eclipse Public License - v 2.0 The accompanying program is provided under the terms",
    "CC-BY-4.0": "Creative Commons Attribution 4.0 International Public License",
    "CC-BY-SA-4.0": "Creative Commons Attribution-ShareAlike 4.0 International Public License",
    "CC-BY-NC-4.0": "Creative Commons Attribution-NonCommercial 4.0 International Public License",
    "CC-BY-NC-SA-4.0": "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International "
                       "Public License",
    "CC-BY-ND-4.0": "Creative Commons Attribution-NoDerivatives 4.0 International Public License",
    "CC-BY-NC-ND-4.0": "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International "
                       "Public License",
}.items():
    TEMPLATES[_name].append(_opening)
#: The identifier line that source files carry.
for _name in TEMPLATES:
    if _name != "proprietary":
        TEMPLATES[_name].append(f"SPDX-License-Identifier: {_name}")
#: Conditions of one license that another has as well: where a place of the second
#: follows within so many words, the first is named like it.
LARGER = {"BSD-2-Clause": ("BSD-3-Clause", 200)}


class Scanner:
    """Index of templates; scans texts for them."""

    def __init__(self, templates: Mapping[str, list[str]] = TEMPLATES, words: int = WORDS,
                 containment: float = CONTAINMENT, recall: float = RECALL):
        self.containment = containment
        self.names: list[str] = []
        self.grams: list[np.ndarray] = []
        orders, numbered = [], []
        digits = {int(word_hashes([str(n)])[0][0]) for n in range(100)}
        for name, texts in templates.items():
            for text in texts:
                hashes, counts = word_hashes([text])
                k = min(words, int(counts[0]))
                if k:
                    grams = shingle_hashes(hashes, counts, k)[0]
                    self.names.append(name)
                    self.grams.append(np.unique(grams))
                    orders.append(k)
                    number = [int(h) in digits for h in hashes]
                    numbered.append({int(g) for i, g in enumerate(grams) if any(number[i:i + k])})
        # The n-grams with a number that no other license has, or all with a number.
        self.telling = [own.difference(*(g.tolist() for g, other in zip(self.grams, self.names)
                                         if other != name)) or own
                        for own, name in zip(numbered, self.names)]
        # Classes of templates: the same n-gram order, at most ``step`` n-grams
        # and more than half as many; step is a power of two.
        by_class: dict[tuple[int, int], list[int]] = {}
        for i, (g, k) in enumerate(zip(self.grams, orders)):
            by_class.setdefault((k, 1 << (len(g) - 1).bit_length()), []).append(i)
        self.classes: dict[int, dict[int, list]] = {}
        self.functions = {}
        for (k, step), members in sorted(by_class.items()):
            least = min(len(self.grams[i]) for i in members)
            # A window of 2 step n-grams that holds the share c of a template
            # of s n-grams: similarity at least c s / (2 step + (1 - c) s).
            floor = containment * least / (2 * step + (1 - containment) * least)
            bands = int(np.ceil(np.log(1 - recall) / np.log(1 - floor)))
            self.classes.setdefault(k, {})[step] = [_Table() for _ in range(bands)]
        for k, steps in self.classes.items():
            a, b = minhash_functions(max(map(len, steps.values())), SEED + k)
            self.functions[k] = list(zip(a, b))
            for step, tables in steps.items():
                for i in by_class[k, step]:
                    for table, (x, y) in zip(tables, self.functions[k]):
                        table.add(int(_hash(self._low(self.grams[i]), x, y).min()), i)

    @staticmethod
    def _low(grams: np.ndarray) -> np.ndarray:
        return (grams >> np.uint64(32)).astype(np.uint32)

    def scan(self, texts: list[str]) -> list[list[tuple[str, int, int, float]]]:
        """(license, first word, words, containment) of each text's matches:
        every place of every template; of overlapping places of different
        licenses the one with the higher containment."""
        spans: list[list[tuple[int, int, int, float]]] = [[] for _ in texts]
        group: list[int] = []
        for i, text in enumerate(texts):
            if len(text) > PIECE:
                words = np.concatenate([word_hashes([p])[0] for p in pieces(text)])
                self._scan([i], words, np.array([len(words)]), spans)
                continue
            group.append(i)
            if sum(len(texts[j]) for j in group) > PIECE:
                self._scan(group, *word_hashes([texts[j] for j in group]), spans)
                group = []
        if group:
            self._scan(group, *word_hashes([texts[j] for j in group]), spans)
        return [self._named(self._strongest(sorted(d))) for d in spans]

    def _scan(self, own: list[int], words: np.ndarray, counts: np.ndarray, spans) -> None:
        """Add the places in the texts ``own``, whose words are given, to ``spans``;
        a text of more than a chunk stands alone."""
        for k, steps in self.classes.items():
            hits: dict[tuple[int, int, int], list] = {}
            if len(own) == 1 and len(words) > CHUNK + max(steps) + k:
                for begin in range(0, len(words), CHUNK):
                    part = words[begin:begin + CHUNK + max(steps) + k - 1]
                    self._hits(k, steps, part, np.array([len(part)]), begin, hits)
            else:
                self._hits(k, steps, words, counts, 0, hits)
            for (doc, t, step), found in hits.items():
                at, first = np.unique(np.concatenate([f[0] for f in found]), return_index=True)
                grams = np.concatenate([f[1] for f in found])[first]
                for one, last, share in self._places(at.tolist(), grams.tolist(), t, 2 * step):
                    spans[own[doc]].append((t, one, last - one + k, share))

    def _hits(self, k, steps, hashes, counts, offset, hits) -> None:
        """Add the n-grams of templates in their verified windows to ``hits``:
        (text, template, step) to [(places in the text, n-grams)].  With one text,
        only windows that begin within the first chunk, moved by ``offset``."""
        grams, made = _full_shingles(hashes, counts, k)
        if not len(grams):
            return
        first, low = np.cumsum(made) - made, self._low(grams)
        # Blocks of 1, 2, 4 ... n-grams by text, each of two of the level
        # below; a window is a block and the next one of its text.
        levels = []
        owner, blocks, step = np.repeat(np.arange(len(made)), made), made, 1
        nth = np.arange(len(owner)) - first[owner]
        while step <= max(steps):
            levels.append((step, owner, nth, nth + 1 < blocks[owner]))
            begin = np.flatnonzero(nth % 2 == 0)
            levels[-1] += (begin,)
            owner, nth = owner[begin], nth[begin] // 2
            blocks, step = -(-blocks // 2), step * 2
        found: set[tuple[int, int, int]] = set()
        for f, (x, y) in enumerate(self.functions[k]):
            least = _hash(low, x, y)
            for step, owner, nth, has_next, begin in levels:
                tables = steps.get(step, ())
                if f < len(tables):
                    window = least.copy()
                    np.minimum(window[:-1], least[1:], out=window[:-1], where=has_next[:-1])
                    table = tables[f]
                    for w in np.flatnonzero(table.seen[window >> np.uint32(16)]).tolist():
                        found.update((step, w, t) for t in table.members.get(int(window[w]), ()))
                least = np.minimum.reduceat(least, begin)
        places = {step: (owner, nth) for step, owner, nth, _, _ in levels}
        for step, w, t in sorted(found):
            owner, nth = places[step]
            doc = int(owner[w])
            if len(counts) == 1 and nth[w] * step >= CHUNK:
                continue                    # the next chunk's
            begin = int(first[doc] + nth[w] * step)
            part = grams[begin:min(begin + 2 * step, int(first[doc] + made[doc]))]
            hit = np.isin(part, self.grams[t])
            if len(np.unique(part[hit])) / len(self.grams[t]) >= self.containment:
                at = begin - int(first[doc]) + offset + np.flatnonzero(hit)
                hits.setdefault((doc, t, step), []).append((at, part[hit]))

    def _places(self, at: list[int], grams: list[int], t: int, far: int):
        """(first n-gram, last, containment) of the template's places."""
        size, here, begin, last = len(self.grams[t]), set(), 0, 0
        telling = self.telling[t]
        for place, gram in zip(at, grams):
            whole = len(here) / size >= self.containment
            if here and (place - last >= far or whole and gram in here):
                if whole and (not telling or here & telling):
                    yield begin, last, len(here) / size
                here = set()
            if not here:
                begin = place
            here.add(gram)
            last = place
        if len(here) / size >= self.containment and (not telling or here & telling):
            yield begin, last, len(here) / size

    def _strongest(self, spans: list[tuple[int, int, int, float]]):
        """The spans that no stronger one of another license overlaps."""
        by_start = sorted(spans, key=lambda m: m[1])
        starts = [m[1] for m in by_start]
        longest = max((m[2] for m in spans), default=0)
        return [(t, at, n, share) for t, at, n, share in spans
                if not any(o + m > at and self.names[u] != self.names[t]
                           and (s > share or s == share and o <= at and o + m >= at + n and m > n)
                           for u, o, m, s in by_start[bisect_left(starts, at - longest):
                                                      bisect_left(starts, at + n)])]

    def _named(self, spans: list[tuple[int, int, int, float]]):
        """The spans with their licenses' names, the larger license's where its
        telling clause follows."""
        out = []
        for t, at, n, share in spans:
            name = self.names[t]
            larger, within = LARGER.get(name, (None, 0))
            if larger and any(self.names[u] == larger and at <= o <= at + n + within
                              for u, o, _, _ in spans):
                name = larger
            out.append((name, at, n, share))
        return out


class _Table:
    """Minimum hashes of templates in one band."""

    def __init__(self):
        self.seen = np.zeros(1 << 16, bool)         # by leading 16 bits
        self.members: dict[int, list[int]] = {}

    def add(self, value: int, template: int) -> None:
        self.seen[value >> 16] = True
        self.members.setdefault(value, []).append(template)


def _hash(low: np.ndarray, a: np.uint32, b: np.uint32) -> np.ndarray:
    x = low * a + b
    return x ^ (x >> np.uint32(15))


def _full_shingles(hashes: np.ndarray, counts: np.ndarray, k: int):
    """Shingles of the texts with at least k words (others have none)."""
    grams, made = shingle_hashes(hashes, counts, k)
    keep = np.repeat(counts >= k, made)
    return grams[keep], np.where(counts >= k, made, 0)


def find(docs: DataFrame, templates: Mapping[str, list[str]] = TEMPLATES) -> DataFrame:
    """doc_id, matches (array of license, first_word, n_words, containment)."""
    def start():
        scanner = Scanner(templates)

        def work(cols):
            ids, texts = cols
            out = []
            for begin in range(0, len(texts), 64):
                for found in scanner.scan(texts[begin:begin + 64]):
                    out.append([{"license": name, "first_word": at, "n_words": n,
                                 "containment": share} for name, at, n, share in found])
            return [ids, out]
        return work

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs, [F.col("doc_id"), text_or_empty().alias("text")],
                    f"doc_id {kind}, matches array<struct<license:string,first_word:int,"
                    "n_words:int,containment:double>>", start)


def licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_matches, licenses (sorted, distinct), best containment."""
    return find(docs).select(
        "doc_id", F.size("matches").cast("long").alias("n_matches"),
        F.array_sort(F.array_distinct("matches.license")).alias("licenses"),
        F.coalesce(F.array_max("matches.containment"), F.lit(0.0)).alias("best_containment"),
        "matches")
