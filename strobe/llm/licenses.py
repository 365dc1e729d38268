"""License scans by conditional compression.

Candidate blocks are runs of sentences or lines with a licensing cue.  Every
cue sentence, by itself and with its neighbours, and every whole block is
compressed alone and with every template as a raw zstandard dictionary; the
bytes that a template saves are measured against its own size.  The templates
that save enough are confirmed by the exact differences in wording: words of
the template that the text lacks, and words that it has besides.  A difference
in a version number or in a word that tells licenses apart rejects a template.

Neighbours reach as many words before and after a cue sentence as the template
has, and at least GAP sentences, so notices that a full stop or a line break
cuts are whole.

Defined results: null or empty texts have no blocks; each place of a license
gives one row, of several templates the one with the most wording, then the
shortest place, then the template first in the alphabet; a null id is kept;
rows that repeat an id give their blocks each; other columns are not read.
"""

from __future__ import annotations

import difflib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate, chain

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CUE = r"(?i)licen[cs]e|copyright|redistribut|public domain|warrant(?:y|ies)|SPDX-"
#: Sentences without a cue that a block may span.
GAP = 2
#: Share of a template's compressed size that it has to save.
MIN_REDUCTION = 0.15
#: Share of a template's words that the block must have, in order.
MIN_COVERED = 0.75

#: Notices as licenses print them, by SPDX identifier.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "ISC": ["Released under the ISC License."],
}
#: Words that tell licenses apart: none may be missing or be there besides.
TELLING = frozenset(
    "mit apache gnu general lesser affero bsd mozilla cc by nc sa nd cc0 creative commons attribution noncommercial "
    "sharealike isc unencumbered".split()
)
SCHEMA = (
    "doc_id long, start long, length long, license string, template int, reduction double, covered double, "
    "missing string, added string, exact boolean"
)
_UNIT = re.compile(r"[^\n]*?(?:[.!?]+(?=\s)|\n|$)", re.S)
_CUE = re.compile(CUE)
_WORD = re.compile(r"[A-Za-z0-9.]*[A-Za-z0-9]")


def units(text: str) -> list[tuple[int, int, bool]]:
    """(start, end, has a cue) of the sentences or lines."""
    return [(m.start(), m.end(), bool(_CUE.search(m.group()))) for m in _UNIT.finditer(text) if m.end() > m.start()]


def blocks(cued: list[bool]) -> Iterator[tuple[int, int]]:
    """(first, last) unit of the runs of units that have a cue."""
    first = last = None
    for i in (i for i, cue in enumerate(cued) if cue):
        if last is not None and i - last > GAP + 1:
            yield first, last
            first = None
        first, last = i if first is None else first, i
    if last is not None:
        yield first, last


def words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def telling(word: str) -> bool:
    return word in TELLING or word[0].isdigit()


class Scanner:
    """Templates with their compressors; one for each task."""

    def __init__(self) -> None:
        options = {"level": 3, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.plain = zstandard.ZstdCompressor(**options)
        self.templates = []
        for name, texts in sorted(TEMPLATES.items()):
            for i, text in enumerate(texts):
                given = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                own = words(text)
                self.templates.append((name, i, own, zstandard.ZstdCompressor(dict_data=given, **options), len(self.plain.compress(text.encode())), Counter(own)))

    def confirm(self, block: list[str], template: list[str]) -> tuple[int, list[str], list[str], int, int] | None:
        """Words of the template covered, its missing words, the block's words
        in between, and the first and last of the block; None where they are
        no match."""
        same = difflib.SequenceMatcher(None, template, block, autojunk=False).get_matching_blocks()
        got = sum(m.size for m in same)
        inner = [m for m in same if m.size]
        if not inner or got < MIN_COVERED * len(template):
            return None
        taken = {i for m in inner for i in range(m.a, m.a + m.size)}
        used = {i for m in inner for i in range(m.b, m.b + m.size)}
        missing = [w for i, w in enumerate(template) if i not in taken]
        added = [block[i] for i in range(inner[0].b, inner[-1].b + inner[-1].size) if i not in used]
        if any(telling(w) for w in missing + added):
            return None
        return got, missing, added, inner[0].b, inner[-1].b + inner[-1].size - 1

    def scan(self, text: str) -> Iterator[tuple]:
        found = units(text)
        own = [words(text[a:b]) for a, b, _ in found]
        for first, last in blocks([cue for _, _, cue in found]):
            hits: dict[str, list[tuple]] = {}
            seen = set()
            for i in range(first, last + 1):
                if found[i][2]:
                    for t, (before, after) in self._reach(own, i).items():
                        if self._words_tell(own[before : after + 1], t):
                            # by itself, then with all neighbours, then with some
                            some = ((a, b) for a in range(i, before - 1, -1) for b in range(i, after + 1))
                            self._try(text, found, own, chain([(i, i), (before, after)], some), t, hits, seen)
            self._try_block(text, found, own, (max(first - GAP, 0), min(last + GAP, len(found) - 1)), hits)
            yield from self._best(found, hits)

    def _reach(self, own: list[list[str]], i: int) -> dict[int, tuple[int, int]]:
        """Units around a cue unit in which each template could stand."""
        out, spans = {}, {}
        for t, (_, _, template, *_) in enumerate(self.templates):
            size = len(template)
            if size not in spans:
                a, n = i, 0
                while a > 0 and (n < size or i - a < GAP):
                    a -= 1
                    n += len(own[a])
                b, n = i, 0
                while b < len(own) - 1 and (n < size or b - i < GAP):
                    b += 1
                    n += len(own[b])
                spans[size] = a, b
            out[t] = spans[size]
        return out

    def _try(self, text, found, own, places, t: int, hits: dict, seen: set) -> None:
        """Add the template's confirmed place in the first of some runs of
        units that has it."""
        for a, b in places:
            if (a, b, t) in seen:
                continue
            seen.add((a, b, t))
            hit = self._match(text, found, own, a, b, t)
            if hit:
                hits.setdefault(self.templates[t][0], []).append(hit)
                return

    def _try_block(self, text, found, own, place, hits: dict) -> None:
        """Templates of licenses not found yet, over the whole block."""
        for t, template in enumerate(self.templates):
            if template[0] not in hits:
                hit = self._match(text, found, own, *place, t)
                if hit:
                    hits[template[0]] = [hit]

    def _words_tell(self, runs: list[list[str]], t: int) -> bool:
        """Whether the words, in any order, suffice for a match."""
        _, _, template, _, _, bag = self.templates[t]
        have = Counter(w for run in runs for w in run if w in bag)
        return sum((have & bag).values()) >= MIN_COVERED * len(template) and all(have[w] >= n for w, n in bag.items() if telling(w))

    def _match(self, text, found, own, a: int, b: int, t: int) -> tuple | None:
        _, _, template, compressor, size, _ = self.templates[t]
        if not self._words_tell(own[a : b + 1], t):
            return None
        unit = [w for u in own[a : b + 1] for w in u]
        raw = text[found[a][0] : found[b][1]].encode()
        reduction = (len(self.plain.compress(raw)) - len(compressor.compress(raw))) / size
        if reduction < MIN_REDUCTION:
            return None
        match = self.confirm(unit, template)
        if match is None:
            return None
        got, missing, added, low, high = match
        ends = list(accumulate(len(u) for u in own[a : b + 1]))
        return a + bisect_right(ends, low), a + bisect_right(ends, high), got, missing, added, reduction, t

    def _best(self, found, hits: dict) -> Iterator[tuple]:
        """Rows of the places of each license that do not overlap a better
        one of it."""
        rows = []
        for name, own in hits.items():
            taken: list[tuple[int, int]] = []
            for a, b, got, missing, added, reduction, t in sorted(own, key=lambda h: (len(h[3]) + len(h[4]) - h[2], h[1] - h[0], h[6], h[0])):
                if all(b < x or y < a for x, y in taken):
                    taken.append((a, b))
                    start = found[a][0]
                    covered = got / len(self.templates[t][2])
                    rows.append((start, found[b][1] - start, name, self.templates[t][1], reduction, covered, " ".join(missing), " ".join(added), not missing and not added))
        yield from sorted(rows, key=lambda r: (r[0], r[2]))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row for each block that is confirmed as a license notice, with its
    place in code points."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        types = [pa.int64()] * 3 + [pa.string(), pa.int32(), pa.float64(), pa.float64(), pa.string(), pa.string(), pa.bool_()]
        for batch in batches:
            found = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                found += [(doc, *hit) for hit in scanner.scan(text.as_py())]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], t) for i, t in enumerate(types)], names)

    cued = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.rlike("text", F.lit(CUE)))
    return cued.mapInArrow(rows, SCHEMA)
