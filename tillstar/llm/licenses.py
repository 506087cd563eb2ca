"""Licence scans by conditional compression.

Candidate blocks are the words around every phrase that speaks of a licence
(a cue), as far as the longest template reaches to either side, over line ends
and blank lines; blocks that meet are one.  A block is compressed alone and
with each template as raw dictionary: the relative size reduction says how
much of the block the template explains.  Templates are ranked by it, and the
best one is confirmed by its exact wording: the words of overlapping windows
are aligned with the template's, which is found where the window has all of
its words that matter (names, versions and terms) in order and at least
``SIMILAR`` of the rest, and the wording differences are reported.  If the
winner is refused the next one is tried; if it is confirmed, the words before
and after the notice are blocks of their own and are ranked again, so every
notice of a block is found.  Only templates that the alignment must refuse are
not compressed: those of which the block lacks a needed word, or holds fewer
than ``SIMILAR`` of the words in any order.  A line with a cue outside all
notices found is reported as ``unknown``.

A word at the notice's ends that the template lacks does not count against it
(a sentence before or after the notice); the differences between are listed.

Edge cases: null and empty texts and texts without a cue give no row; a text
with several notices gives a row each; equal reductions are ranked by template
name; very long texts are scanned whole, block by block; repeated rows are each
reported; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BSD_HEAD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met")
BSD = (BSD_HEAD + ": [Redistributions] of source code must retain the above copyright notice, this list of conditions and "
       "the following disclaimer. Redistributions in [binary] form must reproduce the above copyright notice, this list of "
       "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.")
MIT_HEAD = ("[Permission] is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without [restriction]")
# Well-known notices, by licence.  Words in brackets are the ones
# that must be there.
TEMPLATES = {
    "Apache-2.0": ["[Apache] License [2.0]", "[Apache-2.0] License", "Apache Software License Version [2.0] ([Apache])",
                   "Licensed under the [Apache] [License], Version [2.0].",
                   "Licensed under the [Apache] [License], Version [2.0] (the \"License\"); you may not use this file "
                   "except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"],
    "BSD-2-Clause": [BSD, "Licensed under the [BSD] [2-Clause] License.", BSD_HEAD.replace("following", "following [two]")],
    "BSD-3-Clause": [BSD + " Neither the name of the copyright holder nor the names of its contributors may be used to "
                     "[endorse] or promote products derived from this software without specific prior written permission.",
                     "Licensed under the [BSD] [3-Clause] License.", BSD_HEAD.replace("following", "following [three]")],
    "CC-BY-4.0": ["Licensed under [CC] [BY] [4.0].",
                  "This work is licensed under a [Creative] [Commons] [Attribution] [4.0] International License."],
    "CC-BY-SA-4.0": ["Licensed under [CC] [BY-SA] [4.0].",
                     "This work is licensed under a [Creative] [Commons] [Attribution-ShareAlike] [4.0] "
                     "International License."],
    "CC-BY-NC-4.0": ["Licensed under [CC] [BY-NC] [4.0].",
                     "This work is licensed under a [Creative] [Commons] [Attribution-NonCommercial] [4.0] "
                     "International License."],
    "CC0-1.0": ["Licensed under [CC0] [1.0].",
                "To the extent possible under law, the author has waived all copyright and related rights "
                "under [CC0] [1.0]."],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the [Eclipse] Public "
                "License [2.0] which is available at https://www.eclipse.org/legal/epl-2.0", "[Eclipse] Public License [2.0]",
                "[Eclipse] Public License v [2.0]"],
    "GPL-2.0": ["GNU [GPL] [v2]", "GNU [GPLv2]", "GNU [GPL] version [2]", "[GNU] [General] Public License [v2]",
                "This work is licensed under the GNU [General] Public License, version [2].",
                "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "[General] Public License as published by the Free Software Foundation; either version [2] of the License"],
    "GPL-3.0": ["GNU [GPL] [v3]", "GNU [GPLv3]", "GNU [GPL] version [3]", "[GNU] [General] Public License [v3]",
                "This work is licensed under the GNU [General] Public License, version [3].",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "[General] Public License as published by the Free Software Foundation, either version [3] of the License"],
    "LGPL-2.1": ["This work is licensed under the GNU [Lesser] General Public License, version [2.1].",
                 "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                 "[Lesser] General Public License as published by the Free Software Foundation; either version [2.1] of the "
                 "License"],
    "LGPL-3.0": ["This work is licensed under the GNU [Lesser] General Public License, version [3]."],
    "AGPL-3.0": ["This work is licensed under the GNU [Affero] General Public License, version [3]."],
    "ISC": ["Released under the [ISC] License.",
            "Permission to use, copy, modify, and/or distribute this software for any [purpose] with or without [fee] is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "MIT": ["Released under the [MIT] License.", MIT_HEAD,
            MIT_HEAD + ", including without limitation the rights to use, copy, modify, merge, publish, distribute, "
            "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
            "so, subject to the following conditions: The above copyright notice and this permission notice shall be "
            "included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT "
            "WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
            "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the [Mozilla] Public License, v. [2.0]."],
    "Unlicense": ["This is free and [unencumbered] software released into the public [domain]."],
    "Proprietary": ["All [rights] [reserved]."],
}
# Each licence by its SPDX line, with the name and its GNU variants.
for _name in [n for n in TEMPLATES if n != "Proprietary"]:
    TEMPLATES[_name] = TEMPLATES[_name] + [f"[SPDX-License-Identifier]: [{n}]" for n in (
        (_name, f"{_name}-only", f"{_name}-or-later") if "GPL" in _name else (_name,))]
CUES = ("licen", "copyright", "all rights reserved", "hereby granted", "free software", "creative commons",
        "redistribution and use", "public domain", "gpl")
CUE = "|".join(c.replace(" ", "[ \\t\\r\\n]+") for c in CUES)
SIMILAR = 0.8
# words to either side of a cue that no template explains, for its reduction
AROUND = 60
WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def most_extra(ws: list[str]) -> float:
    return (1 - SIMILAR) * len(ws) + 1


def longest(ws: list[str]) -> int:
    """Words of the longest notice that is confirmed as this template."""
    return len(ws) + int(most_extra(ws))


class Templates:
    """Templates prepared for scanning; one per worker."""

    def __init__(self, templates: dict = TEMPLATES, level: int = 9):
        self.alone = zstandard.ZstdCompressor(level=level, write_checksum=False, write_content_size=False)
        self.all = []
        self.reach = 0
        for name in sorted(templates):
            for text in templates[name]:
                plain = re.sub(r"[\[\]]", "", text)
                must = {w for x in re.findall(r"\[([^\]]+)\]", text) for w in words_of(x)}
                given = zstandard.ZstdCompressionDict(plain.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                given.precompute_compress(level=level)
                self.reach = max(self.reach, longest(words_of(plain)))
                self.all.append((name, words_of(plain), must, zstandard.ZstdCompressor(
                    level=level, dict_data=given, write_checksum=False, write_content_size=False, write_dict_id=False)))

    def reductions(self, words: list[str], which=None) -> list[float]:
        """Size reductions of the words by these templates (numbers)."""
        data = " ".join(words).encode("utf-8", "replace")
        alone = len(self.alone.compress(data)) or 1
        return [1 - len(self.all[k][3].compress(data)) / alone for k in (range(len(self.all)) if which is None else which)]

    def confirm(self, own: list[str], ws: list[str], must: set) -> tuple[int, int, int, list, list] | None:
        """(start, end, words held, extra words, missing words) of the place in
        ``own`` that has most of the template's words in order; None if not
        enough."""
        same = [m for m in SequenceMatcher(None, own, ws, autojunk=False).get_matching_blocks() if m.size]
        best = None
        # stray words of the template before or after the notice are left out
        for i in range(len(same)):
            held, names = 0, set()
            for j in range(i, len(same)):
                held += same[j].size
                names.update(ws[same[j].b:same[j].b + same[j].size])
                start, end = same[i].a, same[j].a + same[j].size
                extra = end - start - held
                if extra > most_extra(ws):
                    break
                if held >= SIMILAR * len(ws) and must <= names and (best is None or held - extra > best[0]):
                    best = (held - extra, start, end, held, same[i:j + 1])
        if best is None:
            return None
        _, start, end, held, same = best
        kept = {i for m in same for i in range(m.a, m.a + m.size)}
        has = {i for m in same for i in range(m.b, m.b + m.size)}
        return (start, end, held, ["+" + own[i] for i in range(start, end) if i not in kept],
                ["-" + w for i, w in enumerate(ws) if i not in has])

    def find(self, own: list[str], ws: list[str], must: set):
        """All places of a template in a block, by windows that overlap so
        that every notice is whole in one."""
        if not must <= set(own):
            return
        most, need, seen = longest(ws), Counter(ws), set()
        step = max(most // 2, 1)
        todo = [(i, min(i + most + step, len(own))) for i in range(0, max(len(own) - most, 0) + step, step)]
        while todo:
            i, j = todo.pop()
            part = own[i:j]
            if (not must <= set(part) or (Counter(part) & need).total() < SIMILAR * len(ws)
                    or not (got := self.confirm(part, ws, must))):
                continue
            start, end = i + got[0], i + got[1]
            if (start, end) not in seen:
                seen.add((start, end))
                yield start, end, *got[2:]
            todo += [(i, start), (end, j)]

    def ranked(self, own: list[str]) -> list[int]:
        """Templates that the alignment need not refuse, by size reduction."""
        has = Counter(own)
        able = [k for k, (_, ws, must, _) in enumerate(self.all)
                if must <= has.keys() and (has & Counter(ws)).total() >= SIMILAR * len(ws)]
        return [k for _, _, k in sorted((-r, self.all[k][0], k) for r, k in zip(self.reductions(own, able), able))] if able else []

    def notices(self, own: list[str]) -> list[tuple]:
        """(start, end, licence, reduction, similarity, differences) of the
        block's notices: the confirmed winner, then those to its sides."""
        out, todo = [], [(0, len(own))]
        while todo:
            i, j = todo.pop()
            for k in self.ranked(own[i:j]):
                name, ws, must, _ = self.all[k]
                places = [(len(extra) + len(missing) - held, start, end, held, extra + missing)
                          for start, end, held, extra, missing in self.find(own[i:j], ws, must)]
                if places:
                    _, start, end, held, differs = min(places)
                    out.append((i + start, i + end, name, self.reductions(own[i + start:i + end], [k])[0], held / len(ws),
                                " ".join(differs)))
                    todo += [(i, i + start), (i + end, j)]
                    break
        return out

    def scan(self, text: str) -> list[tuple]:
        """(line, licence, reduction, similarity, differences) by notice."""
        low = text.lower()
        found = [(m.start(), m.group()) for m in WORD.finditer(low)]
        at, own = [a for a, _ in found], [w for _, w in found]
        ends = [m.start() for m in re.finditer("\n", low)]
        cues = [(max(bisect_right(at, m.start()) - 1, 0), bisect_left(ends, m.start())) for m in re.finditer(CUE, low)]
        stretches = []
        for c, _ in cues:
            lo, hi = max(c - self.reach, 0), min(c + self.reach + 1, len(own))
            if stretches and lo <= stretches[-1][1]:
                stretches[-1][1] = hi
            else:
                stretches.append([lo, hi])
        out, taken = [], set()
        for lo, hi in stretches:
            for start, end, name, reduction, similar, differs in self.notices(own[lo:hi]):
                taken.update(range(lo + start, lo + end))
                out.append((bisect_left(ends, at[lo + start]), name, reduction, similar, differs))
        told = {bisect_left(ends, at[i]) for i in taken}
        for c, line in cues:
            if line not in told:
                told.add(line)
                out.append((line, "unknown", max(self.reductions(own[max(c - AROUND, 0):c + AROUND])), 0.0, ""))
            elif c not in taken and all(abs(c - i) > self.reach for i in taken):
                # a far part of a long line that also has a notice
                taken.add(c)
                out.append((line, "unknown", max(self.reductions(own[max(c - AROUND, 0):c + AROUND])), 0.0, ""))
        return sorted(out)


def scan_licenses(docs: DataFrame, templates: dict = TEMPLATES) -> DataFrame:
    """doc_id, line, license, reduction, similarity, differences: a row for
    every notice in the whole text of every document."""
    rows = docs.select("doc_id", "text").filter(F.lower("text").rlike(CUE))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def scan(batches):
        known = Templates(templates)
        for b in batches:
            found = [(i, *x) for i, t in enumerate(b.column("text").to_pylist()) for x in known.scan(t)]
            cols = list(zip(*found)) or [()] * 6
            types = (pa.int32(), pa.string(), pa.float64(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(cols[0], pa.int64()))] + [pa.array(c, t) for c, t in zip(cols[1:], types)],
                ["doc_id", "line", "license", "reduction", "similarity", "differences"])

    return rows.mapInArrow(scan, f"doc_id {kind}, line int, license string, reduction double, similarity double, "
                                 "differences string")
