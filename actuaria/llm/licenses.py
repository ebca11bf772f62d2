"""Operator 2: license scans by conditional compression.

Notices are looked for in the words around every license word, whatever the lines,
so that wrapped notices, comment signs and notices inside longer lines are read
alike; templates of a caller that hold no license word are looked for in whole texts.
Pairs of neighbouring words that a template shares with the text place it; the part of
the text that is aligned to it is a candidate block.  Every block is compressed alone
and with each template as a raw zstandard dictionary, and the templates are ranked by
the bytes that they save.  The first in that order whose wording is confirmed names
the block: the words that it lacks or has beyond the template are few, and names and
version numbers agree.  Of named blocks that overlap, the one that saves most bytes stays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actuaria.llm.common import slices, texts_of

#: Fixed notices: license and wording.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
    # Headers of source files, titles of the long licenses, whole texts of the short ones.
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    *((re.sub("-(?:only|or-later)$", "", i), f"SPDX-License-Identifier: {i}") for i in (
        "Apache-2.0 MIT ISC BSD-2-Clause BSD-3-Clause GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later "
        "LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later "
        "MPL-2.0 EPL-2.0 BSL-1.0 Zlib CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0 CC-BY-ND-4.0 CC0-1.0 Unlicense"
    ).split()),
)
HINTS = re.compile(
    r"licen[sc]|copyright|rights reserved|public domain|spdx|permission|redistribut|warrant|\bcc[ -]?by|in compliance with", re.I
)
_HINT_PARTS = ("licen", "copyright", "reserved", "domain", "spdx", "permission", "redistribut", "warrant", "cc", "compliance")
_WORD = re.compile(r"[A-Za-z0-9]+(?:[.-][A-Za-z0-9]+)*")
#: Characters read on both sides of a license word at least; otherwise twice the longest template.
AROUND = 2000
#: What stands between the words of a wrapped notice: a line break with white space and comment signs.
_BREAK = re.compile(r"\s*\n\s*(?:(?:[#*;%!>|]+|/[/*]+|--+|<!--|dnl\b|rem\b)\s*)*", re.I)
_TAIL = re.compile(r"[.!?)\"'”]*")
_TAG = "spdx-license-identifier"
#: Words that must agree in templates of more than LONG words, beside those with a digit.
NAMES = frozenset("affero apache endorse fee gnu isc lesser mit mozilla unencumbered".split())
LONG = 20
#: Before ``general`` they make another license.
RIVALS = frozenset(("lesser", "library", "affero"))
_YEAR = re.compile(r"(?:19|20)\d\d(?:-(?:19|20)?\d\d)?")
#: Words that never tell licenses apart.
COMMON = frozenset(
    "a an and any are as at author be conditions copy except extent following for form forms free from general granted has "
    "have hereby if in is it law licence license licensed may met not of on or person possible provided public released rights "
    "reserved software source subject terms that the this to under use version v with without work you your file charge all".split()
)


@dataclass(frozen=True)
class Template:
    license: str
    text: str

    @property
    def words(self) -> list[str]:
        return wording(self.text)

    @property
    def telling(self) -> frozenset[str]:
        """The names and numbers that must be there, and no others of the kind."""
        words = self.words
        if len(words) > LONG:
            return frozenset(w for w in words if w in NAMES or (re.search(r"\d", w) and len(w) > 1) or (w.isdigit() and "version" in words))
        return frozenset(w for w in words if w not in COMMON)


def wording(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


@lru_cache(maxsize=8)
def compressors(templates: tuple[tuple[str, str], ...], level: int = 19):
    """The plain compressor, and (template, compressor with it as raw dictionary)."""
    options = {"level": level, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    made = []
    for license_id, text in templates:
        raw = zstandard.ZstdCompressionDict(text.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        made.append((Template(license_id, text), zstandard.ZstdCompressor(dict_data=raw, **options)))
    return zstandard.ZstdCompressor(**options), tuple(made)


def regions(text: str, templates) -> Iterator[tuple[int, int]]:
    """(start, end) of the parts of a text around its license words, cut at white space.

    The whole text if one of the templates holds no license word.
    """
    around, hinted = reach(templates)
    if not hinted:
        yield 0, len(text)
        return
    low = text.lower()
    if not any(h in low for h in _HINT_PARTS):
        return
    start = end = None
    for m in HINTS.finditer(text):
        if start is not None and m.start() - around > end:
            yield _whole(text, start, end)
            start = None
        if start is None:
            start = max(0, m.start() - around)
        end = m.end() + around
    if start is not None:
        yield _whole(text, start, end)


@lru_cache(maxsize=8)
def reach(templates: tuple[tuple[str, str], ...]) -> tuple[int, bool]:
    """How far from a license word a notice may go on, and whether all templates hold such words."""
    return max([AROUND, *(2 * len(t) for _, t in templates)]), all(HINTS.search(t) for _, t in templates)


def _whole(text: str, start: int, end: int) -> tuple[int, int]:
    while start > 0 and not text[start - 1].isspace():
        start -= 1
    while end < len(text) and not text[end].isspace():
        end += 1
    return start, min(end, len(text))


@lru_cache(maxsize=8)
def index(templates: tuple[tuple[str, str], ...]) -> tuple[tuple, dict[tuple[str, str], list[tuple[int, int]]]]:
    """(words, telling words) of each template, and where each pair of neighbouring words stands in them."""
    made, pairs = [], {}
    for k, (name, text) in enumerate(templates):
        words = wording(text)
        made.append((words, Template(name, text).telling))
        for at, pair in enumerate(zip(words, words[1:])):
            pairs.setdefault(pair, []).append((k, at))
    return tuple(made), pairs


def placements(words: list[str], templates) -> Iterator[tuple[int, int, int]]:
    """(template, start, end) of the windows of words in which a template may stand."""
    made, pairs = index(templates)
    hits: dict[int, list[tuple[int, int]]] = {}
    for i, pair in enumerate(zip(words, words[1:])):
        for k, at in pairs.get(pair, ()):
            hits.setdefault(k, []).append((i - at, at))
    for k, found in sorted(hits.items()):
        n = len(made[k][0])
        slack = n // 3
        found.sort()
        first, seen = found[0][0], set()
        for begin, at in [*found, (len(words) + n, 0)]:
            if begin - first > slack:
                if len(seen) >= 0.2 * (n - 1):
                    yield k, max(0, first - slack - 2), min(len(words), first + n + 2 * slack + 2)
                first, seen = begin, set()
            seen.add(at)


def align(template: list[str], words: list[str]) -> tuple[int, int, list[str], list[str], list[int]] | None:
    """(start, end, missing, extra, places of extra) of the part of ``words`` that is aligned to the template.

    Single words that match far before or behind the rest don't belong to the part.
    """
    matcher = SequenceMatcher(None, template, words, autojunk=False)
    same = [m for m in matcher.get_matching_blocks() if m.size]
    while len(same) > 1 and same[1].b - same[0].b - same[0].size > same[0].size:
        del same[0]
    while len(same) > 1 and same[-1].b - same[-2].b - same[-2].size > same[-1].size:
        del same[-1]
    if not same:
        return None
    held = {m.a + d for m in same for d in range(m.size)}
    matched = {m.b + d for m in same for d in range(m.size)}
    start, end = same[0].b, same[-1].b + same[-1].size
    places = [i for i in range(start, end) if i not in matched]
    return start, end, [w for i, w in enumerate(template) if i not in held], [words[i] for i in places], places


def worded(known: tuple[list[str], frozenset[str]], block: list[str], after: list[str], most_missing: float) -> tuple[list[str], list[str]] | None:
    """(missing, extra) of a block against a template, None if they are too many or tell of another license."""
    template, telling = known
    matcher = SequenceMatcher(None, template, block, autojunk=False)
    same = [m for m in matcher.get_matching_blocks() if m.size]
    held = {m.a + d for m in same for d in range(m.size)}
    matched = {m.b + d for m in same for d in range(m.size)}
    missing = [w for i, w in enumerate(template) if i not in held]
    places = [i for i in range(len(block)) if i not in matched]
    extra = [block[i] for i in places]
    if not matched or 0 not in matched or len(block) - 1 not in matched:
        return None  # the part aligned to this template is another block
    if telling & set(missing) or len(missing) > most_missing * len(template) or len(extra) > 0.5 * len(template):
        return None
    if any(re.search(r"\d", w) for w in telling) and any(re.search(r"\d", w) and w not in template and not _YEAR.fullmatch(w) for w in extra):
        return None
    if any(block[i] in RIVALS and [*block[i + 1 : i + 2], *after][:1] == ["general"] for i in places):
        return None
    return missing, extra


def savings(raw: bytes, templates) -> tuple[int, list[int]]:
    """The compressed size of a block, and the bytes that each template saves as its dictionary."""
    plain, made = compressors(templates)
    alone = len(plain.compress(raw))
    return alone, [alone - len(c.compress(raw)) for _, c in made]


def notices(text: str, templates, least_gain: float, most_missing: float) -> list[tuple[int, int, str, float, list[str], list[str]]]:
    """(start, end, license, gain, missing, extra) of the confirmed notices of a text, none overlapping."""
    known = index(templates)[0]
    spans = [m.span() for m in _WORD.finditer(text)]
    words = [text[a:b].lower() for a, b in spans]
    confirmed = {}

    def name(start: int, end: int, tag: str = "") -> None:
        """Rank all templates by the bytes they save on words start to end; the first that the wording confirms names them."""
        a, b = spans[start][0], _TAIL.match(text, spans[end - 1][1]).end()
        raw = (tag + _BREAK.sub(" ", text[a:b])).lower().encode("utf-8", "surrogatepass")
        block = wording(tag) + words[start:end]
        alone, saved = savings(raw, templates)
        best = None
        for k in sorted(range(len(known)), key=lambda k: (-saved[k], k)):
            if saved[k] < least_gain * alone or (best and saved[k] < -best[0]):
                break
            is_tag = known[k][0][0] == _TAG
            if is_tag != (block[0] == _TAG):
                continue
            differing = worded(known[k], block, words[end : end + 1], 0 if is_tag else most_missing)
            if differing is not None and not (is_tag and differing[1]):
                # Most bytes saved first; ties: fewer words differing, then the template's place in the list.
                found = (-saved[k], len(differing[0]) + len(differing[1]), k, start, end, a, b, saved[k] / alone, *differing)
                best = min(best, found, key=lambda x: x[:3]) if best else found
        if best:
            confirmed[start, end] = best

    tagged = {w[1] for w, _ in known if len(w) == 2 and w[0] == _TAG}
    for i in (i for i, w in enumerate(words) if w == _TAG):
        first = i
        for j in range(i + 1, len(words)):
            if "\n" in text[spans[i][1] : spans[j][0]]:
                break
            if words[j] in tagged:
                # A further name of the same tag has its own place, and is weighed with the tag.
                name(first, j + 1, "" if first == i else "SPDX-License-Identifier: ")
                first = j + 1
            elif words[j] in ("and", "or", "with"):
                first = j + 1
            else:
                break
    done: dict[int, int] = {}
    blocks = set()
    for k, low, high in placements(words, templates):
        template = known[k][0]
        low = max(low, done.get(k, 0))  # behind the template's last notice
        if template[0] == _TAG or (found := align(template, words[low:high])) is None:
            continue
        start, end, missing, _, _ = found
        blocks.add((low + start, low + end))
        if len(missing) <= most_missing * len(template):
            done[k] = low + end
    for start, end in sorted(blocks):
        name(start, end)
    taken, kept = [], []
    for _, _, k, start, end, a, b, gain, missing, extra in sorted(confirmed.values(), key=lambda x: x[:5]):
        if all(end <= x or y <= start for x, y in taken):
            taken.append((start, end))
            kept.append((a, b, templates[k][0], gain, missing, extra))
    return sorted(kept, key=lambda x: x[:3])


def identify(block: str, templates, least_gain: float, most_missing: float) -> tuple[str, float, list[str], list[str]] | None:
    """(license, gain, missing, extra) of the longest confirmed notice in the block."""
    found = notices(block, templates, least_gain, most_missing)
    return max(found, key=lambda x: x[1] - x[0])[2:] if found else None


def scan_licenses(
    docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, least_gain: float = 0.15, most_missing: float = 0.25
) -> DataFrame:
    """(doc_id, start, end, license, gain, exact, missing, extra): one row per confirmed notice.

    start and end are code points of the part of the text that is aligned to the
    template, over line breaks and comment signs, end exclusive; ``gain`` is the share
    of that part's compressed size that the template saves; ``exact`` tells that no
    word differs; ``missing`` and ``extra`` list the words that do, blank-joined.
    A text gives several notices if they don't overlap; of those that do, the one that
    saves most bytes stays, then the one with fewer differing words, then the first
    template.  Every name of an SPDX tag is a notice; names that no template has are
    none.  Of licenses longer than a page the templates hold titles and headers.
    Null and empty texts give no row, nor do texts without license words, unless one of
    the ``templates`` holds none itself.  Null ids stay
    null, repeated rows give their notices each, whole long texts are read, an empty
    table gives an empty one.  Other columns are not read.  No shuffle.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 8 << 20):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch.column("text"))):
                for at, end in regions(text, templates):
                    for a, b, name, gain, missing, extra in notices(text[at:end], templates, least_gain, most_missing):
                        rows.append((doc_id, at + a, at + b, name, round(gain, 6), not missing and not extra, " ".join(missing), " ".join(extra)))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.bool_(), pa.string(), pa.string()]
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["doc_id", "start", "end", "license", "gain", "exact", "missing", "extra"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        emit, "doc_id long, start long, end long, license string, gain double, exact boolean, missing string, extra string"
    )
