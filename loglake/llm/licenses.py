"""License scans by conditional compression.

Texts with a cue (one of few words that every notice must have one of, worked out from the templates)
are taken as words. The words around a cue that a template would need are a candidate block, blank lines
and list marks or not. It is compressed alone and with the template as raw zstandard dictionary: the
template that saves most explains the block best. Templates are tried in order of what they
save, and the first whose wording is really there, word by word but for few differences, is
reported with its place and the differences. If the differences touch what names a license or
its version, it is another one: when no template fits, that is reported as an unknown variant.

Only texts with a cue leave the scan; nothing is shuffled. Work is linear in the text.
"""

from __future__ import annotations

import difflib
import re
from collections import Counter
from collections.abc import Iterator, Sequence, Set
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Template(NamedTuple):
    """A license by its SPDX name, and a wording of its notice."""

    license: str
    text: str


#: The family of licenses that begin with the sentence of the BSD conditions.
BSD = "BSD"
#: Customary wordings of public licenses.
TEMPLATES = (
    Template("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    Template("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    Template(
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    Template("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    Template(
        BSD,
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
    Template("CC-BY-4.0", "Licensed under CC BY 4.0."),
    Template("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    Template("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    Template("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    Template("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    Template("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    Template("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    Template("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    Template("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    Template("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    Template("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    Template(
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    Template(
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    Template("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    Template("MIT", "Released under the MIT License."),
    Template("MIT", "Licensed under the MIT License."),
    Template(
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions",
    ),
    Template(
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    Template("Unlicense", "This is free and unencumbered software released into the public domain."),
    Template("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    Template(
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
        "list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    Template(
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
        "list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
    ),
    Template(
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
        "this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
)
#: Share of a template's words that must be there, in order; words of it that may be missing, changed or added.
COVERAGE = 0.85
LEVEL = 19
#: Letters of a word that may be a cue, if a template has enough of them.
CUE_LETTERS = 6
#: License of a notice that is worded like a template but names something else.
UNKNOWN = "unknown variant"
#: Words that name a license: a template's own must be there, others may not come in.
NAMES = frozenset(
    "affero apache artistic attribution attribution-noncommercial attribution-noncommercial-noderivatives "
    "attribution-noncommercial-sharealike attribution-noderivatives attribution-sharealike boost bsd by by-nc by-nc-nd by-nc-sa "
    "by-nd by-sa cc cc0 cddl commons creative eclipse eupl european general gnu isc lesser library mit mozilla mpl public "
    "unencumbered universal".split()
)
#: What narrows or widens a license when it is added to its name.
QUALIFIERS = NAMES - frozenset("by cc commons creative general public universal".split()) | frozenset(
    "alike commercial derivatives derivs no-derivatives no-derivs noderivatives noderivs non non-commercial noncommercial nc nd sa "
    "share share-alike sharealike".split()
)
_VERSION = re.compile(r"v?(\d{1,2}(?:\.\d+)*?)(?:\.0)*(-clause)?")
_WORD = re.compile(r"\w+(?:[.\-]\w+)*")
#: The number of an item of a list, which is no version.
_LIST_MARK = re.compile(r"(?:^|[.:;\n])\s{0,40}(?:[*#/-]{1,4}\s{0,40})?\(?(\d{1,2})[.)](?=\s)")
FOUND = "license string, template int, start long, end long, saved int, coverage double, differences array<string>"


def _spelled(word: str) -> str:
    """One spelling of a version: 2, 2.0 and v2.0 are the same."""
    version = _VERSION.fullmatch(word)
    return version[1] + (version[2] or "") if version else word


class _Word(NamedTuple):
    word: str
    spelled: str
    start: int
    end: int


def _words(text: str) -> list[_Word]:
    marks = {m.start(1) for m in _LIST_MARK.finditer(text)}
    found = ((m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text) if m.start() not in marks)
    return [_Word(w, _spelled(w) if w[-1].isdigit() or w.endswith("-clause") else w, a, b) for w, a, b in found]


def cue_words(templates: Sequence[Template]) -> list[str]:
    """Words of which every notice has one: of each template more than may be missing.

    Words that most templates have come first, so that they are few.
    """
    given = [[w.spelled for w in _words(t.text)] for t in templates]
    common = Counter(w for words in given for w in set(words))
    cues: set[str] = set()
    for template, words in zip(templates, given, strict=True):
        if not words:
            raise ValueError(f"a template of {template.license} has no words")
        share = Counter(words)
        missing = len(words) * (1 - COVERAGE) - sum(share[w] for w in cues & share.keys())
        for word in sorted(share, key=lambda w: (len(w) < CUE_LETTERS or not w.isalpha(), -common[w], -len(w), w)):
            if missing < 0:
                break
            if word not in cues:
                cues.add(word)
                missing -= share[word]
    return sorted(cues)


class _Scanner:
    def __init__(self, templates: Sequence[Template]) -> None:
        self.templates, self.cues = templates, frozenset(cue_words(templates))
        own = [_words(t.text) for t in templates]
        self.words = [[w.word for w in words] for words in own]
        self.spelled = [[w.spelled for w in words] for words in own]
        self.shares = [Counter(words) for words in self.spelled]
        #: Where a cue is in the templates: (template, its places there).
        self.places: dict[str, list[tuple[int, list[int]]]] = {
            cue: [(i, [p for p, w in enumerate(words) if w == cue]) for i, words in enumerate(self.spelled) if cue in words]
            for cue in self.cues
        }
        self.plain = zstandard.ZstdCompressor(level=LEVEL)
        self.given, self.sizes = [], []
        for template in templates:
            content = template.text.lower().encode()
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.given.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary))
            self.sizes.append(len(self.plain.compress(content)))

    def enough(self, template: int, words: Set[str]) -> bool:
        """Whether as many words of a template as it needs are among the words."""
        share = self.shares[template]
        return sum(n for w, n in share.items() if w in words) >= COVERAGE * len(self.spelled[template])

    def window(self, words: list[_Word], floor: int, start: int, template: int) -> tuple[int, int]:
        """The words that may hold a template that starts at `start`, if few are added or missing."""
        size = len(self.words[template])
        slack = max(2, size // 4)
        return max(floor, start - slack), min(len(words), start + size + slack)

    def ranked(self, text: str, words: list[_Word], floor: int, cue: int, possible: Set[int]) -> list[tuple[int, int, list[tuple[int, int]]]]:
        """(bytes saved, template, windows), the best first; of equal savings the shorter template."""
        saved = []
        for i, places in self.places[words[cue].spelled]:
            if i not in possible:
                continue
            windows = [self.window(words, floor, cue - p, i) for p in places]
            windows = [(low, high) for low, high in windows if self.enough(i, {w.spelled for w in words[low:high]})]
            if windows:
                data = text[words[min(windows)[0]].start : words[max(high for _, high in windows) - 1].end].lower().encode()
                saved.append((len(self.plain.compress(data)) - len(self.given[i].compress(data)), i, windows))
        return sorted((x for x in saved if x[0] > 0), key=lambda x: (-x[0], self.sizes[x[1]], x[1]))

    def confirm(self, words: list[_Word], low: int, high: int, cue: int, template: int) -> tuple[int, int, float, list[str]] | None:
        """First and last word, share of the template's words, and differences; None if too many or the cue is outside."""
        wanted = self.words[template]
        matcher = difflib.SequenceMatcher(None, [w.spelled for w in words[low:high]], self.spelled[template], autojunk=False)
        same = [m for m in matcher.get_matching_blocks() if m.size]
        coverage = sum(m.size for m in same) / len(wanted)
        if coverage < COVERAGE:
            return None
        first, last = low + same[0].a, low + same[-1].a + same[-1].size
        if not first <= cue < last or last - first > len(wanted) / COVERAGE:
            return None
        differences = []
        for kind, a, b, c, d in matcher.get_opcodes():
            inside = first <= low + a and low + b <= last
            if kind != "equal" and (inside or d > c):
                added = [w.word for w in words[low + a : low + b]] if inside else []
                differences.append(" ".join([*(f"-{w}" for w in wanted[c:d]), *(f"+{w}" for w in added)]))
        return first, last - 1, coverage, differences

    def names_another(self, template: int, differences: Sequence[str]) -> bool:
        """Whether the differences touch the name, clauses or version of a template's license."""
        own = {_spelled(w) for w in self.words[template]}
        for difference in differences:
            words = difference.split(" ")
            gone, come = ({_spelled(w[1:]) for w in words if w[0] == sign} for sign in "-+")
            if any(w in NAMES or _VERSION.fullmatch(w) for w in gone - come):
                return True
            if any(w in QUALIFIERS or _VERSION.fullmatch(w) for w in come - own):
                return True
        return False

    def scan(self, text: str) -> list[tuple]:
        words = _words(text)
        vocabulary = {w.spelled for w in words}
        possible = {i for i in range(len(self.templates)) if self.enough(i, vocabulary)}
        found, floor = [], 0
        for cue, word in enumerate(words if possible else ()):
            if cue < floor or word.spelled not in self.cues:
                continue
            best = None
            for saved, template, windows in self.ranked(text, words, floor, cue, possible):
                tried = (self.confirm(words, low, high, cue, template) for low, high in windows)
                there = max(filter(None, tried), key=lambda t: t[2], default=None)
                if there and not self.names_another(template, there[3]):
                    best = (self.templates[template].license, template, saved, there)
                    break
                if there and not best:
                    best = (UNKNOWN, template, saved, there)
            if best:
                license_, template, saved, (first, last, coverage, differences) = best
                found.append((license_, template, words[first].start, words[last].end, saved, coverage, differences))
                floor = last + 1
        return found


def scan_licenses(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """A row per notice found: doc_id, license (or UNKNOWN), template (number), start and end (code points,
    end exclusive), saved (bytes), coverage (share of its words), differences (`-` words of the
    template that are not there, `+` others in their place).

    Notices of a text do not overlap. Missing and empty texts have none; repeated rows have theirs each; other columns are left out.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _Scanner(templates)
        for batch in batches:
            rows = [(i, *f) for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True) for f in scanner.scan(t)]
            columns = list(zip(*rows, strict=True)) or [[]] * 8
            types = [batch.schema.field("doc_id").type, pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.list_(pa.string())]
            names = ["doc_id", "license", "template", "start", "end", "saved", "coverage", "differences"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    cue = "(?iu)" + "|".join(re.escape(w) for w in cue_words(templates))
    cued = docs.select("doc_id", "text").where(F.col("text").rlike(cue))
    return cued.mapInArrow(scan, f"doc_id {kind}, {FOUND}")
