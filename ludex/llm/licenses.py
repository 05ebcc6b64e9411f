"""License scans by conditional compression.

Candidate blocks of a document (words that speak of licences, with as many words
on either side as the longest template has) are compressed with zstandard
twice: plainly, and with the wording of a template as raw dictionary. The less
is left of a block given a template, the more of its wording comes from it.
Templates are ranked by that size reduction, those that save nothing are out;
the first one in rank whose wording differs from the block by few words, none of
them a word that tells licences apart, is confirmed, with the differences. So of
two wordings that both are there, one being part of the other (BSD with two and
with three clauses), the one that explains more of the block is found. Its words
are taken out of the block and the rest is judged again, until no template is
confirmed.
"""

from __future__ import annotations

import difflib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludex.llm.common import read_table, text_chunks

# A template is confirmed when at most this share of its words is missing or
# changed.
MAX_DIFFERENCE = 0.15
# Triggers at most this many lines and characters apart are one mention; longer
# mentions are cut.
JOIN_LINES, MAX_LINE, MAX_BLOCK = 3, 1200, 6000
# A long block is judged in windows of this many reaches that overlap by one.
WINDOW = 5
LEVEL = 9
# Stands for words that are no longer compared.
TAKEN = "\x00"

# Words that mark a candidate line (in lower case) ...
TRIGGERS = ["licen", "copyright", "permission", "public domain", "spdx", "warrant",
            "redistribut", "cc by", "cc0", "creative commons"]
# ... words that tell licences apart, besides numbers ...
TELLING = {"lesser", "library", "affero", "nc", "sa", "nd", "noncommercial", "sharealike",
           "noderivatives", "not", "neither", "apache", "mit", "bsd", "isc", "mozilla", "gnu",
           "cc0", "eclipse", "unlicense", "boost"}
# ... and the wordings: common notices of each licence.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0",
     'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
     "except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
     'in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
     "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT",
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     'software and associated documentation files (the "Software"), to deal in the Software '
     "without restriction, including without limitation the rights to use, copy, modify, merge, "
     "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
     "to whom the Software is furnished to do so, subject to the following conditions: The above "
     "copyright notice and this permission notice shall be included in all copies or substantial "
     "portions of the Software."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-2-Clause",
     "Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met: Redistributions of source code "
     "must retain the above copyright notice, this list of conditions and the following "
     "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
     "list of conditions and the following disclaimer in the documentation and/or other "
     "materials provided with the distribution."),
    ("BSD-3-Clause",
     "Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met: Redistributions of source code "
     "must retain the above copyright notice, this list of conditions and the following "
     "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
     "list of conditions and the following disclaimer in the documentation and/or other "
     "materials provided with the distribution. Neither the name of the copyright holder nor the "
     "names of its contributors may be used to endorse or promote products derived from this "
     "software without specific prior written permission."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-or-later",
     "This program is free software: you can redistribute it and/or modify it under the terms of "
     "the GNU General Public License as published by the Free Software Foundation, either version "
     "3 of the License, or (at your option) any later version."),
    ("GPL-2.0-or-later",
     "This program is free software; you can redistribute it and/or modify it under the terms of "
     "the GNU General Public License as published by the Free Software Foundation; either version "
     "2 of the License, or (at your option) any later version."),
    ("GPL-2.0",
     "This program is free software; you can redistribute it and/or modify it under the terms of "
     "the GNU General Public License version 2 as published by the Free Software Foundation."),
    ("LGPL-2.1-or-later",
     "This library is free software; you can redistribute it and/or modify it under the terms of "
     "the GNU Lesser General Public License as published by the Free Software Foundation; either "
     "version 2.1 of the License, or (at your option) any later version."),
    ("AGPL-3.0-or-later",
     "This program is free software: you can redistribute it and/or modify it under the terms of "
     "the GNU Affero General Public License as published by the Free Software Foundation, either "
     "version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0",
     "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
     "copy of the MPL was not distributed with this file, You can obtain one at "
     "https://mozilla.org/MPL/2.0/."),
    ("ISC",
     "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
     "without fee is hereby granted, provided that the above copyright notice and this permission "
     "notice appear in all copies."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-4.0",
     "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
     "International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("Unlicense",
     "This is free and unencumbered software released into the public domain."),
    ("EPL-2.0",
     "This program and the accompanying materials are made available under the terms of the "
     "Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
]
# Identifiers that are found in SPDX lines.
SPDX_IDS = ["0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause",
            "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0",
            "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC",
            "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT",
            "MPL-2.0", "Unlicense"]
TEMPLATES += [(name, f"SPDX-License-Identifier: {name}") for name in SPDX_IDS]

_WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*")
# Numbers of list items: after the start, a mark or "and" / "or", before a blank.
_ITEM = re.compile(r"(?:\A|[.:;]|[;,]\s*(?:and|or)\b)[\s*/#>;%-]*"
                   r"(\(?[0-9]{1,2}[.)]|\(?[A-Za-z]\))(?=[ \t])")
# The (first) identifier of an SPDX line, which is one word.
_SPDX = re.compile(r"(?i:license-identifier):[\s*/#>;%(-]*([A-Za-z0-9](?:[A-Za-z0-9.+-]*[A-Za-z0-9+])?)")
# Triggers; those of two words may be parted by a line break (and comment signs).
_BREAK = r"(?: |[ \t\r]*\n[\s*/#>;%-]*)"
_TRIGGER = re.compile("|".join(_BREAK.join(map(re.escape, t.split(" "))) for t in TRIGGERS),
                      re.IGNORECASE | re.ASCII)
_BROKEN = re.compile("|".join((_BREAK.join(map(re.escape, t.split(" ")))) for t in TRIGGERS
                              if " " in t))


def word_spans(text: str) -> list[tuple[str, int, int]]:
    """(word in lower case, start, end), without the numbers of list items; an
    SPDX identifier is one word."""
    items = {m.start(1) + m[1].startswith("(") for m in _ITEM.finditer(text)}
    words = [(m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text)
             if m.start() not in items]
    ids = {m.start(1): m for m in _SPDX.finditer(text)}
    if not ids:
        return words
    out: list[tuple[str, int, int]] = []
    for w, a, b in words:
        if a in ids:
            out.append((ids[a][1].lower(), *ids[a].span(1)))
        elif not out or a >= out[-1][2]:
            out.append((w, a, b))
    return out


def words_of(text: str) -> list[str]:
    return [w for w, _, _ in word_spans(text)]


def _plain(text: str) -> bytes:
    return " ".join(words_of(text)).encode()


def reach_of(templates: list[tuple[str, str]], max_difference: float = MAX_DIFFERENCE) -> int:
    """Words of the longest template, with those that may be put in."""
    longest = max((len(words_of(w)) for _, w in templates), default=0)
    return math.ceil(longest * (1 + max_difference)) + 1


def _speaks(text: str) -> bool:
    low = text.lower()
    return any(t in low for t in TRIGGERS) or bool(_BROKEN.search(low))


def _mentions(text: str, words: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """(first, last word) of the triggers of each mention."""
    if not words:
        return []
    starts = [a for _, a, _ in words]
    found: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        a, b = (max(0, bisect_right(starts, at) - 1) for at in (m.start(), m.end() - 1))
        last = found[-1] if found else None
        if last and m.start() - last[3] <= MAX_LINE and m.end() - last[2] <= MAX_BLOCK and \
                text.count("\n", last[3], m.start()) <= JOIN_LINES:
            last[1], last[3] = max(last[1], b), m.end()
        else:
            found.append([a, b, m.start(), m.end()])
    return [(a, b) for a, b, _, _ in found]


def _blocks(mentions: list[tuple[int, int]], n: int, reach: int) -> list[tuple[int, int]]:
    """(first, end word) of the blocks: mentions with their reach, joined where
    they overlap."""
    blocks: list[list[int]] = []
    for a, b in mentions:
        a, b = max(0, a - reach), min(n, b + 1 + reach)
        if blocks and a <= blocks[-1][1]:
            blocks[-1][1] = max(b, blocks[-1][1])
        else:
            blocks.append([a, b])
    return [(a, b) for a, b in blocks]


def candidate_blocks(text: str, reach: int | None = None) -> list[tuple[int, int, str]]:
    """(first line, last line, text) of the blocks that speak of licences, with
    ``reach`` words on either side; lines from 0."""
    reach = reach_of(TEMPLATES) if reach is None else reach
    words = word_spans(text) if _speaks(text) else []
    ends = [(words[a][1], words[b - 1][2]) for a, b in
            _blocks(_mentions(text, words), len(words), reach)]
    return [(text.count("\n", 0, a), text.count("\n", 0, b), text[a:b]) for a, b in ends]


class Scanner:
    """The templates as raw dictionaries, and the blocks judged so far."""

    def __init__(self, templates: list[tuple[str, str]] | None = None,
                 max_difference: float = MAX_DIFFERENCE):
        self.max_difference = max_difference
        options = {"level": LEVEL, "write_content_size": False, "write_checksum": False}
        self.alone = zstandard.ZstdCompressor(**options)
        self.templates = []
        templates = TEMPLATES if templates is None else templates
        self.reach = reach_of(templates, max_difference)
        for name, wording in templates:
            data = zstandard.ZstdCompressionDict(_plain(wording) + b" ",
                                                 dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.templates.append((name, words_of(wording),
                                   zstandard.ZstdCompressor(dict_data=data, **options)))
        self.bags = [Counter(wording) for _, wording, _ in self.templates]
        self.seen: dict[str, tuple] = {}

    def reductions(self, words: list[str]) -> list[tuple[float, int]]:
        """(share of the compressed size saved, template number), best first;
        ties by template order."""
        plain = " ".join(words).encode()
        alone = len(self.alone.compress(plain))
        return sorted(((1 - len(c.compress(plain)) / alone, i)
                       for i, (_, _, c) in enumerate(self.templates)),
                      key=lambda g: (-g[0], g[1]))

    def differences(self, template: int,
                    block: list[str]) -> tuple[int, list[str], int, int]:
        """(template words missing or changed, the differences as -old+new,
        first and end word that are equal) for the best alignment; text around
        the wording does not count."""
        wording = self.templates[template][1]
        matcher = difflib.SequenceMatcher(None, wording, block, autojunk=False)
        lost, notes, equal = 0, [], []
        for kind, a, b, c, d in matcher.get_opcodes():
            if kind == "equal":
                equal += [c, d]
                continue
            if kind == "insert" and (a == 0 or a == len(wording)):
                continue
            inner = block[c:d] if 0 < a and b < len(wording) else \
                block[c:d][: b - a] if a else block[max(c, d - b + a):d]
            lost += max(b - a, len(inner) if kind == "insert" else 0)
            notes.append(f"-{' '.join(wording[a:b])}+{' '.join(inner)}")
        return lost, notes, *((equal[0], equal[-1]) if equal else (0, 0))

    def aligned(self, template: int, block: list[str],
                limit: int) -> tuple[int, int, list[str]] | None:
        """(first, end word, differences) of a place of the block, first word
        below ``limit``, that confirms the template. Places are tried from their
        longest run of equal words, with the words that may belong to it."""
        wording, bag = self.templates[template][1], self.bags[template]
        may = self.max_difference * len(wording)
        slack, left = math.ceil(may), list(block)
        while len(wording) - (Counter(left) & bag).total() <= may:
            run = difflib.SequenceMatcher(None, wording, left, autojunk=False).find_longest_match()
            if not run.size:
                return None
            start = max(0, run.b - run.a - slack)
            near = left[start:run.b + len(wording) - run.a + slack]
            lost, notes, a, b = self.differences(template, near)
            changed = {w for note in notes for w in re.split(r"[-+ ]", note)}
            if b > a and start + a < limit and lost <= may and not (
                    changed & TELLING or any(w[0].isdigit() for w in changed if w)):
                return start + a, start + b, notes
            left[run.b:run.b + run.size] = [TAKEN] * run.size
        return None

    def confirmed(self, block: list[str], limit: int) -> tuple | None:
        """(first, end word, licence, reduction, rank, differences) of the first
        template in rank that is confirmed."""
        for rank, (gain, i) in enumerate(self.reductions(block), 1):
            if gain <= 0:
                break
            place = self.aligned(i, block, limit)
            if place:
                return *place[:2], self.templates[i][0], round(gain, 4), rank, place[2]
        return None

    def judge(self, block: str) -> tuple[str, float, int, list[str]]:
        """(licence or 'unknown', reduction, rank of the winner, differences)."""
        if block in self.seen:
            return self.seen[block]
        words = words_of(block)
        place = self.confirmed(words, len(words)) if words else None
        found = place[2:] if place else \
            ("unknown", round(self.reductions(words)[0][0], 4) if words else 0.0, 0, [])
        if len(self.seen) >= 50_000:
            self.seen.clear()
        self.seen[block] = found
        return found

    def scan(self, text: str) -> list[tuple[int, int, str, float, int, list[str]]]:
        """(first line, last line, licence, reduction, rank, differences) of the
        notices in a text, and of the mentions that no notice confirms."""
        words = word_spans(text) if _speaks(text) else []
        mentions = _mentions(text, words)
        if not mentions:
            return []
        left, found = [w for w, _, _ in words], []
        for first, end in _blocks(mentions, len(words), self.reach):
            for at in range(first, max(first + 1, end - self.reach), (WINDOW - 1) * self.reach):
                stop = min(end, at + WINDOW * self.reach)
                # A place that starts in the overlap is whole in the next window.
                limit = stop - at if stop == end else (WINDOW - 1) * self.reach
                while place := self.confirmed(left[at:stop], limit):
                    a, b = at + place[0], at + place[1]
                    found.append((a, b, *place[2:]))
                    left[a:b] = [TAKEN] * (b - a)
        for a, b in mentions:
            if not any(f[0] <= b and a < f[1] for f in found):
                line = text.rfind("\n", 0, words[a][1]) + 1, text.find("\n", words[b][2])
                block = text[max(line[0], words[a][1] - MAX_LINE):
                             min(line[1] if line[1] >= 0 else len(text), words[b][2] + MAX_LINE)]
                _, gain, _, _ = self.judge(block)
                found.append((a, b + 1, "unknown", gain, 0, []))
        return [(text.count("\n", 0, words[a][1]), text.count("\n", 0, words[b - 1][1]), *rest)
                for a, b, *rest in sorted(found, key=lambda f: f[:2])]


_FINDING = pa.struct([("license", pa.string()), ("first_line", pa.int32()),
                      ("last_line", pa.int32()), ("reduction", pa.float64()),
                      ("rank", pa.int32()), ("differences", pa.list_(pa.string()))])


def _scan(templates, max_difference: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, max_difference)
        for chunk in text_chunks(batches, "text"):
            rows = []
            for text in chunk.column("text").to_pylist():
                rows.append([dict(zip(_FINDING.names, f, strict=True)) for f in
                             ((name, first, last, *rest)
                              for first, last, name, *rest in scanner.scan(text or ""))])
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), pa.array(rows, pa.list_(_FINDING))],
                names=["doc_id", "findings"])

    return run


def license_scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None,
                 max_difference: float = MAX_DIFFERENCE) -> DataFrame:
    """``docs`` (doc_id, text) -> one row per document: doc_id and findings,
    one for each confirmed notice, and for each mention outside of them
    (``unknown``), in order (of an SPDX expression the first identifier counts): license, first_line, last_line, reduction (share of the compressed
    size), rank of the winner, differences in wording. No shuffle.

    Cases: NULL and empty texts have no findings. Templates of one reduction
    rank in their order. Repeated rows are reported each; doc_id may be NULL;
    other columns are ignored. An empty table gives an empty table."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _scan(templates, max_difference),
        f"doc_id {kind}, findings array<struct<license:string,first_line:int,last_line:int,"
        "reduction:double,rank:int,differences:array<string>>>")


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    found = license_scan(read_table(spark, sf_dir, "documents"))
    names = F.array_sort(F.array_distinct(F.transform("findings", lambda f: f["license"])))
    return found.select(
        "doc_id", F.size("findings").cast("bigint").alias("n_blocks"),
        F.array_join(names, ",").alias("licenses"),
        F.array_join(F.transform("findings", lambda f: F.concat_ws(
            ":", f["license"], f["first_line"], f["last_line"], F.size(f["differences"]))), ",")
        .alias("findings"))
