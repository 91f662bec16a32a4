"""Licence notices found by conditional compression and confirmed by their exact wording.

Some words, such as the name of a licence, stand in every notice: around each of them lie the candidate blocks, for every template as many
words to both sides as its notice can take up. They are left out only where the words around lack some that each template's notices need. The
words of a block are compressed alone and with the template as a raw dictionary, and all templates are ranked by the bytes that they save.
From the first of the rank on, the differences between a template's words and its block's are taken; the first template that its block holds
whole, up to a bounded number of plain words, and with every word in place that tells it from other notices, such as a version, is a notice.
What is left around the word is ranked again, until no template is confirmed. Lines don't matter: a notice may be wrapped anywhere. An SPDX identifier is one notice for all licences: the words that
follow its template name them.
"""

from __future__ import annotations

import bisect
import difflib
import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame

from arrivalmart.llm.texts import column, parts_of

LEVEL = 19
# What a template must save of its own compressed size to be compared word by word; a whole notice saves several times as much.
LEAST_SAVED = 0.15
# The share of a notice's words that may be missing, and that may stand between its words.
MISSING = 0.1
ADDED = 0.2
# A word broken after a hyphen at the end of a line is one word, signs of a comment at the next line's begin left out.
BROKEN = re.compile(r"-[^\S\n]*\n[\s*#/;%]*")
WORD = re.compile(r"[^\W_]+(?:(?:[.\-]|-[^\S\n]*\n[\s*#/;%]*)[^\W_]+)*")

# The wording of public notices, by the SPDX name of the licence.
TEMPLATES: tuple[tuple[str | None, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "under the Apache License 2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "under the MIT License"),
    ("MIT", "under the terms of the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "under the GNU General Public License v2"),
    ("GPL-3.0", "under the GNU General Public License v3"),
    ("GPL-2.0", "under the GNU GPL v2"),
    ("GPL-3.0", "under the GNU GPL v3"),
    ("GPL-2.0", "under the GPLv2"),
    ("GPL-3.0", "under the GPLv3"),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("EPL-1.0", "under the terms of the Eclipse Public License v1.0"),
    ("EPL-2.0", "under the terms of the Eclipse Public License v2.0"),
    ("EPL-2.0", "under the terms of the Eclipse Public License 2.0"),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    (None, "SPDX-License-Identifier:"),
)
# The kinds and versions of Creative Commons licences, whose notices differ in nothing else.
KINDS = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
EDITIONS = {"3.0": "Unported", "4.0": "International"}
TEMPLATES += tuple((f"CC-{kind}-{edition}", f"under CC {kind} {edition}") for kind in KINDS for edition in EDITIONS)
TEMPLATES += tuple((f"CC-{kind}-{edition}", f"under a Creative Commons {name} {edition} {scope} License") for kind, name in KINDS.items() for edition, scope in EDITIONS.items())
# Words one of which each template has; none of them is among the common words below, so no notice lacks it; a part between hyphens or dots counts.
MENTIONS = frozenset("apache mit gnu gplv2 gplv3 mozilla bsd redistribution cc creative cc0 unencumbered restriction distribute boost eclipse spdx".split())
MENTION = "(?:^|[^0-9a-z])(?:" + "|".join(sorted(MENTIONS)) + ")(?:$|[^0-9a-z])"
# What may stand between an SPDX template and the name after it, and between the names of an expression.
BETWEEN = re.compile(r"[\s*#/;%:()\"'+]*")
JOINS = ("AND", "OR", "WITH")
# Words that many notices share. Any other word tells a notice apart and must be in place.
COMMON = frozenset(
    "a an and any are as be can by except following for form forms free granted hereby in is it license licensed licence licenced may met modify "
    "not of or permission permitted program provided published redistribute released software source subject terms that the this to under use version "
    "with without work you your file compliance conditions code person obtaining copy associated documentation files deal charge purpose fee".split()
)


def words_of_text(text: str) -> list[tuple[str, int, int]]:
    return [(BROKEN.sub("-", m[0]).lower(), m.start(), m.end()) for m in WORD.finditer(text)]


@dataclass(frozen=True)
class Found:
    license: str
    template: int
    start: int  # code points in the text
    end: int
    saved: float  # of the template's compressed size, in the window of the notice
    missing: str  # words of the notice that are not there
    added: str  # words between its words


@dataclass(frozen=True)
class Template:
    words: list[str]
    size: int  # compressed alone, beyond an empty frame
    compressor: zstandard.ZstdCompressor  # with the template as dictionary
    needed: frozenset[str]  # no notice with its wording lacks one of them
    reach: int  # words that its block takes in on both sides of a mention


@functools.cache
def _alone() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)


@functools.cache
def templates() -> list[Template]:
    found = []
    empty = len(_alone().compress(b""))
    for _, text in TEMPLATES:
        words = [w for w, _, _ in words_of_text(text)]
        needed = frozenset(w for w in words if w not in COMMON or int(MISSING * len(words)) == 0)
        raw = " ".join(words).encode()
        own = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_content_size=False, write_dict_id=False)
        found.append(Template(words, len(_alone().compress(raw)) - empty, compressor, needed, int((1 + ADDED) * len(words)) + 1))
    return found


@functools.cache
def widest() -> int:
    return max(t.reach for t in templates())


def ranked(words: list[str], k: int, begin: int, end: int) -> list[tuple[int, int, int, int]]:
    """Bytes that each template saves of its block's compressed size, its number, and the block's first word and the one after its last.

    Blocks lie around the word k, not before begin nor from end on; the templates that save most come first.
    """
    alone: dict[tuple[int, int], tuple[bytes, int]] = {}
    found = []
    for number, t in enumerate(templates()):
        at = max(begin, k - t.reach), min(end, k + t.reach + 1)
        if at not in alone:
            raw = " ".join(words[at[0] : at[1]]).encode()
            alone[at] = raw, len(_alone().compress(raw))
        raw, size = alone[at]
        saved = size - len(t.compressor.compress(raw))
        if saved >= LEAST_SAVED * t.size:
            found.append((saved, number, *at))
    return sorted(found, key=lambda f: (-f[0], f[1]))


def wording(template: list[str], own: list[tuple[str, int, int]]) -> tuple[int, int, list[str], list[str]] | None:
    """Where a notice's words stand in a block, first and last, and the words missing and added; None if it isn't there."""
    same = difflib.SequenceMatcher(a=template, b=[w for w, _, _ in own], autojunk=False).get_matching_blocks()[:-1]
    if not same:
        return None
    # From the longest agreement outwards; a stray word beyond a gap is not part of the notice.
    low = high = max(range(len(same)), key=lambda k: same[k].size)
    gap = ADDED * len(template)
    while low > 0 and same[low].b - same[low - 1].b - same[low - 1].size <= gap:
        low -= 1
    while high + 1 < len(same) and same[high + 1].b - same[high].b - same[high].size <= gap:
        high += 1
    same = same[low : high + 1]
    first, last = same[0].b, same[-1].b + same[-1].size
    held = {k for m in same for k in range(m.a, m.a + m.size)}
    used = {k for m in same for k in range(m.b, m.b + m.size)}
    missing = [w for k, w in enumerate(template) if k not in held]
    added = [own[k][0] for k in range(first, last) if k not in used]
    if len(missing) > MISSING * len(template) or len(added) > ADDED * len(template) or any(w not in COMMON for w in missing):
        return None
    return first, last, missing, added


def expression(text: str, block: list[tuple[str, int, int]], at: int, stop: int) -> tuple[str, int, int]:
    """The names of licences before the words at and stop, as an SPDX expression without brackets; the word after them, and their end."""
    names: list[str] = []
    end = block[at - 1][2]
    while at < stop and BETWEEN.fullmatch(text, end, block[at][1]):
        word = BROKEN.sub("-", text[block[at][1] : block[at][2]])
        joins = word in JOINS
        if joins == (len(names) % 2 == 0):
            break
        end = block[at][2]
        if not joins and text[end : end + 1] == "+":
            word, end = word + "+", end + 1
        names.append(word)
        at += 1
    if names and names[-1] in JOINS:
        names.pop()
        at -= 1
        end = block[at - 1][2] + (names[-1][-1] == "+")
    return " ".join(names), at, end


def winner(text: str, own: list[tuple[str, int, int]], words: list[str], k: int, begin: int, end: int) -> tuple[int, int, Found] | None:
    """Of the notices around the word k whose wording their block holds, the one that saves most; its first word and the one after its last."""
    have = set(words[begin:end])
    if not any(t.needed <= have for t in templates()):
        return None
    for saved, number, low, high in ranked(words, k, begin, end):
        t = templates()[number]
        # A notice beside the word is left to its own mention: the block may hold only a part of it.
        while (at := wording(t.words, own[low:high])) and not low + at[0] <= k < low + at[1]:
            low, high = (low + at[1], high) if low + at[1] <= k else (low, low + at[0])
        if not at:
            continue
        first, last, missing, added = low + at[0], low + at[1], at[2], at[3]
        name, close = TEMPLATES[number][0], own[last - 1][2]
        if name is None:
            name, last, close = expression(text, own, last, end)
            if not name:
                continue
        return first, last, Found(name, number, own[first][1], close, round(saved / t.size, 4), " ".join(missing), " ".join(added))
    return None


def notices(text: str) -> list[Found]:
    """All notices of a whole text, in order; no two share a word.

    Blocks end at notices found before. They are ranked until no notice is left around the mention or the mention is part of one, so
    each ranking gives a notice or is a mention's last.
    """
    own = words_of_text(text)
    words = [w for w, _, _ in own]
    found: list[tuple[int, int, Found]] = []  # apart from each other, in order
    for k, word in enumerate(words):
        if word not in MENTIONS and ("-" not in word and "." not in word or not MENTIONS.intersection(re.split("[.-]", word))):
            continue
        while True:
            after = bisect.bisect_right(found, k, key=lambda f: f[0])
            if after and found[after - 1][1] > k:
                break
            begin = max(k - widest(), found[after - 1][1] if after else 0)
            end = min(k + widest() + 1, found[after][0] if after < len(found) else len(own))
            won = winner(text, own, words, k, begin, end)
            if won is None:
                break
            found.insert(after, won)
    return [f for _, _, f in found]


FIELDS = "license string, template int, start long, end long, saved double, missing string, added string"


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each notice of each text: id, nth from 0, and the fields of Found.

    Null and empty texts have none, repeated rows repeat theirs, null ids are kept, other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in parts_of(batch, text_col):
                rows, found = [], []
                for row in pc.indices_nonzero(pc.match_substring_regex(texts, MENTION, ignore_case=True)).to_pylist():
                    for nth, own in enumerate(notices(texts[row].as_py())):
                        rows.append(row)
                        found.append((nth, own.license, own.template, own.start, own.end, own.saved, own.missing, own.added))
                kinds = (pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.string(), pa.string())
                columns = [pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds)]
                names = [id_col, "nth", "license", "template", "start", "end", "saved", "missing", "added"]
                yield pa.RecordBatch.from_arrays([column(part, id_col).take(pa.array(rows, pa.int64())), *columns], names)

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, nth int, {FIELDS}")
