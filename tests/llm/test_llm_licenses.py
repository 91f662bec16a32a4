import random
import re
import textwrap

import pytest
from brute import documents, empty

from arrivalmart.llm import licenses

# A notice of every template with its licence.
NOTICES = [(name, text) if name else ("BSD-3-Clause OR MIT", f"{text} BSD-3-Clause OR MIT.") for name, text in licenses.TEMPLATES]
MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software\nand associated documentation files (the \"Software\"), to deal in the Software without\nrestriction, including"


@pytest.mark.parametrize(
    ("text", "names"),
    [
        ("", []),
        ("Words before. Licensed under the Apache License, Version 2.0. Words after", ["Apache-2.0"]),
        ("Licensed under CC BY-NC 4.0.\nmore", ["CC-BY-NC-4.0"]),
        ("Licensed under CC BY-NC 2.5.", []),
        ("Licensed under CC BY-SA 3.0.", ["CC-BY-SA-3.0"]),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.", ["CC-BY-SA-3.0"]),
        ("It is licensed under the terms of the MIT license; so is this", ["MIT"]),
        ("Distributed under the Boost Software License, Version 1.0.", ["BSL-1.0"]),
        ("available under the terms of the Eclipse Public License v2.0", ["EPL-2.0"]),
        ("released under the GNU GPL v3", ["GPL-3.0"]),
        ("# SPDX-License-Identifier: BSD-3-Clause\nimport os", ["BSD-3-Clause"]),
        ("/* SPDX-License-Identifier: GPL-2.0-or-later */ int main", ["GPL-2.0-or-later"]),
        ("// SPDX-License-Identifier: (GPL-2.0+ OR MIT) AND Apache-2.0\n", ["GPL-2.0+ OR MIT AND Apache-2.0"]),
        ("SPDX-License-Identifier: MIT or so", ["MIT"]),
        ("SPDX-License-Identifier: MIT OR", ["MIT"]),
        ("SPDX-License-Identifier:", []),
        ("the creative work of a mit student, hereby shown, is not under any license", []),
        ("Licensed under CC BY 4.0.", ["CC-BY-4.0"]),
        ("This work is licensed under the GNU General Public License, version 2.", ["GPL-2.0"]),
        ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0"]),
        ("This work is licenced under the GNU General Public License, version 3.", ["GPL-3.0"]),
        ("LICENSED UNDER THE MIT LICENSE. Licensed under CC BY 4.0.", ["MIT", "CC-BY-4.0"]),
        ("this work by someone else. Licensed under CC BY-SA 4.0.", ["CC-BY-SA-4.0"]),
        ("a driving license, version 2.0, is needed", []),
        ("the license of the work is unknown", []),
        (MIT, ["MIT"]),
        ("x " * 50_000 + "Licensed under the BSD 3-Clause License. " + "y " * 50_000, ["BSD-3-Clause"]),
    ],
)
def test_notices(text, names):
    found = licenses.notices(text)
    assert [f.license for f in found] == names
    for f in found:
        assert 0 <= f.start < f.end <= len(text) and f.saved >= licenses.LEAST_SAVED


def test_every_template_is_found_in_its_own_text():
    for name, text in NOTICES:
        if re.search(licenses.MENTION, text, re.IGNORECASE):
            assert name in [f.license for f in licenses.notices(f"Words first.\n{text}\nWords last.")], text


PROSE = (
    "The valley lies between two ranges of low hills, and a narrow road follows the river down to the old market town, where boats "
    "once carried wool and timber to the coast. Few travellers stop there now, though its bridge and chapel are worth an hour of anyone's "
    "time. In spring the meadows flood, and herons stand along the banks until the water has gone. "
)


@pytest.mark.parametrize("n", [0, 60, 100, 250])
def test_every_template_is_found_in_a_line_of_prose(n):
    before, after = PROSE[len(PROSE) - n :] if n else "", PROSE[:n]
    for name, text in NOTICES:
        if re.search(licenses.MENTION, text, re.IGNORECASE):
            found = licenses.notices(f"{before}{text} {after}")
            assert [f.license for f in found] == [name], (name, text)
            assert found[0].saved >= licenses.LEAST_SAVED


def test_every_template_has_a_mention():
    assert all(re.search(licenses.MENTION, text, re.IGNORECASE) for _, text in licenses.TEMPLATES)
    assert all(any(w in licenses.MENTIONS or licenses.MENTIONS.intersection(re.split("[.-]", w)) for w in t.words) for t in licenses.templates())
    assert not licenses.MENTIONS & licenses.COMMON


@pytest.mark.parametrize("sign", ["", "# ", " * ", "// "])
@pytest.mark.parametrize("above", ["", "Copyright (C) 2019 The Example Project Developers <dev@example.org>\n\n", f"{PROSE}\n", "A tool\n"])
@pytest.mark.parametrize("width", [20, 40, 70])
def test_every_template_is_found_wrapped(sign, above, width):
    for name, text in NOTICES:
        lines = [*above.split("\n"), *textwrap.wrap(text, width), "", *textwrap.wrap(PROSE, width)]
        wrapped = "\n".join(sign + line for line in lines)
        assert re.search(licenses.MENTION, wrapped, re.IGNORECASE)
        found = licenses.notices(wrapped)
        assert [f.license for f in found] == [name], text
        assert found[0].saved > 1.5 * licenses.LEAST_SAVED


def test_notices_broken_over_lines():
    gpl = """Copyright (C) 2019 The Example Project Developers <dev@example.org>
This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version."""
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy"
    cc = "This work is\nlicensed under a Creative Commons Attribution 4.0 International License."
    assert [[f.license for f in licenses.notices(t)] for t in (gpl, mpl, cc)] == [["GPL-2.0-or-later"], ["MPL-2.0"], ["CC-BY-4.0"]]


def test_many_notices_in_a_row():
    own = [NOTICES[k % len(NOTICES)] for k in range(1500)]
    assert [f.license for f in licenses.notices(" ".join(text for _, text in own))] == [name for name, _ in own]


def test_the_rank_decides():
    """Two templates are held whole by a text; the one that saves more is its notice, though it comes later among the templates."""
    long = next(k for k, (_, text) in enumerate(licenses.TEMPLATES) if "in compliance with" in text)
    text = f"{PROSE}{licenses.TEMPLATES[long][1]} {PROSE}"
    own = licenses.words_of_text(text)
    words = [w for w, _, _ in own]
    ranked = licenses.ranked(words, words.index("apache"), 0, len(words))
    held = [n for _, n, low, high in ranked if licenses.wording(licenses.templates()[n].words, own[low:high])]
    assert held[0] == long and min(held[1:]) < long
    assert [f.template for f in licenses.notices(text)] == [long]


def plain_notices(text):
    """All templates against all windows of the words, without mentions or blocks; of those that share words, the one that saves most bytes."""
    own, every = licenses.words_of_text(text), set()
    for number, t in enumerate(licenses.templates()):
        size = int((1 + licenses.ADDED) * len(t.words)) + (12 if licenses.TEMPLATES[number][0] is None else 0)
        for begin in range(len(own)):
            window = own[begin : begin + size]
            at = licenses.wording(t.words, window)
            if at and at[0] == 0:
                part = " ".join(w for w, _, _ in window[: at[1]]).encode()
                saved = len(licenses._alone().compress(part)) - len(t.compressor.compress(part))
                name, last, end = licenses.TEMPLATES[number][0], at[1], window[at[1] - 1][2]
                if name is None:
                    name, last, end = licenses.expression(text, window, last, len(window))
                if name:
                    every.add((saved, -number, begin, begin + last, name, window[0][1], end))
    taken, found = set(), []
    for _, _, first, last, name, start, end in sorted(every, key=lambda e: (-e[0], -e[1], e[2])):
        if taken.isdisjoint(range(first, last)):
            taken.update(range(first, last))
            found.append((start, end, name))
    return sorted(found)


def test_equal_to_all_templates_at_all_windows():
    draw = random.Random(4)
    prose = PROSE.split()
    for _ in range(60):
        parts = []
        for _ in range(draw.randint(1, 5)):
            parts.append(" ".join(draw.choices(prose, k=draw.randint(0, 40))))
            parts.append(draw.choice(NOTICES)[1])
        text = draw.choice([" ", "\n", ". "]).join([*parts, "and so on"])
        assert [(f.start, f.end, f.license) for f in licenses.notices(text)] == plain_notices(text), text


def test_a_broken_notice_beside_a_whole_one():
    text = "Redistribution and use in source and also binary forms, with or without modification, are permitted provided that the following conditions are met. "
    whole = next(t for name, t in licenses.TEMPLATES if name == "BSD")
    assert [(f.license, f.added) for f in licenses.notices(f"{text} {whole}. {text}")] == [("BSD", "also"), ("BSD", ""), ("BSD", "also")]


def test_differences_are_told():
    found = licenses.notices("This work is licensed under the new GNU General Public License version 3")[0]
    assert found.license == "GPL-3.0" and found.added == "new" and found.missing == ""


def test_equal_to_a_search_for_the_lines(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lines = {
        "Licensed under CC BY-NC 4.0": "CC-BY-NC-4.0",
        "This work is licensed under the GNU General Public License, version 3": "GPL-3.0",
        "Licensed under the Apache License, Version 2.0": "Apache-2.0",
        "Released under the MIT License": "MIT",
    }
    expected = {(r.doc_id, name) for r in docs.collect() for line, name in lines.items() if line in (r.text or "")}
    assert {(r.doc_id, r.license) for r in licenses.scan(docs).collect()} == expected


def test_rows_of_every_kind(spark):
    found = licenses.scan(documents(spark))
    assert [(r.doc_id, r.license) for r in found.collect()] == [(15, "MIT")]
    assert licenses.scan(empty(spark)).count() == 0
