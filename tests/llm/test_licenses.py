import duckdb
import pytest
from helpers import awkward, docs

from corpusloom.llm import licenses as L

MIT = """MIT License

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction.

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, express or implied."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at http://www.example.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES."""
CASES = [
    (1, MIT, "MIT", 1), (2, APACHE, "Apache-2.0", 1), (3, "Released under the MIT License.", "MIT", 1),
    (4, "x y. Licensed under CC BY-NC 4.0.\nThis work is licensed under the GNU General Public License, version 3.", "GPL-3.0,CC-BY-NC", 2),
    (5, "Released under the MIT License. Released under the MIT License.", "MIT", 2), (6, "a new kind of license version agreement", "", 0),
    (7, "// SPDX-License-Identifier: Apache-2.0\ncode", "Apache-2.0", 1), (8, "All rights reserved.", "", 0),
    (9, "Licensed under the Apache License, Version 2.0.", "Apache-2.0", 1),
]


def test_cases(spark):
    out = {r.doc_id: r for r in L.scan(docs(spark, [(i, t) for i, t, _, _ in CASES])).collect()}
    for i, _, names, n in CASES:
        assert (out[i].licences, out[i].n_matches) == (names, n), out[i]
    assert out[6].sequence == "?" and out[6].n_unmatched == 1 and out[8].sequence == "all-rights"


GPL = """This program is free software; you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published
by the Free Software Foundation; either version {} of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU General Public License for more details.

You should have received a copy of the GNU {}General Public License along with this program."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
{}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES ARE DISCLAIMED."""
ENDORSE = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely."""
BOOST = """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY."""
MPL = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
EPL = "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0 which accompanies this distribution."
STANDARD = {
    "MIT": MIT, "Apache-2.0": APACHE, "GPL-2.0": GPL.format("", 2, ""), "GPL-3.0": GPL.format("", 3, ""), "LGPL": GPL.format("Lesser ", 3, "Lesser "),
    "AGPL-3.0": GPL.format("Affero ", 3, "Affero "), "BSD-2-Clause": BSD.format(""), "BSD-3-Clause": BSD.format(ENDORSE), "ISC": ISC, "Zlib": ZLIB,
    "BSL-1.0": BOOST, "MPL-2.0": MPL, "EPL-2.0": EPL,
    "Unlicense": "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell it.",
    "CC-BY-SA": "This work is licensed under a Creative Commons BY-SA 4.0 International License.", "CC-BY": "Text is available under CC BY 4.0 terms.",
    "CC-BY-NC": "Licensed under CC BY-NC 4.0.", "CC-BY-NC-SA": "Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-ND": "Released under CC BY-NC-ND 4.0.",
    "CC0-1.0": "To the extent possible under law this work is dedicated to the public domain (CC0 1.0).",
}


def wrapped(text, width, mark, first="", last=""):
    import textwrap
    lines = [line for block in text.split("\n\n") for part in block.split("\n") for line in [*textwrap.wrap(part, width)]]
    paragraphs = ["\n".join(f"{mark}{x}" for part in block.split("\n") for x in textwrap.wrap(part, width)) for block in text.split("\n\n")]
    assert lines
    return first + f"\n{mark.rstrip()}\n".join(paragraphs) + last


@pytest.mark.parametrize("style", ["plain", "wrapped", "stars", "slashes", "hashes"])
def test_standard_texts(spark, style):
    """Twenty licences as one line a paragraph, hard-wrapped, and in comments."""
    form = {"plain": lambda t: t, "wrapped": lambda t: wrapped(t, 72, ""), "stars": lambda t: wrapped(t, 70, " * ", "/*\n", "\n */\nint main;"),
            "slashes": lambda t: wrapped(t, 60, "// ", "", "\ncode();"), "hashes": lambda t: wrapped(t, 66, "# ", "#!/bin/sh\n#\n")}[style]
    names = sorted(STANDARD)
    rows = [(i, form(STANDARD[n])) for i, n in enumerate(names)]
    out = {r.doc_id: r for r in L.scan(docs(spark, rows)).collect()}
    assert {n: out[i].licences for i, n in enumerate(names)} == {n: n for n in names}
    con = duckdb.connect()
    con.register("documents", docs(spark, rows).select("doc_id", "text").toPandas())
    assert sorted(map(tuple, con.execute(L.oracle()).fetchall())) == sorted(map(tuple, out.values()))


def test_mentions_with_more_words(spark):
    rows = [(1, "Licensed under the MIT License, see LICENSE for details."), (2, "# SPDX-License-Identifier: LGPL-2.1-or-later"),
            (3, "// SPDX-License-Identifier: AGPL-3.0-only"), (4, "/* SPDX-License-Identifier: ISC */"), (5, "The licence of a pub is no licence")]
    out = {r.doc_id: r.licences for r in L.scan(docs(spark, rows)).collect()}
    assert out == {1: "MIT", 2: "LGPL", 3: "AGPL-3.0", 4: "ISC", 5: ""}


def test_every_pattern_needs_an_anchor():
    import re
    for _, pattern in L.SENTENCES:
        required = re.sub(r"\([^()]*\)[?*]", "", re.sub(r"\([^()]*\)\?", "", pattern))
        assert any(a in required for a in L.ANCHORS), pattern


@pytest.mark.parametrize("rows", [awkward(), [(i, t) for i, t, _, _ in CASES], []])
def test_sql_oracle(spark, rows):
    d = docs(spark, [r for r in rows if r[0] not in (None, 8, 12)])
    if not rows:
        assert L.scan(d.limit(0)).count() == 0
        return
    con = duckdb.connect()
    con.register("documents", d.select("doc_id", "text").toPandas())
    want = sorted(map(tuple, con.execute(L.oracle()).fetchall()))
    assert sorted(map(tuple, L.scan(d).collect())) == want


def test_null_and_repeated_rows(spark):
    out = L.scan(docs(spark, awkward())).collect()
    assert len(out) == len(awkward()) and all(r.sequence == "" for r in out)
