"""Original licence texts as they stand in files: wrapped, commented, with abbreviations."""

import textwrap

import pytest

from tests.llm.helpers import documents, odd_documents
from tests.llm.test_license_scan import expected, found

MIT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0
"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
TEXTS = [(MIT, ["MIT", "MIT"]), (APACHE, ["Apache-2.0"]), (GPL, ["GPL-3.0-or-later"]), (BSD, ["BSD"]), (MPL, ["MPL-2.0"])]


def forms(text):
    lines = text.splitlines()
    yield text
    yield text.replace("\n", "\r\n")
    for mark in ("# ", "// ", " * ", "-- ", ";; "):
        yield "\n".join(mark + line for line in lines)
    yield "/*\n" + "\n".join(" * " + line for line in lines) + "\n */\nint main"
    for width in (12, 40):
        yield "\n\n".join(textwrap.fill(p, width, break_long_words=False, break_on_hyphens=False) for p in text.split("\n\n"))


@pytest.mark.parametrize(("text", "licences"), TEXTS)
def test_wrapped_texts(spark, text, licences):
    texts = list(forms(text))
    got = found(odd_documents(spark, texts))
    assert [[r[3] for r in got if r[0] == i] for i in range(len(texts))] == [licences] * len(texts)


def test_whole_mit_text_is_one_match(spark):
    (title, grant) = found(odd_documents(spark, [MIT]))
    assert title[1:] == (0, 1, "MIT") and grant[1:] == (2, 16, "MIT")


def test_openings_and_others(spark):
    texts = {
        "This software is released under the MIT License.": ["MIT"],
        "The project is\nlicensed under CC BY 4.0.": ["CC-BY-4.0"],
        "Licensed under\nthe Apache License, Version 2.0.": ["Apache-2.0"],
        "Licensed under\nCC BY-NC 4.0.": ["CC-BY-NC-4.0"],
        "Licensed under the GNU General Public License, version 2.": ["GPL-2.0-only"],
        "It is not licensed under the MIT License.": [],
        "Released under the BSD\nof that time, licensed under": [],
        "this\nthe\nthis software is\nreleased": [],
    }
    got = found(odd_documents(spark, list(texts)))
    assert [[r[3] for r in got if r[0] == i] for i in range(len(texts))] == list(texts.values())


def test_matches_of_whole_pieces_stay(spark):
    docs = documents(spark, "sf0.01")
    assert set(found(docs)) >= set(expected(docs))
