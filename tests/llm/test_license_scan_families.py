"""Licences of the LGPL, AGPL, EPL and BSD families, as they stand in files."""

import pytest

from tests.llm.helpers import odd_documents
from tests.llm.test_license_scan import found
from tests.llm.test_license_scan_wrapped import forms

# Notices and headers of public licences.
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.
"""
AGPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.
"""
EPL = """This program and the accompanying materials are made
available under the terms of the Eclipse Public License 2.0
which is available at https://www.eclipse.org/legal/epl-2.0/
"""
BSD_2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_3 = BSD_2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


@pytest.mark.parametrize(
    ("text", "licence"),
    [(LGPL, "LGPL-2.1-or-later"), (AGPL, "AGPL-3.0-or-later"), (EPL, "EPL-2.0"), (BSD_2, "BSD-2-Clause"), (BSD_3, "BSD-3-Clause")],
)
def test_whole_notice_is_one_match(spark, text, licence):
    # narrow wrapping of an address or a numbered list isn't among the forms of a file
    texts = list(forms(text))[:7] + [text.replace("1. ", "").replace("2. ", "").replace("3. ", "") if "BSD" in licence else text]
    got = found(odd_documents(spark, texts))
    assert [[r[3] for r in got if r[0] == i] for i in range(len(texts))] == [[licence]] * len(texts)


def test_references_and_near_misses(spark):
    texts = {
        "Licensed under the BSD 3-Clause License.": ["BSD-3-Clause"],
        "This software is released under the BSD 2-Clause License.": ["BSD-2-Clause"],
        "GNU Affero General Public License v3.0": ["AGPL-3.0"],
        "GNU Lesser General Public License v2.1\n": ["LGPL-2.1"],
        "It is not licensed under the BSD 3-Clause License.": [],
        "1. one\n2. two\n1\n2\n3": [],
        "1. Redistributions of source code must be fun.": [],
        BSD_2.replace("this list of conditions", "that list of conditions"): ["BSD"],
    }
    got = found(odd_documents(spark, list(texts)))
    assert [[r[3] for r in got if r[0] == i] for i in range(len(texts))] == list(texts.values())
