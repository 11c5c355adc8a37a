"""Standard licence texts and notices are recognised in their usual layout."""

from __future__ import annotations

import textwrap

import pytest

from hanji.llm import licenses

APACHE = [
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at',
    "    http://www.apache.org/licenses/LICENSE-2.0",
    'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
]
WARRANTY = "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
GPL2 = [
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    WARRANTY,
    "You should have received a copy of the GNU General Public License along with this program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.",
]
GPL3 = [
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    WARRANTY,
    "You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
]
MPL = ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."]
MPL_2 = [MPL[0].replace("http:", "https:")]
BSD2 = [
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
]
BSD3 = [*BSD2, "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."]
ISC = ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."]
MIT = [
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
]
GENUINE = {
    "apache-notice": APACHE, "gpl-2-notice": GPL2, "gpl-3-notice": GPL3, "mpl-notice": MPL, "mpl-notice-2": MPL_2,
    "bsd-2-text": BSD2, "bsd-3-text": BSD3, "isc-text": ISC, "mit-text": MIT,
}


def found(spark, layout):
    rows = [(k, layout(text)) for k, text in enumerate(GENUINE.values())]
    got = {r.doc_id: r.rules.split(",") for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    return {rule: got.get(k, []) for k, rule in enumerate(GENUINE)}


def test_genuine_texts(spark):
    got = found(spark, "\n\n".join)
    assert {rule for rule in GENUINE if rule not in got[rule]} == set()


@pytest.mark.parametrize("width", [70, 80])
@pytest.mark.parametrize("mark", ["", " * ", "# "])
def test_wrapped_texts(spark, width, mark):
    wrapped = lambda text: "\n\n".join(textwrap.fill(part, width) for part in text)
    got = found(spark, lambda text: textwrap.indent(wrapped(text), mark, lambda line: True))
    assert {rule for rule in GENUINE if rule not in got[rule]} == set()


def test_lines_of_their_own_still_count(spark):
    text = "Copyright 2020 A. Writer\nAll rights reserved\nReleased under the\nMIT License.\n\nReleased under\nthe MIT License"
    row = licenses.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.sentence_ids == "all-rights,mit-line" and row.licenses == "MIT,proprietary"


def test_the_longer_rule_alone(spark):
    rows = [(1, "\n\n".join(BSD3)), (2, "\n\n".join(BSD2)), (3, "\n\n".join([*BSD3, *BSD2])), (4, "\n\n".join([*BSD2, *BSD3]))]
    got = {r.doc_id: r.licenses for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "BSD-3-Clause", 2: "BSD-2-Clause", 3: "BSD-2-Clause,BSD-3-Clause", 4: "BSD-2-Clause,BSD-3-Clause"}
