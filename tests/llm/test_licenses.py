from __future__ import annotations

import re

import duckdb
import pytest

from hanji.llm import licenses

APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and limitations under the License."""
BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Words between. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
TEXTS = [
    "Some prose.\nReleased under the MIT License.\nMore.", "released UNDER the   mit, license", "He spoke of being released under the MIT License yesterday.", BSD, BSD.split("Words")[1],
    "All rights reserved. Licensed under CC BY-NC 4.0.\tAll rights reserved.", None, "", "nothing", "x " * 50_000 + ". This work is licensed under the GNU General Public License, version 3.", "permission; ", APACHE,
]

TEXTS.append(BSD + "\nNeither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.")


def brute(text):
    lines = re.sub(r"([.!?:;])[ \t\r\f]+", r"\1\n", text or "").split("\n")
    names = {s: n for n, s in licenses.SENTENCES.items()}
    ids = [names[n] for line in lines if (n := re.sub("[^a-z0-9]+", " ", line.lower()).strip()) in names]
    spans = [(k, k + len(seq), lic, rule) for lic, rule, seq in licenses.RULES for k in range(len(ids)) if ids[k : k + len(seq)] == seq]
    alone = {(lic, rule) for s, e, lic, rule in spans if not any(a <= s and e <= b and b - a > e - s for a, b, *_ in spans)}
    hit = [(lic, rule) for lic, rule, _ in licenses.RULES if (lic, rule) in alone]
    return (",".join(ids), ",".join(r for _, r in hit), ",".join(sorted({x for x, _ in hit}))) if hit else None


@pytest.fixture(scope="module")
def rows():
    return [(k, t, "x") for k, t in enumerate(TEXTS)] + [(0, TEXTS[0], "x"), (None, TEXTS[1], "x")]


def test_against_brute_force(spark, rows):
    got = sorted(map(str, (tuple(r) for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string, hits string")).collect())))
    assert got == sorted(str((k, *b)) for k, t, _ in rows if (b := brute(t)))
    assert brute(BSD)[1] == "bsd-2-text" and brute(BSD.split("Words")[1]) is None and brute(TEXTS[2]) is None


def test_oracle(spark, rows):
    own = [r for r in rows if r[0] is not None][:-1]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR, hits VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", own)
    want = sorted(con.sql(f"SELECT doc_id, sentence_ids, rules, licenses FROM ({licenses.oracle()})").fetchall())
    assert sorted(tuple(r) for r in licenses.scan_licenses(spark.createDataFrame(own, "doc_id long, text string, hits string")).collect()) == want


def test_no_rows(no_docs):
    assert licenses.scan_licenses(no_docs).collect() == []


def test_very_many_line_feeds_and_marks(spark):
    texts = ["\n" * 1_000_000 + TEXTS[1], "-" * 1_000_000 + "\n" + TEXTS[1], ("--\n" * 300_000) + TEXTS[1], "\n-" * 500_000]
    found = licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r.doc_id for r in found.collect()} == {0, 1, 2}
