"""Licence scan by sentence rules: sentences become identifiers, identifier sequences match ordered rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licence texts and notices, normalised (lower case, runs of other than a-z and 0-9
# as one space).
SENTENCES = {
    "all-rights": "all rights reserved",
    "apache-line": "licensed under the apache license version 2 0",
    "apache-grant": "licensed under the apache license version 2 0 the license",
    "apache-comply": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "apache-at": "you may obtain a copy of the license at",
    "apache-url": "http www apache org licenses license 2 0",
    "mit-line": "released under the mit license",
    "mit-line-2": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "gpl3-line": "this work is licensed under the gnu general public license version 3",
    "gpl-redistribute-2": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-redistribute-3": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-warranty": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-redistribute": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "gpl-either-2": "either version 2 of the license or at your option any later version",
    "gpl-useful": "this program is distributed in the hope that it will be useful but without any warranty",
    "gpl-implied": "without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-received": "you should have received a copy of the gnu general public license along with this program",
    "mpl-terms": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl-subject": "this source code form is subject to the terms of the mozilla public license v",
    "mpl-at": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "mpl-at-2": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "cc-by-line": "licensed under cc by 4 0",
    "cc-by-sa-line": "licensed under cc by sa 4 0",
    "cc-by-nc-line": "licensed under cc by nc 4 0",
    "cc0-line": "released into the public domain under cc0 1 0",
}

# A rule holds if its sentences stand in this order among the document's known sentences, next to each
# other there (unknown sentences may stand between) and not as a part of a longer rule's. The -notice rules list the standard wording as sentence_ids cuts it.
RULES = [
    ("Apache-2.0", "apache-line", ["apache-line"]),
    ("Apache-2.0", "apache-header", ["apache-comply", "apache-copy", "apache-as-is", "apache-see"]),
    ("Apache-2.0", "apache-notice", ["apache-grant", "apache-comply", "apache-at", "apache-url", "apache-as-is", "apache-see"]),
    ("BSD-2-Clause", "bsd-2-text", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", "bsd-3-text", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("CC-BY-4.0", "cc-by-line", ["cc-by-line"]),
    ("CC-BY-NC-4.0", "cc-by-nc-line", ["cc-by-nc-line"]),
    ("CC-BY-SA-4.0", "cc-by-sa-line", ["cc-by-sa-line"]),
    ("CC0-1.0", "cc0-line", ["cc0-line"]),
    ("GPL-2.0-or-later", "gpl-2-header", ["gpl-redistribute-2", "gpl-warranty", "gpl-received"]),
    ("GPL-2.0-or-later", "gpl-2-notice", ["gpl-redistribute", "gpl-either-2", "gpl-useful", "gpl-implied", "gpl-received"]),
    ("GPL-3.0", "gpl-3-line", ["gpl3-line"]),
    ("GPL-3.0-or-later", "gpl-3-header", ["gpl-redistribute-3", "gpl-warranty", "gpl-received"]),
    ("GPL-3.0-or-later", "gpl-3-notice", ["gpl-redistribute-3", "gpl-useful", "gpl-implied", "gpl-received"]),
    ("ISC", "isc-text", ["isc-grant"]),
    ("MIT", "mit-line", ["mit-line"]),
    ("MIT", "mit-line-2", ["mit-line-2"]),
    ("MIT", "mit-text", ["mit-grant", "mit-notice", "mit-as-is"]),
    ("MPL-2.0", "mpl-header", ["mpl-terms"]),
    ("MPL-2.0", "mpl-notice", ["mpl-subject", "mpl-at"]),
    ("MPL-2.0", "mpl-notice-2", ["mpl-subject", "mpl-at-2"]),
    ("proprietary", "all-rights-reserved", ["all-rights"]),
]


def sentence_ids(text: Column) -> Column:
    """The identifiers of the known sentences of a text, in order.

    A sentence ends at . ! ? : or ; before white space, and around lines without letters and digits; single line ends
    inside it are white space, so wrapped texts are read like others. A sentence that isn't known so is read once more
    line by line, for notices of one line among other lines.
    """
    known = F.create_map(*[F.lit(x) for name, sentence in SENTENCES.items() for x in (sentence, name)])
    normal = lambda s: F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " "))
    # A double line feed stands for a sentence's end.
    sentences = F.split(F.regexp_replace(text, r"([.!?:;])[ \t\r\f\n]+", "$1\n\n"), r"\n[^\p{L}\p{N}]*\n")
    read = F.transform(sentences, lambda s: F.struct(s.alias("raw"), normal(s).alias("whole")))
    # Most sentences are far from any known one; the lookup sees only those that are some known sentence.
    parts = lambda s: F.when(s["whole"].isin(*SENTENCES.values()), F.array(s["whole"])).when(F.contains(s["raw"], F.lit("\n")), F.transform(F.split(s["raw"], "\n"), normal)).otherwise(F.array().cast("array<string>"))
    found = F.filter(F.flatten(F.transform(read, parts)), lambda s: s.isin(*SENTENCES.values()))
    return F.transform(found, lambda s: F.try_element_at(known, s))


def needle(ids: list[str]) -> str:
    return "," + ",".join(ids) + ","


def longer_rules(ids: list[str]) -> list[str]:
    """The needles of the rules that contain these sentences and more, longest first."""
    return sorted((needle(other) for _, _, other in RULES if len(other) > len(ids) and needle(ids) in needle(other)), key=len, reverse=True)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text, ...) -> doc_id, sentence_ids string, rules string, licenses string.

    One row for each document in which a rule matches; the strings are joined by commas, sentences in the text's order,
    rules in the table's order and licences distinct and sorted. Lone sentences of longer rules match nothing, and where a
    rule is a part of a longer one that matches there, only the longer one does (a BSD-3-Clause text isn't BSD-2-Clause). Null and
    empty texts match nothing, repeated rows give repeated rows, other columns are ignored. Everything happens inside
    one row, so there is no shuffle and no hot group; a very long text costs its own length.
    """
    found = docs.select("doc_id", sentence_ids(F.col("text")).alias("ids"))
    found = found.filter(F.size("ids") > 0).withColumn("sentence_ids", F.array_join("ids", ","))
    hay = F.concat(F.lit(","), F.col("sentence_ids"), F.lit(","))
    rest = lambda ids: reduce(lambda text, longer: F.replace(text, F.lit(longer), F.lit(",")), longer_rules(ids), hay)
    rules = [F.when(F.contains(rest(ids), F.lit(needle(ids))), F.struct(F.lit(rule).alias("rule"), F.lit(license).alias("license"))) for license, rule, ids in RULES]
    found = found.withColumn("hits", F.filter(F.array(*rules), lambda hit: hit.isNotNull())).filter(F.size("hits") > 0)
    return found.select("doc_id", "sentence_ids", F.array_join("hits.rule", ",").alias("rules"), F.array_join(F.array_sort(F.array_distinct("hits.license")), ",").alias("licenses"))


def oracle() -> str:
    """The scan line by line in DuckDB's SQL: the same where no known sentence is wrapped."""
    known = ", ".join(f"('{sentence}', '{name}')" for name, sentence in SENTENCES.items())
    rules = ", ".join(f"({k}, '{license}', '{rule}', '{needle(ids)}', [{', '.join(repr(x) for x in longer_rules(ids)) or 'NULL'}])" for k, (license, rule, ids) in enumerate(RULES))
    return f"""
WITH known(sentence, name) AS (VALUES {known}),
rules(k, license, rule, needle, longer) AS (VALUES {rules}),
lines AS (SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line FROM (
  SELECT doc_id, string_split(regexp_replace(text, '([.!?:;])[ \\t\\r\\f]+', '\\1' || chr(10), 'g'), chr(10)) AS l FROM documents)),
ids AS (SELECT doc_id, string_agg(name, ',' ORDER BY pos) AS sentence_ids FROM lines
  JOIN known ON trim(regexp_replace(lower(line), '[^a-z0-9]+', ' ', 'g')) = sentence GROUP BY doc_id)
SELECT doc_id, any_value(sentence_ids) AS sentence_ids, string_agg(rule, ',' ORDER BY k) AS rules,
  array_to_string(list_sort(list_distinct(list(license))), ',') AS licenses
FROM ids JOIN rules ON contains(
  CASE WHEN longer[1] IS NULL THEN ',' || sentence_ids || ',' ELSE list_reduce([',' || sentence_ids || ','] || longer, lambda text, x: replace(text, x, ',')) END, needle)
GROUP BY doc_id"""
