"""Licences by known sentences and ordered rules; built-in expressions only.

A text is cut into sentences (at ``. ! ? ;`` before white space, at ``:`` before a line end). A sentence is normalised: ASCII lower case, everything
but letters and digits becomes one blank. Known sentences have identifiers; where a sentence over several lines
is not known, all runs of its neighbouring lines are looked up, from the left and the longest first, so a title, a copyright
line or a URL without a full stop, blank lines and comment leaders do not hide what stands beside them. An SPDX expression
is read as one identifier line for each licence that it names; exceptions behind WITH are left out. The identifiers, in the
order of the text, make a sequence; unknown sentences between them do not count. Rules are ordered, each a sequence of
identifiers and a licence: a rule that occurs takes its identifiers out of the sequence, so a long rule stands before the
short ones that it contains. "All rights reserved" before a grant belongs to the grant; alone it is a rule of its own.
Sentences and rules are arguments; the given ones cover the notices of the licences in common use.

Every row is on its own: no shuffle, no Python. Texts without any of the words in ``HINTS`` hold no known
sentence (a test checks that) and are not cut. Null and empty texts have no sentences. Repeated rows are alike.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.llm.common import table
from silverlode.operators.staging import compute_once

# Sentences of well-known licence notices, by identifier.
SENTENCES = {
    "apache2-under": ["Licensed under the Apache License, Version 2.0", 'Licensed under the Apache License, Version 2.0 (the "License")'],
    "apache2-comply": ["you may not use this file except in compliance with the License"],
    "apache2-copy": ["You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0"],
    "apache2-basis": ['Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied'],
    "apache2-see": ["See the License for the specific language governing permissions and limitations under the License"],
    "mit-under": ["Released under the MIT License", "Licensed under the MIT License", "This project is licensed under the MIT License", "The MIT License", "MIT License"],
    "mit-grant": ['Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions'],
    "mit-notice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"],
    "mit-as-is": ['THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT'],
    "mit-liable": ["IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE"],
    "bsd-grant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"],
    "bsd-names": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "bsd-as-is": ['THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED', 'THIS SOFTWARE IS PROVIDED BY THE AUTHOR "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED'],
    "isc-under": ["ISC License", "Licensed under the ISC License"],
    "isc-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"],
    "isc-as-is": ['THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS'],
    "isc-liable": ["IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE"],
    "unlicense": ["This is free and unencumbered software released into the public domain"],
    "gpl2-later": ["either version 2 of the License, or (at your option) any later version"],
    "lgpl21-later": ["either version 2.1 of the License, or (at your option) any later version"],
    "lgpl-see": ["See the GNU Lesser General Public License for more details"],
    "agpl3-free": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"],
    "agpl-see": ["See the GNU Affero General Public License for more details"],
    "gpl3-under": ["This work is licensed under the GNU General Public License, version 3", "Licensed under the GNU General Public License, version 3"],
    "gpl3-free": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"],
    "gpl-hope": ["This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY", "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"],
    "gpl-see": ["See the GNU General Public License for more details"],
    "cc-by-4": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-sa-4": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc-by-nc-4": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc0-1": ["This work is dedicated to the public domain under CC0 1.0", "Licensed under CC0 1.0"],
    "mpl2-subject": ["This Source Code Form is subject to the terms of the Mozilla Public License, v"],
    "reserved": ["All rights reserved"],
    "spdx-apache2": ["SPDX-License-Identifier: Apache-2.0"],
    "spdx-mit": ["SPDX-License-Identifier: MIT"],
    "spdx-gpl3": ["SPDX-License-Identifier: GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-or-later"],
}
# Licences that an identifier line may name beside those above.
SPDX = ["0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MPL-2.0", "Unlicense", "Zlib"]
SPDX_LINE = "SPDX-License-Identifier:"
SENTENCES |= {f"spdx-{x.lower()}": [f"{SPDX_LINE} {x}"] for x in SPDX}
# Licence and the identifiers that make it, in order of application.
RULES = [
    ("Apache-2.0", ["apache2-under", "apache2-comply", "apache2-copy", "apache2-basis", "apache2-see"]),
    ("Apache-2.0", ["apache2-under", "apache2-comply", "apache2-basis", "apache2-see"]),
    ("MIT", ["mit-under", "mit-grant", "mit-notice", "mit-as-is", "mit-liable"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-as-is", "mit-liable"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "bsd-as-is"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is"]),
    ("ISC", ["isc-under", "isc-grant", "isc-as-is", "isc-liable"]),
    ("ISC", ["isc-grant", "isc-as-is", "isc-liable"]),
    ("AGPL-3.0-or-later", ["agpl3-free", "gpl-hope", "gpl-hope", "agpl-see"]),
    ("LGPL-2.1-or-later", ["lgpl21-later", "gpl-hope", "gpl-hope", "lgpl-see"]),
    ("GPL-2.0-or-later", ["gpl2-later", "gpl-hope", "gpl-hope", "gpl-see"]),
    ("GPL-3.0-or-later", ["gpl3-free", "gpl-hope", "gpl-hope", "gpl-see"]),
    ("GPL-3.0-or-later", ["gpl3-free"]),
    ("GPL-3.0", ["gpl3-under"]),
    ("Apache-2.0", ["apache2-under"]),
    ("MIT", ["mit-under"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("CC0-1.0", ["cc0-1"]),
    ("MPL-2.0", ["mpl2-subject"]),
    ("Apache-2.0", ["spdx-apache2"]),
    ("MIT", ["spdx-mit"]),
    ("GPL-3.0", ["spdx-gpl3"]),
    ("AGPL-3.0-or-later", ["agpl3-free"]),
    ("ISC", ["isc-under"]),
    ("Unlicense", ["unlicense"]),
    *((x, [f"spdx-{x.lower()}"]) for x in SPDX),
    ("proprietary", ["reserved"]),
]
RESERVED = "reserved"
HINTS = ["unencumbered", "licens", "warrant", "permi", "redistribut", "liab", "rights reserved", "cc0", "copyright"]

ENDS = "[.!?;]+[ \t\n\r\f\x0b]|:[ \t\r]*\n"
CUT = "\x01"
# Comment leaders that would cut or spoil a line; others are neither letters nor digits.
LEADERS = "(?im)^[ \t]*(?:;+|(?:rem|dnl)[ \t])"


# Two licences of an expression, and an exception.
SPDX_PAIR = rf"({SPDX_LINE})[ \t(]*([A-Za-z0-9.+-]+)[ \t)]+(?:OR|AND)[ \t(]+"
SPDX_WITH = rf"({SPDX_LINE})[ \t(]*([A-Za-z0-9.+-]+)[ \t]+WITH[ \t]+[A-Za-z0-9.+-]+"
SPDX_NAMES = 6  # licences that one expression may name


def applied(rules: list[tuple[str, list[str]]]) -> list[tuple[str, str]]:
    """Licence and identifiers as they are looked up: a reservation of rights before a grant goes with the grant."""
    forms = [(name, form) for name, ids in rules for form in (([RESERVED, *ids], ids) if RESERVED not in ids else (ids,))]
    return [(name, "".join(f"<{x}>" for x in ids)) for name, ids in forms]


def normal(sentence: str) -> str:
    """A known sentence as it is looked up."""
    kept = "".join(c if c.isascii() and c.isalnum() else " " for c in sentence)
    return " ".join(kept.lower().split())


def known_sentences(sentences: dict[str, list[str]] | None = None) -> dict[str, str]:
    """Normalised sentence -> identifier."""
    return {normal(x): name for name, forms in (sentences or SENTENCES).items() for x in forms}


def _spdx_lines(text: Column) -> Column:
    """The text with an identifier line for each licence of an SPDX expression."""
    out = F.regexp_replace(text, SPDX_WITH, "$1 $2")
    for _ in range(SPDX_NAMES - 1):
        out = F.regexp_replace(F.regexp_replace(out, SPDX_PAIR, "$1 $2\n$1 "), SPDX_WITH, "$1 $2")
    return F.when(text.contains(SPDX_LINE), out).otherwise(text)


def sentence_ids(text: str, sentences: dict[str, list[str]] | None = None, hints: list[str] = HINTS) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    known = known_sentences(sentences)
    ids = F.create_map(*[F.lit(x) for pair in sorted(known.items()) for x in pair])
    # Every blank of a known sentence may be a line end; both its ends are ends of a line or sentence. The longest come first.
    runs = "|".join(x.replace(" ", "[ |]") for x in sorted(known, key=lambda x: (-len(x), x)))
    cut = F.regexp_replace(F.regexp_replace(_spdx_lines(F.col(text)), LEADERS, " "), ENDS, CUT + "\n")
    lower = F.translate(cut, string.ascii_uppercase + "|", string.ascii_lowercase + " ")
    lines = F.regexp_replace(F.regexp_replace(lower, f"[^a-z0-9\n{CUT}]+", " "), " ?\n[ \n]*", "|")
    marked = F.regexp_replace(F.concat(F.lit(CUT), lines, F.lit(CUT)), f"[ |]*{CUT}[ |]*", CUT)
    found = F.regexp_extract_all(marked, F.lit(f"(?<=[|{CUT}])(?:{runs})(?=[|{CUT}])"), F.lit(0))
    hint = F.col(text).rlike("(?i)" + "|".join(hints))
    return F.when(hint, F.transform(found, lambda x: F.element_at(ids, F.translate(x, "|", " ")))).otherwise(F.array().cast("array<string>"))


def licenses(docs: DataFrame, text: str = "text", sentences: dict[str, list[str]] | None = None, rules: list[tuple[str, list[str]]] | None = None, hints: list[str] = HINTS) -> DataFrame:
    """``docs`` with ``sentence_ids`` (array), ``licenses`` (array, in the order of the rules) and ``n_left`` (identifiers in no rule).

    ``sentences`` (identifier -> forms) and ``rules`` (licence, identifiers; in order) stand for the given ones; a text
    without any of ``hints`` (in any case of letters) is not looked at. Columns of these names in ``docs`` are replaced.
    """
    free = "_" * (1 + max(map(len, docs.columns)))  # longer than any name of the table
    names, state = f"{free}n", f"{free}s"
    with_ids = compute_once(docs, {names: sentence_ids(text, sentences, hints)})
    sequence = F.concat_ws("", F.transform(names, lambda x: F.concat(F.lit("<"), x, F.lit(">"))))
    sequence = F.regexp_replace(sequence, f"(<{RESERVED}>)+", f"<{RESERVED}>")
    steps = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(ids).alias("ids")) for name, ids in applied(rules or RULES)])
    start = F.struct(sequence.alias("left"), F.array().cast("array<string>").alias("found"))

    def apply(state: Column, rule: Column) -> Column:
        hit = state["left"].contains(rule["ids"])
        return F.struct(F.replace(state["left"], rule["ids"], F.lit("")).alias("left"), F.when(hit, F.array_union(state["found"], F.array(rule["name"]))).otherwise(state["found"]).alias("found"))

    judged = compute_once(with_ids, {state: F.when(F.size(names) > 0, F.aggregate(steps, start, apply)).otherwise(start)})
    left = F.length(F.col(state)["left"]) - F.length(F.replace(F.col(state)["left"], F.lit("<"), F.lit("")))
    kept = [c for c in docs.columns if c not in ("sentence_ids", "licenses", "n_left")]
    return judged.select(*kept, F.col(names).alias("sentence_ids"), F.col(state)["found"].alias("licenses"), left.cast("long").alias("n_left"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence sentences and licences of every row of ``documents``."""
    found = licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"), F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("licenses", ",").alias("licenses"), "n_left",
    )


def _sql() -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    known = known_sentences()
    table_ = ", ".join(f"({quote(k)}, {quote(v)})" for k, v in sorted(known.items()))
    # Every mark stands twice, so that each sentence has one on either side; ^ is a cut, | a line end.
    runs = "|".join(x.replace(" ", r"(?: |\|\|)") for x in sorted(known, key=lambda x: (-len(x), x)))
    replace = lambda x, pattern, by: f"regexp_replace({x}, {quote(pattern)}, {by}, 'g')"
    spdx = replace("text", SPDX_WITH, r"'\1 \2'")
    for _ in range(SPDX_NAMES - 1):
        spdx = replace(replace(spdx, SPDX_PAIR, r"'\1 \2' || chr(10) || '\1 '"), SPDX_WITH, r"'\1 \2'")
    cut = replace(replace("line", LEADERS, "' '"), ENDS, "chr(1) || chr(10)")
    lower = f"translate({cut}, '{string.ascii_uppercase}|', '{string.ascii_lowercase} ')"
    lines = replace(replace(lower, r"[^a-z0-9\n\x01]+", "' '"), r" ?\n[ \n]*", "'|'")
    marked = replace(replace(f"chr(1) || {lines} || chr(1)", r"[ |]*\x01[ |]*", "'^^'"), r"\|", "'||'")
    steps = [f"s0 AS (SELECT doc_id, ids, regexp_replace(coalesce(list_aggregate(list_transform(ids, lambda x: '<' || x || '>'), 'string_agg', ''), ''), '(<{RESERVED}>)+', '<{RESERVED}>', 'g') AS rest, CAST([] AS VARCHAR[]) AS found FROM ids)"]
    for k, (name, ids) in enumerate(applied(RULES)):
        pattern = quote(ids)
        add = f"CASE WHEN contains(rest, {pattern}) AND NOT list_contains(found, {quote(name)}) THEN list_append(found, {quote(name)}) ELSE found END"
        steps.append(f"s{k + 1} AS (SELECT doc_id, ids, replace(rest, {pattern}, '') AS rest, {add} AS found FROM s{k})")
    return f"""
WITH known(sentence, id) AS (VALUES {table_}),
hinted AS (
  SELECT doc_id, CASE WHEN contains(text, '{SPDX_LINE}') THEN {spdx} ELSE text END AS line FROM documents WHERE regexp_matches(text, {quote("(?i)" + "|".join(HINTS))})
), hits AS (
  SELECT doc_id, unnest(got) AS run, unnest(range(len(got))) AS place FROM (SELECT doc_id, regexp_extract_all({marked}, {quote(rf"[|^](?:{runs})[|^]")}) AS got FROM hinted)
), ids AS (
  SELECT d.doc_id, coalesce(h.ids, CAST([] AS VARCHAR[])) AS ids
  FROM documents d LEFT JOIN (
    SELECT doc_id, list(k.id ORDER BY place) AS ids FROM hits JOIN known k ON k.sentence = trim(replace(replace(run, '||', ' '), '^', ''), '| ') GROUP BY doc_id
  ) h USING (doc_id)
), {", ".join(steps)}
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_sentences, coalesce(array_to_string(ids, ','), '') AS sentence_ids,
  coalesce(array_to_string(found, ','), '') AS licenses, CAST(length(rest) - length(replace(rest, '<', '')) AS BIGINT) AS n_left
FROM s{len(applied(RULES))}
"""


QUERIES = {"op4_license_scan": (op4_license_scan, _sql())}
