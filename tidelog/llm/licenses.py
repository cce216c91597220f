"""Licence recognition by sentence rules, with DataFrame functions alone.

Texts are cut into sentences, sentences are normalised (small letters and digits, single blanks) and looked up
in a map made of `SENTENCES`, which gives known licence sentences an identifier; a lookup costs the same however many
are known. The identifiers of a text, in its order,
are then matched against `RULES` from the first to the last: a rule that finds its sequence of identifiers
adds its licence and takes the sequence out, so a complete licence text is not reported again as the notice
that is a part of it. What no rule takes is reported as unmatched.

A sentence may go on over single line breaks, with or without comment marks before the lines, and may begin and
end at any line, for notices often stand between lines that end without a mark. So every run of lines of a
sentence is looked up that begins as a known sentence does and is no longer than the longest one. Of runs that
overlap, one does not count if another begins before it, or begins with it and is longer.

All of it happens within a row, without a shuffle. Texts without any of `CUES`, one of which is in every
known sentence, are not cut up.

Defined results: every row gives a row; null, empty and unlicensed texts have no identifiers and empty lists;
repeated rows give repeated results; a null doc_id stays null; further columns are not looked at. A sentence
that repeats counts each time.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CUES = ("licen", "permission", "as is", "liable", "distribut", "copyright", "warrant", "public domain", "mpl")

# Sentences of published licences and common notices, with the identifier of each.
SENTENCES = {
    "mit_notice": ["Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT License."],
    "mit_grant": ['Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'],
    "mit_condition": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "as_is": ['THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'],
    "mit_liability": ["IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."],
    "isc_grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "apache2_notice": ["Licensed under the Apache License, Version 2.0.", "Released under the Apache License, Version 2.0."],
    "apache2_header": ['Licensed under the Apache License, Version 2.0 (the "License");'],
    "apache2_use": ["you may not use this file except in compliance with the License."],
    "apache2_copy": ["You may obtain a copy of the License at"],
    "apache2_as_is": ['Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'],
    "apache2_language": ["See the License for the specific language governing permissions and limitations under the License."],
    "bsd_grant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "bsd_source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "bsd_binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."],
    "bsd_names": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "bsd_notice": ["Licensed under the BSD License.", "Released under the BSD License."],
    "gpl2_notice": ["This work is licensed under the GNU General Public License, version 2."],
    "gpl3_notice": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3."],
    "gpl_free": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "gpl_hope": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"],
    "gpl_fitness": ["without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "gpl_details": ["See the GNU General Public License for more details."],
    "lgpl3_notice": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "agpl3_notice": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "mpl2_notice": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, Version 2.0."],
    "mpl2_copy": ["If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "gpl2_terms": ["you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation;"],
    "gpl2_only": ["you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."],
    "version2_later": ["either version 2 of the License, or (at your option) any later version."],
    "version21_later": ["either version 2.1 of the License, or (at your option) any later version."],
    "version3_later": ["either version 3 of the License, or (at your option) any later version."],
    "lgpl_terms": ["you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation;"],
    "lgpl3_free": ["you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "lgpl_hope": ["This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"],
    "lgpl_details": ["See the GNU Lesser General Public License for more details."],
    "agpl3_free": ["you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "agpl_details": ["See the GNU Affero General Public License for more details."],
    "unlicense_free": ["This is free and unencumbered software released into the public domain."],
    "unlicense_use": ["Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
    "zlib_as_is": ["This software is provided 'as-is', without any express or implied warranty."],
    "zlib_liability": ["In no event will the authors be held liable for any damages arising from the use of this software."],
    "zlib_grant": ["Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"],
    "boost_notice": ["Distributed under the Boost Software License, Version 1.0."],
    "boost_grant": ['Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:'],
    "epl2_notice": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"],
    "bsd_as_is": ['THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.'],
    "cc_by_notice": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc_by_sa_notice": ["Licensed under CC BY-SA 4.0."],
    "cc_by_nc_notice": ["Licensed under CC BY-NC 4.0."],
    "cc0_notice": ["This work is dedicated to the public domain."],
    "all_rights": ["Copyright, all rights reserved."],
}
# Licences and the identifiers that make them up, complete texts before notices.
RULES = [
    ("MIT", ["mit_grant", "mit_condition", "as_is", "mit_liability"]),
    ("ISC", ["isc_grant", "as_is"]),
    ("BSD-3-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_names"]),
    ("BSD-2-Clause", ["bsd_grant", "bsd_source", "bsd_binary"]),
    ("Apache-2.0", ["apache2_header", "apache2_use", "apache2_copy", "apache2_as_is", "apache2_language"]),
    ("GPL-3.0-or-later", ["gpl_free", "gpl_hope", "gpl_fitness", "gpl_details"]),
    ("LGPL-3.0-or-later", ["lgpl3_free", "lgpl_hope", "gpl_fitness", "lgpl_details"]),
    ("LGPL-2.1-or-later", ["lgpl_terms", "version21_later", "lgpl_hope", "gpl_fitness", "lgpl_details"]),
    ("AGPL-3.0-or-later", ["agpl3_free", "gpl_hope", "gpl_fitness", "agpl_details"]),
    ("GPL-2.0-or-later", ["gpl2_terms", "version2_later", "gpl_hope", "gpl_fitness", "gpl_details"]),
    ("Unlicense", ["unlicense_free", "unlicense_use"]),
    ("Zlib", ["zlib_as_is", "zlib_liability", "zlib_grant"]),
    ("MPL-2.0", ["mpl2_notice", "mpl2_copy"]),
    ("Apache-2.0", ["apache2_header", "apache2_use"]),
    ("GPL-2.0-or-later", ["gpl2_terms", "version2_later"]),
    ("GPL-3.0-or-later", ["gpl2_terms", "version3_later"]),
    ("LGPL-2.1-or-later", ["lgpl_terms", "version21_later"]),
    ("LGPL-3.0-or-later", ["lgpl_terms", "version3_later"]),
    ("LGPL-3.0-or-later", ["lgpl3_free"]),
    ("AGPL-3.0-or-later", ["agpl3_free"]),
    ("GPL-2.0", ["gpl2_only"]),
    ("Zlib", ["zlib_grant"]),
    ("BSL-1.0", ["boost_grant"]),
    ("BSL-1.0", ["boost_notice"]),
    ("EPL-2.0", ["epl2_notice"]),
    ("Unlicense", ["unlicense_free"]),
    ("MIT", ["mit_grant"]),
    ("ISC", ["isc_grant"]),
    ("GPL-3.0-or-later", ["gpl_free"]),
    ("MIT", ["mit_notice"]),
    ("Apache-2.0", ["apache2_notice"]),
    ("BSD", ["bsd_notice"]),
    ("GPL-2.0", ["gpl2_notice"]),
    ("GPL-3.0", ["gpl3_notice"]),
    ("LGPL-3.0", ["lgpl3_notice"]),
    ("AGPL-3.0", ["agpl3_notice"]),
    ("MPL-2.0", ["mpl2_notice"]),
    ("CC-BY-4.0", ["cc_by_notice"]),
    ("CC-BY-SA-4.0", ["cc_by_sa_notice"]),
    ("CC-BY-NC-4.0", ["cc_by_nc_notice"]),
    ("CC0-1.0", ["cc0_notice"]),
    ("proprietary", ["all_rights"]),
]

# A sentence ends at a blank line, or at one of these marks before white space; it may begin and end at any line.
SENTENCE_END = r"([.!?;:])[ \t\r\n\f]+"
NOT_KEPT = "[^a-z0-9]+"


def normalised(sentence: str) -> str:
    return re.sub(NOT_KEPT, " ", sentence.lower()).strip(" ")


def lookup(sentences: dict[str, list[str]] = SENTENCES) -> dict[str, str]:
    """Normalised sentence -> identifier; a sentence that itself holds an end mark is known by its parts."""
    found = {}
    for name, texts in sentences.items():
        for text in texts:
            parts = [p for p in map(normalised, re.sub(SENTENCE_END, r"\1\n", text).split("\n")) if p]
            # Only the longest part is looked up, the others of such a sentence say little on their own.
            found[max(parts, key=len)] = name
    missing = [s for s in found if not any(normalised(c) in s for c in CUES)]
    if missing:
        raise ValueError(f"no cue in {missing}")
    return found


def beginnings(known: dict[str, str]) -> list[str]:
    """The first words of known sentences that a run of lines may begin with: one word, or two."""
    words = [s.split(" ") for s in known]
    return sorted({" ".join(w[:n]) for w in words for n in (1, 2)})


def _identifiers(text: Column, known: dict[str, str]) -> Column:
    """Known sentences in the order of the text."""
    table = F.create_map(*(F.lit(x) for pair in known.items() for x in pair))
    most = max(len(s) for s in known)
    lines_at_most = max(s.count(" ") + 1 for s in known)
    # Capitals are free after lower(): E is a sentence's end, L a line break. Comment marks are blanks like all
    # that is not kept, so that a line of them is a blank line.
    marked = F.regexp_replace(F.regexp_replace(F.lower(text), SENTENCE_END, "E"), r"\r\n|\r|\n", "L")
    plain = F.regexp_replace(F.regexp_replace(marked, "[^a-z0-9EL]+", " "), " ?([EL]) ?", "$1")
    sentences = F.split(F.regexp_replace(plain, "[EL]{2,}", "E"), "E")
    firsts = F.array(*(F.lit(w) for w in beginnings(known)))

    def runs(sentence: Column) -> Column:
        lines = F.filter(F.split(F.trim(sentence), "L"), lambda x: x != "")
        places = F.filter(F.sequence(F.lit(1), F.size(lines)), lambda i: F.array_contains(firsts, F.substring_index(F.element_at(lines, i), " ", 2)))

        def from_line(i: Column) -> Column:
            upto = F.sequence(i, F.least(F.size(lines), i + F.lit(lines_at_most - 1)))
            run = F.transform(upto, lambda j: F.struct(i.alias("i"), j.alias("j"), F.array_join(F.slice(lines, i, j - i + 1), " ").alias("text")))
            short = F.filter(run, lambda r: F.length(r["text"]) <= most)
            return F.transform(short, lambda r: F.struct(r["i"].alias("i"), r["j"].alias("j"), F.try_element_at(table, r["text"]).alias("name")))

        found = F.filter(F.flatten(F.transform(places, from_line)), lambda r: r["name"].isNotNull())
        return F.when(F.size(lines) > 0, found)

    def counts(hits: Column) -> Column:
        def beaten(h: Column) -> Column:
            return F.exists(hits, lambda g: (g["i"] <= h["j"]) & (g["j"] >= h["i"]) & ((g["i"] < h["i"]) | ((g["i"] == h["i"]) & (g["j"] > h["j"]))))

        return F.transform(F.filter(hits, lambda h: ~beaten(h)), lambda h: h["name"])

    hits = F.filter(F.transform(sentences, runs), lambda found: F.size(found) > 0)
    return F.flatten(F.transform(hits, counts))


def scan(docs: DataFrame, sentences: dict[str, list[str]] = SENTENCES, rules: list[tuple[str, list[str]]] = RULES) -> DataFrame:
    """doc_id, n_known, identifiers, licences, unmatched of every row of `docs` (doc_id, text); the last three
    are lists joined by commas, in the order of the text, of the rules, and of the text."""
    text = F.lower("text")
    cue = F.coalesce(F.greatest(*(F.contains(text, F.lit(c)) for c in CUES)), F.lit(False))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(cue, _identifiers(F.col("text"), lookup(sentences))).otherwise(F.array().cast("array<string>")).alias("ids"),
    )
    steps = F.array(*(F.struct(F.lit(name).alias("name"), F.lit("".join(f"<{i}>" for i in ids)).alias("ids")) for name, ids in rules))
    start = F.struct(F.concat_ws("", F.transform("ids", lambda i: F.concat(F.lit("<"), i, F.lit(">")))).alias("rest"), F.lit("").alias("found"))
    done = F.aggregate(
        steps,
        start,
        lambda state, rule: F.when(
            F.contains(state["rest"], rule["ids"]),
            F.struct(
                F.replace(state["rest"], rule["ids"], F.lit("|")).alias("rest"),
                F.concat(state["found"], F.lit(","), rule["name"]).alias("found"),
            ),
        ).otherwise(state),
    )
    rows = rows.withColumn("done", F.when(F.size("ids") > 0, done))
    licences = F.array_distinct(F.filter(F.split(F.coalesce("done.found", F.lit("")), ","), lambda x: x != ""))
    unmatched = F.filter(F.split(F.coalesce("done.rest", F.lit("")), "[<>|]+"), lambda x: x != "")
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_known"),
        F.concat_ws(",", "ids").alias("identifiers"),
        F.concat_ws(",", licences).alias("licences"),
        F.concat_ws(",", unmatched).alias("unmatched"),
    )
