"""Licence recognition by sentence rules: normalised sentences become known
sentence identifiers, and the sequence of identifiers is matched against
ordered licence rules.  DataFrame functions, no shuffle."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licence texts and notices (identifier: wordings).
SENTENCES: dict[str, list[str]] = {
    "apache-notice": ["Licensed under the Apache License, Version 2.0",
                      'Licensed under the Apache License, Version 2.0 (the "License")'],
    "apache-header": ['Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
                      "except in compliance with the License."],
    "apache-obtain": ["You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                      "You may obtain a copy of the License at"],
    "apache-as-is": ["Unless required by applicable law or agreed to in writing, software distributed under the "
                     'License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
                     "either express or implied."],
    "apache-see": ["See the License for the specific language governing permissions and limitations under the License."],
    "mit-notice": ["Released under the MIT License.", "Licensed under the MIT License.", "The MIT License (MIT)",
                   "MIT License", "This project is licensed under the MIT License."],
    "mit-grant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                  'associated documentation files (the "Software"), to deal in the Software without restriction, '
                  "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
                  "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
                  "furnished to do so, subject to the following conditions:"],
    "mit-include": ["The above copyright notice and this permission notice shall be included in all copies or "
                    "substantial portions of the Software."],
    "mit-as-is": ['THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
                  "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
                  "NONINFRINGEMENT."],
    "bsd2-notice": ["Licensed under the BSD 2-Clause License.", "Released under the BSD 2-Clause License.", "BSD 2-Clause License"],
    "bsd3-notice": ["Licensed under the BSD 3-Clause License.", "Released under the BSD 3-Clause License.", "BSD 3-Clause License"],
    "bsd-notice": ["Released under the BSD License.", "Licensed under the BSD License."],
    "bsd-redistribute": ["Redistribution and use in source and binary forms, with or without modification, are "
                         "permitted provided that the following conditions are met:"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                   "following disclaimer."],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
                   "the following disclaimer in the documentation and/or other materials provided with the distribution."],
    "bsd-endorse": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                    "promote products derived from this software without specific prior written permission."],
    "isc-notice": ["ISC License", "The ISC License", "Licensed under the ISC License."],
    "isc-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                  "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
                  "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is "
                  "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "0bsd-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                   "hereby granted."],
    "isc-as-is": ['THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
                  "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."],
    "zlib-as-is": ["This software is provided 'as-is', without any express or implied warranty."],
    "zlib-damages": ["In no event will the authors be held liable for any damages arising from the use of this software."],
    "zlib-grant": ["Permission is granted to anyone to use this software for any purpose, including commercial applications, "
                   "and to alter it and redistribute it freely, subject to the following restrictions:"],
    "boost-notice": ["Distributed under the Boost Software License, Version 1.0.", "Boost Software License - Version 1.0"],
    "unlicense-free": ["This is free and unencumbered software released into the public domain."],
    "unlicense-anyone": ["Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in "
                         "source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by "
                         "any means."],
    "mpl2-form": ["This Source Code Form is subject to the terms of the Mozilla Public License, v."],
    "mpl2-copy": ["If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
                  "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "mpl2-notice": ["Licensed under the Mozilla Public License 2.0.", "Licensed under the Mozilla Public License, version 2.0.",
                    "Mozilla Public License Version 2.0"],
    "epl2-available": ["This program and the accompanying materials are made available under the terms of the Eclipse Public "
                       "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"],
    "epl2-notice": ["Licensed under the Eclipse Public License 2.0.", "Eclipse Public License - v 2.0"],
    "lgpl3-notice": ["This work is licensed under the GNU Lesser General Public License, version 3.",
                     "Licensed under the GNU Lesser General Public License, version 3."],
    "lgpl3-free": ["you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
                   "published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
                   "later version."],
    "lgpl21-free": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                    "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the "
                    "License, or (at your option) any later version."],
    "lgpl-hope": ["This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
                  "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "agpl3-notice": ["This work is licensed under the GNU Affero General Public License, version 3.",
                     "Licensed under the GNU Affero General Public License, version 3."],
    "agpl3-free": ["you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
                   "published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
                   "later version."],
    "gpl2-free": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                  "General Public License as published by the Free Software Foundation; either version 2 of the License, "
                  "or (at your option) any later version."],
    "gpl3-notice": ["This work is licensed under the GNU General Public License, version 3.",
                    "Licensed under the GNU General Public License, version 3."],
    "gpl2-notice": ["This work is licensed under the GNU General Public License, version 2.",
                    "Licensed under the GNU General Public License, version 2."],
    # (a sentence ends at the colon of "This program is free software:")
    "gpl-free": ["you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
                 "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "gpl-hope": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
                 "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0."],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under CC BY 4.0.",
              "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under CC BY-SA 4.0.",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc0": ["Released under CC0 1.0.", "This work is dedicated to the public domain under CC0 1.0."],
    "rights-reserved": ["All rights reserved."],
}
# Ordered rules: the first that fits at a sentence wins, so longer ones come first.
RULES: list[tuple[str, list[str]]] = [
    ("Apache-2.0", ["apache-header", "apache-obtain", "apache-as-is", "apache-see"]),
    ("Apache-2.0", ["apache-header", "apache-obtain"]),
    ("Apache-2.0", ["apache-header"]),
    ("Apache-2.0", ["apache-notice"]),
    ("MIT", ["mit-notice", "mit-grant", "mit-include", "mit-as-is"]),
    ("MIT", ["mit-grant", "mit-include", "mit-as-is"]),
    ("MIT", ["mit-grant"]),
    ("MIT", ["mit-notice"]),
    ("BSD-3-Clause", ["bsd-redistribute", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-redistribute", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", ["bsd3-notice"]),
    ("BSD-2-Clause", ["bsd2-notice"]),
    ("BSD", ["bsd-notice", "bsd-redistribute"]),
    ("BSD", ["bsd-redistribute"]),
    ("BSD", ["bsd-notice"]),
    ("ISC", ["isc-notice", "isc-grant", "isc-as-is"]),
    ("ISC", ["isc-grant", "isc-as-is"]),
    ("ISC", ["isc-grant"]),
    ("ISC", ["isc-notice"]),
    ("0BSD", ["0bsd-grant", "isc-as-is"]),
    ("0BSD", ["0bsd-grant"]),
    ("Zlib", ["zlib-as-is", "zlib-damages", "zlib-grant"]),
    ("Zlib", ["zlib-grant"]),
    ("BSL-1.0", ["boost-notice"]),
    ("Unlicense", ["unlicense-free", "unlicense-anyone"]),
    ("Unlicense", ["unlicense-free"]),
    ("MPL-2.0", ["mpl2-form"]),
    ("MPL-2.0", ["mpl2-copy"]),
    ("MPL-2.0", ["mpl2-notice"]),
    ("EPL-2.0", ["epl2-available"]),
    ("EPL-2.0", ["epl2-notice"]),
    ("LGPL-2.1-or-later", ["lgpl21-free", "lgpl-hope"]),
    ("LGPL-2.1-or-later", ["lgpl21-free"]),
    ("LGPL-3.0-or-later", ["lgpl3-free"]),
    ("LGPL-3.0", ["lgpl3-notice"]),
    ("AGPL-3.0-or-later", ["agpl3-free"]),
    ("AGPL-3.0", ["agpl3-notice"]),
    ("GPL-2.0-or-later", ["gpl2-free", "gpl-hope"]),
    ("GPL-2.0-or-later", ["gpl2-free"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-hope"]),
    ("GPL-3.0-or-later", ["gpl-free"]),
    ("GPL-3.0", ["gpl3-notice"]),
    ("GPL-2.0", ["gpl2-notice"]),
    ("CC-BY-NC-4.0", ["cc-by-nc"]),
    ("CC-BY-SA-4.0", ["cc-by-sa"]),
    ("CC-BY-4.0", ["cc-by"]),
    ("CC0-1.0", ["cc0"]),
]
# A line break before a lower-case letter, comment signs aside, is inside a sentence.
_WRAP = r"\n[ \t]*(?:#+|//+|\*+)?[ \t]*(?=[a-z])"
#: The number of a clause, at the start of its line.
_NUMBER = r"(?m)^[ \t]*(?:(?:#+|//+|\*+)[ \t]*)?\(?[0-9]{1,2}[.)][ \t]+"
_BREAK = r"(?<=[.!?:])\s+|\n+"
_OTHER = r"[^a-z0-9]+"


def normal_sentence(sentence: str) -> str:
    """The same as the Spark expression, for the wordings."""
    return re.sub(_OTHER, " ", sentence.lower()).strip(" ")


def _identifiers(sentences: dict[str, list[str]]) -> tuple[dict[str, str], dict[str, str]]:
    """(normalised wording -> sign, identifier -> sign); a sign is one character,
    so that a text's identifiers are a string with one sign a sentence."""
    sign = {name: chr(0x4E00 + i) for i, name in enumerate(sentences)}
    return {normal_sentence(w): sign[name] for name, ways in sentences.items() for w in ways}, sign


def anchors(wordings) -> list[str]:
    """A few words such that each wording holds one: a text without any of them
    has no known sentence."""
    left, out = [set(w.split()) for w in wordings], []
    while left:
        count: dict[str, int] = {}
        for words in left:
            for word in words:
                if len(word) >= 4 or max(map(len, words)) < 4:
                    count[word] = count.get(word, 0) + 1
        best = min(count, key=lambda x: (-count[x], -len(x), x))
        out.append(best)
        left = [words for words in left if best not in words]
    return out


def _literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def scan_licenses(docs: DataFrame, sentences: dict[str, list[str]] = SENTENCES,
                  rules: list[tuple[str, list[str]]] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_matches, licenses (distinct, sorted,
    joined by commas), matches (array of license, first sentence from 0, number
    of sentences), has_unmatched (known sentences that no rule took).

    Sentences end at a line break, or at white space after ``.``, ``!``, ``?``
    or ``:``; a line going on in lower case belongs to the one before, and a clause
    number at the start of a line to no sentence.  They are
    compared lower-cased with everything but a-z and 0-9 as one space.  At each
    sentence the first rule whose identifiers follow there in order matches;
    matches do not overlap.  Null and empty texts have no sentences; texts of any
    length are read whole; repeated rows each keep their row; an empty table gives
    no rows; other columns of ``docs`` take no part, whatever their names.
    """
    wordings, sign = _identifiers(sentences)
    patterns: dict[str, str] = {}
    for name, ids in rules:
        patterns.setdefault("".join(sign[i] for i in ids), name)
    lower = F.lower(F.coalesce(F.col(text), F.lit("")))
    candidate = F.lit(False)
    for word in anchors(wordings):
        candidate = candidate | lower.contains(word)
    known = _literal_map(wordings)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.when(candidate, F.col(text)).alias("text"))
    pieces = F.split(F.regexp_replace(F.regexp_replace("text", _NUMBER, ""), _WRAP, " "), _BREAK)
    signs = F.transform(pieces, lambda s: F.coalesce(F.element_at(known, F.trim(
        F.regexp_replace(F.lower(s), _OTHER, " "))), F.lit(" ")))
    rows = rows.select("doc_id", F.coalesce(F.array_join(signs, ""), F.lit("")).alias("signs"))
    either = "|".join(patterns)
    found = F.regexp_extract_all("signs", F.lit(f"({either})"), 1)
    # the text between matches gives each match's place
    gaps = F.transform(F.split("signs", either, -1), lambda g: F.length(g))
    matches = F.transform(found, lambda m, i: F.struct(
        F.element_at(_literal_map(patterns), m).alias("license"),
        (F.aggregate(F.slice(gaps, 1, i + 1), F.lit(0), lambda a, x: a + x)
         + F.length(F.array_join(F.slice(found, 1, i), ""))).alias("sentence"),
        F.length(m).alias("sentences")))
    any_known = F.col("signs").rlike("[^ ]")
    none = F.array().cast("array<struct<license:string,sentence:int,sentences:int>>")
    rows = rows.withColumn("matches", F.when(any_known, matches).otherwise(none))
    return rows.select(
        "doc_id", F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct("matches.license")), ",").alias("licenses"), "matches",
        F.regexp_replace("signs", either, "").rlike("[^ ]").alias("has_unmatched"))
