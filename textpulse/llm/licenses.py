"""Licence scan by sentence rules: sentences to identifiers, identifier sequences to licences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of licences and notices, by identifier.
SENTENCES = {
    "MIT-released": "Released under the MIT License.",
    "MIT-licensed": "Licensed under the MIT License.",
    "MIT-this": "This project is licensed under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "MIT-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "AS-IS-software": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "NO-LIABILITY": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "APACHE-2": "Licensed under the Apache License, Version 2.0.",
    "APACHE-2-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "APACHE-2-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "APACHE-2-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "APACHE-2-see": "See the License for the specific language governing permissions and limitations under the License.",
    "GPL-3-work": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "GPL-details": "See the GNU General Public License for more details.",
    "CC-BY-NC-4": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4-work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "BSD-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "BSD-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "BSD-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "MPL-2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "UNLICENSE": "This is free and unencumbered software released into the public domain.",
    "APACHE-2-licence-title": "Apache License Version 2.0, January 2004",
    "BSD-advertising": "All advertising materials mentioning features or use of this software must display the following acknowledgement:",
    "ISC-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "0BSD-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "MIT-0-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.",
    "GPL-2-only-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "GPL-3-only-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License version 3 as published by the Free Software Foundation.",
    "LGPL-21-free": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "LGPL-3-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "LGPL-3-library": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "AGPL-3-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MPL-2-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "MPL-11": "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\");",
    "BSL-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",
    "BSL-header": "Distributed under the Boost Software License, Version 1.0.",
    "ZLIB-as-is": "This software is provided 'as-is', without any express or implied warranty.",
    "ZLIB-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "EPL-2": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at http://www.eclipse.org/legal/epl-2.0/",
    "EPL-1": "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    "OFL-header": "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "WTFPL-do": "You just DO WHAT THE FUCK YOU WANT TO.",
    "CC0-waived": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide.",
    "EUPL-12": "Licensed under the EUPL, Version 1.2 or - as soon they will be approved by the European Commission - subsequent versions of the EUPL (the \"Licence\");",
    "CDDL-1": "The contents of this file are subject to the terms of the Common Development and Distribution License (the \"License\").",
}

# Names under which notices of one line mention a licence.
NAMES = {
    "MIT": ["MIT License"], "Apache-2.0": ["Apache License 2.0", "Apache 2.0 License", "Apache License, Version 2.0"],
    "GPL-2.0-only": ["GPLv2", "GNU General Public License v2.0"], "GPL-3.0-only": ["GPLv3", "GNU General Public License v3.0"],
    "LGPL-2.1-only": ["LGPLv2.1"], "LGPL-3.0-only": ["LGPLv3"], "AGPL-3.0-only": ["AGPLv3", "GNU Affero General Public License v3.0"],
    "BSD-2-Clause": ["BSD 2-Clause License"], "BSD-3-Clause": ["BSD 3-Clause License"], "ISC": ["ISC License"],
    "MPL-2.0": ["Mozilla Public License 2.0", "Mozilla Public License, version 2.0"], "BSL-1.0": ["Boost Software License 1.0"],
    "EPL-2.0": ["Eclipse Public License 2.0"], "Unlicense": ["Unlicense"], "Zlib": ["zlib License"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal"], "CC-BY-4.0": ["CC BY 4.0"], "CC-BY-SA-4.0": ["CC BY-SA 4.0"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0"], "OFL-1.1": ["SIL Open Font License 1.1"],
}
WAYS = [
    "Released under the {}.", "Licensed under the {}.", "Licensed under {}.", "Distributed under the {}.",
    "This project is licensed under the {}.", "This software is licensed under the {}.",
    "This software is released under the {}.", "This work is licensed under the {}.",
]
# Identifiers of licences as tags name them, beside those of the rules.
TAGS = ["GPL-2.0", "GPL-3.0", "GPL-2.0+", "GPL-3.0+", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "AGPL-3.0-only", "LGPL-2.1-only", "LGPL-3.0-only"]

# Ordered rules. A rule holds where its identifiers follow each other in this order, no other known
# sentence and at most GAP pieces of text between two of them.
RULES = [
    ("MIT", ["MIT-grant", "MIT-notice", "AS-IS-software", "NO-LIABILITY"]),
    ("MIT", ["MIT-grant", "MIT-notice"]),
    ("MIT", ["MIT-released"]),
    ("MIT", ["MIT-licensed"]),
    ("MIT", ["MIT-this"]),
    ("Apache-2.0", ["APACHE-2-header", "APACHE-2-copy", "APACHE-2-as-is", "APACHE-2-see"]),
    ("Apache-2.0", ["APACHE-2-header", "APACHE-2-copy"]),
    ("Apache-2.0", ["APACHE-2"]),
    ("GPL-3.0-or-later", ["GPL-free", "GPL-hope", "GPL-details"]),
    ("GPL-3.0-or-later", ["GPL-free"]),
    ("GPL-2.0-or-later", ["GPL-2-free", "GPL-hope", "GPL-details"]),
    ("GPL-2.0-or-later", ["GPL-2-free"]),
    ("GPL-3.0-only", ["GPL-3-work"]),
    ("CC-BY-NC-4.0", ["CC-BY-NC-4"]),
    ("CC-BY-SA-4.0", ["CC-BY-SA-4"]),
    ("CC-BY-4.0", ["CC-BY-4"]),
    ("CC-BY-4.0", ["CC-BY-4-work"]),
    ("BSD-3-Clause", ["BSD-grant", "BSD-source", "BSD-binary", "BSD-names"]),
    ("BSD-2-Clause", ["BSD-grant", "BSD-source", "BSD-binary"]),
    ("MPL-2.0", ["MPL-2"]),
    ("Unlicense", ["UNLICENSE"]),
    ("Apache-2.0", ["APACHE-2-licence-title"]),
    ("BSD-4-Clause", ["BSD-grant", "BSD-source", "BSD-binary", "BSD-advertising", "BSD-names"]),
    ("ISC", ["ISC-grant"]),
    ("0BSD", ["0BSD-grant"]),
    ("MIT-0", ["MIT-0-grant", "AS-IS-software", "NO-LIABILITY"]),
    ("GPL-2.0-only", ["GPL-2-only-free"]),
    ("GPL-3.0-only", ["GPL-3-only-free"]),
    ("LGPL-2.1-or-later", ["LGPL-21-free"]),
    ("LGPL-3.0-or-later", ["LGPL-3-free"]),
    ("LGPL-3.0-or-later", ["LGPL-3-library"]),
    ("AGPL-3.0-or-later", ["AGPL-3-free"]),
    ("MPL-2.0", ["MPL-2", "MPL-2-copy"]),
    ("MPL-1.1", ["MPL-11"]),
    ("BSL-1.0", ["BSL-grant"]),
    ("BSL-1.0", ["BSL-header"]),
    ("Zlib", ["ZLIB-as-is", "ZLIB-grant"]),
    ("EPL-2.0", ["EPL-2"]),
    ("EPL-1.0", ["EPL-1"]),
    ("OFL-1.1", ["OFL-header"]),
    ("WTFPL", ["WTFPL-do"]),
    ("CC0-1.0", ["CC0-waived"]),
    ("EUPL-1.2", ["EUPL-12"]),
    ("CDDL-1.0", ["CDDL-1"]),
]

# Pieces of text between two sentences of one rule.
GAP = 12
# A known sentence may be cut into so many pieces by line ends and marks.
SPAN = 40
_NOT_WORDS = r"[^a-z0-9]+"
# Between the first words of a known sentence: also line ends and comment marks.
_BETWEEN = r"[^\p{L}\p{N}]++"
# Comment marks and a list number at the start of a line.
_LINE_START = r"(?md)^[^\p{L}\p{N}\n]*+(?:(?:\d{1,2}|[a-z]|[ivx]{1,4})[.)][ \t]++)?"
# A text is cut at line ends and after marks; what follows a colon or semicolon on its line is marked.
_AFTER_COLON = r"(?<=[:;][\"')\]]{0,3})[ \t]+"
_CUT = r"\x01|\n+|(?<=[.!?][\"')\]]{0,3})[ \t\f]+"
# What copies of a sentence have in its holes may be so much longer.
HOLE = 200
# Words in which copies of a sentence differ, after ``normal``, and how the table has them.
HOLES = [
    (r"^neither the names? of [a-z0-9 ]{1,200}? nor the names of (?:its )?contributors may", "neither the name of the copyright holder nor the names of its contributors may"),
    (r"^in no event shall [a-z0-9 ]{1,200}? be liable for any claim", "in no event shall the authors or copyright holders be liable for any claim"),
    (r"^permission to use copy modify and(?: or)? distribute", "permission to use copy modify and or distribute"),
    (r"^to the extent possible under law [a-z0-9 ]{1,200}? (?:has|have) (?:dedicated|waived) all copyright", "to the extent possible under law the author s have dedicated all copyright"),
    (r"\bhttps\b", "http"),
    (r"\bmozilla org mpl 2 0(?: index txt)?$", "mozilla org mpl 2 0"),
    (r"\bpermission notice including the next paragraph shall\b", "permission notice shall"),
    (r"^apache license version 2 0 january 2004 http www apache org licenses$", "apache license version 2 0 january 2004"),
]


_RULES = "array<struct<rule: int, license: string, ids: array<int>, n: int>>"
_MATCHES = "array<struct<rule: int, license: string, first: int, n: int>>"


def normal(sentence: Column) -> Column:
    """Lower case; everything but ASCII letters and digits counts as one space."""
    return F.trim(F.regexp_replace(F.lower(sentence), _NOT_WORDS, " "))


def _normal(sentence: str) -> str:
    kept = "".join(c if c.isascii() and c.isalnum() else " " for c in sentence.lower())
    return " ".join(kept.split())


def _table() -> tuple[dict[str, int], list[tuple[str, list[int]]]]:
    """Numbers of the known normalised sentences, and all rules by those numbers: the fixed ones, then one for
    each way to mention a licence and each tag."""
    number = {name: i for i, name in enumerate(SENTENCES, 1)}
    known = {_normal(s): number[name] for name, s in SENTENCES.items()}
    rules = [(name, [number[s] for s in ids]) for name, ids in RULES]
    mentions = [(name, way.format(short)) for name, shorts in NAMES.items() for short in shorts for way in WAYS]
    tags = dict.fromkeys([name for name, _ in RULES] + list(NAMES) + TAGS)
    mentions += [(name, f"SPDX-License-Identifier: {name}") for name in tags]
    for name, sentence in mentions:
        if _normal(sentence) not in known:
            known[_normal(sentence)] = max(known.values()) + 1
            rules.append((name, [known[_normal(sentence)]]))
    return known, rules


def _reach(known: dict[str, int]) -> dict[str, int]:
    """First three words of known sentences, and how many letters such a sentence may have, its holes filled."""
    reach: dict[str, int] = {}
    for sentence in known:
        start = " ".join(sentence.split()[:3])
        reach[start] = max(reach.get(start, 0), len(sentence) + HOLE)
    reach["neither the names"] = reach["neither the name"]
    return reach


def _map(table: dict[str, int]) -> Column:
    """A fixed map of normalised words to numbers."""
    return F.expr(f"map({', '.join(f"'{words}', {n}" for words, n in table.items())})")


def pieces(text: Column) -> Column:
    """What lies between line ends and marks of ``text``, in order: (soft, words). ``words`` is normalised, ``soft``
    tells that a colon or semicolon of the same line stands before. A piece holds a letter or digit. Comment
    marks and list numbers at line starts go. Linear in the length of the text."""
    clean = F.translate(F.coalesce(text, F.lit("")), "\x01\x02\r", "  \n")
    clean = F.regexp_replace(F.regexp_replace(clean, _LINE_START, ""), _AFTER_COLON, "\x01\x02")
    cut = F.filter(F.split(clean, _CUT), lambda p: p.rlike(r"[\p{L}\p{N}]"))
    return F.transform(cut, lambda p: F.struct(p.startswith("\x02").alias("soft"), normal(p).alias("words")))


def recognised(parts: Column, known: dict[str, int]) -> Column:
    """Known sentences in ``parts``, in order: (at, k, id), the first piece, how many, and the identifier.

    Where the first three words from a piece on are those of a known sentence, it and the pieces after it are put
    together and looked up in the table of known sentences; the longest known one holds. One that starts inside
    another is left out, and one after a colon counts only where another ends.
    """
    reach = _reach(known)
    table, limits = _map(known), _map(reach)
    first = "|".join(sorted({s.split()[0] for s in reach}))

    def words(i: Column, k: Column | int) -> Column:
        return F.array_join(F.transform(F.slice(parts, i + 1, k), lambda p: p["words"]), " ")

    def put_together(i: Column, k: Column) -> Column:
        filled = words(i, k)
        for pattern, plain in HOLES:
            filled = F.regexp_replace(filled, pattern, plain)
        return F.struct(k.alias("k"), F.coalesce(F.try_element_at(table, words(i, k)), F.try_element_at(table, filled)).alias("id"))

    def length(i: Column, k: Column) -> Column:
        return F.aggregate(F.slice(parts, i + 1, k), F.lit(0), lambda n, p: n + F.length(p["words"]) + 1)

    def longest(p: Column, i: Column) -> Column:
        limit = F.try_element_at(limits, F.substring_index(words(i, 3), " ", 3))
        spans = F.filter(F.sequence(F.lit(1), F.least(F.lit(SPAN), F.size(parts) - i)), lambda k: length(i, k) <= limit)
        best = F.array_max(F.filter(F.transform(spans, lambda k: put_together(i, k)), lambda s: s["id"].isNotNull()))
        return F.struct(i.alias("at"), p["soft"].alias("soft"), F.when(p["words"].rlike(f"^(?:{first})\\b") & limit.isNotNull(), best).alias("best"))

    return F.transform(
        F.filter(F.transform(parts, longest), lambda s: s["best"].isNotNull()),
        lambda s: F.struct(s["at"], s["best"]["k"].alias("k"), s["best"]["id"].alias("id"), s["soft"]),
    )


def _apart(found: Column) -> Column:
    """``found`` without sentences inside others, and without those after a colon where no other ends."""

    def stands(s: Column, i: Column) -> Column:
        before = F.slice(found, F.greatest(i - SPAN + 1, F.lit(1)), F.least(i, F.lit(SPAN)))
        inside = F.exists(before, lambda o: o["at"] + o["k"] > s["at"])
        follows = F.exists(before, lambda o: o["at"] + o["k"] == s["at"])
        return ~inside & (~s["soft"] | follows)

    return F.filter(found, stands)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_sentences, n_known, licenses, matches), a row per document row.

    ``n_sentences`` counts the pieces of the text (``pieces``), those of a known sentence as one. ``matches`` lists
    (rule, license, first, n): the rule's number, its licence, the number of the first piece (from 0) and how many
    known sentences. At one sentence the longest rule wins, and a match inside a longer one is
    left out; ``licenses`` are the distinct licences joined by "|" in code-point order, empty if none. Everything
    is decided inside a row: nothing is shuffled, and no group can be hot. Null and empty texts have no
    sentences; repeated rows stay; an empty table gives no rows; only doc_id and text are read.
    """
    known, rules = _table()
    starts = sorted(_BETWEEN.join(start.split()) for start in _reach(known))
    by_first: dict[int, list] = {}
    for i, (name, ids) in sorted(enumerate(rules, 1), key=lambda r: -len(r[1][1])):
        numbers = f"array({', '.join(map(str, ids))})"
        by_first.setdefault(ids[0], []).append(f"named_struct('rule', {i}, 'license', '{name}', 'ids', {numbers}, 'n', {len(ids)})")
    table = F.expr(f"map({', '.join(f'{first}, array({', '.join(some)})' for first, some in by_first.items())})")
    most = max(len(ids) for _, ids in rules)
    rows = docs.select("doc_id", pieces(F.col("text")).alias("parts"), F.col("text").rlike(f"(?i)\\b(?:{'|'.join(starts)})").alias("may"))
    rows = rows.withColumn("found", F.when(F.col("may"), recognised(F.col("parts"), known)))
    rows = rows.withColumn("known", _apart(F.col("found")))

    def holds(rule: Column, j: Column) -> Column:
        """Whether the known sentences from number ``j`` on are the rule's, near enough to each other."""
        some = F.slice("known", j + 1, rule["n"])
        near = F.forall(
            F.sequence(F.lit(1), F.size(some)),
            lambda x: (x == 1) | (F.element_at(some, x)["at"] - F.element_at(some, F.greatest(x - 1, F.lit(1)))["at"]
                                  - F.element_at(some, F.greatest(x - 1, F.lit(1)))["k"] <= GAP),
        )
        return (F.transform(some, lambda s: s["id"]) == rule["ids"]) & near

    def held(place: Column, j: Column) -> Column:
        """The longest rule that holds from a known sentence on, or null."""
        best = F.try_element_at(
            F.filter(F.coalesce(F.try_element_at(table, place["id"]), F.array().cast(_RULES)), lambda r: holds(r, j)), F.lit(1)
        )
        return F.when(best.isNotNull(), F.struct(
            best["rule"].alias("rule"), best["license"].alias("license"), place["at"].alias("first"), best["n"].alias("n")
        ))

    def inside(match: Column, i: Column) -> Column:
        """Whether a match that starts earlier reaches as far; only so many places back one can start."""
        start = F.greatest(i - most + 2, F.lit(1))
        ahead = F.slice("best", start, F.least(i, F.lit(most - 1)))
        ends = F.transform(ahead, lambda o, x: start - 1 + x + o["n"] >= i + match["n"])
        return F.exists(ends, lambda e: e)

    rows = rows.withColumn("best", F.transform("known", held))
    matched = rows.withColumn("matches", F.coalesce(
        F.filter("best", lambda m, i: m.isNotNull() & ~F.coalesce(inside(m, i), F.lit(False))), F.array().cast(_MATCHES)
    ))
    joined = F.aggregate("known", F.lit(0), lambda n, s: n + s["k"] - 1)
    return matched.select(
        "doc_id",
        (F.size("parts") - F.coalesce(joined, F.lit(0))).cast("bigint").alias("n_sentences"),
        F.coalesce(F.size("known"), F.lit(0)).cast("bigint").alias("n_known"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"]))), "|").alias("licenses"),
        "matches",
    )
