"""License scan in column expressions only, by sentence rules.

A text is cut into sentences, which are normalised: lower case, letters and digits only. Normalised
sentences are looked up among known license sentences, and so are runs of pieces that line breaks
made of one sentence, as in wrapped texts and comments; the known ones give a sequence of sentence
identifiers per document. A holder's name inside a sentence is replaced first by the words of the
template, and the license expression behind an SPDX tag gives an identifier per license. Ordered rules
then replace identifier sequences by licenses, the most specific rule first; identifiers that no rule
takes stay as unresolved.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.once import compute_once

# Sentences of public licenses and notices, by identifier. Copyright lines name no license
# and are not listed.
SENTENCES = {
    "MITgrant": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    ],
    "MITnotice": [
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ],
    "MITwarranty": [
        "The Software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to "
        "the warranties of merchantability, fitness for a particular purpose and noninfringement."
    ],
    "MITref": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the MIT License.",
        "MIT License",
        "The MIT License",
        "The MIT License (MIT)",
        "This software is released under the MIT License.",
        "Distributed under the MIT License.",
        "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file.",
    ],
    "ISCgrant": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ],
    "ISCref": ["ISC License", "Licensed under the ISC License."],
    "BSDgrant": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"
    ],
    "BSDsource": [
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    ],
    "BSDbinary": [
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution."
    ],
    "BSDendorse": [
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission."
    ],
    "BSDwarranty": [
        "This software is provided by the copyright holders and contributors \"as is\" and any express or implied "
        "warranties, including, but not limited to, the implied warranties of merchantability and fitness for a "
        "particular purpose are disclaimed."
    ],
    "BSD2ref": ["Licensed under the BSD 2-Clause License.", "BSD 2-Clause License", "BSD 2-Clause \"Simplified\" License"],
    "BSD3ref": ["Licensed under the BSD 3-Clause License.", "BSD 3-Clause License", "BSD 3-Clause \"New\" or \"Revised\" License"],
    "ApacheMITref": [
        "Licensed under the Apache License, Version 2.0 or MIT",
        "Licensed under either of Apache License, Version 2.0 or MIT license at your option.",
        "Apache License, Version 2.0 or MIT",
        "Apache License, Version 2.0 or MIT License",
        "Licensed under the MIT License or the Apache License, Version 2.0",
    ],
    "Apache2ref": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\");",
        "Apache License, Version 2.0",
        "Apache License Version 2.0, January 2004",
        "Licensed under the Apache License 2.0.",
        "This project is licensed under the Apache License 2.0.",
        "This project is licensed under the Apache License, Version 2.0.",
        "Apache License 2.0",
    ],
    "Apache2comply": ["you may not use this file except in compliance with the License."],
    "Apache2copy": ["You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "Apache2asis": [
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ],
    "GPL2ref": [
        "This work is licensed under the GNU General Public License, version 2.",
        "Licensed under the GNU General Public License, version 2.",
        "GNU General Public License v2.0",
        "GNU General Public License Version 2, June 1991",
    ],
    "GPL3ref": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
        "GNU General Public License v3.0",
        "GNU General Public License Version 3, 29 June 2007",
    ],
    "GPLfree": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."],
    "GPL2free": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                 "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
                 "option) any later version."],
    "LGPLfree": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
                 "Public License as published by the Free Software Foundation;"],
    "LGPL3free": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
                  "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                  "option) any later version."],
    "AGPL3free": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
                  "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                  "option) any later version."],
    "FSFversion21": ["either version 2.1 of the License, or (at your option) any later version."],
    "FSFversion3": ["either version 3 of the License, or (at your option) any later version."],
    "GPLhope": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"],
    "LGPL21ref": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "GNU Lesser General Public License v2.1",
        "GNU Lesser General Public License Version 2.1, February 1999",
    ],
    "LGPL3ref": [
        "Licensed under the GNU Lesser General Public License, version 3.",
        "GNU Lesser General Public License v3.0",
        "GNU Lesser General Public License Version 3, 29 June 2007",
    ],
    "AGPL3ref": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "GNU Affero General Public License v3.0",
        "GNU Affero General Public License Version 3, 19 November 2007",
    ],
    "MPL2ref": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "Mozilla Public License Version 2.0",
        "Mozilla Public License, v. 2.0",
    ],
    "MPL2copy": ["If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "EPL2ref": ["Eclipse Public License - v 2.0", "Licensed under the Eclipse Public License 2.0."],
    "BSL1ref": [
        "Distributed under the Boost Software License, Version 1.0.",
        "Boost Software License - Version 1.0 - August 17th, 2003",
    ],
    "Zlibasis": ["This software is provided 'as-is', without any express or implied warranty."],
    "Zlibgrant": [
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
        "alter it and redistribute it freely, subject to the following restrictions:"
    ],
    "CCBYref": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CCBYSAref": ["Licensed under CC BY-SA 4.0.",
                  "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CCBYNCref": ["Licensed under CC BY-NC 4.0.",
                  "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0ref": ["Licensed under CC0 1.0.", "Released under CC0 1.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "Reserved": ["All rights reserved."],
}
# Licenses and the identifier sequences that mean them, in the order in which they are tried.
RULES = [
    ("MIT", ["MITref", "MITgrant", "MITnotice", "MITwarranty"]),
    ("MIT", ["MITgrant", "MITnotice", "MITwarranty"]),
    ("MIT", ["MITgrant", "MITnotice"]),
    ("BSD-3-Clause", ["BSDgrant", "BSDsource", "BSDbinary", "BSDendorse", "BSDwarranty"]),
    ("BSD-3-Clause", ["BSDgrant", "BSDsource", "BSDbinary", "BSDendorse"]),
    ("BSD-2-Clause", ["BSDgrant", "BSDsource", "BSDbinary", "BSDwarranty"]),
    ("BSD-2-Clause", ["BSDgrant", "BSDsource", "BSDbinary"]),
    ("Apache-2.0", ["Apache2ref", "Apache2comply", "Apache2copy", "Apache2asis"]),
    ("Apache-2.0", ["Apache2ref", "Apache2comply"]),
    ("GPL-3.0-or-later", ["GPL2free", "FSFversion3", "GPLhope"]),
    ("GPL-3.0-or-later", ["GPL2free", "FSFversion3"]),
    ("LGPL-2.1-or-later", ["LGPLfree", "FSFversion21"]),
    ("LGPL-3.0-or-later", ["LGPLfree", "FSFversion3"]),
    ("LGPL-3.0-or-later", ["LGPL3free"]),
    ("AGPL-3.0-or-later", ["AGPL3free", "GPLhope"]),
    ("AGPL-3.0-or-later", ["AGPL3free"]),
    ("GPL-3.0-or-later", ["GPLfree", "GPLhope"]),
    ("GPL-3.0-or-later", ["GPLfree"]),
    ("GPL-2.0-or-later", ["GPL2free", "GPLhope"]),
    ("GPL-2.0-or-later", ["GPL2free"]),
    ("ISC", ["ISCref", "ISCgrant"]),
    ("ISC", ["ISCgrant"]),
    ("ISC", ["ISCref"]),
    ("Apache-2.0 OR MIT", ["ApacheMITref"]),
    ("MIT", ["MITref"]),
    ("BSD-2-Clause", ["BSD2ref"]),
    ("BSD-3-Clause", ["BSD3ref"]),
    ("Apache-2.0", ["Apache2ref"]),
    ("GPL-2.0-only", ["GPL2ref"]),
    ("GPL-3.0-only", ["GPL3ref"]),
    ("LGPL-2.1-only", ["LGPL21ref"]),
    ("LGPL-3.0-only", ["LGPL3ref"]),
    ("AGPL-3.0-only", ["AGPL3ref"]),
    ("MPL-2.0", ["MPL2ref", "MPL2copy"]),
    ("MPL-2.0", ["MPL2ref"]),
    ("EPL-2.0", ["EPL2ref"]),
    ("BSL-1.0", ["BSL1ref"]),
    ("Zlib", ["Zlibasis", "Zlibgrant"]),
    ("Zlib", ["Zlibgrant"]),
    ("CC-BY-4.0", ["CCBYref"]),
    ("CC-BY-SA-4.0", ["CCBYSAref"]),
    ("CC-BY-NC-4.0", ["CCBYNCref"]),
    ("CC0-1.0", ["CC0ref"]),
    ("Unlicense", ["Unlicense"]),
    ("Proprietary", ["Reserved"]),
]
# License identifiers of SPDX tags, and former names of some.
SPDX_TAG = "spdx license identifier"
SPDX = [
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause",
    "BSL-1.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CDDL-1.0", "EPL-1.0", "EPL-2.0", "EUPL-1.2", "GPL-1.0-or-later",
    "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.0-only", "LGPL-2.0-or-later",
    "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MIT-0", "MPL-1.1", "MPL-2.0", "MS-PL",
    "NCSA", "OFL-1.1", "PostgreSQL", "PSF-2.0", "Unlicense", "WTFPL", "X11", "Zlib",
]
SPDX_FORMER = {
    "AGPL-3.0": "AGPL-3.0-only",
    "GPL-2.0": "GPL-2.0-only",
    "GPL-3.0": "GPL-3.0-only",
    "LGPL-2.0": "LGPL-2.0-only",
    "LGPL-2.1": "LGPL-2.1-only",
    "LGPL-3.0": "LGPL-3.0-only",
}
# What an SPDX tag says needs no other sentence.
EVERY_RULE = RULES + [(name, ["SPDX-" + name]) for name in SPDX]
# Words of a license expression between its licenses, once "or later" is one word.
OPERATOR = " (?:or|and|with) "
# In lower-case text: a name in a place where templates name the copyright holder, also over lines, and
# the sign for later versions; each with what stands for it. The first group, if any, stays.
GAP = "[^a-z0-9]+"
REPLACED = [
    (GAP.join(["neither", "the", "names?", "of"]) + r"[^;]{1,200}?" + GAP.join(["", "nor", "the", "names", "of"]),
     "neither the name of the copyright holder nor the names of"),
    (GAP.join(["this", "software", "is", "provided", "by"]) + r"[^;]{1,200}?" + GAP.join(["", "as", "is", "and", "any", "express"]),
     "this software is provided by the copyright holders and contributors as is and any express"),
    (r"(gpl-[0-9]\.[0-9])\+", "{1}-or-later"),
]
# Sentences end at a line break or behind a mark that white space follows.
SENTENCE_END = r"(?<=[.;:!?])[\x20\x09]+|[\x0A\x0D]+"
# A piece that ends in such a mark is not continued by the next one.
ENDED = r"[.;:!?][\x20\x09]*$"
# List labels and comment leaders with letters or digits, which are not part of the sentence behind them.
LABEL = r"^[^a-z0-9]*(?:(?:[0-9]{1,2}|[a-z]|[ivx]{1,4})\)|(?:dnl|rem)[\x20\x09])[^a-z0-9]*(?=[a-z0-9])"


def normalised(sentence: str) -> str:
    return re.sub(r"[^a-z0-9]+", " ", re.sub(r"[A-Z]", lambda m: m.group().lower(), sentence)).strip()


def known_sentences() -> dict[str, str]:
    """Normalised sentence to identifier. A listed sentence with an end mark inside is known by its
    longest part."""
    known = {}
    for identifier, sentences in SENTENCES.items():
        for sentence in sentences:
            known[max(map(normalised, re.split(SENTENCE_END, sentence)), key=len)] = identifier
    return known


def spdx_names() -> dict[str, str]:
    """Normalised name in a license expression to identifier."""
    names = {name: name for name in SPDX} | SPDX_FORMER
    return {one_word(normalised(name)): "SPDX-" + now for name, now in names.items()}


def one_word(expression: str) -> str:
    return expression.replace(" or later", " orlater")


def openings(known: dict[str, str]) -> list[str]:
    """The beginnings of known sentences that more words must follow."""
    words = [s.split(" ") for s in known]
    return sorted({" ".join(w[:n]) for w in words for n in range(1, len(w))})


def looked_up(known: dict[str, str]) -> Column:
    """(place, id, n) of every known sentence: the longest that begins at a place and has n pieces.

    Only a piece that opens a known sentence is carried on, and only while the run stays an opening.
    """
    table = F.create_map(*[F.lit(x) for item in known.items() for x in item])
    opening = openings(known)
    most = max(len(s.split(" ")) for s in known)

    def carried(run: Column, stop: Column) -> Column:
        return F.when(~stop & run.isin(opening), run)

    def step(state: Column, piece: Column) -> Column:
        run = F.concat(state["run"], F.lit(" "), piece["words"])
        found = F.when(run.isNotNull(), F.element_at(table, run))
        return F.struct(
            carried(run, piece["stop"]).alias("run"),
            F.coalesce(found, state["id"]).alias("id"),
            F.when(found.isNotNull(), state["upto"] + 1).otherwise(state["n"]).alias("n"),
            (state["upto"] + 1).alias("upto"),
        )

    def begun(piece: Column, place: Column) -> Column:
        alone = F.element_at(table, piece["words"])
        run = carried(piece["words"], piece["stop"])
        start = F.struct(run.alias("run"), alone.alias("id"), F.lit(1).alias("n"), F.lit(1).alias("upto"))
        longest = F.aggregate(F.slice("sentences", place + 2, F.lit(most - 1)), start, step)
        single = F.struct(place.alias("place"), alone.alias("id"), F.lit(1).alias("n"))
        several = F.transform(F.array(longest), lambda x: F.struct(place.alias("place"), x["id"].alias("id"), x["n"].alias("n")))
        return F.when(run.isNotNull(), F.get(several, F.lit(0))).otherwise(single)

    return F.filter(F.transform("sentences", begun), lambda x: x["id"].isNotNull())


def outermost(most: int) -> Column:
    """The entries of ``looked`` without those that lie within an earlier one."""

    def within(x: Column, i: Column) -> Column:
        first = F.greatest(i - most, F.lit(0))
        before = F.slice("looked", first + 1, i - first)
        return F.exists(before, lambda e: e["place"] + e["n"] >= x["place"] + x["n"])

    return F.when(F.exists("looked", lambda x: x["n"] > 1), F.filter("looked", lambda x, i: ~within(x, i))).otherwise(F.col("looked"))


def tagged() -> Column:
    """(place, part, id) of the licenses that SPDX tags among ``sentences`` name, unknown ones left out.

    The expression is the next sentence, as a blank behind the tag's colon cuts there, or else what follows
    the tag in its own sentence. ``part`` counts from 1 within an expression.
    """
    table = F.create_map(*[F.lit(x) for item in spdx_names().items() for x in item])
    none = F.array().cast("array<struct<place:int,part:int,id:string>>")

    def named(piece: Column, place: Column) -> Column:
        words = piece["words"]
        own = F.substring(words, len(SPDX_TAG) + 2, 1 << 30)
        expression = F.when(words.endswith(SPDX_TAG), F.get("sentences", place + 1)["words"]).when(words.startswith(SPDX_TAG + " "), own)
        parts = F.split(F.replace(expression, F.lit(" or later"), F.lit(" orlater")), OPERATOR)
        ids = F.transform(parts, lambda part, i: F.struct(place.alias("place"), (i + 1).alias("part"), F.element_at(table, part).alias("id")))
        return F.when(expression.isNotNull(), ids).otherwise(none)

    has = F.exists("sentences", lambda piece: piece["words"].contains(SPDX_TAG))
    return F.when(has, F.filter(F.flatten(F.transform("sentences", named)), lambda x: x["id"].isNotNull())).otherwise(none)


def with_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (a struct of the columns of ``docs``), ``n_sentences``, ``known`` and ``licenses``.

    Sentences are counted and placed as line breaks and marks cut them, after the name of a holder has
    been replaced by the template's words. ``known`` is an array of
    (place of the sentence, identifier); a known sentence that is wrapped over lines, also behind
    comment signs or a list label, has the place of its first piece, and a license in an SPDX expression
    that of its tag. Columns may have any names. ``licenses`` is an array of the
    licenses that the rules make of it, in the order of the text. Identifiers that no rule takes give
    none. A null text counts as empty and has no sentence. Work grows with the text and with its
    known sentences only; repeated rows get equal results, an empty table gives none.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    sentences = known_sentences()
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    lower = F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for pattern, by in REPLACED:
        lower = F.regexp_replace(lower, pattern, by.replace("{1}", "$1"))
    cut = compute_once(docs.select(whole.alias("row"), lower.alias("t")), raw=F.split("t", SENTENCE_END)).drop("t")
    words = lambda r: F.trim(F.regexp_replace(F.regexp_replace(r, LABEL, ""), "[^a-z0-9]+", " "))
    plain = F.transform("raw", lambda r: F.struct(words(r).alias("words"), r.rlike(ENDED).alias("stop")))
    cut = compute_once(cut, sentences=F.filter(plain, lambda s: s["words"] != "")).drop("raw")
    cut = compute_once(cut, n_sentences=F.size("sentences").cast("bigint"), looked=looked_up(sentences), tags=tagged()).drop("sentences")
    most = max(len(s.split(" ")) for s in sentences)
    plain = F.transform(outermost(most), lambda x: F.struct(x["place"], F.lit(0).alias("part"), x["id"]))
    # Sentences that are looked up are in order already.
    every = F.when(F.size("tags") == 0, plain).otherwise(F.array_sort(F.concat(plain, F.col("tags"))))
    known = F.transform(every, lambda x: F.struct(x["place"], x["id"]))
    cut = compute_once(cut, known=known).drop("looked", "tags")
    # Every identifier ends in a semicolon and starts behind one, so rules match whole identifiers.
    sequence = F.concat(F.lit(";"), F.array_join(F.transform("known", lambda x: x["id"]), ";;"), F.lit(";"))
    for number, (_, ids) in enumerate(EVERY_RULE):
        sequence = F.replace(sequence, F.lit(";" + ";;".join(ids) + ";"), F.lit(f";#{number};"))
    names = F.array(*[F.lit(name) for name, _ in EVERY_RULE])
    taken = F.regexp_extract_all(sequence, F.lit(r"#([0-9]+);"), F.lit(1))
    licenses = F.when(F.size("known") == 0, F.array().cast("array<string>")).otherwise(
        F.transform(taken, lambda n: F.get(names, n.cast("int")))
    )
    return compute_once(cut, licenses=licenses).select("row", "n_sentences", "known", "licenses")
