"""Licence scans by sentence rules.

Sentences end after . ! ? before white space and at blank lines; a line that holds nothing but comment marks is blank. A known
sentence begins where a sentence or a line begins and ends where one ends, over as many lines as it is wrapped; a colon
counts as a line's end. A normalised sentence (lower case; everything but letters and digits, so comment marks too, as one
space) that a lexicon knows becomes its identifier; what a longer known sentence of the text covers is not read again. A rule is
an ordered sequence of identifiers; it matches where its identifiers follow each other among the known sentences of a text. Rules
are tried in their order, and a place that a rule has matched is not matched again by a later one.

An SPDX expression is read as one line for each licence that it joins. Texts of any length are read whole; a place of a text is compared with as many words as the longest known sentence has.
Null and empty texts have no sentence and no row in the result; neither have texts without a matched rule. Repeated rows are reported
once; different texts of the same id are read as one, place by place. Extra columns are ignored. An empty table, lexicon or rule set gives an empty table. The lexicon and
rules are parameters; beyond MOST_SENTENCES sentences the lexicon is joined by a shuffle instead of a broadcast.
A sentence with a name in it, as in some third clauses of BSD, is not known; so clauses alone are BSD, without a number.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_SENTENCES = 100_000

#: Starts of known sentences that lines are held against before the join; with more of them all lines are joined.
MOST_STARTS = 2_000

# Sentences that licences are told by, and the rules over them, in order.
SENTENCES = (
    ("apache-short", "Licensed under the Apache License, Version 2.0."),
    ("apache-comply", "You may not use this file except in compliance with the License."),
    ("apache-notice", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("apache-notice", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this software except in compliance with the License.'),
    ("apache-asf", 'The ASF licenses this file to you under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("apache-asf", 'The ASF licenses this file to You under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("apache-asf", 'Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements.'),
    ("apache-title", "Apache License Version 2.0, January 2004"),
    ("mit-short", "Released under the MIT License."),
    ("mit-title", "MIT License"),
    ("mit-title", "The MIT License"),
    ("mit-title", "The MIT License (MIT)"),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    ("mit-grant", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("mit-0-grant", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.'),
    ("mit-keep", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit-keep", "The above copyright notice and this permission notice (including the next paragraph) shall be included in all copies or substantial portions of the Software."),
    ("mit-warranty", 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND.'),
    ("mit-warranty", 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'),
    ("bsd-grant", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("bsd-source", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd-binary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd-name", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("bsd-name", "Neither the name of the copyright holders nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("bsd-name", "Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("bsd-name", "The name of the author may not be used to endorse or promote products derived from this software without specific prior written permission."),
    ("isc-grant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("isc-grant", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("0bsd-grant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("mpl2-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("mpl2-terms", "This Source Code Form is subject to the terms of the Mozilla Public License, v."),
    ("mpl2-get", "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("mpl2-get", "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("epl2-notice", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/."),
    ("epl1-notice", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html."),
    ("boost-grant", 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:'),
    ("boost-notice", "Distributed under the Boost Software License, Version 1.0."),
    ("zlib-grant", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("unlicense-free", "This is free and unencumbered software released into the public domain."),
    ("unlicense-anyone", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("wtfpl", "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE"),
    ("cc0-notice", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("gpl3-short", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-later", "You can redistribute it and/or modify it under the terms of the GNU General Public License."),
    ("gpl-title", "GNU GENERAL PUBLIC LICENSE"),
    ("lgpl-title", "GNU LESSER GENERAL PUBLIC LICENSE"),
    ("lgpl-title", "GNU LIBRARY GENERAL PUBLIC LICENSE"),
    ("agpl-title", "GNU AFFERO GENERAL PUBLIC LICENSE"),
    ("gnu-2-date", "Version 2, June 1991"),
    ("gnu-21-date", "Version 2.1, February 1999"),
    ("gnu-3-date", "Version 3, 29 June 2007"),
    ("agpl-3-date", "Version 3, 19 November 2007"),
    ("gnu-verbatim", "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."),
    ("gpl2-preamble", "The licenses for most software are designed to take away your freedom to share and change it."),
    ("gpl3-preamble", "The GNU General Public License is a free, copyleft license for software and other kinds of works."),
    ("agpl3-preamble", "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software."),
    ("lgpl3-body", "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented by the additional permissions listed below."),
    ("apache-terms", "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("apache-means", '"License" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document.'),
    ("mpl2-title", "Mozilla Public License Version 2.0"),
    ("mpl2-title", "Mozilla Public License, version 2.0"),
    ("mpl2-contributor", "means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software."),
    ("mpl2-contributor", '"Contributor" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software.'),
    ("mpl2-contributor", '1.1. "Contributor" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software.'),
    ("mpl2-covered", '"Covered Software" means Source Code Form to which the initial Contributor has attached the notice in Exhibit A, the Executable Form of such Source Code Form, and Modifications of such Source Code Form, in each case including portions thereof.'),
    ("epl2-title", "Eclipse Public License - v 2.0"),
    ("epl1-title", "Eclipse Public License - v 1.0"),
    ("cc0-title", "CC0 1.0 Universal"),
    ("cc0-body", "The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and Related Rights (defined below) upon the creator and subsequent owner(s) (each and all, an \"owner\") of an original work of authorship and/or a database (each, a \"Work\")."),
    ("zlib-misrepresent", "The origin of this software must not be misrepresented; you must not claim that you wrote the original software."),
    ("bsd-style", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("bsd-style", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file in the root of the source tree."),
    ("mit-style", "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file."),
    ("mit-style", "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file or at https://opensource.org/licenses/MIT."),
    ("apache-style", "Use of this source code is governed by an Apache 2.0 license that can be found in the LICENSE file."),
)
#: The notices of the GNU licences: the work is called program, library or by its own name with "is free software" before this.
_GNU = (("GPL", "GNU General Public License"), ("LGPL", "GNU Lesser General Public License"), ("LGPL", "GNU Library General Public License"), ("AGPL", "GNU Affero General Public License"))
_GNU_VERSIONS = {"GPL": ("2", "3"), "LGPL": ("2", "2.1", "3"), "AGPL": ("3",)}
_GNU_WORKS = ("This program is free software", "This library is free software", "This file is free software", "This software is free software", "This is free software", "It is free software")
SENTENCES += tuple(
    (f"{short.lower()}-{version}-{kind}", f"{work}{join} you can redistribute it and/or modify it under the terms of the {title} {terms}")
    for short, title in _GNU
    for version in _GNU_VERSIONS[short]
    for work in _GNU_WORKS
    for join in (";", ": ")
    for kind, terms in (
        ("later", f"as published by the Free Software Foundation; either version {version} of the License, or (at your option) any later version."),
        ("later", f"as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."),
        ("later", f"as published by the Free Software Foundation; either version {version}, or (at your option) any later version."),
        ("only", f"as published by the Free Software Foundation; version {version} of the License."),
        ("only", f"version {version} as published by the Free Software Foundation."),
        ("only", f"version {version} only, as published by the Free Software Foundation."),
    )
)
#: Licences by SPDX identifier, with the names that notices call them by.
_NAMES = {
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0 License", "Apache-2.0"),
    "MIT": ("MIT License", "MIT"), "MIT-0": ("MIT-0 License", "MIT-0"), "ISC": ("ISC License", "ISC"), "Zlib": ("zlib License",), "BSL-1.0": ("Boost Software License, Version 1.0", "Boost Software License 1.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "BSD-2-Clause"), "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License", "BSD-3-Clause"), "0BSD": ("0BSD", "BSD Zero Clause License"), "BSD": ("BSD License",),
    "MPL-2.0": ("Mozilla Public License 2.0", "Mozilla Public License, Version 2.0", "MPL-2.0", "MPL 2.0"), "MPL-1.1": ("Mozilla Public License 1.1", "Mozilla Public License, Version 1.1"),
    "EPL-1.0": ("Eclipse Public License 1.0", "Eclipse Public License, Version 1.0"), "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License, Version 2.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL v2", "GNU GPLv2", "GPLv2", "GPL-2.0", "GPL v2"), "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3", "GNU GPLv3", "GPLv3", "GPL-3.0", "GPL v3"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "LGPLv2.1", "LGPL-2.1"), "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "LGPLv3", "LGPL-3.0"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "GNU AGPLv3", "AGPLv3", "AGPL-3.0"), "Unlicense": ("Unlicense",), "WTFPL": ("WTFPL",), "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal", "CC0-1.0"),
}
_CREATIVE = (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))
_NAMES |= {
    f"CC-{short}-{version}": (f"CC {short} {version}", f"CC-{short}-{version}", f"Creative Commons {title} {version} {place} License", f"Creative Commons {title} {version} {place}", f"Creative Commons {title} {version} License")
    for short, title in _CREATIVE
    for version, place in (("4.0", "International"), ("3.0", "Unported"))
}
_OPENINGS = tuple(f"{who}{how} under {the}" for who in ("", "This work is ", "This project is ", "This software is ", "This file is ", "This program is ", "This code is ", "This package is ") for how in ("licensed", "released", "distributed", "available") for the in ("", "the ", "a ", "the terms of the "))
SENTENCES += tuple((f"named-{licence}", f"{opening}{name}") for licence, names in _NAMES.items() for name in names for opening in _OPENINGS)
SENTENCES += tuple((f"spdx-{licence}{more}", f"SPDX-License-Identifier: {licence}{more}") for licence in _NAMES for more in ("", "-only", "-or-later") if not more or "GPL" in licence)
#: Notices that point to a file, and those of two licences of which one may choose.
_FOUND_IN = tuple(f"This source code is licensed under the {{}} {tail}" for tail in ("found in the LICENSE file in the root directory of this source tree.", "found in the LICENSE file.", "that can be found in the LICENSE file."))
SENTENCES += tuple((f"named-{licence}", form.format(name if name.endswith("icense") else f"{name} license")) for licence, names in _NAMES.items() for name in names for form in _FOUND_IN)
_EITHER = ("Licensed under either of {0} or {1}", "Licensed under either of the {0} or the {1}", "Licensed under either of {0} or {1} at your option", "Licensed under the {0} or the {1}", "Dual-licensed under {0} and {1}", "Dual licensed under the {0} or the {1}")
_CHOICES = tuple((a, b) for one in _NAMES["Apache-2.0"] for two in ("MIT License", "MIT") for a, b in ((one, two), (two, one)))
SENTENCES += tuple(("either-apache-mit", form.format(a, b)) for form in _EITHER for a, b in _CHOICES)
#: First sentences of the bodies of Creative Commons licences.
SENTENCES += tuple(
    (f"cc-body-{short}", f'By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this Creative Commons {title} 4.0 International Public License ("Public License").') for short, title in _CREATIVE
)
SENTENCES += tuple((f"cc-body-{short}", f"Creative Commons {title} 4.0 International Public License") for short, title in _CREATIVE)
RULES = (
    ("Apache-2.0-notice", ("apache-short", "apache-comply")),
    ("Apache-2.0-notice", ("apache-notice",)),
    ("Apache-2.0-notice", ("apache-asf", "apache-asf")),
    ("Apache-2.0-notice", ("apache-asf",)),
    ("MIT-text", ("mit-grant", "mit-keep", "mit-warranty")),
    ("MIT-text", ("mit-grant", "mit-warranty")),
    ("MIT-0", ("mit-0-grant", "mit-warranty")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-name")),
    ("BSD", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("MPL-2.0", ("mpl2-terms", "mpl2-get")),
    ("Unlicense", ("unlicense-free", "unlicense-anyone")),
    ("Apache-2.0", ("apache-short",)),
    ("Apache-2.0", ("apache-title",)),
    ("MIT", ("mit-short",)),
    ("MIT", ("mit-title",)),
    ("ISC", ("isc-grant",)),
    ("0BSD", ("0bsd-grant",)),
    ("MPL-2.0", ("mpl2-notice",)),
    ("MPL-2.0", ("mpl2-get",)),
    ("EPL-2.0", ("epl2-notice",)),
    ("EPL-1.0", ("epl1-notice",)),
    ("BSL-1.0", ("boost-grant",)),
    ("BSL-1.0", ("boost-notice",)),
    ("Zlib", ("zlib-grant",)),
    ("Unlicense", ("unlicense-free",)),
    ("WTFPL", ("wtfpl",)),
    ("CC0-1.0", ("cc0-notice",)),
    ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("GPL-3.0", ("gpl3-short",)),
    ("GPL", ("gpl-later",)),
    ("GPL-2.0", ("gpl-title", "gnu-2-date")),
    ("GPL-3.0", ("gpl-title", "gnu-3-date")),
    ("LGPL-2.0", ("lgpl-title", "gnu-2-date")),
    ("LGPL-2.1", ("lgpl-title", "gnu-21-date")),
    ("LGPL-3.0", ("lgpl-title", "gnu-3-date")),
    ("AGPL-3.0", ("agpl-title", "agpl-3-date")),
    ("GPL-2.0", ("gpl2-preamble",)),
    ("GPL-3.0", ("gpl3-preamble",)),
    ("AGPL-3.0", ("agpl3-preamble",)),
    ("LGPL-3.0", ("lgpl3-body",)),
    ("Apache-2.0", ("apache-terms", "apache-means")),
    ("MPL-2.0", ("mpl2-title",)),
    ("MPL-2.0", ("mpl2-contributor",)),
    ("MPL-2.0", ("mpl2-covered",)),
    ("EPL-2.0", ("epl2-title",)),
    ("EPL-1.0", ("epl1-title",)),
    ("CC0-1.0", ("cc0-title",)),
    ("CC0-1.0", ("cc0-body",)),
    ("Zlib", ("zlib-misrepresent",)),
    ("BSD", ("bsd-style",)),
    ("MIT", ("mit-style",)),
    ("Apache-2.0", ("apache-style",)),
    ("Apache-2.0-OR-MIT", ("either-apache-mit",)),
)
RULES += tuple((f"CC-{short}-4.0", (f"cc-body-{short}",)) for short, _ in _CREATIVE)
RULES += tuple((f"{short}-{version if '.' in version else version + '.0'}-{'or-later' if kind == 'later' else kind}", (f"{short.lower()}-{version}-{kind}",)) for short, versions in _GNU_VERSIONS.items() for version in versions for kind in ("later", "only"))
RULES += tuple((licence, (f"named-{licence}",)) for licence in _NAMES)
RULES += tuple((x.removeprefix("spdx-"), (x,)) for x, _ in SENTENCES if x.startswith("spdx-"))
# Fixed values end.


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), r"[^\p{L}\p{N}]+", " "))


def _words(sentence: str) -> list[str]:
    return re.findall(r"[^\W_]+", sentence.lower())


def _one_licence_a_line(text: Column) -> Column:
    """The text with a line for each licence of an SPDX expression, whatever joins them."""
    tag = "SPDX-License-Identifier:"
    joined = rf"[ \t]+(?:OR|AND|WITH|or|and|with)[ \t]+(?<={tag}[^\n]{{1,200}})"
    return F.when(F.contains(text, F.lit(tag)), F.regexp_replace(text, joined, f"\n{tag} ")).otherwise(text)


def _fragments(text: Column) -> Column:
    """The normalised lines of a text; an empty one stands after each sentence and for each blank line."""
    text = _one_licence_a_line(text)
    lines = F.regexp_replace(F.regexp_replace(text, r"\r\n?", "\n"), r"[.!?][ \t\n]+", "\n\n")
    lines = F.regexp_replace(F.regexp_replace(lines, r"(?m)^[ \t]*(?:REM|dnl)[ \t]", ""), r":[ \t]+(?=\S)", ":\n")
    return F.split(F.regexp_replace(F.trim(F.regexp_replace(F.lower(lines), r"[^\p{L}\p{N}\n]+", " ")), r" ?\n ?", "\n"), "\n")


def known_sentences(docs: DataFrame, sentences: tuple[tuple[str, str], ...] = SENTENCES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, of, at, until, sentence_id): the known sentences of each text, whose hash is `of`, from line `at` to before `until`."""
    spark = docs.sparkSession
    words = [w for w in (_words(sentence) for _, sentence in sentences) if w]
    most, least = max(map(len, words), default=1), min(3, *map(len, words), 3)
    starts = sorted({" ".join(w[:least]) for w in words})
    lexicon = spark.createDataFrame(list(sentences), "sentence_id string, sentence string").select("sentence_id", normalised(F.col("sentence")).alias("norm")).where("norm <> ''")
    lexicon = lexicon.groupBy("norm").agg(F.min("sentence_id").alias("sentence_id")).withColumn("start", F.substring_index("norm", " ", least))
    if len(sentences) <= MOST_SENTENCES:
        lexicon = F.broadcast(lexicon)

    def start(i: Column) -> Column:
        return F.substring_index(F.array_join(F.slice("lines", i + 1, F.lit(least)), " "), " ", least)

    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col), F.xxhash64(text_col).alias("of"), _fragments(F.col(text_col)).alias("lines"))
    places = F.filter(F.transform("lines", lambda _, i: F.struct(i.alias("at"), start(i).alias("start"))), lambda x: x["start"].isin(starts) if len(starts) <= MOST_STARTS else x["start"] != "")
    # a line has a word at least, so that no known sentence is wrapped over more lines than it has words
    places = F.transform(places, lambda x: F.struct(x["at"].alias("at"), x["start"].alias("start"), F.array_join(F.slice("lines", x["at"] + 1, F.lit(most)), "\n").alias("run")))
    met = rows.select(id_col, "of", F.inline(places)).join(lexicon, "start")
    ends = F.substring("run", F.length("norm") + 1, F.lit(1)).isin("", "\n")
    met = met.where(F.startswith(F.translate("run", "\n", " "), F.col("norm")) & ends)
    return met.select(id_col, "of", "at", (F.col("at") + F.size(F.split(F.substring("run", F.lit(1), F.length("norm")), "\n"))).alias("until"), "sentence_id")


def _uncovered(found: Column) -> Column:
    """Of (of, at, until, sentence_id), text by text, the longest at each place and none that begins in one before it; as (at, sentence_id)."""
    kind = "struct<of:bigint,until:int,kept:array<struct<at:int,sentence_id:string>>>"
    start = F.struct(F.lit(None).alias("of"), F.lit(0).alias("until"), F.array().alias("kept")).cast(kind)

    def step(state: Column, x: Column) -> Column:
        free = state["of"].isNull() | (state["of"] != x["of"]) | (x["at"] >= state["until"])
        place = F.struct(x["at"].alias("at"), x["sentence_id"].alias("sentence_id"))
        taken = F.struct(x["of"].alias("of"), x["until"].alias("until"), F.concat(state["kept"], F.array(place)).alias("kept"))
        return F.when(free, taken.cast(kind)).otherwise(state)

    in_order = F.array_sort(F.transform(found, lambda x: F.struct(x["of"].alias("of"), x["at"].alias("at"), (-x["until"]).alias("back"), x["sentence_id"].alias("sentence_id"), x["until"].alias("until"))))
    return F.array_sort(F.array_distinct(F.aggregate(in_order, start, step, lambda state: state["kept"])))


def recognise(docs: DataFrame, sentences: tuple[tuple[str, str], ...] = SENTENCES, rules: tuple[tuple[str, tuple[str, ...]], ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, sentence_ids, licences): the known sentences of a text in order, and the licences whose rules match, in rule order."""
    if any("|" in name for name, _ in sentences):
        raise ValueError("sentence identifiers may not contain |")
    known = known_sentences(docs, sentences, id_col, text_col).groupBy(id_col).agg(F.collect_set(F.struct("of", "at", "until", "sentence_id")).alias("found"))
    known = known.select(id_col, F.transform(_uncovered(F.col("found")), lambda x: x["sentence_id"]).alias("found"))
    rest = F.concat(F.lit("|"), F.array_join("found", "||"), F.lit("|"))
    kind = "struct<rest:string,matched:array<string>>"
    ordered = F.array(*(F.struct(F.lit(name).alias("name"), F.lit(sequence[0]).alias("first"), F.lit("".join(f"|{x}|" for x in sequence)).alias("needle")) for name, sequence in rules if sequence))
    # only rules whose first identifier the text has can match; they keep their order
    tried = F.filter(ordered, lambda rule: F.array_contains("found", rule["first"])) if rules else F.array().cast("array<struct<name:string,first:string,needle:string>>")

    def step(state: Column, rule: Column) -> Column:
        hit = F.contains(state["rest"], rule["needle"])
        named = F.when(F.array_contains(state["matched"], rule["name"]), state["matched"]).otherwise(F.concat(state["matched"], F.array(rule["name"])))
        return F.when(hit, F.struct(F.replace(state["rest"], rule["needle"], F.lit("#")).alias("rest"), named.alias("matched")).cast(kind)).otherwise(state)

    start = F.struct(rest.alias("rest"), F.array().cast("array<string>").alias("matched")).cast(kind)
    out = known.select(id_col, F.array_join("found", " ").alias("sentence_ids"), F.aggregate(tried, start, step, lambda state: state["matched"]).alias("matched"))
    return out.where(F.size("matched") > 0).select(id_col, "sentence_ids", F.array_join("matched", " ").alias("licences"))
