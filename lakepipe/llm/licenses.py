"""Licence scan by sentence rules.

A text is normalised to its words (lower case; runs of anything but a-z and 0-9 separate words), so line ends,
comment marks, headings and copyright lines around a sentence do not matter. Wherever a known licence sentence
stands in it, word for word, it is replaced by its identifier, the longest sentences first, so a sentence is never
taken for a part of it. What remains of a document is the sequence of its sentence identifiers, against which the
rules are matched in their order: a rule names a licence and the identifiers that must follow each other; matched
ones are used up, so a whole licence text is not reported by its parts too.

Everything happens within the row: texts that hold no word any known sentence has are left out first, and nothing
is shuffled. The table of sentences is fixed and small, and part of the plan.

Defined results: a null or empty text, and one without licence sentences, gives no row; every occurrence counts;
rows that share an id, or have none, are scanned each by itself, repeated rows too; texts of any length are scanned
whole. Other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

# Licences by their SPDX identifiers, with the names under which notes refer to them.
NAMES = {
    "MIT": ["MIT License", "MIT license (MIT)", "terms of the MIT License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "terms of the Apache License, Version 2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-clause BSD license", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-clause BSD license", "New BSD License"],
    "ISC": ["ISC License"],
    "Zlib": ["zlib License", "zlib/libpng license"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "Mozilla Public License, v. 2.0"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License v2.0", "terms of the Eclipse Public License 2.0"],
    "EPL-1.0": ["Eclipse Public License v1.0", "terms of the Eclipse Public License v1.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU GPL version 2", "GNU General Public License v2.0"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU GPL version 3", "GNU General Public License v3.0"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3"],
    "CC0-1.0": ["Creative Commons Zero v1.0 Universal license", "CC0 1.0 Universal license"],
    "CC-BY-4.0": ["Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["Creative Commons Attribution-NonCommercial 4.0 International License"],
    "Unlicense": ["Unlicense"],
}
#: How such a note begins.
VERBS = ["licensed under", "released under", "distributed under", "available under"]
CREATIVE = {"CC-BY-4.0": "CC BY 4.0", "CC-BY-SA-4.0": "CC BY-SA 4.0", "CC-BY-NC-4.0": "CC BY-NC 4.0", "CC0-1.0": "CC0 1.0"}
#: Identifiers of tags beside the keys above.
TAGS = [f"{name}-{way}" for name in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0") for way in ("only", "or-later")] + ["0BSD"]
#: The families of the notice that begins "you can redistribute it".
FAMILIES = {
    "GPL-2.0": ("GNU General Public License", "2"), "GPL-3.0": ("GNU General Public License", "3"),
    "LGPL-2.1": ("GNU Lesser General Public License", "2.1"), "LGPL-3.0": ("GNU Lesser General Public License", "3"),
    "AGPL-3.0": ("GNU Affero General Public License", "3"),
}

# Sentences of public licence texts.
SENTENCES = {
    "reserved": "All rights reserved.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "mit grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit notice": "The above copyright notice and this permission notice shall be included in all copies or substantial "
    "portions of the Software.",
    "mit warranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
    "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "apache header": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache use": "you may not use this file except in compliance with the License.",
    "apache copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache title": "Apache License Version 2.0, January 2004",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:",
    "bsd source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer.",
    "bsd binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "0bsd": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted.",
    "zlib warranty": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and "
    "to alter it and redistribute it freely, subject to the following restrictions:",
    "boost grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
    'and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, '
    "and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the "
    "Software is furnished to do so, all subject to the following:",
    "mpl header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "epl header": "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
    "2.0 which is available at",
    "epl header 1": "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
    "v1.0 which accompanies this distribution",
    "cc0 deed": "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his "
    "or her rights to the work worldwide under copyright law",
    "cc0 notice": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights "
    "to this software to the public domain worldwide.",
    "cc0 title": "CC0 1.0 Universal",
    "gpl 2 title": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "gpl 3 title": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "lgpl 3 title": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "agpl 3 title": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
}
#: Rules of several sentences, and of single sentences, in the order in which they are tried.
TEXT_RULES = [
    ("BSD-3-Clause", ["bsd", "bsd source", "bsd binary", "bsd names"]),
    ("BSD-2-Clause", ["bsd", "bsd source", "bsd binary"]),
    ("MIT", ["mit grant", "mit notice", "mit warranty"]),
    ("MIT", ["mit grant", "mit notice"]),
    ("Apache-2.0", ["apache header", "apache use", "apache copy"]),
    ("Apache-2.0", ["apache header", "apache use"]),
    ("Zlib", ["zlib warranty", "zlib grant"]),
    ("MIT", ["mit grant"]),
    ("Apache-2.0", ["apache header"]),
    ("Apache-2.0", ["apache title"]),
    ("BSD", ["bsd"]),
    ("ISC", ["isc"]),
    ("0BSD", ["0bsd"]),
    ("Zlib", ["zlib grant"]),
    ("BSL-1.0", ["boost grant"]),
    ("MPL-2.0", ["mpl header"]),
    ("EPL-2.0", ["epl header"]),
    ("EPL-1.0", ["epl header 1"]),
    ("CC0-1.0", ["cc0 deed"]),
    ("CC0-1.0", ["cc0 notice"]),
    ("CC0-1.0", ["cc0 title"]),
    ("GPL-2.0", ["gpl 2 title"]),
    ("GPL-3.0", ["gpl 3 title"]),
    ("LGPL-3.0", ["lgpl 3 title"]),
    ("AGPL-3.0", ["agpl 3 title"]),
    ("Unlicense", ["unlicense"]),
]
#: Every known sentence has one of these in a word; texts without them are not normalised.
ANCHORS = ["licens", "permi", "reserved", "redistribut", "unencumbered", "warrant", "domain", "universal", "compliance", "endorse", "cc", "gpl"]


def normalised(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def _sentence_table() -> tuple[dict[str, int], list[tuple[str, list[int]]]]:
    """The normalised sentences with their numbers, and the rules in the order of matching."""
    numbers: dict[str, int] = {}

    def number(sentence: str) -> int:
        return numbers.setdefault(normalised(sentence), len(numbers) + 1)

    by_name = {name: number(sentence) for name, sentence in SENTENCES.items()}
    rules = [(licence, [by_name[n] for n in names]) for licence, names in TEXT_RULES]
    for licence, (name, version) in FAMILIES.items():
        notice = "you can redistribute it and/or modify it under the terms of the"
        published = "as published by the Free Software Foundation"
        later = number(f"{notice} {name} {published}, either version {version} of the License, or (at your option) any later version.")
        rules.append((f"{licence}-or-later", [later]))
        rules.append((f"{licence}-only", [number(f"{notice} {name}, version {version}, {published}.")]))
        rules.append((f"{licence}-only", [number(f"{notice} {name} {published}, version {version} of the License.")]))
    for licence in [*NAMES, *TAGS]:
        rules.append((licence, [number(f"SPDX-License-Identifier: {licence}")]))
    for verb in VERBS:
        for licence, names in NAMES.items():
            rules += [(licence, [number(f"{verb} the {name}")]) for name in names]
        rules += [(licence, [number(f"{verb} {short}")]) for licence, short in CREATIVE.items()]
    rules.append(("All-rights-reserved", [by_name["reserved"]]))
    return numbers, rules


NUMBERS, RULES = _sentence_table()
#: The longest sentence first; equally long ones by their words.
ORDERED = sorted(NUMBERS.items(), key=lambda item: (-len(item[0]), item[0]))


def _pattern(ids: list[int]) -> str:
    return "".join(f"<{i}>" for i in ids)


def _spread(sentence: str) -> str:
    """Every word between spaces of its own, so that neighbouring sentences share no character."""
    return " " + sentence.replace(" ", "  ") + " "


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, licence, n_matches) for every licence found in ``docs`` (doc_id, text)."""
    lower = F.lower("text")
    may = F.lit(False)
    for anchor in ANCHORS:
        may = may | F.contains(lower, F.lit(anchor))
    words = F.regexp_replace(F.btrim(F.regexp_replace(lower, "[^a-z0-9]+", " ")), " ", "  ")
    frame = docs.select("doc_id", "text").where(may).select("doc_id", F.concat(F.lit(" "), words, F.lit(" ")).alias("said"))
    said = F.col("said")
    for sentence, i in ORDERED:
        said = F.replace(said, F.lit(_spread(sentence)), F.lit(f"<{i}>"))
    marks = F.array_join(F.regexp_extract_all(said, F.lit("<[0-9]+>"), F.lit(0)), "")
    frame = frame.select("doc_id", marks.alias("left")).where("left <> ''")
    # The sequence is short: each rule takes its matches out of what the rules before it left.
    found = F.array().cast("array<struct<licence:string,n:bigint>>")
    state = F.struct(F.col("left").alias("left"), found.alias("found"))
    rules = F.array(*[F.struct(F.lit(name).alias("licence"), F.lit(_pattern(ids)).alias("marks")) for name, ids in RULES])

    def apply(done, rule):
        rest = F.replace(done["left"], rule["marks"], F.lit("|"))
        n = ((F.length(done["left"]) - F.length(rest)) / (F.length(rule["marks"]) - 1)).cast("long")
        one = F.array(F.struct(rule["licence"].alias("licence"), n.alias("n")))
        return F.struct(rest.alias("left"), F.when(n > 0, F.concat(done["found"], one)).otherwise(done["found"]).alias("found"))

    matched = frame.select("doc_id", F.aggregate(rules, state, apply)["found"].alias("found"))
    names = F.array_sort(F.array_distinct(F.transform("found", lambda m: m["licence"])))

    def total(name):
        mine = F.filter("found", lambda m: m["licence"] == name)
        n = F.aggregate(mine, F.lit(0).cast("long"), lambda t, m: t + m["n"])
        return F.struct(name.alias("licence"), n.alias("n_matches"))

    return matched.select("doc_id", F.inline(F.transform(names, total)))


def oracle_sql() -> str:
    """``scan`` in SQL for tables whose ids are distinct."""
    said = "' ' || regexp_replace(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' ', '  ', 'g') || ' '"
    cuts, previous = [], "texts"
    for k, (sentence, i) in enumerate(ORDERED):
        if k % 10 == 0:
            cuts.append((f"c{k}", previous, "said"))
            previous = f"c{k}"
        name, source, expression = cuts[-1]
        cuts[-1] = (name, source, f"replace({expression}, '{_spread(sentence)}', '<{i}>')")
    steps = [f"{name} AS (SELECT doc_id, {expression} AS said FROM {source})" for name, source, expression in cuts]
    steps.append(
        f"r AS (SELECT doc_id, array_to_string(regexp_extract_all(said, '<[0-9]+>'), '') AS l0 FROM {previous})"
    )
    previous, counted = "r", []
    for k, (name, ids) in enumerate(RULES):
        pattern = _pattern(ids)
        steps.append(
            f"r{k} AS (SELECT * EXCLUDE (l{k}), (length(l{k}) - length(replace(l{k}, '{pattern}', '|'))) // {len(pattern) - 1} AS n{k}, "
            f"replace(l{k}, '{pattern}', '|') AS l{k + 1} FROM {previous})"
        )
        counted.append(f"{{'licence': '{name}', 'n': n{k}}}")
        previous = f"r{k}"
    return f"""
    WITH texts AS (SELECT doc_id, {said} AS said FROM documents WHERE text IS NOT NULL),
    {', '.join(steps)},
    every AS (SELECT doc_id, unnest([{', '.join(counted)}]) AS m FROM {previous})
    SELECT doc_id, m.licence AS licence, CAST(sum(m.n) AS BIGINT) AS n_matches FROM every WHERE m.n > 0 GROUP BY doc_id, m.licence"""
