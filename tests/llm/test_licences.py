"""Licence sentences and rules: real notices, and a brute force over words that shares no code with the query."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakepipe.llm import licenses, queries

SMALL = "/root/testdata/sf0.01"
MIT = """Copyright (c) 2020 Jane Doe
Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
GPL = """ * This program is free software; you can redistribute it and/or modify
 * it under the terms of the GNU {}General Public License as published by
 * the Free Software Foundation; either version {} of the License, or
 * (at your option) any later version."""
BSD = """Copyright 2020 The Authors. All rights reserved.
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission."""
NOTICES = [
    (MIT, {"MIT": 1}),
    (re.sub("(?m)^", "# ", MIT), {"MIT": 1}),
    (GPL.format("", "2"), {"GPL-2.0-or-later": 1}),
    (GPL.format("", "3"), {"GPL-3.0-or-later": 1}),
    (GPL.format("Lesser ", "2.1"), {"LGPL-2.1-or-later": 1}),
    (GPL.format("Affero ", "3"), {"AGPL-3.0-or-later": 1}),
    (BSD, {"BSD-2-Clause": 1, "All-rights-reserved": 1}),
    (BSD + THIRD, {"BSD-3-Clause": 1, "All-rights-reserved": 1}),
    ("// SPDX-License-Identifier: Apache-2.0\nint main() {}", {"Apache-2.0": 1}),
    ("# SPDX-License-Identifier: GPL-3.0-or-later", {"GPL-3.0-or-later": 1}),
    ("/* SPDX-License-Identifier: GPL-2.0-only */", {"GPL-2.0-only": 1}),
    ("SPDX-License-Identifier: BSL-1.0", {"BSL-1.0": 1}),
    ("foo is licensed under the MIT License.", {"MIT": 1}),
    ("The library is distributed under the Boost Software License, Version 1.0.", {"BSL-1.0": 1}),
    ("CC0 1.0 Universal\n\nThe work is free.", {"CC0-1.0": 1}),
    (
        'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the '
        "License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n",
        {"Apache-2.0": 1},
    ),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0.", {"MPL-2.0": 1}),
    (
        "This program and the accompanying materials are made\navailable under the terms of the Eclipse Public License 2.0\n"
        "which is available at https://www.eclipse.org/legal/epl-2.0/",
        {"EPL-2.0": 1},
    ),
    (
        "This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be held liable.\n\n"
        "Permission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it and "
        "redistribute it\nfreely, subject to the following restrictions:",
        {"Zlib": 1},
    ),
    ("Released under the MIT LICENSE\nReleased under the MIT License. All rights  reserved!", {"MIT": 2, "All-rights-reserved": 1}),
    ("All rights are reserved.", {}),
    ("He licensed the patent under the terms they agreed.", {}),
    ("unlicensed under the MIT Licenses", {}),
    (None, {}),
    ("", {}),
]


def scan(spark, *texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {i: {} for i in range(len(texts))}
    for r in licenses.scan(frame).collect():
        found[r["doc_id"]][r["licence"]] = r["n_matches"]
    return found


def test_notices_as_they_stand_in_files(spark):
    assert scan(spark, *[text for text, _ in NOTICES]) == dict(enumerate(want for _, want in NOTICES))


def brute(text):
    """Words left to right; the longest sentences claim their words first."""
    words = re.findall("[a-z0-9]+", (text or "").lower())
    claimed = [None] * len(words)
    for sentence in sorted(licenses.NUMBERS, key=lambda s: (-len(s), s)):
        w = sentence.split()
        at = 0
        while at + len(w) <= len(words):
            if words[at : at + len(w)] == w and not any(claimed[at : at + len(w)]):
                claimed[at : at + len(w)] = [sentence] + ["inside"] * (len(w) - 1)
                at += len(w)
            else:
                at += 1
    sequence = [licenses.NUMBERS[c] for c in claimed if c and c != "inside"]
    out = Counter()
    for licence, ids in licenses.RULES:
        at = 0
        while at + len(ids) <= len(sequence):
            if sequence[at : at + len(ids)] == ids:
                out[licence] += 1
                sequence[at : at + len(ids)] = ["|"]
            at += 1
    return dict(out)


def test_query_against_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = {i: {} for i in texts}
    for r in queries.op8_licence_rules(spark, SMALL).collect():
        found[r["doc_id"]][r["licence"]] = r["n_matches"]
    short = {i: t for i, t in texts.items() if re.search("(?i)licen[sc]|rights", t or "")}
    assert {i: f for i, f in found.items() if f} == {i: b for i in short if (b := brute(texts[i]))}


def test_notices_by_brute_force():
    assert [brute(text) for text, _ in NOTICES] == [want for _, want in NOTICES]


def test_every_sentence_and_rule_can_be_found(spark):
    """Also two copies side by side, which share no word."""
    sentences = [s for s in licenses.NUMBERS]
    got = scan(spark, *[f"{s}. {s}" for s in sentences])
    assert got == {i: brute(f"{s}. {s}") for i, s in enumerate(sentences)}
    by_number = {i: s for s, i in licenses.NUMBERS.items()}
    got = scan(spark, *["; ".join(by_number[i] for i in ids) for _, ids in licenses.RULES])
    assert all(got[k].get(licence) for k, (licence, _) in enumerate(licenses.RULES))
    assert all(any(a in word for word in s.split() for a in licenses.ANCHORS) for s in sentences)


@pytest.mark.parametrize("before", ["x ", "", "1. "])
def test_long_texts(spark, before):
    text = "word " * 200_000 + before + "Licensed under the ISC License. " + "more " * 200_000
    assert scan(spark, text) == {0: {"ISC": 1}}


def test_odd_rows_are_scanned(odd_docs, no_docs):
    assert licenses.scan(odd_docs).count() == licenses.scan(no_docs).count() == 0
    noted = odd_docs.withColumn("text", F.lit("All rights reserved.")).withColumn("left", F.lit("x"))
    assert licenses.scan(noted).count() == odd_docs.count()
