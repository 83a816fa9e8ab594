"""Licence rules: notices of one and many sentences, order, and what is no licence."""

from lexiloom.llm import licenses as L

MIT = """The MIT License

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
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD = """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions are met:
# 1. Redistributions of source code must retain the above copyright notice,
#    this list of conditions and the following disclaimer.
# 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
#    the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
THIRD = """# 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse
#    or promote products derived from this software without specific prior written permission.
"""


def found(spark, *texts):
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, licenses string")
    return {r.doc_id: r.licenses for r in L.scan(frame).collect()}


def test_notices(spark):
    got = found(
        spark, MIT, BSD, BSD + THIRD, "x y\nReleased under the MIT License.\nz", "// Licensed under CC BY-NC 4.0.", "Licensed under the Apache\nLicense, Version 2.0.",
        "This work is licensed under the GNU General Public License, version 3. Released under the MIT License.",
        None, "", "We license nothing, and all of it is permitted.", "Released under the MIT License. " * 3, THIRD + BSD,
    )
    assert got == {
        0: ["MIT"], 1: ["BSD-2-Clause"], 2: ["BSD-3-Clause"], 3: ["MIT"], 4: ["CC-BY-NC-4.0"], 5: ["Apache-2.0"], 6: ["MIT", "GPL-3.0-only"],
        7: [], 8: [], 9: [], 10: ["MIT"], 11: ["BSD-2-Clause"],
    }


def test_a_rule_takes_its_sentences(spark):
    known = {"a": "permit one", "b": "permit two", "c": "permit three"}
    rules = (("AB", ("a", "b")), ("B", ("b",)), ("BC", ("b", "c")), ("C", ("c",)))
    texts = ["Permit one. Permit two. Permit three.", "Permit two. Permit two. Permit three.", "Permit three. Permit one."]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in L.scan(frame, known, rules).collect()}
    assert got == {0: ["AB", "C"], 1: ["B", "C"], 2: ["C"]}


GNU = """/* This program is free software{0} you can redistribute it and/or modify
 * it under the terms of the GNU {1}General Public License as published by
 * the Free Software Foundation{2} either version {3} of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful, */"""
MPL = """# This Source Code Form is subject to the terms of the Mozilla Public
# License, v. 2.0. If a copy of the MPL was not distributed with this
# file, You can obtain one at https://mozilla.org/MPL/2.0/. """
ZLIB = """  This software is provided 'as-is', without any express or implied
  warranty.  In no event will the authors be held liable for any damages
  arising from the use of this software.

  Permission is granted to anyone to use this software for any purpose,
  including commercial applications, and to alter it and redistribute it
  freely, subject to the following restrictions:

  1. The origin of this software must not be misrepresented"""


def test_notices_as_they_are_written(spark):
    got = found(
        spark, GNU.format(":", "", ",", "3"), GNU.format(";", "", ";", "2"), GNU.format(";", "Lesser ", ";", "2.1"), GNU.format(":", "Lesser ", ",", "3"),
        GNU.format(":", "Affero ", ",", "3"), MPL, ZLIB, "This is free and unencumbered software released into the public domain.\n\nAnyone is free",
        "// Distributed under the Boost Software License, Version 1.0.\n// (See accompanying file)", "Licensed under the Artistic License 2.0.",
        "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\n"
        "copyright notice and this permission notice appear in all copies.\n",
    )
    assert got == {
        0: ["GPL-3.0-or-later"], 1: ["GPL-2.0-or-later"], 2: ["LGPL-2.1-or-later"], 3: ["LGPL-3.0-or-later"], 4: ["AGPL-3.0-or-later"],
        5: ["MPL-2.0"], 6: ["Zlib"], 7: ["Unlicense"], 8: ["BSL-1.0"], 9: ["Artistic-2.0"], 10: ["ISC"],
    }


def test_any_sentences_are_found(spark):
    """What is not worth a look follows from the sentences that are known."""
    known = {"a": "you may use it freely", "b": "no strings", "c": "42"}
    texts = ["Hello.  You MAY use it, freely!  No strings.", "n\u00ba 42.\nNo\nstrings", "you may not", "\u212aa. NO STRINGS"]
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, sentence_ids string")
    got = {r.doc_id: (r.sentence_ids, r.licenses) for r in L.scan(frame, known, (("free", ("a", "b")),)).collect()}
    assert got == {0: (["a", "b"], ["free"]), 1: (["b"], []), 2: ([], []), 3: (["b"], [])}
    assert [r.sentence_ids for r in L.scan(frame, {}, ()).collect()] == [[]] * 4


def test_edges(spark):
    long = "no such sentence here. " * 50_000 + "Released under the MIT License."
    frame = spark.createDataFrame([(1, long), (None, "Released under the MIT License."), (1, long)], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.licenses) for r in L.scan(frame).collect()) == [("1", ["MIT"]), ("1", ["MIT"]), ("None", ["MIT"])]
    assert L.scan(frame.limit(0)).count() == 0


def test_constants():
    assert {x for _, own in L.RULES for x in own} <= L.SENTENCES.keys()
    assert len(set(L.SENTENCES.values())) == len(L.SENTENCES)


def test_main_path_is_native(spark):
    frame = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = L.scan(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
