"""Licence statements in texts: known sentences in, identifiers out, ordered rules on top.

Only DataFrame functions, all inside the row: a text is cut into sentences, every normalised
sentence is looked up among the known licence sentences, and the sequence of identifiers is matched with
the rules in their order, longer ones first. A rule takes the identifiers it matches, so that a full notice is not
reported again by a shorter rule. Nothing is shuffled.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Known sentences, normalised: lower case, letters and digits, single spaces.
SENTENCES = {
    "apache-2-short": "licensed under the apache license version 2 0",
    "apache-2-short-released": "released under the apache license version 2 0",
    "apache-2-the-license": "licensed under the apache license version 2 0 the license",
    "apache-2-comply": "you may not use this file except in compliance with the license",
    "apache-2-obtain": "you may obtain a copy of the license at",
    "apache-2-url": "http www apache org licenses license 2 0",
    "apache-2-as-is": (
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on "
        "an as is basis without warranties or conditions of any kind either express or implied"
    ),
    "apache-2-see": "see the license for the specific language governing permissions and limitations under the license",
    "mit-short": "released under the mit license",
    "mit-short-licensed": "licensed under the mit license",
    "mit-title": "the mit license",
    "mit-title-plain": "mit license",
    "mit-grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the rights "
        "to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to "
        "whom the software is furnished to do so subject to the following conditions"
    ),
    "mit-notice": (
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"
    ),
    "mit-as-is": (
        "the software is provided as is without warranty of any kind express or implied including but not limited to the "
        "warranties of merchantability fitness for a particular purpose and noninfringement"
    ),
    "mit-liability": (
        "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an "
        "action of contract tort or otherwise arising from out of or in connection with the software or the use or other "
        "dealings in the software"
    ),
    "bsd-redistribution": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"
    ),
    "bsd-source": (
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"
    ),
    "bsd-binary": (
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
        "disclaimer in the documentation and or other materials provided with the distribution"
    ),
    "bsd-endorse": (
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission"
    ),
    "gpl-2-short": "this work is licensed under the gnu general public license version 2",
    "gpl-3-short": "this work is licensed under the gnu general public license version 3",
    "gpl-3-short-licensed": "licensed under the gnu general public license version 3",
    "gpl-free-2": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation either version 2 of the license or at your option any later version"
    ),
    "gpl-free-3": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation either version 3 of the license or at your option any later version"
    ),
    "gpl-hope": (
        "this program is distributed in the hope that it will be useful but without any warranty without even the implied "
        "warranty of merchantability or fitness for a particular purpose"
    ),
    "gpl-details": "see the gnu general public license for more details",
    "gpl-received": "you should have received a copy of the gnu general public license along with this program",
    "cc-by-4-short": "licensed under cc by 4 0",
    "cc-by-sa-4-short": "licensed under cc by sa 4 0",
    "cc-by-nc-4-short": "licensed under cc by nc 4 0",
    "cc-by-nc-nd-4-short": "licensed under cc by nc nd 4 0",
    "cc0-short": "released under cc0 1 0",
    "isc-short": "released under the isc license",
    "mpl-2": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl-2-terms": "this source code form is subject to the terms of the mozilla public license v",
    "mpl-2-copy": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "mpl-2-copy-https": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "gnu-free": "this program is free software",
    "gnu-free-library": "this library is free software",
    "gpl-terms": (
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"
    ),
    "gpl-3-terms": (
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free "
        "software foundation either version 3 of the license or at your option any later version"
    ),
    "lgpl-terms": (
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"
    ),
    "lgpl-3-terms": (
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free "
        "software foundation either version 3 of the license or at your option any later version"
    ),
    "agpl-3-terms": (
        "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free "
        "software foundation either version 3 of the license or at your option any later version"
    ),
    "version-2-later": "either version 2 of the license or at your option any later version",
    "version-2-1-later": "either version 2 1 of the license or at your option any later version",
    "version-3-later": "either version 3 of the license or at your option any later version",
    "epl-1-terms": (
        "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which "
        "accompanies this distribution and is available at http www eclipse org legal epl v10 html"
    ),
    "epl-2-terms": (
        "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which "
        "is available at https www eclipse org legal epl 2 0"
    ),
    "unlicense-domain": "this is free and unencumbered software released into the public domain",
    "unlicense-anyone": (
        "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a "
        "compiled binary for any purpose commercial or non commercial and by any means"
    ),
    "bsl-1-short": "distributed under the boost software license version 1 0",
    "bsl-1-title": "boost software license version 1 0 august 17th 2003",
    "bsl-1-grant": (
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license the software to use reproduce display distribute execute and "
        "transmit the software and to prepare derivative works of the software and to permit third parties to whom the "
        "software is furnished to do so all subject to the following"
    ),
    "zlib-as-is": "this software is provided as is without any express or implied warranty",
    "zlib-liability": "in no event will the authors be held liable for any damages arising from the use of this software",
    "zlib-grant": (
        "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it "
        "and redistribute it freely subject to the following restrictions"
    ),
    "artistic-2-terms": "you can redistribute it and or modify it under the terms of the artistic license 2 0",
    "artistic-2-short": "licensed under the artistic license 2 0",
    "isc-grant": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies"
    ),
    "all-rights": "all rights reserved",
}

#: Licence and the identifiers that say so, in order; earlier rules go first.
RULES = (
    ("Apache-2.0", ("apache-2-the-license", "apache-2-comply", "apache-2-obtain", "apache-2-url", "apache-2-as-is", "apache-2-see")),
    ("Apache-2.0", ("apache-2-the-license", "apache-2-comply", "apache-2-obtain", "apache-2-as-is", "apache-2-see")),
    ("MIT", ("mit-title", "mit-grant", "mit-notice", "mit-as-is", "mit-liability")),
    ("MIT", ("mit-title-plain", "mit-grant", "mit-notice", "mit-as-is", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is", "mit-liability")),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary")),
    ("GPL-3.0-or-later", ("gpl-free-3", "gpl-hope", "gpl-details", "gpl-received")),
    ("GPL-2.0-or-later", ("gpl-free-2", "gpl-hope", "gpl-details", "gpl-received")),
    ("GPL-3.0-or-later", ("gpl-free-3",)),
    ("GPL-2.0-or-later", ("gpl-free-2",)),
    ("Apache-2.0", ("apache-2-short",)),
    ("Apache-2.0", ("apache-2-short-released",)),
    ("MIT", ("mit-short",)),
    ("MIT", ("mit-short-licensed",)),
    ("GPL-2.0-only", ("gpl-2-short",)),
    ("GPL-3.0-only", ("gpl-3-short",)),
    ("GPL-3.0-only", ("gpl-3-short-licensed",)),
    ("CC-BY-4.0", ("cc-by-4-short",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4-short",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-short",)),
    ("CC-BY-NC-ND-4.0", ("cc-by-nc-nd-4-short",)),
    ("CC0-1.0", ("cc0-short",)),
    ("ISC", ("isc-short",)),
    ("MPL-2.0", ("mpl-2",)),
    ("MPL-2.0", ("mpl-2-terms", "mpl-2-copy")),
    ("MPL-2.0", ("mpl-2-terms", "mpl-2-copy-https")),
    ("MPL-2.0", ("mpl-2-terms",)),
    ("GPL-3.0-or-later", ("gpl-3-terms",)),
    ("GPL-3.0-or-later", ("gpl-terms", "version-3-later")),
    ("GPL-2.0-or-later", ("gpl-terms", "version-2-later")),
    ("LGPL-3.0-or-later", ("lgpl-3-terms",)),
    ("LGPL-3.0-or-later", ("lgpl-terms", "version-3-later")),
    ("LGPL-2.1-or-later", ("lgpl-terms", "version-2-1-later")),
    ("AGPL-3.0-or-later", ("agpl-3-terms",)),
    ("EPL-1.0", ("epl-1-terms",)),
    ("EPL-2.0", ("epl-2-terms",)),
    ("Unlicense", ("unlicense-domain", "unlicense-anyone")),
    ("Unlicense", ("unlicense-domain",)),
    ("BSL-1.0", ("bsl-1-title", "bsl-1-grant")),
    ("BSL-1.0", ("bsl-1-grant",)),
    ("BSL-1.0", ("bsl-1-short",)),
    ("Zlib", ("zlib-as-is", "zlib-liability", "zlib-grant")),
    ("Zlib", ("zlib-grant",)),
    ("Artistic-2.0", ("artistic-2-terms",)),
    ("Artistic-2.0", ("artistic-2-short",)),
    ("ISC", ("isc-grant",)),
)

#: The end of a sentence, or a blank line.
ENDS, BLANK, CUT = r"([.!?;:])[ \t\r\n]+", r"\n[ \t\r]*\n", "\x01"


def hint_of(known: dict[str, str]) -> str:
    """A pattern for lower-case text: each known sentence has one of its few words, so what has none need not be normalised."""
    left, words = [set(sentence.split()) for sentence in known.values() if sentence], []
    while left:
        counts = Counter(word for sentence in left for word in sentence)
        words.append(min(counts, key=lambda w: (-counts[w] * (len(w) > 4), -len(w), w)))
        left = [sentence for sentence in left if words[-1] not in sentence]
    return "|".join(words) or "(?!)"


def normal(sentence: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(sentence), r"[^a-z0-9]+", " "))


def sentences(text: Column, hint: str) -> Column:
    """Sentences of a text that have the ``hint``, and where one goes over several lines, each of these lines after it."""
    cut = F.regexp_replace(F.translate(text, CUT, " "), ENDS, "$1" + CUT)
    pieces = F.split(F.regexp_replace(cut, BLANK, CUT), CUT)

    def lines(piece: Column) -> Column:
        whole = F.array(piece)
        return F.when(F.contains(piece, F.lit("\n")), F.concat(whole, F.split(piece, "\n"))).otherwise(whole)

    return F.flatten(F.transform(F.filter(pieces, lambda x: F.lower(x).rlike(hint)), lines))


def identify(text: Column, known: dict[str, str]) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    entries = [x for name, sentence in known.items() for x in (F.lit(sentence), F.lit(name))]
    table = F.create_map(*entries) if entries else F.create_map().cast("map<string, string>")
    return F.filter(F.transform(sentences(text, hint_of(known)), lambda x: F.try_element_at(table, normal(x))), lambda x: x.isNotNull())


def match(ids: Column, rules: tuple[tuple[str, tuple[str, ...]], ...]) -> Column:
    """Licences whose rules match the identifiers, in the order of the rules."""
    if not rules:
        return F.array().cast("array<string>")
    steps = F.array(*(F.struct(F.lit(name).alias("name"), F.lit("," + ",".join(own) + ",").alias("own")) for name, own in rules))
    joined = F.concat(F.lit(","), F.array_join(ids, ","), F.lit(","))
    start = F.struct(joined.alias("left"), F.array().cast("array<string>").alias("found"))

    def step(state: Column, rule: Column) -> Column:
        left = state["left"]
        # What a rule takes leaves a bar, so that no rule matches across it.
        after = F.replace(F.replace(left, rule["own"], F.lit(",|,")), rule["own"], F.lit(",|,"))
        hit = F.contains(left, rule["own"])
        return F.struct(after.alias("left"), F.when(hit, F.array_append(state["found"], rule["name"])).otherwise(state["found"]).alias("found"))

    return F.array_distinct(F.aggregate(steps, start, step, lambda state: state["found"]))


def scan(docs: DataFrame, known: dict[str, str] = SENTENCES, rules=RULES) -> DataFrame:
    """``doc_id, sentence_ids, licenses`` of every document: identifiers in text order, licences in rule order.

    Null and empty texts have none of either. Every row gives one row, also repeated ones and those without a
    ``doc_id``; an empty table gives an empty one; other columns do not matter. Texts are scanned whole.
    """
    none = F.array().cast("array<string>")
    ids = F.when(F.lower("text").rlike(hint_of(known)), identify(F.col("text"), known)).otherwise(none)
    # A generator keeps Spark from evaluating the identifiers once per use.
    rows = docs.select("doc_id", F.inline(F.array(F.struct(ids.alias("sentence_ids")))))
    return rows.select("doc_id", "sentence_ids", match(F.col("sentence_ids"), rules).alias("licenses"))
