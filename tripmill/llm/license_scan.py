"""Licences in texts, by their sentences.

A text is cut into pieces at line ends and marks. As sentences are wrapped, and marks stand
in versions and abbreviations too, a known sentence may be one piece or any number of
pieces that follow each other, the longest where several begin; an opening such as "this
software is" is passed over. Each known sentence is replaced by its number, and a rule is a
sequence of numbers; it matches where its sentences follow each other without another piece
between them. Of matches that lie within a longer one, or
that are equally long at the same place, the longer and then the earlier rule stays.
Rows are scanned on their own: nothing is shuffled, and the tables of sentences and rules
are constants.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A piece ends at a line's end, or at a mark that white space or the end follows.
ENDS = r"[.!?;:]+[ \t\r\f]+|\n+"
NOT_IN_WORDS = r"[^a-z0-9]+"

# Sentences of well-known licences and notices, normalised (lower case, words
# and numbers with one space between).
SENTENCES = {
    "mit-reference": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-title": "mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
    " documentation files the software to deal in the software without restriction including without limitation the rights"
    " to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to"
    " whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial"
    " portions of the software",
    "as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the"
    " warranties of merchantability fitness for a particular purpose and noninfringement",
    "no-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability"
    " whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use"
    " or other dealings in the software",
    "apache-2-reference": "licensed under the apache license version 2 0",
    "apache-2-the-license": "licensed under the apache license version 2 0 the license",
    "apache-2-compliance": "you may not use this file except in compliance with the license",
    "apache-2-copy": "you may obtain a copy of the license at",
    "gpl-3-reference": "this work is licensed under the gnu general public license version 3",
    "gpl-2-reference": "this work is licensed under the gnu general public license version 2",
    "gpl-free-software": "this program is free software",
    "gpl-2-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by"
    " the free software foundation either version 2 of the license or at your option any later version",
    "gpl-3-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by"
    " the free software foundation either version 3 of the license or at your option any later version",
    "lgpl-free-software": "this library is free software",
    "lgpl-2.1-terms": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as"
    " published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl-3-terms": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as"
    " published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl-3-terms": "you can redistribute it and or modify it under the terms of the gnu affero general public license as"
    " published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-2-title": "gnu general public license v2 0",
    "gpl-3-title": "gnu general public license v3 0",
    "lgpl-2.1-title": "gnu lesser general public license v2 1",
    "lgpl-3-title": "gnu lesser general public license v3 0",
    "agpl-3-title": "gnu affero general public license v3 0",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that"
    " the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the"
    " following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the"
    " following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
    " products derived from this software without specific prior written permission",
    "bsd-reference": "released under the bsd license",
    "bsd-2-reference": "licensed under the bsd 2 clause license",
    "bsd-3-reference": "licensed under the bsd 3 clause license",
    "bsd-2-release": "released under the bsd 2 clause license",
    "bsd-3-release": "released under the bsd 3 clause license",
    "bsd-2-title": "bsd 2 clause license",
    "bsd-3-title": "bsd 3 clause license",
    "epl-2-terms": "this program and the accompanying materials are made available under the terms of the eclipse public license"
    " 2 0 which is available at https www eclipse org legal epl 2 0",
    "epl-2-title": "eclipse public license v 2 0",
    "mpl-2-reference": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
    " granted provided that the above copyright notice and this permission notice appear in all copies",
    "unlicense-dedication": "this is free and unencumbered software released into the public domain",
    "cc-by-4-reference": "licensed under cc by 4 0",
    "cc-by-sa-4-reference": "licensed under cc by sa 4 0",
    "cc-by-nc-4-reference": "licensed under cc by nc 4 0",
    "cc-by-nd-4-reference": "licensed under cc by nd 4 0",
    "cc-by-nc-sa-4-reference": "licensed under cc by nc sa 4 0",
    "cc0-reference": "released under cc0 1 0",
    "all-rights": "all rights reserved",
}

# Licence, and the sentences that make it known, in order. Earlier rules win.
RULES = (
    ("MIT", ("mit-title", "mit-grant", "mit-notice", "as-is", "no-liability")),
    ("MIT", ("mit-grant", "mit-notice", "as-is", "no-liability")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-grant",)),
    ("MIT", ("mit-reference",)),
    ("MIT", ("mit-licensed",)),
    ("MIT", ("mit-title",)),
    ("Apache-2.0", ("apache-2-the-license", "apache-2-compliance", "apache-2-copy")),
    ("Apache-2.0", ("apache-2-the-license", "apache-2-compliance")),
    ("Apache-2.0", ("apache-2-the-license",)),
    ("Apache-2.0", ("apache-2-reference",)),
    ("GPL-3.0-or-later", ("gpl-free-software", "gpl-3-terms")),
    ("GPL-2.0-or-later", ("gpl-free-software", "gpl-2-terms")),
    ("GPL-3.0-or-later", ("gpl-3-terms",)),
    ("GPL-2.0-or-later", ("gpl-2-terms",)),
    ("GPL-3.0-only", ("gpl-3-reference",)),
    ("GPL-2.0-only", ("gpl-2-reference",)),
    ("LGPL-2.1-or-later", ("lgpl-free-software", "lgpl-2.1-terms")),
    ("LGPL-2.1-or-later", ("lgpl-2.1-terms",)),
    ("LGPL-3.0-or-later", ("lgpl-free-software", "lgpl-3-terms")),
    ("LGPL-3.0-or-later", ("lgpl-3-terms",)),
    ("AGPL-3.0-or-later", ("gpl-free-software", "agpl-3-terms")),
    ("AGPL-3.0-or-later", ("agpl-3-terms",)),
    ("GPL-2.0", ("gpl-2-title",)),
    ("GPL-3.0", ("gpl-3-title",)),
    ("LGPL-2.1", ("lgpl-2.1-title",)),
    ("LGPL-3.0", ("lgpl-3-title",)),
    ("AGPL-3.0", ("agpl-3-title",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD", ("bsd-grant",)),
    ("BSD", ("bsd-reference",)),
    ("BSD-2-Clause", ("bsd-2-reference",)),
    ("BSD-3-Clause", ("bsd-3-reference",)),
    ("BSD-2-Clause", ("bsd-2-release",)),
    ("BSD-3-Clause", ("bsd-3-release",)),
    ("BSD-2-Clause", ("bsd-2-title",)),
    ("BSD-3-Clause", ("bsd-3-title",)),
    ("EPL-2.0", ("epl-2-terms",)),
    ("EPL-2.0", ("epl-2-title",)),
    ("MPL-2.0", ("mpl-2-reference",)),
    ("ISC", ("isc-grant", "as-is")),
    ("ISC", ("isc-grant",)),
    ("Unlicense", ("unlicense-dedication",)),
    ("CC-BY-4.0", ("cc-by-4-reference",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4-reference",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-reference",)),
    ("CC-BY-ND-4.0", ("cc-by-nd-4-reference",)),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa-4-reference",)),
    ("CC0-1.0", ("cc0-reference",)),
    ("proprietary", ("all-rights",)),
)
NUMBER = {name: i + 1 for i, name in enumerate(SENTENCES)}


# Openings of sentences that name the work.
WORKS = "software|work|project|program|code|source code|library|package|module|file|application|tool|repository|document|data|dataset"
OPENING = rf"^(?:this|the) (?:{WORKS}) (?:is|are) (?=(?:released|licensed) )"
OPENED = rf"^(?:this|the)(?: (?:source|(?:{WORKS})(?: (?:is|are))?))?$"
KNOWN = {s: NUMBER[name] for name, s in SENTENCES.items()}
KNOWN |= {re.sub(OPENING, "", s): n for s, n in KNOWN.items()}
# conditions of a list may be numbered
CONDITIONS = ("bsd-source", "bsd-binary", "bsd-names")
KNOWN |= {f"{place} {SENTENCES[name]}": NUMBER[name] for place, name in enumerate(CONDITIONS, 1)}
#: Words that a known sentence, with or without an opening, can begin with.
BEGINS = "^(?:" + "|".join(sorted({s.split()[0] for s in KNOWN} | {"this", "the"})) + ")(?: |$)"
LONGEST = max(len(s.split()) for s in KNOWN) + 5


def normalised(sentence: Column) -> Column:
    """Lower case (A-Z) with one space between words and numbers."""
    return F.trim(F.regexp_replace(F.translate(sentence, UPPER, LOWER), NOT_IN_WORDS, " "))


def pieces(text: Column) -> Column:
    """Normalised pieces of a text in order; those without a word are left out."""
    return F.filter(F.transform(F.split(text, ENDS), normalised), lambda s: s != "")


def _begun(words: Column) -> Column:
    """Whether words are the first of a known sentence, or of an opening."""
    every = F.lit("|" + " |".join(KNOWN) + " ")
    after = F.regexp_replace(words, OPENING, "")
    return words.rlike(BEGINS) & (words.rlike(OPENED) | (F.instr(every, F.concat(F.lit("|"), after, F.lit(" "))) > 0))


def sentences(words: str) -> Column:
    """Number, first piece and count of pieces of each sentence of an array of pieces, in
    order; a piece that is part of none has number 0."""
    table = F.create_map(*[F.lit(x) for pair in KNOWN.items() for x in pair])
    none = F.struct(F.lit(0).alias("number"), F.lit(0).alias("pieces"), F.lit("").alias("so_far"), F.lit(True).alias("on"))

    def longer(a: Column, w: Column, i: Column) -> Column:
        joined = F.when(i == 0, w).otherwise(F.concat(a["so_far"], F.lit(" "), w))
        number = F.element_at(table, F.regexp_replace(joined, OPENING, ""))
        known = F.coalesce(number, F.lit(0))
        return F.struct(
            F.when(known > 0, known).otherwise(a["number"]).alias("number"),
            F.when(known > 0, i + 1).otherwise(a["pieces"]).alias("pieces"),
            joined.alias("so_far"),
            _begun(joined).alias("on"),
        )

    def longest(i: Column) -> Column:
        following = F.transform(F.slice(words, i + 1, LONGEST), lambda w, k: F.struct(w.alias("w"), k.alias("k")))
        return F.aggregate(
            following,
            none,
            lambda a, x: F.when(a["on"], longer(a, x["w"], x["k"])).otherwise(a),
            lambda a: F.struct(a["number"].alias("number"), a["pieces"].alias("pieces")),
        )

    return F.transform(
        words,
        lambda w, i: F.when(_begun(w), longest(i)).otherwise(F.struct(F.lit(0).alias("number"), F.lit(0).alias("pieces"))),
    )


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, first_sentence, n_sentences, licence) of every match, in pieces of the
    text counted from 0.

    Null and empty texts and texts without a known sentence give no row. Rows of the table
    are scanned one by one, so repeated rows repeat their matches and null keys stay null.
    """
    cut = docs.select(F.col(key).alias("_key"), pieces(F.col(text)).alias("_pieces")).where(F.exists("_pieces", _begun))
    # what a generator gives isn't worked out again for every piece
    found_at = cut.select("_key", F.explode(F.array(sentences("_pieces"))).alias("_at"))
    known = found_at.where(F.exists("_at", lambda a: a["number"] > 0))

    def matches(rank: int, licence: str, names: tuple[str, ...]) -> Column:
        # end of the rule's sentences from each place on, as far as they follow each other
        def end(i: Column, name: str) -> Column:
            at = F.get("_at", i)
            return F.when(at["number"] == NUMBER[name], i + at["pieces"])

        def then(ends: Column, name: str) -> Column:
            return F.transform(ends, lambda m: F.struct(m["start"].alias("start"), end(m["end"], name).alias("end")))

        first = F.filter(
            F.transform("_at", lambda a, i: F.when(a["number"] == NUMBER[names[0]], i)), lambda i: i.isNotNull()
        )
        ends = F.transform(first, lambda i: F.struct(i.alias("start"), end(i, names[0]).alias("end")))
        for name in names[1:]:
            ends = then(ends, name)
        return F.transform(
            F.filter(ends, lambda m: m["end"].isNotNull()),
            lambda m: F.struct(
                m["start"].alias("start"), (m["start"] - m["end"]).alias("size"), F.lit(rank).alias("rank"), F.lit(licence).alias("licence")
            ),
        )

    found = F.array_sort(F.concat(*[matches(r, licence, names) for r, (licence, names) in enumerate(RULES)]))
    # in this order a match is within an earlier one exactly if one of those ends no earlier
    kept = F.aggregate(
        found,
        F.struct(F.lit(-1).alias("end"), F.filter(found, lambda m: F.lit(False)).alias("list")),
        lambda acc, m: F.when(m["start"] - m["size"] <= acc["end"], acc).otherwise(
            F.struct((m["start"] - m["size"]).alias("end"), F.concat(acc["list"], F.array(m)).alias("list"))
        ),
        lambda acc: acc["list"],
    )
    return known.select("_key", F.explode(kept).alias("m")).select(
        F.col("_key").alias(key),
        F.col("m.start").alias("first_sentence"),
        (-F.col("m.size")).alias("n_sentences"),
        F.col("m.licence").alias("licence"),
    )
