r"""Licence recognition by sentences.

Texts are put into normal form (lower case, letters and digits, single spaces) with marks where a sentence or
a line ends. A known licence sentence begins behind a mark, possibly after a list label, and ends at one; marks
between its words do not matter, so a hard-wrapped sentence, or one with a semicolon or a comment leader in it, is
found like one on a single line. Known sentences get their identifiers, and the sequence of a document's identifiers
is matched against rules, each an ordered sequence of identifiers. A rule that lies inside a longer matched
rule's sequence is implied by it and not reported apart.

All of it is column functions on one row: one regular expression finds the sentences below in all their wordings,
and nothing is shuffled. ``n_sentences`` counts the pieces between marks. The SQL states the sentences of SENTENCES
on one line each; where texts wrap them, or word them as in WORDINGS, the query finds more than the SQL.

Defined cases: a null text has no sentences; empty and blank texts have none either; the same sentence twice
gives its identifier twice; several licences are all reported, in the order of the rules.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bikeflow.llm.tables import table

# Licence sentences in normal form, with the licence they speak of.
SENTENCES = {
    "mit-name": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
    "associated documentation files the software to deal in the software without restriction including without "
    "limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software "
    "and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the software",
    "as-is": "the software is provided as is without warranty of any kind express or implied including but not "
    "limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "apache-name": "licensed under the apache license version 2 0",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "gpl3-name": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
    "general public license as published by the free software foundation either version 3 of the license or at your "
    "option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even "
    "the implied warranty of merchantability or fitness for a particular purpose",
    "bsd-forms": "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and "
    "the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions "
    "and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse "
    "or promote products derived from this software without specific prior written permission",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by": "licensed under cc by 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "cc0": "this work has been dedicated to the public domain under cc0 1 0",
    "reserved": "all rights reserved",
}

# Licence rules as ordered sentence identifiers.
RULES = [
    ("MIT", ("mit-grant", "mit-notice", "as-is")),
    ("MIT", ("mit-name",)),
    ("MIT", ("mit-licensed",)),
    ("Apache-2.0", ("apache-name", "apache-use", "apache-copy")),
    ("Apache-2.0", ("apache-name",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope")),
    ("GPL-3.0-only", ("gpl3-name",)),
    ("BSD-3-Clause", ("bsd-forms", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-forms", "bsd-source", "bsd-binary")),
    ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("CC-BY-SA-4.0", ("cc-by-sa",)),
    ("CC-BY-4.0", ("cc-by",)),
    ("CC0-1.0", ("cc0",)),
    ("proprietary", ("reserved",)),
]

# Further wordings of licence sentences. ``~`` stands for one to twelve words, ``@`` for as many on one
# line, (a|b) for one of several.
_THIS = "((this|the) (work|project|program|software|package|library|module|file|code|source code|repository|content|document) is )?"
_UNDER = _THIS + "(dual )?(released|licensed|distributed|available|made available|provided|published) under (the )?(terms of (the )?)?"
_TAIL = "( see (the )?(accompanying )?(file )?(license|licence|copying)( (txt|md))?( file)?( for (more )?(details|information))?)?"
_CC = "(creative commons |cc )"
_GNU = "gnu (general public license|gpl)|gpl"
_SPDX = "spdx license identifier "
_PROGRAM = "(this program|@) "
_FREE = (
    _PROGRAM + "is free software you can redistribute it and or modify it under the terms of the {} as published by "
    "the free software foundation either version {} of the license or at your option any later version"
)
_FREE_ONLY = (
    _PROGRAM + "is free software you can redistribute it and or modify it under the terms of the {} as published by "
    "the free software foundation version {}( of the license)?( only)?"
)
WORDINGS = {
    "mit-name": [_UNDER + "(mit|expat)( license| licence)?" + _TAIL, _SPDX + "mit"],
    "mit-notice": [
        "the above copyright notice and this permission notice (including the next paragraph )?shall be included in all "
        "copies or substantial portions of the software",
    ],
    "apache-name": [
        _UNDER + "apache (license|licence|software license)( version)? 2( 0)?( the license)?" + _TAIL,
        _SPDX + "apache 2 0",
    ],
    "apache-use": [
        "you may not use (this|these) (file|files|work|software|project|library) except in compliance with the license",
    ],
    "apache-copy": ["you may obtain a copy of the license at (https?|) ?(www )?apache org licenses license 2 0( txt| html)?"],
    "gpl3-name": [
        _UNDER + f"({_GNU})( license)?( version| v)? ?(3|v3)( 0)?( only)?" + _TAIL,
        _SPDX + "gpl 3 0( only)?",
        _FREE_ONLY.format("gnu general public license", "3"),
    ],
    "gpl3-later": [
        _UNDER + f"({_GNU})( license)?( version| v)? ?(3|v3)( 0)? or (any )?later( version)?" + _TAIL,
        _SPDX + "gpl 3 0 or later",
        _FREE.format("gnu general public license", "3"),
    ],
    "gpl2-name": [
        _UNDER + f"({_GNU})( license)?( version| v)? ?(2|v2)( 0)?( only)?" + _TAIL,
        _SPDX + "gpl 2 0( only)?",
        _FREE_ONLY.format("gnu general public license", "2"),
    ],
    "gpl2-later": [
        _UNDER + f"({_GNU})( license)?( version| v)? ?(2|v2)( 0)? or (any )?later( version)?" + _TAIL,
        _SPDX + "gpl 2 0 or later",
        _FREE.format("gnu general public license", "2"),
    ],
    "gpl-hope": [
        _PROGRAM + "is distributed in the hope that it will be useful but without any warranty without even the "
        "implied warranty of merchantability or fitness for a particular purpose",
    ],
    "lgpl2-name": [
        _UNDER + "(gnu (lesser|library) general public license|gnu lgpl|lgpl)( version| v)? ?(2 1|v2 1)( only)?" + _TAIL,
        _SPDX + "lgpl 2 1( only)?",
    ],
    "lgpl2-later": [_SPDX + "lgpl 2 1 or later", _FREE.format("gnu lesser general public license", "2 1")],
    "lgpl3-name": [
        _UNDER + "(gnu lesser general public license|gnu lgpl|lgpl)( version| v)? ?(3|v3)( 0)?( only)?" + _TAIL,
        _SPDX + "lgpl 3 0( only)?",
    ],
    "lgpl3-later": [_SPDX + "lgpl 3 0 or later", _FREE.format("gnu lesser general public license", "3")],
    "agpl3-name": [
        _UNDER + "(gnu affero general public license|gnu agpl|agpl)( version| v)? ?(3|v3)( 0)?( only)?" + _TAIL,
        _SPDX + "agpl 3 0( only)?",
    ],
    "agpl3-later": [_SPDX + "agpl 3 0 or later", _FREE.format("gnu affero general public license", "3")],
    "mpl2": [
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        _UNDER + "(mozilla public license|mpl)( version| v)? ?2( 0)?" + _TAIL,
        _SPDX + "mpl 2 0",
    ],
    "isc": [
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
        _UNDER + "isc( license)?" + _TAIL,
        _SPDX + "isc",
    ],
    "unlicense": [
        "this is free and unencumbered software released into the public domain",
        _UNDER + "unlicense" + _TAIL,
        _SPDX + "unlicense",
    ],
    "boost": [_UNDER + "boost software license( version)? 1 0" + _TAIL, _SPDX + "bsl 1 0"],
    "epl2": [_UNDER + "eclipse public license( version| v)? ?2 0" + _TAIL, _SPDX + "epl 2 0"],
    "bsd3-name": [_UNDER + "(bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)( license)?" + _TAIL, _SPDX + "bsd 3 clause"],
    "bsd2-name": [_UNDER + "(bsd 2 clause|2 clause bsd|simplified bsd)( license)?" + _TAIL, _SPDX + "bsd 2 clause"],
    "bsd-source": [
        "redistributions of source code must retain the (above )?copyright notice this list of conditions and the following disclaimer",
    ],
    "bsd-endorse": [
        "(neither )?the names? of ~ (nor the names of (its|their|any) contributors )?may (not )?be used to endorse or promote "
        "products derived from this software without specific prior written permission",
    ],
    "cc-by": [_UNDER + _CC + "(by|attribution)( international)? 4 0( international)?( license)?" + _TAIL, _SPDX + "cc by 4 0"],
    "cc-by-sa": [
        _UNDER + _CC + "(by sa|attribution share ?alike) 4 0( international)?( license)?" + _TAIL,
        _SPDX + "cc by sa 4 0",
    ],
    "cc-by-nc": [
        _UNDER + _CC + "(by nc|attribution non ?commercial) 4 0( international)?( license)?" + _TAIL,
        _SPDX + "cc by nc 4 0",
    ],
    "cc-by-nd": [
        _UNDER + _CC + "(by nd|attribution no ?deriv(ative)?s) 4 0( international)?( license)?" + _TAIL,
        _SPDX + "cc by nd 4 0",
    ],
    "cc-by-nc-sa": [
        _UNDER + _CC + "(by nc sa|attribution non ?commercial share ?alike) 4 0( international)?( license)?" + _TAIL,
        _SPDX + "cc by nc sa 4 0",
    ],
    "cc-by-nc-nd": [
        _UNDER + _CC + "(by nc nd|attribution non ?commercial no ?deriv(ative)?s) 4 0( international)?( license)?" + _TAIL,
        _SPDX + "cc by nc nd 4 0",
    ],
    "cc0": [_UNDER + "(creative commons zero|(creative commons )?cc0)( v)? ?1 0( universal)?" + _TAIL, _SPDX + "cc0 1 0"],
    "mit-or-apache": [
        _UNDER + "(either( of)? )?(the )?(apache license( version)? 2 0|apache 2 0)( license)? (or|and) (the )?mit( license)?"
        "( at your option)?" + _TAIL,
        _UNDER + "(either( of)? )?(the )?mit( license)? (or|and) (the )?(apache license( version)? 2 0|apache 2 0)( license)?"
        "( at your option)?" + _TAIL,
        _SPDX + "(mit or apache 2 0|apache 2 0 or mit)",
    ],
    "reserved": ["copyright @ all rights reserved"],
}

# The rules of the sentences that only WORDINGS has.
MORE_RULES = [
    ("MIT", ("mit-or-apache",)),
    ("Apache-2.0", ("mit-or-apache",)),
    ("GPL-3.0-or-later", ("gpl3-later",)),
    ("GPL-2.0-or-later", ("gpl2-later",)),
    ("GPL-2.0-only", ("gpl2-name",)),
    ("LGPL-2.1-or-later", ("lgpl2-later",)),
    ("LGPL-2.1-only", ("lgpl2-name",)),
    ("LGPL-3.0-or-later", ("lgpl3-later",)),
    ("LGPL-3.0-only", ("lgpl3-name",)),
    ("AGPL-3.0-or-later", ("agpl3-later",)),
    ("AGPL-3.0-only", ("agpl3-name",)),
    ("MPL-2.0", ("mpl2",)),
    ("ISC", ("isc",)),
    ("Unlicense", ("unlicense",)),
    ("BSL-1.0", ("boost",)),
    ("EPL-2.0", ("epl2",)),
    ("BSD-3-Clause", ("bsd3-name",)),
    ("BSD-2-Clause", ("bsd2-name",)),
    ("CC-BY-ND-4.0", ("cc-by-nd",)),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa",)),
    ("CC-BY-NC-ND-4.0", ("cc-by-nc-nd",)),
]

# Every wording has one of these, so a text without them has no licence sentence.
_ONE_OF = ["under", "licen", "software", "redistribut", "reserved", "public"]

_END = "\u0001"
# A list label before a sentence: 1, a, iv.
_LABEL = "(?:(?:[0-9]{1,2}|[a-z]|[ivx]{1,4}) )?"


def _marked(text):
    """Normal form with a mark at the end of each sentence and line."""
    marked = F.regexp_replace(F.lower(F.replace(text, F.lit(_END), F.lit(" "))), r"[.!?;]+[ \t\r\n]+|\n", _END)
    return F.regexp_replace(marked, rf"[^\p{{L}}\p{{N}}{_END}]+", " ")


def _pieces(marked):
    return F.filter(F.transform(F.split(marked, _END), lambda s: F.trim(s)), lambda s: s != "")


def sentences(text):
    """Array of a text's sentences in normal form."""
    return _pieces(_marked(text))


def _wordings() -> list[tuple[str, str]]:
    """(identifier, all its wordings); those that go on with "or later" come before those that end earlier."""
    names = dict.fromkeys([*(n for n in WORDINGS if n.endswith("-later")), *SENTENCES, *WORDINGS])
    return [(n, "|".join([*([SENTENCES[n]] if n in SENTENCES else []), *WORDINGS.get(n, [])])) for n in names]


def _regex(wording: str) -> str:
    """Between two words stands a space or a mark."""
    gap, word = f"[ {_END}]", f"[^ {_END}]+"
    made = wording.replace("(", "(?:").replace(" ", gap)
    return made.replace("~", f"(?:{word}{gap}){{0,11}}?{word}").replace("@", f"(?:{word} ){{0,11}}?{word}")


def _any_of() -> str:
    """All wordings; a beginning that several share is tried once."""
    heads = {head: [] for head in (_UNDER, _SPDX, _PROGRAM, "")}
    names = dict.fromkeys([*(n for n in WORDINGS if n.endswith("-later")), *SENTENCES, *WORDINGS])
    for n in names:
        for w in [*([SENTENCES[n]] if n in SENTENCES else []), *WORDINGS.get(n, [])]:
            head = next(h for h in heads if w.startswith(h))
            heads[head].append(_regex(w[len(head) :]))
    return "|".join(f"{_regex(head)}(?:{'|'.join(rest)})" for head, rest in heads.items())


def _found(marked):
    """Array of the identifiers of the licence sentences in a marked text, in order."""
    joined = F.regexp_replace(marked, f" ?{_END}[ {_END}]*", _END)  # a mark and its spaces are one character
    padded = F.concat(F.lit(_END), F.trim(joined), F.lit(_END))
    hits = F.regexp_extract_all(padded, F.lit(f"{_END}{_LABEL}({_any_of()})(?={_END})"), F.lit(1))

    def name(hit):
        return F.coalesce(*[F.when(F.regexp_like(hit, F.lit(f"^(?:{_regex(w)})$")), F.lit(n)) for n, w in _wordings()])

    some = reduce(or_, [F.contains(marked, F.lit(w)) for w in _ONE_OF])
    return F.when(some, F.transform(hits, name)).otherwise(F.array().cast("array<string>"))


def _matched(name_sequence):
    """The identifiers occur one behind the other in the document's sequence."""
    return F.contains(F.col("sequence"), F.lit("," + ",".join(name_sequence) + ","))


def scan_licenses(docs: DataFrame, *, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` with n_sentences, the identifiers of licence sentences in order, and the licences."""
    rows = docs.select(*keys, _marked(F.coalesce(F.col(text), F.lit(""))).alias("marked"))
    n_sentences = F.size(_pieces(F.col("marked"))).cast("long").alias("n_sentences")
    rows = rows.select(*keys, n_sentences, F.array_join(_found(F.col("marked")), ",").alias("sentence_ids"))
    rows = rows.withColumn("sequence", F.concat(F.lit(","), "sentence_ids", F.lit(",")))
    whole = F.length("sequence") > 2
    hits = []
    rules = [*RULES, *MORE_RULES]
    for name, rule in rules:
        longer = [r for _, r in rules if len(r) > len(rule) and f",{','.join(rule)}," in f",{','.join(r)},"]
        hit = _matched(rule)
        for r in longer:
            hit = hit & ~_matched(r)
        hits.append(F.when(whole & hit, F.lit(name)))
    licences = F.array_distinct(F.array_compact(F.array(*hits)))
    return rows.select(*keys, "n_sentences", "sentence_ids", F.array_join(licences, ",").alias("licenses"))


def op6_license_scans(spark: SparkSession, sf: str) -> DataFrame:
    return scan_licenses(table(spark, sf, "documents"), keys=["doc_id"])


def _sql() -> str:
    known = ", ".join(f"('{s}', '{name}')" for name, s in SENTENCES.items())
    rules = ", ".join(f"({k}, '{name}', ',{','.join(rule)},')" for k, (name, rule) in enumerate(RULES))
    return rf"""
WITH known(s, id) AS (VALUES {known}), rules(k, name, rule) AS (VALUES {rules}),
c AS (SELECT doc_id, list_filter([trim(s) FOR s IN string_split(regexp_replace(regexp_replace(lower(replace(coalesce(text, ''), chr(1), ' ')),
      '[.!?;]+[ \t\r\n]+|\n', chr(1), 'g'), '[^\p{{L}}\p{{N}}\x01]+', ' ', 'g'), chr(1))], lambda s: s <> '') AS cut FROM documents),
u AS (SELECT doc_id, unnest(cut) AS s, unnest(range(len(cut))) AS i FROM c),
q AS (SELECT doc_id, string_agg(id, ',' ORDER BY i) AS ids FROM u JOIN known USING (s) GROUP BY doc_id),
m AS (SELECT doc_id, k, name, rule FROM q, rules WHERE contains(',' || ids || ',', rule)),
l AS (SELECT doc_id, name, min(k) AS k FROM m WHERE NOT EXISTS
      (SELECT 1 FROM m AS o WHERE o.doc_id = m.doc_id AND o.rule <> m.rule AND contains(o.rule, m.rule)) GROUP BY doc_id, name)
SELECT c.doc_id, CAST(len(cut) AS BIGINT) AS n_sentences, coalesce(ids, '') AS sentence_ids, coalesce(names, '') AS licenses
FROM c LEFT JOIN q USING (doc_id)
LEFT JOIN (SELECT doc_id, string_agg(name, ',' ORDER BY k) AS names FROM l GROUP BY doc_id) USING (doc_id)
"""


OP6_SQL = _sql()
