"""License recognition by sentence rules, with DataFrame functions only.

A text is cut into sentences, each is normalised (lower case, other signs than letters, digits and dots become one
space), and sentences equal to a known license sentence become its identifier. Ordered rules then look for runs of
identifiers; a rule that matches uses its identifiers up, so a full grant is not also reported as its parts.
Texts are cut twice, with line ends as sentence ends and as spaces, for notices on one line and wrapped ones.

No join and no shuffle: sentences are looked up in a literal map of fixed size inside each row. Texts without any of the
stems of GATE, one of which stands inside a word of every known sentence (a test checks that), have no identifier and
skip the cutting. The SQL has a narrower gate, KEYWORDS, of phrases as well.

Defined results: null, empty or unmatched text has licenses '' and n_known 0; repeated rows repeat; licenses are
distinct, in rule order, comma-joined; sentence_ids holds the first cut's identifiers in order. Other columns stay out
of the report.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Known license sentences, normalised as below, and their identifiers.
SENTENCES = {
    "licensed under the apache license version 2.0": "apache2",
    "licensed under the apache license version 2.0 the license": "apache2grant",
    "you may not use this file except in compliance with the license": "apache2use",
    "you may obtain a copy of the license at http www.apache.org licenses license 2.0": "apache2copy",
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "this project is licensed under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mitgrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mitnotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mitwarranty",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "iscgrant",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsdgrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsdsource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsdbinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsdname",
    "this work is licensed under the gnu general public license version 3": "gpl3",
    "this work is licensed under the gnu general public license version 2": "gpl2",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2later",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2.1 of the license or at your option any later version": "lgpl21later",
    "this source code form is subject to the terms of the mozilla public license v. 2.0": "mpl2",
    "licensed under cc by 4.0": "ccby4",
    "licensed under cc by sa 4.0": "ccbysa4",
    "licensed under cc by nc 4.0": "ccbync4",
    "this work is licensed under a creative commons attribution 4.0 international license": "ccby4",
    "this work is licensed under a creative commons attribution noncommercial 4.0 international license": "ccbync4",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "this work is in the public domain": "publicdomain",
    "all rights reserved": "reserved",
}
# Ordered rules, a run of identifiers (each followed by a space) and the license it means.
RULES = [
    ("apache2grant (apache2use )?(apache2copy )?", "Apache-2.0"),
    ("apache2use apache2copy ", "Apache-2.0"),
    ("apache2 ", "Apache-2.0"),
    ("mitgrant mitnotice (mitwarranty )?", "MIT"),
    ("mit ", "MIT"),
    ("iscgrant ", "ISC"),
    ("bsdgrant bsdsource bsdbinary bsdname ", "BSD-3-Clause"),
    ("bsdgrant bsdsource bsdbinary ", "BSD-2-Clause"),
    ("gpl3later ", "GPL-3.0-or-later"),
    ("gpl2later ", "GPL-2.0-or-later"),
    ("gpl3 ", "GPL-3.0-only"),
    ("gpl2 ", "GPL-2.0-only"),
    ("lgpl21later ", "LGPL-2.1-or-later"),
    ("mpl2 ", "MPL-2.0"),
    ("ccbync4 ", "CC-BY-NC-4.0"),
    ("ccbysa4 ", "CC-BY-SA-4.0"),
    ("ccby4 ", "CC-BY-4.0"),
    ("unlicense ", "Unlicense"),
    ("publicdomain ", "public-domain"),
    ("reserved ", "all-rights-reserved"),
]
KEYWORDS = r"(?i)licen|permission|redistribut|copyright|provided as is|public domain|rights reserved|free software"
#: Parts of single words only, so that line ends, quotes and spaces between words can't hide a known sentence.
GATE = r"(?i)licen|permission|redistribut|copyright|warranty|public|reserved|free"
ENDS = r"[.!?;:]+[\x20\t]+|[.!?;:]*[\x20\t]*[\n\r]+|[.!?;:]+\z"
SIGNS = r"[^a-z0-9.]+"


def identifiers(text, lines: bool):
    """The known sentences' identifiers in order, each followed by a space."""
    shown = text if lines else F.regexp_replace(text, r"[\n\r]+", " ")
    table = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])
    clean = F.transform(F.split(F.lower(shown), ENDS), lambda s: F.trim(F.regexp_replace(s, SIGNS, " ")))
    known = F.filter(F.transform(F.filter(clean, lambda s: F.length(s) >= min(map(len, SENTENCES))), lambda s: table[s]), lambda s: s.isNotNull())
    return F.when(F.size(known) > 0, F.concat(F.array_join(known, " "), F.lit(" "))).otherwise(F.lit(""))


def licenses_of(ids):
    """The array of licenses that the ordered rules find; null at rules that don't match."""
    rest, found = ids, []
    for pattern, name in RULES:
        found.append(F.when(rest.rlike(f"(^| ){pattern}"), F.lit(name)))
        rest = F.regexp_replace(rest, f"(^| ){pattern}", "$1")
    return F.array(*found)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, sentence_ids, n_known, licenses for every row."""
    value = F.col(text).cast("string")
    hit = value.rlike(GATE)
    base = docs.select(F.col(doc_id).alias("doc_id"), *[F.when(hit, identifiers(value, k)).otherwise(F.lit("")).alias(n) for k, n in ((True, "_a"), (False, "_b"))])
    none = F.expr("cast(array() as array<string>)")
    both = base.select("doc_id", "_a", *[F.when(F.col(c) != "", licenses_of(F.col(c))).otherwise(none).alias(c + "l") for c in ("_a", "_b")])
    order = F.array(*[F.lit(n) for n in dict.fromkeys(n for _, n in RULES)])
    union = F.concat("_al", "_bl")
    return both.select("doc_id", F.trim("_a").alias("sentence_ids"), F.when(F.col("_a") == "", 0).otherwise(F.size(F.split("_a", " ")) - 1).cast("long").alias("n_known"), F.array_join(F.filter(order, lambda n: F.array_contains(union, n)), ",").alias("licenses"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def scan_sql(table: str = "documents") -> str:
    """The same report in DuckDB's SQL."""
    keys, values = (", ".join(map(_quoted, x)) for x in (SENTENCES.keys(), SENTENCES.values()))

    def ids(text: str) -> str:
        cut = f"string_split_regex(lower({text}), {_quoted(ENDS)})"
        clean = f"list_transform({cut}, lambda s: trim(regexp_replace(s, {_quoted(SIGNS)}, ' ', 'g')))"
        known = f"list_filter(list_transform({clean}, lambda s: map([{keys}], [{values}])[s]), lambda s: s IS NOT NULL)"
        return f"array_to_string(list_transform({known}, lambda s: s || ' '), '')"

    steps, names = [], ("a", "b")
    steps.append(f"c0 AS (SELECT doc_id, CASE WHEN regexp_matches(text, {_quoted(KEYWORDS)}) THEN {ids('text')} ELSE '' END AS a, CASE WHEN regexp_matches(text, {_quoted(KEYWORDS)}) THEN {ids('regexp_replace(text, ' + _quoted('[' + chr(92) + 'n' + chr(92) + 'r]+') + ', ' + _quoted(' ') + ', ' + _quoted('g') + ')')} ELSE '' END AS b, '|' AS la, '|' AS lb FROM {table})")
    for k, (pattern, name) in enumerate(RULES):
        p = _quoted(f"(^| ){pattern}")
        columns = ", ".join(f"regexp_replace({n}, {p}, '\\1', 'g') AS {n}, l{n} || CASE WHEN regexp_matches({n}, {p}) THEN {_quoted(name + '|')} ELSE '' END AS l{n}" for n in names)
        extra = "a AS first_ids" if k == 0 else "first_ids"
        steps.append(f"c{k + 1} AS (SELECT doc_id, {extra}, {columns} FROM c{k})")
    order = ", ".join(_quoted(n) for n in dict.fromkeys(n for _, n in RULES))
    return f"WITH {', '.join(steps)} SELECT doc_id, trim(first_ids) AS sentence_ids, CAST(len(first_ids) - len(replace(first_ids, ' ', '')) AS BIGINT) AS n_known, array_to_string(list_filter([{order}], lambda n: contains(la, '|' || n || '|') OR contains(lb, '|' || n || '|')), ',') AS licenses FROM c{len(RULES)}"
