"""Licence scan by sentence rules: normalised sentences are looked up among known licence sentences, and the sequence of their identifiers is matched
against ordered rules. DataFrame functions only, without a shuffle: everything happens in the row of the text.

A text is cut into sentences after . ; : ! ? and white space, and before a line that begins with a capital. A sentence is normalised to lower-case letters,
digits, plus signs and inner full stops, single spaces between. What is looked up is one piece of a text or several that follow each other, the longest that is
known first, so a notice that is wrapped before a capital, or cut at a semicolon or after "v.", is found as well. The SQL twin looks up single pieces only; the two
agree on tables without such notices. Rules are tried in order; each one found takes its identifiers out of the sequence, so a general
rule does not see what a special one has explained. Identifiers that no rule takes are counted as unmatched.

Null and empty texts have no sentences and no licences. Every row gets a row, repeated and null doc_ids too; an empty table gives none. Other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linegauge.llm.common import documents

# Licence sentences, normalised, and their identifiers.
SENTENCES = {
    "released under the mit license": "MITref",
    "licensed under the mit license": "MITref",
    "this project is licensed under the mit license": "MITref",
    "this software is released under the mit license": "MITref",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MITgrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MITnotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MITwarranty",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISCgrant",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BSDgrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BSDsource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BSDbinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSDendorse",
    "licensed under the bsd 2 clause license": "BSD2ref",
    "licensed under the bsd 3 clause license": "BSD3ref",
    "licensed under the apache license version 2.0": "Apache2ref",
    "licensed under the apache license version 2.0 the license": "Apache2ref",
    "you may not use this file except in compliance with the license": "ApacheComply",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "ApacheBasis",
    "this work is licensed under the gnu general public license version 3": "GPL3ref",
    "this work is licensed under the gnu general public license version 2": "GPL2ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "GPL3later",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "GPL3later",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "GPL2later",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "LGPL3later",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "AGPL3later",
    "licensed under the gnu lesser general public license version 3": "LGPL3ref",
    "licensed under the gnu affero general public license version 3": "AGPL3ref",
    "this source code form is subject to the terms of the mozilla public license v. 2.0": "MPL2ref",
    "licensed under cc by nc 4.0": "CCBYNC4ref",
    "licensed under cc by 4.0": "CCBY4ref",
    "licensed under cc by sa 4.0": "CCBYSA4ref",
    "this work is licensed under a creative commons attribution 4.0 international license": "CCBY4ref",
    "this work is licensed under a creative commons attribution noncommercial 4.0 international license": "CCBYNC4ref",
    "this work is dedicated to the public domain under the cc0 license": "CC0ref",
}
# Rules in order, a licence and the identifiers that follow each other.
RULES = [
    ("MIT", ["MITgrant", "MITnotice", "MITwarranty"]),
    ("MIT", ["MITgrant", "MITnotice"]),
    ("BSD-3-Clause", ["BSDgrant", "BSDsource", "BSDbinary", "BSDendorse"]),
    ("BSD-2-Clause", ["BSDgrant", "BSDsource", "BSDbinary"]),
    ("ISC", ["ISCgrant"]),
    ("Apache-2.0", ["Apache2ref", "ApacheComply", "ApacheBasis"]),
    ("Apache-2.0", ["Apache2ref"]),
    ("AGPL-3.0-or-later", ["AGPL3later"]),
    ("LGPL-3.0-or-later", ["LGPL3later"]),
    ("GPL-3.0-or-later", ["GPL3later"]),
    ("GPL-2.0-or-later", ["GPL2later"]),
    ("AGPL-3.0-only", ["AGPL3ref"]),
    ("LGPL-3.0-only", ["LGPL3ref"]),
    ("GPL-3.0-only", ["GPL3ref"]),
    ("GPL-2.0-only", ["GPL2ref"]),
    ("MPL-2.0", ["MPL2ref"]),
    ("CC-BY-NC-4.0", ["CCBYNC4ref"]),
    ("CC-BY-SA-4.0", ["CCBYSA4ref"]),
    ("CC-BY-4.0", ["CCBY4ref"]),
    ("CC0-1.0", ["CC0ref"]),
    ("BSD-2-Clause", ["BSD2ref"]),
    ("BSD-3-Clause", ["BSD3ref"]),
    ("MIT", ["MITref"]),
]
#: Each known sentence holds one of these, so a text without them has none.
ANCHORS = ("licens", "permi", "redistribut", "warrant")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CUT = "\x01"


def sentences(text: Column) -> Column:
    """Normalised sentences in order."""
    cut = F.regexp_replace(text, r"([.;:!?])[ \t\r\n]+", f"$1{CUT}")
    cut = F.regexp_replace(cut, r"\n([^A-Za-z\n]*[A-Z])", f"{CUT}$1")
    plain = F.regexp_replace(F.translate(cut, UPPER, LOWER), f"[^a-z0-9+.{CUT}]+", " ")
    return F.transform(F.split(plain, CUT), lambda s: F.regexp_replace(s, "^[ .]+|[ .]+$", ""))


def _key(sentence: str) -> str:
    """A sentence without full stops at the ends of its words, as pieces leave it when they are joined."""
    return sentence.replace(". ", " ")


def known_ids(pieces: Column) -> Column:
    """Identifiers of the known sentences in order: from the left, the longest run of pieces that makes one; its pieces are used up."""
    known = F.array(*(F.struct(F.lit(_key(s)).alias("key"), F.lit(i).alias("id")) for s, i in SENTENCES.items()))
    longest = max(len(_key(s).split(" ")) for s in SENTENCES)

    def runs(piece: Column, at: Column) -> Column:
        """(at, next, id) of the longest run that begins here, or none."""
        some = F.filter(known, lambda k: F.startswith(k.key, piece))
        here = F.slice(pieces, at + 1, longest)
        sizes = F.sequence(F.lit(1), F.size(here))

        def first(k: Column) -> Column:
            fits = F.filter(sizes, lambda n: F.array_join(F.slice(here, 1, n), " ") == k.key)
            return F.struct(F.element_at(fits, 1).alias("n"), k.id.alias("id"))

        whole = F.filter(some, lambda k: F.startswith(F.concat(F.array_join(here, " "), F.lit(" ")), F.concat(k.key, F.lit(" "))))
        found = F.filter(F.transform(whole, first), lambda r: r.n.isNotNull())
        best = F.array_max(found)
        return F.when(F.size(found) > 0, F.struct(at.alias("at"), (at + best.n).alias("next"), best.id.alias("id")))

    every = F.filter(F.transform(pieces, runs), lambda r: r.isNotNull())
    begin = F.struct(F.lit(0).alias("next"), F.array().cast("array<string>").alias("ids"))

    def step(state: Column, run: Column) -> Column:
        taken = F.struct(run["next"].alias("next"), F.array_append(state.ids, run.id).alias("ids"))
        return F.when(run.at >= state["next"], taken).otherwise(state)

    return F.aggregate(every, begin, step, lambda state: state.ids)


def scanned(docs: DataFrame) -> DataFrame:
    """``doc_id, sentence_ids, licenses`` (arrays in order) and ``n_unmatched``."""
    text = F.coalesce("text", F.lit(""))
    lower = F.translate(text, UPPER, LOWER)
    possible = F.lit(False)
    for anchor in ANCHORS:
        possible = possible | F.contains(lower, F.lit(anchor))
    none = F.array().cast("array<string>")
    # Empty pieces and full stops at the ends of words are left out, as in the keys.
    pieces = F.filter(F.transform(sentences(text), lambda s: F.replace(s, F.lit(". "), F.lit(" "))), lambda s: s != "")
    rows = docs.select("doc_id", F.when(possible, pieces).otherwise(none).alias("pieces"))
    rows = rows.select("doc_id", F.when(F.size("pieces") > 0, known_ids(F.col("pieces"))).otherwise(none).alias("sentence_ids"))

    # Identifiers are written as <id>, so a rule is a plain piece of text.
    sequence = F.array_join(F.transform("sentence_ids", lambda i: F.concat(F.lit("<"), i, F.lit(">"))), "")
    rules = F.array(*(F.struct(F.lit(name).alias("name"), F.lit(_piece(ids)).alias("piece")) for name, ids in RULES))
    begin = F.struct(sequence.alias("rest"), F.array().cast("array<string>").alias("found"))

    def step(state: Column, rule: Column) -> Column:
        hit = F.contains(state.rest, rule.piece)
        return F.struct(
            F.when(hit, F.replace(state.rest, rule.piece, F.lit("|"))).otherwise(state.rest).alias("rest"),
            F.when(hit, F.array_append(state.found, rule["name"])).otherwise(state.found).alias("found"),
        )

    rows = rows.withColumn("walked", F.when(F.size("sentence_ids") > 0, F.aggregate(rules, begin, step)).otherwise(begin))
    unmatched = F.char_length(F.regexp_replace("walked.rest", "[^<]", "")).cast("long")
    return rows.select("doc_id", "sentence_ids", F.array_distinct("walked.found").alias("licenses"), unmatched.alias("n_unmatched"))


def _piece(ids: list[str]) -> str:
    return "".join(f"<{i}>" for i in ids)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scanned(documents(spark, sf_dir))
    joined = [F.array_join(c, ",").alias(c) for c in ("sentence_ids", "licenses")]
    return rows.select("doc_id", *joined, F.size("sentence_ids").cast("long").alias("n_known"), "n_unmatched")


def _twin() -> str:
    """Unnested sentences joined with the known ones, then one step for each rule."""
    known = ", ".join(f"('{s}', '{i}')" for s, i in SENTENCES.items())
    steps, before = [], "sequences"
    for k, (name, ids) in enumerate(RULES):
        piece = _piece(ids)
        steps.append(
            f"step{k} AS (SELECT doc_id, row_id, ids, n, replace(rest, '{piece}', '|') AS rest, "
            f"CASE WHEN contains(rest, '{piece}') AND NOT list_contains(found, '{name}') THEN list_append(found, '{name}') ELSE found END AS found "
            f"FROM {before})"
        )
        before = f"step{k}"
    return rf"""
WITH known(sentence, id) AS (VALUES {known}),
docs AS (SELECT doc_id, row_number() OVER () AS row_id, coalesce(text, '') AS text FROM documents),
cut AS (
  SELECT row_id, string_split(regexp_replace(translate(
    regexp_replace(regexp_replace(text, '([.;:!?])[ \t\r\n]+', '\1' || chr(1), 'g'), '\n([^A-Za-z\n]*[A-Z])', chr(1) || '\1', 'g'),
    '{UPPER}', '{LOWER}'), '[^a-z0-9+.\x01]+', ' ', 'g'), chr(1)) AS parts FROM docs
),
parts AS (SELECT row_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS place FROM cut),
found AS (
  SELECT row_id, list(id ORDER BY place) AS ids
  FROM parts JOIN known ON sentence = regexp_replace(part, '^[ .]+|[ .]+$', '', 'g') GROUP BY row_id
),
sequences AS (
  SELECT doc_id, row_id, array_to_string(ids, ',') AS ids, coalesce(len(ids), 0) AS n,
    CASE WHEN ids IS NULL THEN '' ELSE '<' || array_to_string(ids, '><') || '>' END AS rest, CAST([] AS VARCHAR[]) AS found
  FROM docs LEFT JOIN found USING (row_id)
),
{", ".join(steps)}
SELECT doc_id, coalesce(ids, '') AS sentence_ids, array_to_string(found, ',') AS licenses, CAST(n AS BIGINT) AS n_known,
  CAST(length(regexp_replace(rest, '[^<]', '', 'g')) AS BIGINT) AS n_unmatched
FROM {before}
"""


OP3_SQL = _twin()
