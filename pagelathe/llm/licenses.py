"""Licence scan by sentence rules.

A text is normalised to words and marks where a sentence ends (or, at line ends
and the like, may end), known licence sentences between marks become
identifiers, and the resulting sequence of them is matched against ordered
licence rules.  A rule is a sequence of identifiers that must
follow one another directly (unknown sentences in between break it); the rules
are tried in order and what one has matched is gone for the next.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Normalised sentences of well-known licence texts and notices
# (lower case, every other run of characters than letters, digits and dots
# inside numbers one space), with their identifiers.
SENTENCES = {
    "licensed under the apache license version 2.0": "ApacheRef",
    "this work is licensed under the apache license version 2.0": "ApacheRef",
    "licensed under the apache license version 2.0 the license": "ApacheHead",
    "you may not use this file except in compliance with the license": "ApacheUse",
    "you may obtain a copy of the license at http www.apache.org licenses license 2.0": "ApacheCopy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "ApacheAsIs",
    "see the license for the specific language governing permissions and limitations under the license": "ApacheSee",
    "released under the mit license": "MITRef",
    "licensed under the mit license": "MITRef",
    "this work is licensed under the mit license": "MITRef",
    "mit license": "MITTitle",
    "the mit license": "MITTitle",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MITGrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MITNotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MITAsIs",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "MITLiability",
    "this work is licensed under the gnu general public license version 3": "GPL3Ref",
    "licensed under the gnu general public license version 3": "GPL3Ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "GPL2PlusGrant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "GPL3PlusGrant",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "GPLAsIs",
    "see the gnu general public license for more details": "GPLSee",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BSDGrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BSDSource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BSDBinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSDNames",
    "this source code form is subject to the terms of the mozilla public license v. 2.0": "MPLHead",
    "licensed under cc by nc 4.0": "CCBYNCRef",
    "this work is licensed under cc by nc 4.0": "CCBYNCRef",
    "licensed under cc by 4.0": "CCBYRef",
    "licensed under cc by sa 4.0": "CCBYSARef",
    "this work is licensed under a creative commons attribution 4.0 international license": "CCBYRef",
    "all rights reserved": "Reserved",
}
# Licence rules in the order in which they are tried.
RULES = [
    ("Apache-2.0", ["ApacheHead", "ApacheUse", "ApacheCopy", "ApacheAsIs", "ApacheSee"]),
    ("Apache-2.0", ["ApacheHead"]),
    ("Apache-2.0", ["ApacheRef"]),
    ("MIT", ["MITTitle", "MITGrant", "MITNotice", "MITAsIs", "MITLiability"]),
    ("MIT", ["MITGrant", "MITNotice", "MITAsIs", "MITLiability"]),
    ("MIT", ["MITRef"]),
    ("GPL-3.0-or-later", ["GPL3PlusGrant", "GPLAsIs", "GPLSee"]),
    ("GPL-2.0-or-later", ["GPL2PlusGrant", "GPLAsIs", "GPLSee"]),
    ("GPL-3.0-or-later", ["GPL3PlusGrant"]),
    ("GPL-2.0-or-later", ["GPL2PlusGrant"]),
    ("GPL-3.0-only", ["GPL3Ref"]),
    ("BSD-3-Clause", ["BSDGrant", "BSDSource", "BSDBinary", "BSDNames"]),
    ("BSD-2-Clause", ["BSDGrant", "BSDSource", "BSDBinary"]),
    ("MPL-2.0", ["MPLHead"]),
    ("CC-BY-NC-4.0", ["CCBYNCRef"]),
    ("CC-BY-SA-4.0", ["CCBYSARef"]),
    ("CC-BY-4.0", ["CCBYRef"]),
    ("LicenseRef-AllRightsReserved", ["Reserved"]),
]
UNKNOWN = "?"
#: Marks of a normalised text: a sentence ends; one may end (line ends, ';', ':').
HARD, SOFT = "!", ";"
#: Lines without the signs that comments, quotations and lists put before or after them.
LINES = [
    (r"\r\n?", "\n"),
    (r"(?m)^[ \t]*(?:(?:/\*+|\*+[/)]?|//+!?|#+!?|;+|--+|%+|<!--+|\.?\\\"|\(\*+|\{-+|[>|!•]|(?:REM|rem|dnl)\b)[ \t]*)+", ""),
    (r"(?m)[ \t]*(?:\*+[/)]|--+>|-+\}|[*#|]+)?[ \t]*$", ""),
    (r"(\A|[.:;]\s+|\n\n+)[ \t]*\(?(?:[0-9]{1,2}|[A-Za-z])[.)][ \t]+", "$1;"),
]
#: Sentence ends, ends of addresses and lines.  A line goes on after a comma and before lower case.
MARKS = [
    (r"(?i)\bhttps://", "http://"),
    (r"\b([vV])\.\s+(?=[0-9])", "$1 "),
    (r"[.!?]+(?=[\s)\"'”’]|\z)|[!?]+", HARD),
    (r"(http://\S+)(?=\s)", "$1;"),
    (r":(?=\s|\z)|\n[ \t]*\n\s*", SOFT),
    (r",[ \t]*\n|\n[ \t]*(?=[a-z(])", " "),
    (r"\n", SOFT),
]
#: Lower case text as words with one blank or mark between them.
WORDS = [(r"[^a-z0-9.!;]+|(?<![a-z0-9])\.+|\.+(?![a-z0-9])", " "), (r" *;[; ]*", SOFT), (r"[; ]*![!; ]*", HARD), (r"  +", " ")]


def normal_text(text: Column) -> Column:
    """The words of a text, all between marks; an empty text is one mark."""
    for pattern, by in LINES + MARKS:
        text = F.regexp_replace(text, pattern, by)
    text = F.concat(F.lit(HARD), F.lower(text), F.lit(HARD))
    for pattern, by in WORDS:
        text = F.regexp_replace(text, pattern, by)
    return text


def normal_sentence(sentence: str) -> str:
    """The words of a known sentence, as in normal_text."""
    for pattern, by in MARKS[:2] + [(r"[!?;:]", " ")]:
        sentence = re.sub(pattern, by.replace("$", "\\"), sentence)
    return re.sub(r"[^a-z0-9.]+|(?<![a-z0-9])\.+|\.+(?![a-z0-9])", " ", sentence.lower()).strip().replace("  ", " ")


def sentence_ids(text: Column, known: dict[str, str]) -> Column:
    """",A,,?,,B,": identifiers in text order, a run of unknown sentences as one '?'.

    A known sentence stands between marks and may have soft ones inside.
    """
    # Longer sentences first: a soft mark inside one may end a shorter one.
    kept = sorted(((normal_sentence(s), i) for s, i in known.items()), key=lambda x: (-len(x[0]), x[0]))
    steps = F.array(*[
        F.struct(F.lit(s).alias("words"), F.lit("([!;])" + "[ ;]".join(map(re.escape, s.split())) + "(?=[!;])").alias("pattern"), F.lit(f"$1={n}=").alias("by"))
        for n, (s, _) in enumerate(kept)
    ])
    names = F.create_map(*[F.lit(x) for n, (_, i) in enumerate(kept) for x in (f"={n}=", i)])
    words = normal_text(text)
    start = F.transform(F.array(words), lambda w: F.struct(w.alias("text"), F.replace(w, F.lit(SOFT), F.lit(" ")).alias("flat")))[0]
    marked = F.aggregate(
        steps,
        start,
        lambda state, x: F.struct(
            F.when(F.contains(state["flat"], x["words"]), F.regexp_replace(state["text"], x["pattern"], x["by"])).otherwise(state["text"]).alias("text"),
            state["flat"].alias("flat"),
        ),
    )["text"]
    ids = F.transform(F.filter(F.split(marked, "[!;]"), lambda s: s != ""), lambda s: F.coalesce(F.try_element_at(names, s), F.lit(UNKNOWN)))
    listed = F.regexp_replace(F.concat(F.lit(","), F.array_join(ids, ",,"), F.lit(",")), r"(,\?,)+", f",{UNKNOWN},")
    # A text with none of the longest words of known sentences has none of them.
    longest = sorted({max(s.split(), key=len) for s, _ in kept})
    return F.when(F.lower(text).rlike("|".join(map(re.escape, longest))), listed).otherwise(F.lit(f",{UNKNOWN},"))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sentences: dict[str, str] | None = None, rules: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """One row per input row: doc_id, licenses, sentences, unmatched.

    ``licenses`` are the distinct licences found, sorted; ``sentences`` the
    known sentence identifiers in text order; ``unmatched`` those that no rule
    took.  Lists are strings joined by commas, empty for texts without any (as
    for null and empty texts).  Repeated rows give repeated results.
    """
    known, rules = sentences or SENTENCES, rules or RULES
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    steps = F.array(*[F.struct(F.lit("".join(f",{i}," for i in ids)).alias("token"), F.lit(name).alias("name")) for name, ids in rules])
    start = F.struct(F.col("ids").alias("left"), F.array().cast("array<string>").alias("found"))

    def apply(state: Column, rule: Column) -> Column:
        hit = F.contains(state["left"], rule["token"])
        return F.struct(
            F.when(hit, F.replace(state["left"], rule["token"], F.lit(f",{UNKNOWN},"))).otherwise(state["left"]).alias("left"),
            F.when(hit, F.array_append(state["found"], rule["name"])).otherwise(state["found"]).alias("found"),
        )

    listed = rows.select("doc_id", sentence_ids(F.col("text"), known).alias("ids"))
    state = F.when(F.col("ids") == f",{UNKNOWN},", start).otherwise(F.aggregate(steps, start, apply))
    # Named identifiers as a plain list: what is left of ",A,,?,,B," without '?'.
    plain = lambda c: F.array_join(F.filter(F.split(c, ","), lambda x: (x != "") & (x != UNKNOWN)), ",")
    return listed.withColumn("state", state).select(
        "doc_id",
        F.array_join(F.array_sort(F.array_distinct("state.found")), ",").alias("licenses"),
        plain("ids").alias("sentences"),
        plain("state.left").alias("unmatched"),
    )
