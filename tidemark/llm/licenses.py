"""Operator 6: licence recognition by sentences and ordered rules over their identifiers.

A text is cut into sentences: after ``. ! ? ; :`` and white space, before a line that begins in upper case,
and at blank lines, but not within ``v. 2``. Normalised sentences (letters and digits in lower case, single spaces)
that are known become identifiers, longer ones first; a known sentence may go on over lines that begin in upper case. Rules then match identifier sequences, in order: what an earlier rule matched is
taken out before the next one looks.

Everything happens within a row, so nothing is shuffled. Texts without any anchor word, which every known
sentence has, skip the cutting. NULL and empty texts have no sentences; repeated rows are judged alike; an
empty table gives no rows.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import table

# Known sentences, normalised, and their identifiers.
SENTENCES = {
    "released under the mit license": "mit-ref",
    "licensed under the mit license": "mit-ref",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
    " documentation files the software to deal in the software without restriction including without limitation the"
    " rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit"
    " persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of"
    " the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the"
    " warranties of merchantability fitness for a particular purpose and noninfringement": "mit-warranty",
    "licensed under the apache license version 2 0": "apache2-ref",
    "licensed under the apache license version 2 0 the license": "apache2-ref",
    "you may not use this file except in compliance with the license": "apache-comply",
    "you may obtain a copy of the license at": "apache-copy",
    "this work is licensed under the gnu general public license version 3": "gpl3-ref",
    "this work is licensed under the gnu general public license version 2": "gpl2-ref",
    "this program is free software": "gpl-free",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free"
    " software foundation": "gpl-terms",
    "either version 3 of the license or at your option any later version": "gpl3-later",
    "either version 2 of the license or at your option any later version": "gpl2-later",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the"
    " following conditions are met": "bsd-intro",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following"
    " disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following"
    " disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"
    " derived from this software without specific prior written permission": "bsd-endorse",
    "licensed under cc by 4 0": "cc-by-ref",
    "licensed under cc by nc 4 0": "cc-by-nc-ref",
    "licensed under cc by sa 4 0": "cc-by-sa-ref",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl2-ref",
}

# Ordered rules, sequences of identifiers and the licence they mean.
RULES = (
    (("bsd-intro", "bsd-source", "bsd-binary", "bsd-endorse"), "BSD-3-Clause"),
    (("bsd-intro", "bsd-source", "bsd-binary"), "BSD-2-Clause"),
    (("mit-grant", "mit-notice", "mit-warranty"), "MIT"),
    (("mit-grant", "mit-notice"), "MIT"),
    (("gpl-free", "gpl-terms", "gpl3-later"), "GPL-3.0-or-later"),
    (("gpl-free", "gpl-terms", "gpl2-later"), "GPL-2.0-or-later"),
    (("apache2-ref", "apache-comply", "apache-copy"), "Apache-2.0"),
    (("mit-ref",), "MIT"),
    (("apache2-ref",), "Apache-2.0"),
    (("gpl3-ref",), "GPL-3.0-only"),
    (("gpl2-ref",), "GPL-2.0-only"),
    (("cc-by-nc-ref",), "CC-BY-NC-4.0"),
    (("cc-by-sa-ref",), "CC-BY-SA-4.0"),
    (("cc-by-ref",), "CC-BY-4.0"),
    (("mpl2-ref",), "MPL-2.0"),
)

# Each known sentence has one of these words.
ANCHORS = ("licens", "permission", "warranty", "redistribut", "free software")

SPACE = r"\x09-\x0D\x20"
CUTS = (
    (rf"([.!?;:])[{SPACE}]+", "$1\x01"),
    (rf"\n[{SPACE}]*\n", "\x01"),
    (rf"\n[{SPACE}]*([A-Z])", "\x01$1"),
)


_TERMS = (
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free"
    " software foundation"
)

# Further wordings of the standard notices, which the SQL does not have.
NOTICES = {
    **SENTENCES,
    **{
        f"{_TERMS} either version {v} of the license or at your option any later version": f"gpl{v}-terms-later"
        for v in (2, 3)
    },
    **{f"{_TERMS} version {v}": f"gpl{v}-terms-only" for v in (2, 3)},
    **{f"{_TERMS} version {v} of the license": f"gpl{v}-terms-only" for v in (2, 3)},
    "version 2 of the license": "gpl2-version",
    "version 3 of the license": "gpl3-version",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apache-copy",
    "you may obtain a copy of the license at https www apache org licenses license 2 0": "apache-copy",
    **{
        sentence: f"cc-{short}-ref"
        for short, name in (("by", "attribution"), ("by-nc", "attribution noncommercial"), ("by-sa", "attribution sharealike"))
        for sentence in (
            f"this work is licensed under cc {short.replace('-', ' ')} 4 0",
            f"this work is licensed under a creative commons {name} 4 0 international license",
        )
    },
}

# Rules for them, before the others.
NOTICE_RULES = (
    (("gpl-free", "gpl3-terms-later"), "GPL-3.0-or-later"),
    (("gpl-free", "gpl2-terms-later"), "GPL-2.0-or-later"),
    (("gpl-free", "gpl3-terms-only"), "GPL-3.0-only"),
    (("gpl-free", "gpl2-terms-only"), "GPL-2.0-only"),
    (("gpl-free", "gpl-terms", "gpl3-version"), "GPL-3.0-only"),
    (("gpl-free", "gpl-terms", "gpl2-version"), "GPL-2.0-only"),
)

#: To words between cuts: \x01, or \x02 before a line that begins in upper case, which may also go on with a sentence.
STEPS = (
    ("\x02", " "),
    (rf"([!?;:]|(?<![{SPACE}][vV])\.|\.(?![{SPACE}]+[0-9]))[{SPACE}]+", "$1\x01"),
    CUTS[1],
    (rf"\n[{SPACE}]*([A-Z])", "\x02$1"),
    ("[^A-Za-z0-9\x01\x02]+", " "),
    (" ?([\x01\x02]) ?", "$1"),
    ("\x02*\x01[\x01\x02]*", "\x01"),
    ("\x02+", "\x02"),
)


def sentence_ids(text: Column) -> Column:
    """The identifiers of a text's known sentences, in order."""
    for pattern, by in STEPS:
        text = F.regexp_replace(text, pattern, by)
    text = F.concat(F.lit("\x01"), F.trim(F.lower(text)), F.lit("\x01"))
    for sentence in sorted(NOTICES, key=lambda s: (-len(s.split()), s)):
        text = F.regexp_replace(text, f"(?<=[\x01\x02]){sentence.replace(' ', '[ \x02]')}(?=[\x01\x02])", f"<{NOTICES[sentence]}>")
    return F.regexp_extract_all(text, F.lit("<([a-z0-9-]+)>"), F.lit(1))


def recognised(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``sentence_ids`` (array), ``licenses`` (array, in the order of the rules) and ``unmatched`` (sentences no rule took)."""
    may = F.col(text).rlike("(?i)" + "|".join(a.replace(" ", rf"[^A-Za-z0-9]+") for a in ANCHORS))
    none = F.array().cast("array<string>")
    out = docs.withColumn("sentence_ids", F.when(may, sentence_ids(F.col(text))).otherwise(none))
    rest = F.when(F.size("sentence_ids") > 0, F.concat(F.lit("<"), F.array_join("sentence_ids", "><"), F.lit(">"))).otherwise("")
    out = out.withColumns({"_rest": rest, "licenses": none})
    for sequence, licence in (*NOTICE_RULES, *RULES):
        pattern = "(" + "".join(f"<{x}>" for x in sequence) + ")+"
        has = F.col("_rest").rlike(pattern)
        out = out.withColumns(
            {
                "licenses": F.when(has, F.array_union("licenses", F.array(F.lit(licence)))).otherwise(F.col("licenses")),
                "_rest": F.when(has, F.regexp_replace("_rest", pattern, "")).otherwise(F.col("_rest")),
            }
        )
    left = F.size(F.split("_rest", "<")) - 1
    return out.withColumn("unmatched", left.cast("int")).drop("_rest")


def op6_license_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = recognised(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.size("sentence_ids").cast("long").alias("n_known"),
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("licenses", ",").alias("licenses"),
        F.col("unmatched").cast("long").alias("unmatched"),
    )


def _sql() -> str:
    text = "text"
    for pattern, by in CUTS:
        by = by.replace("$1", "\\1").replace("\x01", "' || chr(1) || '")
        text = f"regexp_replace({text}, '{pattern}', '{by}', 'g')"
    known = ", ".join(f"'{k}': '{v}'" for k, v in SENTENCES.items())
    steps = ["s0 AS (SELECT doc_id, ids, coalesce('<' || nullif(array_to_string(ids, '><'), '') || '>', '') AS rest, []::VARCHAR[] AS found FROM ids)"]
    for k, (sequence, licence) in enumerate(RULES):
        pattern = "(" + "".join(f"<{x}>" for x in sequence) + ")+"
        steps.append(
            f"s{k + 1} AS (SELECT doc_id, ids, regexp_replace(rest, '{pattern}', '', 'g') AS rest, CASE WHEN regexp_matches(rest, '{pattern}')"
            f" AND NOT list_contains(found, '{licence}') THEN list_append(found, '{licence}') ELSE found END AS found FROM s{k})"
        )
    return f"""
WITH cut AS (SELECT doc_id, string_split({text}, chr(1)) AS parts FROM documents),
ids AS (SELECT doc_id, coalesce(list_filter(list_transform(parts, lambda s:
    MAP {{{known}}}[trim(lower(regexp_replace(s, '[^A-Za-z0-9]+', ' ', 'g')))]), lambda x: x IS NOT NULL), []) AS ids FROM cut),
{", ".join(steps)}
SELECT doc_id, len(ids) AS n_known, array_to_string(ids, ',') AS sentence_ids, array_to_string(found, ',') AS licenses,
       len(string_split(rest, '<')) - 1 AS unmatched FROM s{len(RULES)}"""


SQL = _sql()
