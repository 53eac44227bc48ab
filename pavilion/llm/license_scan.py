"""Licences in texts, recognised by their sentences.

A text is cut into sentences, also across the line breaks of a paragraph. They are
normalised: comment marks and white space go, letters become small, spellings become
one. A sentence that a pattern knows is
replaced by its identifier; one that merely sounds like a licence is ``unknown``,
all others are dropped. The sequence of identifiers is then matched against
ordered rules: the first rule takes its identifiers out wherever they follow one
another, then the next, so long licences come before their parts.

DataFrame functions only, and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pavilion.llm.expressions import let
from pavilion.llm.storage import fresh

# Identifiers of sentences and the patterns of their normalised text.
_LICENSED = r"(?:this \S+(?: \S+)? is )?(?:licensed|released|distributed|available|published|provided)(?: to you)? under(?: the terms of)?(?: the)? "
_FREE = r".{0,80}is free software[:;,]? you can redistribute it and/or modify it under the terms of the gnu general public license "
SENTENCES: list[tuple[str, str]] = [
    ("spdx-mit", r"spdx-license-identifier: ?mit"),
    ("spdx-apache-2", r"spdx-license-identifier: ?apache-2\.0"),
    ("spdx-bsd-2", r"spdx-license-identifier: ?bsd-2-clause"),
    ("spdx-bsd-3", r"spdx-license-identifier: ?bsd-3-clause"),
    ("spdx-isc", r"spdx-license-identifier: ?isc"),
    ("spdx-mpl-2", r"spdx-license-identifier: ?mpl-2\.0"),
    ("spdx-gpl-2", r"spdx-license-identifier: ?gpl-2\.0(?:-only|-or-later|\+)?"),
    ("spdx-gpl-3", r"spdx-license-identifier: ?gpl-3\.0(?:-only|-or-later|\+)?"),
    ("spdx-lgpl", r"spdx-license-identifier: ?lgpl-[23]\.[01](?:-only|-or-later|\+)?"),
    ("spdx-agpl-3", r"spdx-license-identifier: ?agpl-3\.0(?:-only|-or-later|\+)?"),
    ("spdx-cc0", r"spdx-license-identifier: ?cc0-1\.0"),
    ("copyright", r"(?:copyright|©|\(c\))(?: (?:copyright|©|\(c\)))*,? .{0,200}"),
    ("all-rights", r"all rights reserved"),
    ("mit-name", _LICENSED + r"(?:mit|expat) license|(?:the )?mit license(?: \(mit\))?"),
    ("mit-grant", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software .*"),
    ("mit-notice", r"the above copyright notice and this permission notice .*shall be included in all copies .*"),
    ("as-is", r"the software is provided \"?as is\"?,? (?:without warranty of any kind|and .* disclaims all warranties).*"),
    ("no-liability", r"in no event shall (?:the|any) .*(?:liable|liability).*"),
    ("isc-grant", r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee is hereby granted.*"),
    ("apache-2-name", _LICENSED + r"apache license,? (?:version|v\.?) ?2(?:\.0)?(?: \(the \"?license\"?\))?|apache license,? version 2\.0.*"),
    ("apache-comply", r"you may not use this file except in compliance with the license"),
    ("apache-copy", r"you may obtain a copy of the license at.*"),
    ("apache-basis", r"unless required by applicable law or agreed to in writing, .*without warranties or conditions of any kind.*"),
    ("apache-see", r"see the license for the specific language governing permissions and limitations under the license"),
    ("bsd-grant", r"redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd-source", r"(?:\W?\d\W? )?redistributions? of source code must retain .*"),
    ("bsd-binary", r"(?:\W?\d\W? )?redistributions? in binary form must reproduce .*"),
    ("bsd-endorse", r"(?:\W?\d\W? )?neither the names? of .*may be used to endorse or promote products .*"),
    ("bsd-as-is", r"this software is provided by the .*\"?as is\"? .*"),
    ("gpl-3-free", _FREE + r".*version 3 of the license.*"),
    ("gpl-2-free", _FREE + r".*version 2 of the license.*"),
    ("gpl-free", _FREE + r".*"),
    ("gpl-2-name", _LICENSED + r"(?:gnu general public license|gnu gpl|gpl),? ?(?:version|v)\.? ?2(?:\.0)?.*"),
    ("gpl-3-name", _LICENSED + r"(?:gnu general public license|gnu gpl|gpl),? ?(?:version|v)\.? ?3(?:\.0)?.*"),
    ("gpl-name", _LICENSED + r"(?:gnu general public license|gnu gpl|gpl)"),
    ("gpl-version-2", r"either version 2 of the license, or .*any later version"),
    ("gpl-version-3", r"either version 3 of the license, or .*any later version"),
    ("gpl-hope", r".{0,80}is distributed in the hope that it will be useful, but without any warranty.*"),
    ("gpl-see", r"see the gnu general public license for more details"),
    ("gpl-received", r"you should have received a copy of the gnu .*"),
    ("gpl-else", r"if not, (?:see|write to) .*"),
    ("lgpl-name", _LICENSED + r"(?:gnu (?:lesser|library) general public license|gnu lgpl|lgpl).*"),
    ("agpl-name", _LICENSED + r"(?:gnu affero general public license|gnu agpl|agpl).*"),
    ("mpl-2-name", r"this source code form is subject to the terms of the mozilla public license, v\. 2\.0|" + _LICENSED + r"mozilla public license.*"),
    ("cc-by-nc-name", _LICENSED + r"(?:a )?(?:cc[ -]by-nc|creative commons attribution-noncommercial)(?:-sa|-nd)?.*"),
    ("cc-by-sa-name", _LICENSED + r"(?:a )?(?:cc[ -]by-sa|creative commons attribution-sharealike).*"),
    ("cc-by-nd-name", _LICENSED + r"(?:a )?(?:cc[ -]by-nd|creative commons attribution-noderiv).*"),
    ("cc-by-name", _LICENSED + r"(?:a )?(?:cc[ -]by|creative commons attribution)(?: \d.*| (?:international )?license.*)?"),
    ("cc0-name", _LICENSED + r"cc0.*|to the extent possible under law, .*has waived all copyright .*"),
    ("public-domain", r"this is free and unencumbered software released into the public domain|.{0,60}(?:released into|is in|placed in) the public domain"),
    ("non-commercial", r".{0,120}(?:not for|prohibits?|forbids?|no) commercial (?:use|purposes?).{0,80}"),
    ("confidential", r".{0,80}(?:proprietary and confidential|confidential and proprietary|trade secrets? of).{0,80}"),
    ("no-copying", r"(?:no part of this .*may be (?:reproduced|copied)|unauthori[sz]ed (?:copying|use|reproduction)) .*"),
]

# Ordered rules: identifiers in a row, the licence, and its class.
RULES: list[tuple[tuple[str, ...], str, str]] = [
    (("mit-name", "copyright", "mit-grant", "mit-notice", "as-is", "no-liability"), "MIT", "permissive"),
    (("mit-grant", "mit-notice", "as-is", "no-liability"), "MIT", "permissive"),
    (("mit-grant", "mit-notice", "as-is"), "MIT", "permissive"),
    (("mit-grant", "mit-notice"), "MIT", "permissive"),
    (("apache-2-name", "apache-comply", "apache-copy", "apache-basis", "apache-see"), "Apache-2.0", "permissive"),
    (("apache-2-name", "apache-comply", "apache-copy", "apache-see"), "Apache-2.0", "permissive"),
    (("apache-2-name", "apache-comply", "apache-copy"), "Apache-2.0", "permissive"),
    (("copyright", "all-rights", "bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is", "no-liability"), "BSD-3-Clause", "permissive"),
    (("copyright", "all-rights", "bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"), "BSD-3-Clause", "permissive"),
    (("copyright", "all-rights", "bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is", "no-liability"), "BSD-2-Clause", "permissive"),
    (("copyright", "all-rights", "bsd-grant", "bsd-source", "bsd-binary"), "BSD-2-Clause", "permissive"),
    (("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is", "no-liability"), "BSD-3-Clause", "permissive"),
    (("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"), "BSD-3-Clause", "permissive"),
    (("bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is", "no-liability"), "BSD-2-Clause", "permissive"),
    (("bsd-grant", "bsd-source", "bsd-binary"), "BSD-2-Clause", "permissive"),
    (("isc-grant", "as-is", "no-liability"), "ISC", "permissive"),
    (("isc-grant", "as-is"), "ISC", "permissive"),
    (("isc-grant",), "ISC", "permissive"),
    (("gpl-3-free", "gpl-hope", "gpl-see", "gpl-received", "gpl-else"), "GPL-3.0", "copyleft"),
    (("gpl-3-free", "gpl-hope", "gpl-see", "gpl-received"), "GPL-3.0", "copyleft"),
    (("gpl-3-free",), "GPL-3.0", "copyleft"),
    (("gpl-2-free", "gpl-hope", "gpl-see", "gpl-received", "gpl-else"), "GPL-2.0", "copyleft"),
    (("gpl-2-free", "gpl-hope", "gpl-see", "gpl-received"), "GPL-2.0", "copyleft"),
    (("gpl-2-free",), "GPL-2.0", "copyleft"),
    (("gpl-free", "gpl-version-3", "gpl-hope", "gpl-received"), "GPL-3.0", "copyleft"),
    (("gpl-free", "gpl-version-2", "gpl-hope", "gpl-received"), "GPL-2.0", "copyleft"),
    (("gpl-free", "gpl-hope", "gpl-received"), "GPL", "copyleft"),
    (("gpl-free",), "GPL", "copyleft"),
    (("copyright", "all-rights"), "proprietary", "reserved"),
    (("mit-name",), "MIT", "permissive"),
    (("spdx-mit",), "MIT", "permissive"),
    (("mit-grant",), "MIT", "permissive"),
    (("apache-2-name",), "Apache-2.0", "permissive"),
    (("spdx-apache-2",), "Apache-2.0", "permissive"),
    (("spdx-bsd-2",), "BSD-2-Clause", "permissive"),
    (("spdx-bsd-3",), "BSD-3-Clause", "permissive"),
    (("spdx-isc",), "ISC", "permissive"),
    (("mpl-2-name",), "MPL-2.0", "copyleft"),
    (("spdx-mpl-2",), "MPL-2.0", "copyleft"),
    (("gpl-2-name",), "GPL-2.0", "copyleft"),
    (("spdx-gpl-2",), "GPL-2.0", "copyleft"),
    (("gpl-3-name",), "GPL-3.0", "copyleft"),
    (("spdx-gpl-3",), "GPL-3.0", "copyleft"),
    (("gpl-name",), "GPL", "copyleft"),
    (("lgpl-name",), "LGPL", "copyleft"),
    (("spdx-lgpl",), "LGPL", "copyleft"),
    (("agpl-name",), "AGPL-3.0", "copyleft"),
    (("spdx-agpl-3",), "AGPL-3.0", "copyleft"),
    (("cc-by-nc-name",), "CC-BY-NC", "restricted"),
    (("cc-by-sa-name",), "CC-BY-SA", "copyleft"),
    (("cc-by-nd-name",), "CC-BY-ND", "restricted"),
    (("cc-by-name",), "CC-BY", "permissive"),
    (("cc0-name",), "CC0-1.0", "permissive"),
    (("spdx-cc0",), "CC0-1.0", "permissive"),
    (("public-domain",), "public-domain", "permissive"),
    (("non-commercial",), "non-commercial", "restricted"),
    (("confidential",), "proprietary", "reserved"),
    (("no-copying",), "proprietary", "reserved"),
    (("all-rights",), "proprietary", "reserved"),
]

# The first class that any licence of a text has is the text's.
CLASSES = ("reserved", "restricted", "copyleft", "permissive")
_SOUNDS_LIKE = r"licen[cs]e|copyright|©|\(c\) |all rights|warrant|redistribut|permission|public domain|free software|you may|commercial|proprietary|unauthori|spdx|gnu |in no event shall"


# Words of daily use sound like a licence too. An unknown sentence has the weight of one if it
# says what only licences say, or if it allows, forbids or disclaims something about a work.
_SURELY = (
    r"\bspdx\b|all rights (?:are )?reserved|\bpublic domain\b|copyright (?:notice|holder|owner|\(c\)|©|\d)|(?:©|\(c\)) ?\d"
    r"|\blicensed? (?:under|for use)\b|\blicense agreement|\bredistribut\w+|in no event shall|\bend[ -]user license|\bgnu (?:[a-z]+ )*public"
    r"|^(?:an?|the|this) license\b"
    r"|without (?:any |express or implied )?warrant|as is\b.*warrant|warrant.*\bas is\b"
)
_GRANTS = (
    r"\blicense|\bcopyright|\bpermission|\bpermitted|\byou may\b|\bwarrant|\bproprietary\b|\bunauthori|\bcommercial"
    r"|\bfree software|\ball rights\b|\bconfidential"
)
_WORKS = (
    r"\b(?:software|source code|copyrighted|program code|object code|binary form|documentation)\b"
    r"|\b(?:this|the|these|its|such) (?:\w+ )?(?:work|works|file|files|program|library|document|documents|material|materials|code|package|dataset|data set)\b"
    r"|\b(?:copy|copies|reproduce[sd]?|reproduction|distribut\w+|modif\w+|sublicense|publish|resell|reuse|use) (?:\w+ ){0,6}(?:work|works|software|material|materials|content|document|text|copies|purposes|use)\b"
    r"|\bterms (?:and conditions )?of (?:the|this|use)\b|\bderivative work"
)


def weighty(sentence: Column) -> Column:
    """Does a normalised sentence that is not known have the weight of a licence?"""
    return sentence.rlike(_SURELY) | (sentence.rlike(_GRANTS) & sentence.rlike(_WORKS))


def normalised(sentence: Column) -> Column:
    """Small letters, single spaces, one spelling, no comment marks or end marks."""
    plain = F.regexp_replace(F.lower(sentence), r"^[\s/*#;%!<>|-]+|[\s/*#;:%!<>|.?-]+$", "")
    plain = F.regexp_replace(plain, r"[\s*]+", " ")
    plain = F.translate(plain, "“”‘’´`–—", "\"\"''''--")
    return F.regexp_replace(plain, r"\blicen(?:c|s)e(d?)\b", "license$1")


# How lines begin that go on with no sentence before them. Wrapped lines may begin with any other word.
_BEGINS = (
    r"Copyright|COPYRIGHT (?:\(C\)|©|\d)|©|\([cC]\) |All rights|ALL RIGHTS|SPDX|"
    r"(?:Licen[cs]ed|Released|Distributed|Available|Published|Provided)(?: to you)? under|This |THIS SOFTWARE IS|"
    r"Permission |The above|Redistribution|\d[.)] |Neither the|THE SOFTWARE IS|The software is|IN NO EVENT|In no event|"
    r"Unless required|You (?:may|should) |See the Licen|To the extent|No part|Unauthori"
)
_CUTS = "|".join(
    [
        r"\n\s*\n\s*",
        r"(?<=[.!?])\s+",
        r"(?<=:)[ \t]*\n\s*(?!(?i:you can))",
        r"(?<=(?i:conditions are met:|following conditions:))\s+",
        r"(?<=;)\s+(?=(?i:you may not use this))",
        rf"\n[ \t]*(?={_BEGINS})",
    ]
)
_COMMENT_HEAD = r"(?m)^[ \t]*(?:(?:/\*+|\*+/|\*|//+|#+|;+|%+|--+|!+|\|+|>+|<!--+)[ \t]*)+"
_COMMENT_TAIL = r"(?m)[ \t]*(?:\*+/|--+>)?[ \t]*$"
# Copyright lines and headings stand alone.
_ALONE = r"(?m)^((?:Copyright|COPYRIGHT \(C\)|©|\([cC]\) ).*|All rights reserved\.?|.{0,60}\b(?i:licen[cs]e)(?: \([^)\n]*\))?(?=\n[ \t]*[A-Z\"]))$"


def sentences(text: Column) -> Column:
    """Sentences that sound like a licence, in order, with their line breaks.

    They end at a blank line, at an end mark before white space, at a colon at the end
    of a line or before a list of conditions, and before a line that begins as licence
    sentences do.
    """
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), r"\r\n?", "\n")
    plain = F.regexp_replace(F.regexp_replace(plain, _COMMENT_HEAD, ""), _COMMENT_TAIL, "")
    cut = F.split(F.regexp_replace(plain, _ALONE, "$1\n"), _CUTS, -1)
    address = r"^\W*https?://\S*\s*$"  # of a licence's text, as in Apache's
    return F.filter(cut, lambda s: F.lower(s).rlike(_SOUNDS_LIKE) & ~s.rlike(address))


def _identifier(sentence: Column) -> Column:
    found = F.lit("unknown")
    for name, pattern in reversed(SENTENCES):
        found = F.when(sentence.rlike(f"^(?:{pattern})$"), name).otherwise(found)
    return found


def _known_or_weighty(sentence: Column) -> Column:
    """The identifier; null for an unknown sentence without the weight of a licence."""
    return let(_identifier(sentence), lambda i: F.when((i != "unknown") | weighty(sentence), i))


def _identifiers_of(sentence: Column) -> Column:
    """Of a sentence, or of its lines if it is known only line by line."""

    def by_line(whole: Column) -> Column:
        lines = F.filter(F.split(sentence, r"\n"), lambda s: F.lower(s).rlike(_SOUNDS_LIKE))
        plain = F.filter(F.transform(lines, normalised), lambda s: s != "")
        named = F.filter(F.transform(plain, _known_or_weighty), lambda i: i.isNotNull())
        broken = (whole == "unknown") & F.contains(sentence, F.lit("\n")) & (F.size(lines) > 0)
        light = (whole == "unknown") & ~weighty(normalised(sentence))
        return F.when(broken, named).when(light, none).otherwise(F.array(whole))

    none = F.array().cast("array<string>")

    return let(normalised(sentence), lambda s: F.when(s == "", F.array().cast("array<string>")).otherwise(let(_identifier(s), by_line)))


def identifiers(text: Column) -> Column:
    """The identifiers of a text's licence sentences, in order."""
    return F.when(
        F.coalesce(text, F.lit("")).rlike(f"(?i){_SOUNDS_LIKE}"), F.flatten(F.transform(sentences(text), _identifiers_of))
    ).otherwise(F.array().cast("array<string>"))


def _matched(sequence: Column) -> Column:
    """Licences by rule order, what no rule took, and the class."""
    start = F.struct(sequence.alias("rest"), F.array().cast("array<string>").alias("found"))
    rules = F.array(
        *[
            F.struct(F.lit("(?<=,)" + "".join(f"{i}," for i in ids)).alias("p"), F.lit(name).alias("name"))
            for ids, name, _ in RULES
        ]
    )

    def apply(state: Column, rule: Column) -> Column:
        return F.when(
            F.regexp_like(state["rest"], rule["p"]),
            F.struct(
                F.regexp_replace(state["rest"], rule["p"], F.lit("")).alias("rest"),
                F.array_union(state["found"], F.array(rule["name"])).alias("found"),
            ),
        ).otherwise(state)

    return F.aggregate(rules, start, apply)


def scanned(docs: DataFrame, text_column: str = "text") -> tuple[DataFrame, list[str]]:
    """``docs`` with five more columns, and their names.

    ``sentence_ids``, the identifiers in order; ``licenses``, in rule order; ``unmatched``
    identifiers that no rule took, copyright lines left out; ``license_class``, the
    strictest of ``CLASSES``, ``unknown`` if there are only unmatched ones and null if
    there is nothing; ``usable``, false for reserved, restricted and unknown. A sentence
    that is not known counts only if it has the weight of a licence (:func:`weighty`), not
    for a word of daily use. Null, empty and plain texts have empty lists and are usable;
    repeated rows are judged alike, and texts of any length as a whole. Names that ``docs`` has get
    underscores.
    """
    names = fresh(docs, "sentence_ids", "licenses", "unmatched", "license_class", "usable")
    none = F.array().cast("array<string>")

    def judge(ids: Column) -> Column:
        sequence = F.concat(F.lit(","), F.array_join(ids, ","), F.lit(","))
        return let(_matched(sequence), lambda state: outcome(ids, state))

    def outcome(ids: Column, state: Column) -> Column:
        rest = F.filter(F.split(state["rest"], ","), lambda i: (i != "") & (i != "copyright"))
        kind = F.when(F.size(rest) > 0, F.lit("unknown"))
        for name in reversed(CLASSES):
            members = F.array(*[F.lit(n) for n in dict.fromkeys(n for _, n, c in RULES if c == name)])
            kind = F.when(F.arrays_overlap(state["found"], members), name).otherwise(kind)
        return F.struct(ids.alias("ids"), state["found"].alias("found"), rest.alias("rest"), kind.alias("kind"))

    nothing = F.struct(none.alias("ids"), none.alias("found"), none.alias("rest"), F.lit(None).cast("string").alias("kind"))
    result = let(
        identifiers(F.col(f"`{text_column}`")), lambda ids: F.when(F.size(ids) > 0, judge(ids)).otherwise(nothing)
    )
    (scan,) = fresh(docs, "scan")
    known = docs.withColumn(scan, result)
    usable = ~F.coalesce(F.col(scan)["kind"], F.lit("")).isin("reserved", "restricted", "unknown")
    parts = [F.col(scan)[c].alias(n) for c, n in zip(("ids", "found", "rest", "kind"), names, strict=False)]
    return known.select(*[F.col(f"`{c}`") for c in docs.columns], *parts, usable.alias(names[4])), names
