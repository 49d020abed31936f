"""License scans: sparse TF-IDF cosine to templates, then inheritance from the nearest ancestor directory.

Statements, headers and license files become sparse term vectors; their cosine
to each template is a join over the shared terms.  Weights come from the template
set, so that the words that tell siblings apart ("lesser", "sa", a version) weigh most.
A file takes the license of its best passage.  License files speak for their directory:
other files without a license of their own inherit from the nearest directory
above them that has one.  Only the templates' few hundred terms are broadcast.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketlake.llm.common import saved, whole_text


def _gnu(name: str, short: str, version: str, day: str) -> list[str]:
    return [
        f"Licensed under the {name}, version {version}",
        f"This work is licensed under the {name}, version {version}",
        f"{name} Version {version}, {day}",
        f"redistribute it and/or modify it under the terms of the {name} version {version}",
        f"you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software "
        f"Foundation, either version {version} of the License, or (at your option) any later version",
        f"Licensed under the {short} version {version}",
        f"{short} {version}",
        f"SPDX-License-Identifier: {short}-{version}",
    ]


def _creative(code: str, name: str, version: str) -> list[str]:
    kind = "International" if version == "4.0" else "Unported"
    return [
        f"Licensed under a Creative Commons {name} {version} {kind} License",
        f"Creative Commons {name} {version} {kind}",
        f"Creative Commons {name} {version}",
        f"Licensed under CC {code} {version}",
        f"SPDX-License-Identifier: CC-{code}-{version}",
    ]


def _named(spdx: str, *names: str) -> list[str]:
    named = [x for n in names for x in (f"Licensed under the {n}", f"Released under the {n}", n)]
    return [*named, f"SPDX-License-Identifier: {spdx}"]


_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_NO_ENDORSEMENT = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
    "from this software without specific prior written permission. "
)
_BSD_WARRANTY = (
    "This software is provided by the copyright holders and contributors as is and any express or implied warranties, including, but "
    "not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed. In no event shall "
    "the copyright holder or contributors be liable for any direct, indirect, incidental, special, exemplary, or consequential damages "
    "however caused and on any theory of liability arising in any way out of the use of this software, even if advised of the "
    "possibility of such damage."
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    "(the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
    "so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software. The Software is provided as is, without warranty of any kind, express or implied, including "
    "but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
)
_ISC_NOTICE = ", provided that the above copyright notice and this permission notice appear in all copies"

# Statements by which files name their license, and the texts of short licenses.
TEMPLATES = {
    "0BSD": [*_named("0BSD", "Zero-Clause BSD License", "BSD Zero Clause License"), f"{_ISC}."],
    "AGPL-3.0": _gnu("GNU Affero General Public License", "AGPL", "3.0", "19 November 2007"),
    "Apache-2.0": [
        *_named("Apache-2.0", "Apache License, Version 2.0", "Apache License 2.0"),
        "Licensed under the Apache License, Version 2.0 (the License)",
        "Apache License Version 2.0, January 2004",
    ],
    "Artistic-2.0": _named("Artistic-2.0", "Artistic License 2.0"),
    "BSD-2-Clause": [
        *_named("BSD-2-Clause", "BSD 2-Clause License", "Simplified BSD License", "Two-Clause BSD License"),
        _BSD + _BSD_WARRANTY,
    ],
    "BSD-3-Clause": [
        *_named("BSD-3-Clause", "BSD 3-Clause License", "New BSD License", "Three-Clause BSD License"),
        "Use of this source code is governed by a BSD-style license",
        _BSD + _NO_ENDORSEMENT + _BSD_WARRANTY,
    ],
    "BSL-1.0": [
        *_named("BSL-1.0", "Boost Software License 1.0"),
        "Distributed under the Boost Software License, Version 1.0",
        "Boost Software License Version 1.0, August 17th, 2003",
    ],
    "CC-BY-3.0": _creative("BY", "Attribution", "3.0"),
    "CC-BY-4.0": _creative("BY", "Attribution", "4.0"),
    "CC-BY-NC-4.0": _creative("BY-NC", "Attribution-NonCommercial", "4.0"),
    "CC-BY-NC-ND-4.0": _creative("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives", "4.0"),
    "CC-BY-NC-SA-4.0": _creative("BY-NC-SA", "Attribution-NonCommercial-ShareAlike", "4.0"),
    "CC-BY-ND-4.0": _creative("BY-ND", "Attribution-NoDerivatives", "4.0"),
    "CC-BY-SA-3.0": _creative("BY-SA", "Attribution-ShareAlike", "3.0"),
    "CC-BY-SA-4.0": _creative("BY-SA", "Attribution-ShareAlike", "4.0"),
    "CC0-1.0": _named("CC0-1.0", "CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal License"),
    "EPL-1.0": _named("EPL-1.0", "Eclipse Public License 1.0", "Eclipse Public License, Version 1.0"),
    "EPL-2.0": _named("EPL-2.0", "Eclipse Public License 2.0", "Eclipse Public License, Version 2.0"),
    "EUPL-1.2": _named("EUPL-1.2", "European Union Public Licence 1.2", "EUPL, Version 1.2"),
    "GPL-2.0": _gnu("GNU General Public License", "GPL", "2.0", "June 1991"),
    "GPL-3.0": _gnu("GNU General Public License", "GPL", "3.0", "29 June 2007"),
    "ISC": [*_named("ISC", "ISC License"), _ISC + _ISC_NOTICE],
    "LGPL-2.0": _gnu("GNU Library General Public License", "LGPL", "2.0", "June 1991"),
    "LGPL-2.1": _gnu("GNU Lesser General Public License", "LGPL", "2.1", "February 1999"),
    "LGPL-3.0": _gnu("GNU Lesser General Public License", "LGPL", "3.0", "29 June 2007"),
    "MIT": [
        *_named("MIT", "MIT License"),
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        _MIT,
    ],
    "MPL-1.1": _named("MPL-1.1", "Mozilla Public License, Version 1.1", "Mozilla Public License 1.1"),
    "MPL-2.0": [
        *_named("MPL-2.0", "Mozilla Public License, Version 2.0", "Mozilla Public License 2.0"),
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    ],
    "MS-PL": _named("MS-PL", "Microsoft Public License"),
    "Unlicense": [
        *_named("Unlicense", "Unlicense"),
        "This is free and unencumbered software released into the public domain",
    ],
    "WTFPL": _named("WTFPL", "WTFPL"),
    "Zlib": [
        *_named("Zlib", "zlib License"),
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
        "redistribute it freely",
    ],
}
# Words that tell nothing about a license.
STOP_WORDS = (
    "a an and any are as at by for form forms free from in is it of on only or later person subject terms that the this to under use "
    "v with without work"
).split()
# Names of licenses and words that tell siblings apart.
MARKERS = (
    "affero agpl apache artistic boost bsd bsl cc0 eclipse endorse epl eupl european gpl isc lesser lgpl library microsoft mit "
    "mozilla mpl nc nd noderivatives noncommercial sa sharealike simplified unlicense wtfpl zero zlib"
).split()
# A passage without one of these names no license; what comes before a name to deny it.
NAMING = (
    r"(?i)licen[sc]|spdx|gpl|creative commons|\bcc[ -]by|\bcc0|redistribut|permission|public domain|"
    r"\b(?:eupl|wtfpl)\b"
)
DENIAL = (
    r"(?i)\b(?:not|never|no longer|nor|neither|isn't|aren't|wasn't|instead of|rather than|unlike|formerly|previously)\b"
    r"(?:\W+\w+){0,3}?\W+(?:licen[sc]ed|released|covered|distributed|governed|available|published|subject|under)\b"
)
_TERM = r"[a-z0-9]+(?:\.[0-9]+)*"
# spellings of the same word, applied in this order to lower-case text
_SPELLINGS = [
    (r"licenc", "licens"),
    (r"gpl[-_ ]?v?([0-9])", "gpl $1"),
    (r"\bv(?:ersion)?\.? ?([0-9])", " version $1"),
    (r"\b(non|no|share)[- ](commercial|derivatives|alike)", "$1$2"),
    (r"([0-9])(?:\.0)+\b", "$1"),
]
# Lines of the longest statement that is not a block; passages of one line up to this many are looked at.
_SPAN = 3
_COMMENT = r"^\s*(?:#|//|/\*|\*|--|;|%|<!--|\x22\x22\x22)"
_SPEAKS = r"(?i)(^|/)(licen[cs]e|copying|notice|unlicense)(\.[^/]*)?$"


def _words(text: str) -> list[str]:
    text = text.lower()
    for pattern, to in _SPELLINGS:
        text = re.sub(pattern, to.replace("$", "\\"), text, flags=re.ASCII)
    return [w for w in re.findall(_TERM, text) if w not in STOP_WORDS]


def _terms_of(content: Column) -> Column:
    """As :func:`_words`, of a column."""
    plain = reduce(lambda c, rule: F.regexp_replace(c, *rule), _SPELLINGS, F.lower(content))
    return F.filter(F.regexp_extract_all(plain, F.lit(_TERM), F.lit(0)), lambda w: ~w.isin(*STOP_WORDS))


def _telling(word: str) -> bool:
    return word in MARKERS or word[0].isdigit()


def template_idf(templates: dict[str, list[str]] = TEMPLATES) -> dict[str, float]:
    """``ln((1 + licenses) / (1 + licenses that use the term)) + 1`` of each term of the templates."""
    sets = [{w for x in statements for w in _words(x)} for statements in templates.values()]
    return {w: math.log((1 + len(sets)) / (1 + sum(w in s for s in sets))) + 1 for w in sorted(set().union(*sets))}


def _template_terms(spark: SparkSession, templates: dict[str, list[str]]) -> DataFrame:
    """One row per (statement, term), a few thousand whatever the input.

    ``unit`` is the term's share of the statement's unit vector, ``required`` whether a passage must hold it,
    ``requires`` how many such terms the statement has.  Marks that only other statements of the license hold
    come with a weight of 0.
    """
    idf = template_idf(templates)
    rows = []
    for name, statements in sorted(templates.items()):
        marks = {w for x in statements for w in _words(x) if w in MARKERS}
        for k, statement in enumerate(statements):
            words = _words(statement)
            weights = {w: words.count(w) * idf[w] for w in set(words)}
            length = math.sqrt(sum(x * x for x in weights.values()))
            needed = sum(_telling(w) for w in weights)
            rows += [(name, k, w, x / length, _telling(w), needed) for w, x in sorted(weights.items())]
            rows += [(name, k, w, 0.0, False, needed) for w in sorted(marks - weights.keys())]
    return spark.createDataFrame(
        rows, "template string, statement int, term string, unit double, required boolean, requires int"
    )


def _passages(files: DataFrame, key: str, speaks: Column) -> DataFrame:
    """``key, line, span, content``: passages that may name a license.

    Every line with a naming word, alone and with the one or two lines that
    follow; and, as line 0 and span 0, the whole text of a license file or the
    leading comment of another.  Passages that deny a license are left out.
    """
    named = files.where(whole_text("text").rlike(NAMING)).select(
        key, speaks.alias("speaks_"), F.split(whole_text("text"), r"\r?\n").alias("lines_")
    )
    following = [F.slice("lines_", k + 1, F.size("lines_")).alias(f"l{k}") for k in range(1, _SPAN)]
    lines = (
        named.select(key, F.posexplode(F.arrays_zip(F.col("lines_").alias("l0"), *following)).alias("line", "at"))
        .where(F.col("at.l0").rlike(NAMING))
        .select(key, "line", *[F.col(f"at.l{k}").alias(f"l{k}") for k in range(_SPAN)])
    )
    spans = [
        F.when(F.col(f"l{n - 1}").isNotNull(), F.struct(F.lit(n).alias("span"), F.concat_ws(" ", *[f"l{k}" for k in range(n)]).alias("content")))
        for n in range(1, _SPAN + 1)
    ]
    short = lines.select(key, "line", F.inline(F.filter(F.array(*spans), lambda x: x.isNotNull())))
    code = F.filter(
        F.transform("lines_", lambda line, i: F.when(~line.rlike(_COMMENT) & (F.trim(line) != ""), i)), lambda i: i.isNotNull()
    )
    leading = F.when(F.col("speaks_"), F.col("lines_")).otherwise(
        F.slice("lines_", F.lit(1), F.coalesce(F.array_min(code), F.size("lines_")))
    )
    blocks = named.select(
        key, F.lit(0).alias("line"), F.lit(0).alias("span"), F.array_join(leading, " ").alias("content")
    ).where("content != ''")
    # a text of its own may say "not" without denying anything
    return short.where(~F.col("content").rlike(DENIAL)).unionByName(blocks)


def own_licenses(
    files: DataFrame,
    templates: dict[str, list[str]] = TEMPLATES,
    floor: float = 0.6,
    key: str = "file",
    margin: float = 0.01,
    speaks: Column | None = None,
) -> DataFrame:
    """``key, own_license, cosine, line`` of each file with a passage whose cosine to a template is at least ``floor``.

    ``files`` has ``key`` (unique) and ``text``; ``speaks`` marks license files,
    whose whole text counts as a passage (default none).  Term weights are
    ``tf * idf`` with :func:`template_idf`; words outside the templates weigh
    ``ln(1 + licenses) + 1`` and only lengthen a passage's vector.  A passage
    must hold every number and mark of a statement and no mark that its license
    has not, so that an unlisted sibling or a line that names two licenses names none; one
    whose second license comes within ``margin`` of the first names none either
    (as "GNU General Public License" without a version).  The best passage
    counts; ties go to the earlier line, then the shorter passage.
    """
    spark = files.sparkSession
    unseen = math.log(1 + len(templates)) + 1
    idf = spark.createDataFrame(sorted(template_idf(templates).items()), "term string, idf double")
    sides = _template_terms(spark, templates)
    place = [key, "line", "span"]
    passages = _passages(files, key, F.lit(False) if speaks is None else speaks)
    # terms of a passage with their counts; a passage is one row until here
    terms = passages.select(*place, F.explode(_terms_of(F.col("content"))).alias("term"))
    # written once: lengths and products both read it, and the texts are searched once
    counted = saved(terms.groupBy(*place, "term").agg(F.count("*").alias("n")), "license-terms")
    weighted = counted.join(F.broadcast(idf), "term", "left").select(
        *place, "term", (F.col("n") * F.coalesce("idf", F.lit(unseen))).alias("weight"), F.col("idf").isNotNull().alias("known")
    )
    norms = weighted.groupBy(*place).agg(
        F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"), F.count_if(F.col("term").isin(*MARKERS)).alias("marks")
    )
    products = (
        weighted.where("known")
        .join(F.broadcast(sides), "term")
        .groupBy(*place, "template", "statement")
        .agg(
            F.sum(F.col("weight") * F.col("unit")).alias("dot"),
            F.count_if("required").alias("held"),
            F.first("requires").alias("requires"),
            F.count_if(F.col("term").isin(*MARKERS)).alias("shared"),
        )
        .where("held = requires")
    )
    scored = products.join(norms, place).where("shared = marks")
    scored = scored.withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 9)).where(F.col("cosine") >= floor - margin)
    per_license = scored.groupBy(*place, "template").agg(F.max("cosine").alias("cosine"))
    # at most one entry per license of the template set
    ranked = per_license.groupBy(*place).agg(F.sort_array(F.collect_list(F.struct("cosine", "template")), asc=False).alias("r"))
    second = F.coalesce(F.get("r", F.lit(1))["cosine"], F.lit(0.0))
    clear = ranked.select(*place, F.col("r")[0]["cosine"].alias("cosine"), F.col("r")[0]["template"].alias("template"), second.alias("second"))
    clear = clear.where((F.col("cosine") >= floor) & (F.col("cosine") - F.col("second") > margin))
    best = F.max_by(F.struct("template", "cosine", "line"), F.struct("cosine", -F.col("line"), -F.col("span")))
    return clear.groupBy(key).agg(best.alias("best")).select(key, F.col("best.template").alias("own_license"), "best.cosine", "best.line")


def directory(path: Column) -> Column:
    """What stands before the last slash, empty for none."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scan_licenses(
    files: DataFrame, templates: dict[str, list[str]] = TEMPLATES, floor: float = 0.6, key: str = "file"
) -> DataFrame:
    """``key, path, own_license, cosine, license, inherited_from`` for each file.

    ``files`` has ``key`` (unique, not null), ``path`` and ``text``.  Files named
    LICENSE, LICENCE, UNLICENSE, COPYING or NOTICE (any ending, any case) speak for their
    directory; of several in one the smallest path with a license does.  Other files without
    a license of their own take that of the nearest directory at or above
    theirs; ``inherited_from`` names it.  A null text is empty; a null path is in
    no directory and inherits nothing; an empty table gives no rows.  Other
    columns are dropped.
    """
    base = files.select(key, "path", "text")
    speaks = F.coalesce(F.col("path").rlike(_SPEAKS), F.lit(False))
    found = own_licenses(base, templates, floor, key, speaks=speaks).drop("line")
    known = base.select(key, "path").join(found, key, "left")
    speakers = (
        known.where(speaks & F.col("own_license").isNotNull())
        .groupBy(directory(F.col("path")).alias("_dir"))
        .agg(F.min(F.struct("path", "own_license")).alias("says"))
        .select("_dir", F.col("says.own_license").alias("_license"))
    )
    parts = F.split(directory(F.col("path")), "/")
    # every directory at or above the file, with its depth; the root is the empty path
    above = F.concat(
        F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")),
        F.array(F.lit("")),
    )
    inherited = (
        known.where(F.col("own_license").isNull() & F.col("path").isNotNull())
        .select(key, F.explode(F.array_distinct(above)).alias("dir"))
        .join(speakers, F.col("dir") == F.col("_dir"))
        .groupBy(F.col(key).alias("_key"))
        .agg(F.max_by(F.struct("_license", "dir"), F.length("dir")).alias("nearest"))
    )
    return known.join(inherited, F.col(key) == F.col("_key"), "left").select(
        key,
        "path",
        "own_license",
        "cosine",
        F.coalesce("own_license", "nearest._license").alias("license"),
        F.col("nearest.dir").alias("inherited_from"),
    )
