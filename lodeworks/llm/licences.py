"""Licence scans: TF-IDF cosine of headers and licence files to templates, then inheritance from the nearest directory.

A file's passages are made around each of its lines that names a licence: the line, its sentences, and the line with its
neighbours, from which comment marks are taken off, since notices are wrapped; and the whole text, if it is a licence file.
Passages are written once and each different one is compared with the templates once, however many files hold it. A
machine-readable identifier in a passage is taken at its word. A file without a licence of its own has that of the
licence file in its nearest ancestor directory. DataFrame functions only.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import let, unused, written

# Licence texts as published, without their copyright lines.
MIT_TEXT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal "
    "in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
    "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
ISC_TEXT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
    "copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD "
    "TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, "
    "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER "
    "TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution. "
)
BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission. "
)
BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE "
    "FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
    "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
#: Short forms, titles and opening sentences of licences, and the texts above.
TEMPLATES = (
    ("MIT", MIT_TEXT),
    ("ISC", ISC_TEXT),
    ("BSD-2-Clause", BSD_CONDITIONS + BSD_DISCLAIMER),
    ("BSD-3-Clause", BSD_CONDITIONS + BSD_NAMES + BSD_DISCLAIMER),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This file is released under the MIT license, see LICENSE for details."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated this work to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
#: Least cosine of a passage and a template.
LEAST = 0.7
CUE = r"(?i)licen[sc]e|copyright|spdx|\bcc[ -]by\b|\bcc0\b|creative commons|public domain|permission is hereby|redistribution and use"
LICENCE_FILE = r"(?i)^(?:licen[sc]e|copying|unlicense)(?:[.-][a-z0-9.-]+)?$"
TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
#: A line with a word; marks of comments at a line's begin; where a sentence ends within a line.
VISIBLE = r"[^\x20\x09-\x0D]"
MARKS = r"^[\x20\x09-\x0D/*#;%!<>-]+"
SENTENCE = r"([.!?])[\x20\x09]+([A-Z(])"
#: Lines of a block before and after the line that names a licence.
BEFORE, AFTER = 1, 3
#: A machine-readable identifier, and what may stand behind its name; of several in an expression the first counts.
SPDX = r"(?i)spdx-license-identifier:[\x20\x09(]*([A-Za-z0-9.+-]+)"
SPDX_TAIL = r"(?i)(?:-only|-or-later|\+)$"


def terms_of(text: str) -> list[str]:
    return re.findall(TERM, text.lower())


def weights(templates=TEMPLATES) -> tuple[dict[str, float], float, list[tuple[str, int, str, float]]]:
    """IDF of the templates' terms, that of any other term, and (term, template, licence, weight) with unit vectors."""
    counted = [Counter(terms_of(text)) for _, text in templates]
    n = len(templates)
    of = {t: sum(t in c for c in counted) for c in counted for t in c}
    idf = {t: math.log((1 + n) / (1 + d)) + 1 for t, d in of.items()}
    rows = []
    for number, ((licence, _), c) in enumerate(zip(templates, counted, strict=True)):
        norm = math.sqrt(sum((k * idf[t]) ** 2 for t, k in c.items()))
        rows += [(t, number, licence, k * idf[t] / norm) for t, k in sorted(c.items())]
    return idf, math.log(1 + n) + 1, rows


def graded(passages: DataFrame, templates=TEMPLATES, least: float = LEAST) -> DataFrame:
    """(passage, licence, score) for the different values of ``passages.passage`` that are like enough to a template.

    A passage with an identifier has its licence, as the templates spell it if they have it, with score 1. Ties go to the licence that comes first by name. The templates' terms are broadcast: a few hundred rows.
    """
    idf, other, rows = weights(templates)
    spark = passages.sparkSession
    vectors = F.broadcast(spark.createDataFrame(rows, "term string, template int, licence string, weight double"))
    known = F.broadcast(spark.createDataFrame(list(idf.items()), "term string, idf double"))
    terms = passages.select("passage").distinct().select("passage", F.explode(F.regexp_extract_all(F.lower("passage"), F.lit(TERM), 0)).alias("term"))
    counted = terms.groupBy("passage", "term").agg(F.count(F.lit(1)).alias("tf"))
    weighed = counted.join(known, "term", "left").withColumn("x", F.col("tf") * F.coalesce("idf", F.lit(other)))
    norms = weighed.groupBy("passage").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    dots = weighed.join(vectors, "term").groupBy("passage", "template", "licence").agg(F.sum(F.col("x") * F.col("weight")).alias("dot"))
    scores = dots.join(norms, "passage").select("passage", "licence", F.round(F.col("dot") / F.col("norm"), 9).alias("score")).where(F.col("score") >= least)
    named = F.regexp_replace(F.regexp_extract("passage", SPDX, 1), SPDX_TAIL, "")
    spelled = F.create_map(*[F.lit(x) for name in sorted({n for n, _ in templates}) for x in (name.lower(), name)])
    told = passages.select("passage").distinct().select("passage", F.coalesce(F.try_element_at(spelled, F.lower(named)), named).alias("licence"), F.lit(1.0).alias("score"))
    scores = scores.unionByName(told.where("licence != ''"))
    first = F.min(F.struct((-F.col("score")).alias("minus"), "licence"))
    return scores.groupBy("passage").agg(first.alias("best")).select("passage", "best.licence", (-F.col("best.minus")).alias("score"))


def passages_of(lines: Column) -> Column:
    """The different passages of a text's lines: lines that name a licence, their sentences that do, and blocks around them."""
    names = lambda x: F.regexp_like(x, F.lit(CUE))
    plain = F.transform(lines, lambda x: F.regexp_replace(x, F.lit(MARKS), F.lit("")))
    sentences = F.flatten(F.transform(F.filter(lines, names), lambda x: F.split(F.regexp_replace(x, F.lit(SENTENCE), F.lit("$1\n$2")), "\n")))

    def blocks(own: Column) -> Column:
        at = F.filter(F.transform(own, lambda x, i: F.when(names(x), i)), lambda i: i.isNotNull())
        first = lambda i: F.greatest(i - BEFORE, F.lit(0))
        return F.transform(at, lambda i: F.array_join(F.slice(own, first(i) + 1, i + AFTER + 1 - first(i)), " "))

    return F.array_distinct(F.concat(F.filter(lines, names), F.filter(sentences, names), let(plain, blocks)))


def ancestors(path: Column) -> Column:
    """All directories above a path, the root being the empty string; of a null path none."""
    steps = F.split(path, "/")
    above = F.transform(F.sequence(F.lit(0), F.size(steps) - 1), lambda k: F.array_join(F.slice(steps, 1, k), "/"))
    return F.when(path.isNotNull(), F.array_distinct(above))


def scan(files: DataFrame, templates=TEMPLATES, least: float = LEAST, path: str = "path", text: str = "text") -> DataFrame:
    """``files`` with own_licence, own_score, licence and licence_from; other names where they clash.

    ``own_licence`` is that of the file's passage with the best score (ties: the first by name); ``licence`` is the
    same or, without one, the licence of the licence file in the nearest directory above; ``licence_from`` is the
    directory, null for a file's own. A licence file has a name such as LICENSE, COPYING.txt, or only lines that name a licence. Of several
    in a directory the best score counts, then the first by name. Rows of one path are one file. A row with a null
    path is no file and gets nothing; a null, empty or blank text has no passage. An empty table stays empty.
    """
    own, score, licence, origin, key = unused(files.columns, "own_licence", "own_score", "licence", "licence_from", "key")
    where, body = F.col(f"`{path}`"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    by_name = F.coalesce(F.regexp_like(F.element_at(F.split(where, "/"), -1), F.lit(LICENCE_FILE)), F.lit(False))
    # most texts are only searched for a cue
    shown = files.select(where.alias("path"), by_name.alias("by_name"), body.alias("text")).where(F.col("by_name") | F.regexp_like("text", F.lit(CUE)))
    visible = lambda x: F.regexp_like(x, F.lit(VISIBLE))
    only = lambda lines: (F.size(lines) > 0) & F.forall(lines, lambda x: F.regexp_like(x, F.lit(CUE)))
    whole = F.when(F.col("by_name"), F.array("text")).otherwise(F.array().cast("array<string>"))
    taken = let(F.filter(F.split("text", "\n"), visible), lambda x: F.struct((F.col("by_name") | only(x)).alias("licence_file"), passages_of(x).alias("found")))
    passages = shown.select("path", taken.alias("t"), whole.alias("whole"))
    passages = passages.select("path", "t.licence_file", F.explode(F.array_distinct(F.concat("t.found", "whole"))).alias("passage"))
    passages = written(passages, "passages")
    scored = passages.join(graded(passages, templates, least), "passage")
    first = F.min(F.struct((-F.col("score")).alias("minus"), "licence")).alias("best")
    owned = scored.groupBy("path").agg(first, F.max("licence_file").alias("licence_file"))
    holders = owned.where("licence_file and path is not null").select(
        F.array_join(F.slice(F.split("path", "/"), 1, F.size(F.split("path", "/")) - 1), "/").alias("above"), "best", "path"
    )
    by_directory = holders.groupBy("above").agg(F.min(F.struct("best.minus", "best.licence", "path")).alias("held"))
    lacking = files.select(where.alias("path")).where("path is not null").distinct().join(owned.select("path"), "path", "left_anti")
    inherited = (
        lacking.select("path", F.explode(ancestors(F.col("path"))).alias("above"))
        .join(by_directory, "above")
        .groupBy("path")
        .agg(F.max(F.struct(F.length("above").alias("depth"), "above", "held.licence")).alias("nearest"))
    )
    known = owned.select(
        F.col("path").alias(key), F.col("best.licence").alias(own), (-F.col("best.minus")).alias(score), F.col("best.licence").alias(licence), F.lit(None).cast("string").alias(origin)
    ).unionByName(
        inherited.select(
            F.col("path").alias(key), F.lit(None).cast("string").alias(own), F.lit(None).cast("double").alias(score), F.col("nearest.licence").alias(licence), F.col("nearest.above").alias(origin)
        )
    )
    columns = [F.col(f"`{c}`") for c in files.columns]
    return files.join(known, where == F.col(key), "left").select(*columns, *[F.col(c) for c in (own, score, licence, origin)])
