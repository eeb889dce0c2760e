"""License scans: a sparse logistic regression on word n-grams over paragraphs, in DataFrame code.

* features are word n-grams (one to three words) around *marker* words of notices; a paragraph
  without a marker has no feature and is no notice, so most text is settled by one pattern;
* the model is trained by Spark ML on a small table of notices (:data:`TEMPLATES` under the rule of
  :func:`training_rows`); an elastic net leaves most weights at zero.  It is a literal map of a few
  hundred n-grams in the scan, which is one projection over the documents: no join and no shuffle;
* *unknown*: a paragraph that looks like a notice, but whose calibrated family probability is under
  the threshold, or which the template comparison does not confirm.  The temperature and the
  threshold come from held-out notices;
* *template comparison*: the share of a template's three-word shingles that the paragraph holds;
* *headers* wrapped over lines: a marked line is compared both ways, joined with its neighbours up to
  a blank line, with the whole wordings (:data:`HEADERS`).
"""

from __future__ import annotations

import json
import math
from itertools import cycle

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staffrank.llm.words import fresh
from staffrank.session import ensure_checkpoint_dir

NONE, UNKNOWN = "none", "unknown"
VOCABULARY = 1 << 14     # most n-grams that the model may know
CONFIRM = 0.6            # share of a template's shingles that confirms its family
PRECISION = 0.99         # of the families named on held-out notices
_SEPARATOR = "[^a-z0-9]+"

# Words of notices around which features are taken.
MARKERS = ["license", "licensed", "licence", "licensing", "copyright", "rights", "reserved", "redistribution", "redistribute",
           "permission", "permitted", "apache", "bsd", "gnu", "mozilla", "commons", "attribution", "cc", "cc0", "spdx",
           "unencumbered", "domain", "reproduced", "released", "distributed", "copyrighted", "unlicense", "redistributions",
           "vorbehalten", "lizenz", "lizenziert", "droits", "derechos", "licencia", "licenciado", "gemeinfrei"]

# Short notices of each licence family ({x} is filled in by the rule below).
TEMPLATES = {
    "apache": ["Licensed under the Apache License, Version 2.0.",
               "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
               "This project is distributed under the Apache License 2.0.", "SPDX-License-Identifier: Apache-2.0",
               "Lizenziert unter der Apache-Lizenz, Version 2.0.", "Distribué sous licence Apache, version 2.0.", "Distribuido bajo la licencia Apache, versión 2.0."],
    "mit": ["Released under the MIT License.", "This software is licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
            "SPDX-License-Identifier: MIT", "Veröffentlicht unter der MIT-Lizenz.", "Publié sous licence MIT.", "Publicado bajo la licencia MIT."],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
            "This code is released under the BSD 3-Clause License.", "Use of this source code is governed by a BSD-style license.",
            "SPDX-License-Identifier: BSD-3-Clause"],
    "gpl": ["This work is licensed under the GNU General Public License, version 3.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
            "Released under the GNU General Public License version 2 or later.", "SPDX-License-Identifier: GPL-3.0-or-later"],
    "lgpl": ["This library is licensed under the GNU Lesser General Public License, version 2.1.",
             "You can redistribute this library under the terms of the GNU Lesser General Public License.", "SPDX-License-Identifier: LGPL-2.1-only"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",
            "Licensed under the Mozilla Public License 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.",
              "This article is available under the Creative Commons Attribution License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
                 "Text is available under the Creative Commons Attribution-ShareAlike License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
                 "Licensed under CC BY-NC-ND 4.0."],
    "public-domain": ["This work is in the public domain.", "Dedicated to the public domain under CC0 1.0.",
                      "This is free and unencumbered software released into the public domain.",
                      "Released under The Unlicense.", "The Unlicense", "Dieses Werk ist gemeinfrei."],
    "reserved": ["All rights reserved.", "Copyright {x}. All rights reserved.", "No part of this work may be reproduced without written permission of the publisher.",
                 "Alle Rechte vorbehalten.", "Tous droits réservés.", "Todos los derechos reservados.", "This material is copyrighted."],
}
# Whole wordings that files carry wrapped over several lines.
HEADERS = {
    "apache": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program.",
    "lgpl": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should have received a copy of the GNU Lesser General Public License along with this library.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
}
AROUND = 3               # lines before and after a line with which a wrapped header is joined
HEADER_SHINGLES = 3      # fewest shingles of a line that is part of a header
# Paragraphs that are no notices, some close to them in words.
OTHER = [
    "The committee met on Monday to discuss the new school building.", "Please read the general terms before you order.",
    "Version 2.0 of the program adds a search page and fixes many errors.", "She got her driving license last year and bought a car.",
    "The public library is open from nine to five.", "Free delivery on all orders this week.", "The work was finished in the spring of that year.",
    "You can use the software on any computer at home.", "Creative people are common in this part of the city.",
    "It is the right of every person to be heard.", "The apache helicopter landed near the river.", "A student of physics at MIT wrote the first paper.",
    "The source of the river is in the mountains.", "Der Verein trifft sich am Montag in der Schule.", "Die Arbeit ist in der Stadt und auf dem Land nicht leicht.",
    "La maison est dans la ville et le jardin est grand.", "Les enfants jouent dans la cour de l'école.", "El libro que me diste es muy bueno.",
    "La casa de mi padre es grande y blanca.", "The rights of the workers were discussed in the first part.", "He was released from prison under the new law.",
    "This page was last changed in May.", "Terms and conditions apply to the offer.", "With or without you the train leaves at noon.",
    "Änderungen und Irrtum vorbehalten.", "Les droits de l'homme sont les mêmes pour tous.", "Los derechos de los niños son importantes.",
    "Er hat die Lizenz als Trainer im Sommer verloren.", "Mi hermano tiene la licencia de conducir.", "The film was copyrighted and shown in many cities.",
    "Permission to land was granted at noon.", "The foundation gave money to the public school.",
]
_FILL = ("2019", "2024 the authors", "the project contributors")
_BEFORE = ("", "", "Note: ", "License. ", "Copyright {x}. ")
_AFTER = ("", "", " See the file for details.", " Thank you for reading.")
_UNSEEN = [  # notices of other families, for the unknown class: the first of each two is fitted, the second held out
    "Licensed under the Eclipse Public License 2.0.", "Released under the zlib License.", "This font is licensed under the SIL Open Font License, version 1.1.",
    "Licensed under the Artistic License 2.0.", "Distributed under the Boost Software License, version 1.0.", "Licensed under the European Union Public Licence.",
    "This file is licensed under the Academic Free License version 3.0.", "Released under the PostgreSQL License.", "Licensed under the ISC License.",
]


def training_rows() -> list[tuple[str, str, bool]]:
    """(paragraph, family, held out): every notice under all openings and endings; a fixed fifth, and
    half of the unknown families, are held out.  A few hundred rows."""
    fill, rows = cycle(_FILL), []
    for family, notices in [*TEMPLATES.items(), (NONE, OTHER), (UNKNOWN, _UNSEEN)]:
        for notice in notices:
            for before in _BEFORE:
                for after in _AFTER:
                    text = (before + notice + after) if family != NONE or not before.startswith(("Lic", "Cop")) else notice + after
                    held = notices.index(notice) % 2 == 1 if family == UNKNOWN else len(rows) % 5 == 4
                    rows.append((text.replace("{x}", next(fill)), family, held))
    return rows


def _marker_words() -> str:
    """Matches a lower-cased text one of whose words is a marker; grouped by first letters, as most words fail there."""
    rest = {}
    for m in MARKERS:
        rest.setdefault(m[0], []).append(m[1:])
    return "(?<![a-z0-9])(?:" + "|".join(f"{c}(?:{'|'.join(r)})" for c, r in rest.items()) + ")(?![a-z0-9])"


def _marked(text: Column) -> Column:
    """Whether a word is a marker: other lines have no feature and are no part of a header, so they are no notices."""
    return F.lower(text).rlike(_marker_words())


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _SEPARATOR), lambda w: w != "")


def _ngrams(words: Column) -> Column:
    """Distinct n-grams of one to three words that hold a marker, space-joined."""
    markers = F.array(*map(F.lit, MARKERS))
    places = F.filter(F.transform(words, lambda w, i: F.when(F.array_contains(markers, w), i)), lambda i: i.isNotNull())

    def gram(first: Column, n: int) -> Column:
        inside = (first >= 0) & (first + n <= F.size(words))
        return F.when(inside, F.concat_ws(" ", F.slice(words, F.greatest(first, F.lit(0)) + 1, n)))

    around = F.flatten(F.transform(places, lambda i: F.array(*[gram(i - back, n) for n in (1, 2, 3) for back in range(n)])))
    return F.array_distinct(F.filter(around, lambda g: g.isNotNull()))


def _shingles(words: Column) -> Column:
    """Distinct three-word shingles; a shorter text is one shingle."""
    some = F.transform(F.sequence(F.lit(0), F.greatest(F.size(words) - 3, F.lit(0))), lambda i: F.concat_ws(" ", F.slice(words, i + 1, 3)))
    return F.array_distinct(some)


def _constant(value, schema: str) -> Column:
    """A literal of nested type: constant-folded once per query."""
    return F.from_json(F.lit(json.dumps(value)), schema)


class LicenseModel:
    """Weights of the trained model and its calibrated limits."""

    def __init__(self, spark: SparkSession, regularisation: float = 1e-3, l1_share: float = 0.5):
        rows = spark.createDataFrame(training_rows(), "text string, family string, held boolean").coalesce(1)
        # a paragraph without a feature is no notice and is never scored
        rows = rows.withColumn("grams", _ngrams(_words(F.col("text")))).where("size(grams) > 0").checkpoint()
        self.classes = [NONE, UNKNOWN, *sorted(TEMPLATES)]
        number = F.element_at(F.create_map(*[x for i, c in enumerate(self.classes) for x in (F.lit(c), F.lit(float(i)))]), F.col("family"))
        fit = rows.where("NOT held").withColumn("label", number)
        counter = CountVectorizer(inputCol="grams", outputCol="features", binary=True, vocabSize=VOCABULARY).fit(fit)
        model = LogisticRegression(family="multinomial", maxIter=80, regParam=regularisation, elasticNetParam=l1_share, standardization=False).fit(counter.transform(fit))
        matrix, self.intercept = model.coefficientMatrix.toArray(), [float(x) for x in model.interceptVector]
        self.weights = {g: [float(x) for x in matrix[:, j]] for j, g in enumerate(counter.vocabulary) if matrix[:, j].any()}
        held = [(r.family, list(r.z)) for r in rows.where("held").select("family", self.logits(F.col("grams")).alias("z")).collect()]
        known = [(self.classes.index(f), z) for f, z in held if f in self.classes]
        self.temperature = min((k / 4 for k in range(2, 25)), key=lambda t: -sum(math.log(max(1e-12, _softmax(z, t)[i])) for i, z in known))
        # the lowest limit at which the families named on held-out notices are right often enough
        named = sorted(((max(_softmax(z, self.temperature)[2:]), self.classes[max(range(2, len(z)), key=lambda i: z[i])] == f) for f, z in held if f != NONE), reverse=True)
        right, limit = 0, 1.0
        for k, (p, ok) in enumerate(named, 1):
            right += ok
            if right >= PRECISION * k:
                limit = p
        self.threshold = min(0.9, max(0.5, limit))

    def logits(self, grams: Column) -> Column:
        weights = _constant(self.weights, "map<string,array<double>>")
        found = F.filter(F.transform(grams, lambda g: F.element_at(weights, g)), lambda w: w.isNotNull())
        return F.aggregate(found, F.array(*map(F.lit, self.intercept)), lambda z, w: F.zip_with(z, w, lambda a, b: a + b))

    def judge(self, paragraph: Column, place: Column, around: Column) -> Column:
        """(place, family, probability, similarity) of one candidate paragraph; family none: no notice.
        A line that is part of a header (see :func:`_header`) has the header's family."""
        words = _words(paragraph)
        z = self.logits(_ngrams(words))
        # one-element arrays bind intermediate results, so that each is computed once
        powers = F.transform(F.array(z), lambda v: F.transform(v, lambda x: F.exp((x - F.array_max(v)) / self.temperature)))
        shares = F.transform(powers, lambda v: F.transform(v, lambda x: x / F.aggregate(v, F.lit(0.0), lambda a, y: a + y)))
        best = F.transform(shares, lambda v: F.struct(F.get(v, 0).alias("none"), F.array_max(F.slice(v, 3, len(self.classes))).alias("p"), v.alias("v")))
        names = F.array(*map(F.lit, self.classes))
        named = F.transform(best, lambda s: F.struct(s["none"].alias("none"), s["p"].alias("p"), F.element_at(names, F.array_position(F.slice(s["v"], 3, len(self.classes)), s["p"]).cast("int") + 2).alias("family")))
        templates = _constant({f: [_local_shingles(t) for t in ts] for f, ts in TEMPLATES.items()}, "map<string,array<array<string>>>")
        mine = _shingles(words)
        checked = F.transform(named, lambda s: F.struct(s["none"].alias("none"), s["p"].alias("p"), s["family"].alias("family"), F.array_max(F.transform(
            F.element_at(templates, s["family"]), lambda t: F.size(F.array_intersect(t, mine)) / F.size(t))).alias("similarity")))
        said = F.transform(checked, lambda s: F.struct(
            place.cast("int").alias("paragraph"),
            F.when((s["none"] >= 0.5) | ~F.exists(words, lambda w: F.array_contains(F.array(*map(F.lit, MARKERS)), w)), NONE).when((s["p"] >= self.threshold) & (s["similarity"] >= CONFIRM), s["family"]).otherwise(UNKNOWN).alias("family"),
            s["p"].alias("probability"), s["similarity"].alias("similarity")))
        marked = F.exists(words, lambda w: F.array_contains(F.array(*map(F.lit, MARKERS)), w))
        header = F.transform(F.array(F.when(marked, mine)), lambda m: F.when(m.isNotNull(), _header(m, around)))
        return F.get(F.zip_with(said, header, lambda n, h: F.when(h.isNull() | ~n["family"].isin(NONE, UNKNOWN), n).otherwise(
            F.struct(n["paragraph"], h["family"].alias("family"), n["probability"], h["similarity"].alias("similarity")))), 0)


def _header(mine: Column, around: Column) -> Column:
    """(similarity, family) of the header that a line with the shingles ``mine`` is part of, or null.
    Containment goes both ways: the line's shingles lie in the header, and of the lines joined with
    their neighbours, ``around``, either most lie in the header or they hold most of it."""
    headers = _constant([{"family": f, "shingles": _local_shingles(t)} for f, t in HEADERS.items()], "array<struct<family:string,shingles:array<string>>>")
    parts = F.filter(headers, lambda h: (F.size(mine) >= HEADER_SHINGLES) & (F.size(F.array_intersect(h["shingles"], mine)) >= CONFIRM * F.size(mine)))

    def compared(ps: Column, joined: Column) -> Column:
        each = F.transform(ps, lambda h: F.transform(F.array(F.size(F.array_intersect(h["shingles"], joined))), lambda n: F.struct(
            (n / F.least(F.size(h["shingles"]), F.size(joined))).alias("similarity"), h["family"].alias("family")))[0])
        return F.array_max(F.filter(each, lambda e: e["similarity"] >= CONFIRM))

    found = lambda ps: F.when(F.size(ps) > 0, F.transform(F.array(_shingles(_words(around))), lambda joined: compared(ps, joined))[0])
    return F.transform(F.array(parts), found)[0]


def _around(raw: Column, at: Column) -> Column:
    """The line ``at`` of ``raw`` with up to :data:`AROUND` lines on both sides, up to a line without
    letters and digits, joined."""
    border = r"\n[^\p{L}\p{N}\n]*(?=\n)"
    before = F.array_join(F.slice(raw, F.greatest(at - AROUND, F.lit(0)) + 1, F.least(at, F.lit(AROUND))), "\n")
    after = F.array_join(F.slice(raw, at + 2, AROUND), "\n")
    before = F.regexp_replace(F.concat(F.lit("\n"), before, F.lit("\n")), "(?s)^.*" + border, "")
    after = F.regexp_replace(F.concat(F.lit("\n"), after, F.lit("\n")), "(?s)" + border + ".*$", "")
    return F.concat(before, F.lit(" "), F.get(raw, at), F.lit(" "), after)


def _local_shingles(notice: str) -> list[str]:
    words = "".join(c if c.isascii() and c.isalnum() else " " for c in notice.replace("{x}", "").lower()).split()
    return sorted({" ".join(words[i: i + 3]) for i in range(max(1, len(words) - 2))})


def _softmax(z: list[float], t: float) -> list[float]:
    top = max(z)
    e = [math.exp((x - top) / t) for x in z]
    return [x / sum(e) for x in e]


def scan(docs: DataFrame, model: LicenseModel | None = None) -> DataFrame:
    """``docs`` with ``n_paragraphs`` (lines with a word), ``notices`` (an array of paragraph number
    from 0, family or unknown, probability, similarity, in order) and ``families`` (sorted, distinct).

    Columns of these names in ``docs`` are replaced.  Defined cases: a null or empty text has no
    paragraphs and no notices; equal paragraphs each count; a very long line is one paragraph; of
    families with equal probability the first by name is taken; an empty table gives an empty table.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    model = model or LicenseModel(docs.sparkSession)
    docs = docs.drop("n_paragraphs", "notices", "families")
    paragraphs, candidates = fresh("_paragraphs", docs.columns), fresh("_candidates", docs.columns)
    # a column of its own: inside the lambdas below an expression would split the text again for each line
    raw_lines = fresh("_lines", docs.columns)
    docs = docs.withColumn(raw_lines, F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n"))
    raw = F.col(raw_lines)
    lines = F.filter(F.transform(raw, lambda x, at: F.struct(x.alias("x"), at.alias("at"))), lambda s: s["x"].rlike(r"[^\x20\x09-\x0D]"))
    docs = docs.withColumn(paragraphs, lines)
    numbered = F.filter(F.transform(paragraphs, lambda x, i: F.when(_marked(x["x"]), F.struct(x["x"].alias("x"), i.alias("i"), x["at"].alias("at")))), lambda s: s.isNotNull())
    docs = docs.withColumn(candidates, numbered)
    judged = F.filter(F.transform(candidates, lambda s: model.judge(s["x"], s["i"], _around(raw, s["at"]))), lambda n: n["family"] != NONE)
    docs = docs.withColumn("notices", judged).withColumn("n_paragraphs", F.size(paragraphs).cast("long"))
    return docs.withColumn("families", F.array_sort(F.array_distinct(F.col("notices.family")))).drop(raw_lines, paragraphs, candidates)
