"""Licence scans: a paragraph classifier over sparse word n-grams, confirmed by templates.

The classifier is a multinomial logistic regression over word uni- and bigrams, trained by
gradient descent with an L1 penalty on paragraphs made from licence notices (whole, cut,
with words dropped and with other words around) and on paragraphs that speak of licences without
granting one of the known families, or of other things. Weights that stay zero leave the model, so it is a
short table of (n-gram, family, weight). The threshold of the unknown class is calibrated on
notices in other words, of which training saw none.

A paragraph is a line, or wrapped lines that follow each other without a blank one, joined
without their comment marks. The model itself says where to look: bigrams speak for a family only if
one of their words does, so paragraphs without such a word can't be told as a family; all others
are scored, in DataFrame operations.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillon.llm.common import written

UNKNOWN, NONE = "unknown", "none"
# Public licence wording by family, training notices and templates.
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "under the MIT License",
        "This project is licensed under the MIT License, see the LICENSE file for details.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "Apache-2.0": [
        "under the Apache License, Version 2.0",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "GPL-3.0": [
        "under the GNU General Public License",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
        "Released under the GPL version 3 or later.",
    ],
    "LGPL": [
        "under the GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "GNU Lesser General Public License, version 2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
    ],
    "BSD": [
        "BSD-style license",
        "under the 3-clause BSD License",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "MPL-2.0": [
        "Mozilla Public License, version 2.0",
        "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "CC-BY-NC": [
        "under a CC BY-NC 4.0 license",
        "under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "Creative Commons Attribution-NonCommercial",
        "CC BY-NC 4.0",
    ],
    "CC-BY-SA": [
        "under a CC BY-SA 4.0 license",
        "under a Creative Commons Attribution-ShareAlike 4.0 International License",
        "Creative Commons Attribution-ShareAlike",
        "CC BY-SA 4.0",
        "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply.",
    ],
    "CC-BY": [
        "under a CC BY 4.0 license",
        "under a Creative Commons Attribution 4.0 International License",
        "Creative Commons Attribution License",
        "CC BY 4.0",
    ],
    "CC0": [
        "public domain under CC0 1.0",
        "CC0 1.0 Universal",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ],
    "proprietary": [
        "all rights reserved",
        "No part of this publication may be reproduced, distributed or transmitted in any form or by any means without the prior written permission of the publisher.",
        "This software is proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly prohibited.",
    ],
}
# Notices that calibrate the unknown class; training sees none of them.
HELD_OUT: dict[str, list[str]] = {
    "MIT": ["Released under the MIT License.", "Distributed under the terms of the MIT license.", "Permission is granted to any person obtaining a copy of this software to deal in the Software without restriction, including the rights to use, modify and sell copies."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "The code is available under the Apache License, version 2.0, with no warranties of any kind."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "The tool is distributed under the terms of the GNU General Public License as published by the Free Software Foundation."],
    "LGPL": ["Licensed under the GNU Lesser General Public License, version 2.1.", "You may redistribute this library under the terms of the GNU Lesser General Public License."],
    "BSD": ["Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", "Released under the 3-clause BSD License."],
    "MPL-2.0": ["Licensed under the Mozilla Public License, version 2.0.", "This file is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This page is shared under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY": ["Licensed under CC BY 4.0.", "The figures are published under a Creative Commons Attribution 4.0 International License."],
    "CC0": ["Dedicated to the public domain under CC0 1.0.", "The data are released as CC0 1.0 Universal."],
    "proprietary": ["Copyright 2020 by the publisher. All rights reserved.", "Proprietary and confidential: unauthorized copying of this document is strictly prohibited."],
}
# Paragraphs that use licensing words without a known grant.
OTHERS = [
    "The driver showed his license to the officer at the gate.",
    "A fishing license can be bought at the town hall during office hours.",
    "Permission was denied by the server, try again later.",
    "The court heard a case about copyright infringement by the publisher.",
    "The warranty of the kettle covers two years from the day of purchase.",
    "You need permission from your parents to join the trip.",
    "The licensed premises close at midnight and open again at noon.",
    "He renewed the license of the radio station for another year.",
    "Her licence to practise was suspended after the hearing.",
    "The software update failed and the source of the error is not known.",
    "Copyright law differs from country to country and changes with time.",
    "The public library lends books under the usual terms and conditions.",
    "Version 2.0 of the file was published by the foundation in this form.",
    "Use the following conditions with the source code of this project and any later version.",
    "A story of permission and of copyright that grants nothing.",
    "This work is under a Creative Commons license, see the terms.",
    "Released under a public license of its own.",
]
# Frequent words of English, Spanish, German and French, which speak for no family.
FREQUENT = (
    "the of and to in a is that it was for on as with by be at this are or an from not but have his her they you we all which one has can will their there been if more when so no up out my your "
    "de la que el en y los se del las un por con una su para es al lo como o pero sus le ha me sin sobre este ya entre cuando todo der die und den von zu das mit sich des auf ist im dem nicht ein eine "
    "als auch es an werden aus er hat dass sie nach wird bei et les le du est pour qui dans par plus pas au sur ne se ce il sont avec son cette ou"
).split()
TOKEN = r"[a-z0-9]+"
MARKS = r"^\s*(?:(?://+!?|/\*+!?|\*+/?|#+|--+|;+|%+|<!--|>+)\s*)*|\s*(?:\*+/|-->|\*+|#+)?\s*$"
# Wrapped notices: so many lines, of at most so many characters, are joined.
JOINED, WRAPPED = (1, 2, 4, 8, 16), 160


@dataclass(frozen=True)
class Settings:
    """samples: made paragraphs a notice; unknown_quantile: share of the held-out paragraphs told right that may fall below the threshold."""

    samples: int = 24
    epochs: int = 30
    rate: float = 1.0
    l1: float = 2e-4
    unknown_quantile: float = 0.02
    confirm: float = 0.5
    seed: int = 11


@dataclass(frozen=True)
class Model:
    weights: tuple[tuple[str, str, float], ...]
    bias: tuple[tuple[str, float], ...]
    threshold: float
    settings: Settings

    def telling(self) -> list[str]:
        """The words that speak for a family more than for none. Where no word of a paragraph does, none of its n-grams does."""
        rows: dict[str, dict[str, float]] = {}
        for g, c, w in self.weights:
            rows.setdefault(g, {})[c] = w
        return sorted(g for g, row in rows.items() if " " not in g and max((w for c, w in row.items() if c != NONE), default=0.0) > row.get(NONE, 0.0))


def tokens_of(text: str) -> list[str]:
    return re.findall(TOKEN, text.lower())


def grams_of(words: list[str]) -> set[str]:
    return {*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))}


def _made(words: list[str], rng: random.Random, fill: list[str]) -> list[str]:
    out = [w for w in words if rng.random() > 0.08] or words
    if len(out) > 8 and rng.random() < 0.4:
        a = rng.randrange(0, len(out) // 3)
        out = out[a : a + max(6, len(out) * 2 // 3)]
    lead, trail = ([rng.choice(fill) for _ in range(rng.choice((0, 0, 1, 3, 8)))] for _ in range(2))
    return lead + out + trail


@lru_cache(maxsize=4)
def trained(settings: Settings = Settings()) -> Model:
    """Train on made paragraphs (some thousand rows, whatever the corpus); calibrate the unknown class on notices that training lacks."""
    rng = random.Random(settings.seed)
    fill = [*FREQUENT, "file", "author", "project", "code", "team", "page", "version", "note", "contact", "name", "2021"]

    def made(notices: dict[str, list[str]]) -> list[tuple[set[str], str]]:
        return [(grams_of(w), family) for family, texts in notices.items() for t in texts for w in [*[_made(tokens_of(t), rng, fill) for _ in range(settings.samples)], *[tokens_of(t)] * 4]]

    soup = [" ".join(rng.choice(fill) for _ in range(rng.randint(4, 40))) for _ in range(20)]
    fit, held = made(TEMPLATES | {NONE: OTHERS + soup}), made(HELD_OUT)
    classes = [*TEMPLATES, NONE]
    seen = set().union(*[grams_of(tokens_of(t)) for texts in [*TEMPLATES.values(), OTHERS] for t in texts])
    # frequent words and single characters say nothing by themselves
    index = {g: i for i, g in enumerate(sorted(g for g in seen if " " in g or (len(g) > 1 and g not in FREQUENT)))}
    at = [np.array(sorted(index[g] for g in grams if g in index), int) for grams, _ in fit]
    sizes = [len(grams) for grams, _ in fit]
    y = [classes.index(f) for _, f in fit]
    weights, bias = np.zeros((len(index), len(classes))), np.zeros(len(classes))
    shuffle = np.random.default_rng(settings.seed)

    def probabilities(rows: np.ndarray, n: int) -> np.ndarray:
        z = bias + weights[rows].sum(axis=0) / np.sqrt(max(n, 1))
        e = np.exp(z - z.max())
        return e / e.sum()

    for epoch in range(settings.epochs):
        rate = settings.rate / (1 + epoch / 8)
        for i in shuffle.permutation(len(fit)):
            step = probabilities(at[i], sizes[i])
            step[y[i]] -= 1
            bias -= rate * 0.1 * step
            moved = weights[at[i]] - rate * step / np.sqrt(sizes[i])
            weights[at[i]] = np.sign(moved) * np.maximum(np.abs(moved) - rate * settings.l1, 0)
    # bigrams speak for a family only where one of their words does
    names = list(index)
    speaks = {g for g, row in zip(names, weights, strict=True) if " " not in g and row[:-1].max() > row[-1]}
    for i, g in enumerate(names):
        if " " in g and not speaks & set(g.split()):
            weights[i, :-1] = np.minimum(weights[i, :-1], weights[i, -1])
    bias[-1] = max(bias[-1], bias[:-1].max() + 1e-6)
    sure = []
    for grams, family in held:
        p = probabilities(np.array([index[g] for g in grams if g in index], int), len(grams))
        if classes[int(p.argmax())] == family:
            sure.append(float(p.max()))
    threshold = sorted(sure)[int(len(sure) * settings.unknown_quantile)]
    table = tuple((g, c, float(w)) for g, row in zip(names, weights, strict=True) for c, w in zip(classes, row, strict=True) if w)
    return Model(table, tuple(zip(classes, map(float, bias), strict=True)), threshold, settings)


def paragraphs(docs: DataFrame, telling: list[str], id_col: str, text_col: str) -> DataFrame:
    """(id, x, first and last line, words) of the paragraphs that begin with a line that holds a telling word.

    Comment marks are dropped. A line is a paragraph, and so are the first 2, 4, 8 and 16 (or all) of the wrapped lines that
    follow it without a blank one between.
    """
    most = JOINED[-1]
    text = F.col(f"`{text_col}`")
    words = lambda line: F.regexp_extract_all(F.lower(line), F.lit(TOKEN), 0)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("x"), F.split(text, r"\r?\n").alias("raw"))
    starts = F.filter(F.transform("raw", lambda x, i: F.when(F.exists(words(x), lambda w: w.isin(telling)), i)), lambda i: i.isNotNull())
    rows = rows.withColumn("starts", starts).filter(F.size("starts") > 0)
    rows = rows.select("id", "x", "raw", F.explode("starts").alias("par"))
    rows = rows.select("id", "x", "par", F.transform(F.expr(f"slice(raw, par + 1, {most})"), lambda x: F.regexp_replace(x, MARKS, "")).alias("lines"))
    stop = F.array_position(F.transform("lines", lambda x: (F.length(x) > 0) & (F.length(x) <= WRAPPED)), F.lit(False))
    fits = F.when(stop == 0, F.size("lines")).otherwise(F.greatest(stop - 1, F.lit(1))).cast("int")
    rows = rows.withColumn("fits", fits)
    sizes = F.array_distinct(F.transform(F.array(*map(F.lit, JOINED)), lambda n: F.least(n, F.col("fits"))))
    rows = rows.select("id", "x", "par", "lines", F.explode(sizes).alias("n"))
    joined = F.array_join(F.slice("lines", 1, F.col("n")), " ")
    return rows.select("id", "x", "par", (F.col("par") + F.col("n") - 1).alias("last"), words(joined).alias("words")).filter(F.size("words") > 0)


def classified(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x, par, last, family, score, template_fit) of each paragraph that may be a notice (lines par to last); x is a hash of its text.

    family is the likeliest one; `unknown` where its probability lies below the calibrated threshold
    or no template of it has at least `confirm` of its bigrams in the paragraph; `none` where the
    likeliest class is none. Of equally likely families the last by name is told.
    """
    spark: SparkSession = docs.sparkSession
    model = model or trained()
    # texts are read and searched once
    pars = written(paragraphs(docs, model.telling(), id_col, text_col).distinct(), "paragraphs")
    bigrams = F.expr("transform(sequence(1, greatest(size(words) - 1, 1)), i -> concat_ws(' ', words[i - 1], get(words, i)))")
    # a paragraph's text decides its class: each distinct one is scored once, however many documents have it
    kinds = pars.select(F.xxhash64("words").alias("kind"), "words").dropDuplicates(["kind"])
    kinds = kinds.withColumn("bigrams", F.array_distinct(bigrams)).select("kind", "bigrams", F.array_distinct(F.concat("words", "bigrams")).alias("grams"))
    kinds = written(kinds, "kinds")
    weights = spark.createDataFrame([(g, c, float(w)) for g, c, w in model.weights], "g string, family string, w double")
    bias = F.create_map(*[x for c, b in model.bias for x in (F.lit(c), F.lit(float(b)))])
    hits = kinds.select("kind", (1 / F.sqrt(F.size("grams"))).alias("scale"), F.explode("grams").alias("g")).join(F.broadcast(weights), "g")  # the model: n-grams of the notices
    z = hits.groupBy("kind", "family").agg(F.round(F.sum(F.col("w") * F.col("scale")), 9).alias("z"))
    z = z.groupBy("kind").agg(F.map_from_entries(F.collect_list(F.struct("family", "z"))).alias("z"))  # a row per class
    classes = F.array(*[F.struct((F.coalesce(F.try_element_at("z", F.lit(c)), F.lit(0.0)) + F.element_at(bias, c)).alias("z"), F.lit(c).alias("family")) for c, _ in model.bias])
    scored = kinds.select("kind", "bigrams").join(z, "kind", "left").withColumn("c", classes)
    top = F.array_max("c")
    scored = scored.withColumn("top", top).withColumn("score", 1 / F.aggregate("c", F.lit(0.0), lambda a, x: a + F.exp(x["z"] - F.array_max("c")["z"])))
    scored = scored.filter(F.col("top.family") != NONE)
    fits = F.lit(0.0)
    for family, texts in TEMPLATES.items():
        for t in texts:
            words = tokens_of(t)
            wanted = sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})
            share = F.size(F.array_intersect("bigrams", F.array(*map(F.lit, wanted)))) / len(wanted)
            fits = F.greatest(fits, F.when(F.col("top.family") == family, share).otherwise(0.0))
    scored = scored.withColumn("fit", fits)
    confirmed = (F.col("score") >= model.threshold) & (F.col("fit") >= model.settings.confirm)
    family = F.when(confirmed, F.col("top.family")).otherwise(UNKNOWN)
    # a row for each text, as a table of its own: Spark can split the other side at a notice that many documents have
    scored = written(scored.select("kind", family.alias("family"), F.round("score", 6).alias("score"), F.round("fit", 6).alias("template_fit")), "scored")
    return pars.select("id", "x", "par", "last", F.xxhash64("words").alias("kind")).join(scored, "kind").drop("kind")


def scanned(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, license, licenses, n_license_paragraphs, score and template_fit of every row of docs.

    licenses lists the families found (unknown included) with commas, by name; license is that of the
    surest paragraph (ties: the first), null where there is none. Null and empty texts have none;
    equal rows each keep a row. Extra columns are not read.
    """
    found = classified(docs, model, id_col, text_col)
    # joined lines count where they are a known family's; lines on their own also as unknown
    found = found.filter((F.col("family") != UNKNOWN) | (F.col("par") == F.col("last"))).withColumn("more", F.col("last") - F.col("par"))
    # joined lines that fit no template better than one of them does by itself add nothing
    inside = F.lit(None).cast("double")
    for n in JOINED[1:]:
        w = Window.partitionBy("id", "x", "family").orderBy("par").rangeBetween(0, n - 1)
        inside = F.when(F.col("more") + 1 >= n, F.max(F.when(F.col("more") == 0, F.col("template_fit"))).over(w)).otherwise(inside)
    found = found.withColumn("inside", inside).filter((F.col("more") == 0) | F.col("inside").isNull() | (F.col("inside") < F.col("template_fit")))
    unit = F.struct((-F.col("template_fit")).alias("order"), "more", "par", "last", "family", "score", "template_fit")
    found = found.groupBy("id", "x").agg(F.array_sort(F.collect_list(unit)).alias("all"))
    apart = lambda u, v: (u["last"] < v["par"]) | (v["last"] < u["par"])
    # of known ones that overlap, those that fit a template best stay
    found = found.withColumn("known", F.filter("all", lambda u: u["family"] != UNKNOWN))
    best = F.aggregate("known", F.slice("known", 1, 0), lambda a, u: F.when(F.forall(a, lambda v: apart(u, v)), F.concat(a, F.array(u))).otherwise(a))
    found = found.withColumn("best", F.when(F.exists("known", lambda u: u["more"] > 0), best).otherwise(F.col("known")))
    # an unknown line that joined lines of a known family hold is explained by them
    found = found.withColumn("joined", F.filter("known", lambda u: u["more"] > 0))
    rest = F.filter("all", lambda u: (u["family"] == UNKNOWN) & F.forall("joined", lambda v: apart(u, v)))
    found = found.select("id", "x", F.explode(F.concat("best", rest)).alias("u")).select("id", "x", "u.*")
    sure = F.struct((F.col("family") != UNKNOWN).alias("known"), "score", (-F.col("par")).alias("p"), "family", "template_fit")
    found = found.groupBy("id", "x").agg(
        F.max(sure).alias("best"), F.array_join(F.array_sort(F.collect_set("family")), ",").alias("licenses"), F.count(F.lit(1)).alias("n_license_paragraphs")
    )
    rows = docs.select(F.col(id_col).alias("__i"), F.xxhash64(text_col).alias("__x"))
    out = rows.join(found, F.col("__i").eqNullSafe(F.col("id")) & (F.col("__x") == F.col("x")), "left")
    return out.select(
        F.col("__i").alias(id_col), F.col("best.family").alias("license"), "licenses", F.coalesce("n_license_paragraphs", F.lit(0).cast("long")).alias("n_license_paragraphs"),
        F.col("best.score").alias("score"), F.col("best.template_fit").alias("template_fit"),
    )
