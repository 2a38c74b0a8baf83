"""Licence scans: a trained paragraph classifier with template confirmation, in DataFrame operations only.

A paragraph is a run of lines that are wrapped: every line of it but the last ends without a full stop, colon or the like, and no
blank line lies between.  A paragraph in which nothing is found is looked at line by line.  Features are the
word 1- to 3-grams of the licence templates and of the counterexamples of ordinary prose below (present or not; those of function words alone are left out); a multinomial logistic regression with an L1 part is
trained on the templates, shortened and embedded, against other prose that uses the same words, and against a bounded sample
of ordinary lines of the scanned table (about ``SAMPLE`` documents by hash, lines without a template's 3-gram).

Calibration: a first model is trained without the last template of every family and every fourth other text, and scores those in all
their frames.  One temperature for the scores by least log-loss, and for each family the probability below which it is not named
so that at least ``PRECISION`` of those named so are right, come from texts it has not seen; the model in use is then trained on
all.  A named family is confirmed if ``CONFIRM`` or more of the neighbouring word pairs of one of its templates occur in the paragraph, one that no other family has among them;
without confirmation or below the threshold a licence-like paragraph is 'unknown'.

A paragraph for which 'none' is likeliest is ordinary prose.  Paragraphs whose words cannot change that are not scored, by a bound on
the model's scores that is exact for the decision: each word has a most that it can add, and the words that add least cannot reach the bound together, so
one of the others must occur.  Scoring is a projection of each document's row, so nothing is shuffled and no
paragraph is cut short.

Null and empty texts have no paragraphs.  Repeated rows give equal results; null doc_ids stay; other columns are ignored.  If the
scanned table is empty, training uses the made examples alone and the result is empty.  Ties between families go to the first by name.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SAMPLE = 400
CONFIRM, PRECISION = 0.7, 0.99
#: Between these lies the probability from which a family is named.
LEAST, MOST = 0.4, 0.9
GRAMS = 3

# fixed values: notices, headers and the telling paragraphs of licence texts by family, as words
TEMPLATES = {
    "agpl": [
        "licensed under the gnu affero general public license version 3",
        "gnu affero general public license version 3",
        "gnu affero general public license",
        "spdx license identifier agpl 3 0",
        "agpl v3",
        "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation "
        "either version 3 of the license or at your option any later version",
        "this program is free software under the terms of the gnu affero general public license",
    ],
    "apache": [
        "licensed under the apache license version 2 0",
        "apache license version 2 0",
        "spdx license identifier apache 2 0",
        "you may not use this file except in compliance with the apache license",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
        "you may obtain a copy of the license at http www apache org licenses license 2 0",
        "distributed under the apache software license",
    ],
    "bsd": [
        "released under the bsd license",
        "licensed under the bsd license",
        "bsd 3 clause license",
        "spdx license identifier bsd 3 clause",
        "spdx license identifier bsd 2 clause",
        "governed by a bsd style license",
        "redistribution and use in source and binary forms with or without modification are permitted",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer "
        "in the documentation and or other materials provided with the distribution",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission",
        "licensed under the 3 clause bsd license",
    ],
    "cc-by": [
        "cc by 4 0",
        "licensed under cc by 4 0",
        "spdx license identifier cc by 4 0",
        "creative commons attribution 4 0 international",
        "this work is licensed under a creative commons attribution 4 0 international license",
    ],
    "cc-by-nc": [
        "cc by nc 4 0",
        "licensed under cc by nc 4 0",
        "spdx license identifier cc by nc 4 0",
        "creative commons attribution noncommercial 4 0 international",
        "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    ],
    "cc-by-sa": [
        "cc by sa 4 0",
        "licensed under cc by sa 4 0",
        "spdx license identifier cc by sa 4 0",
        "creative commons attribution sharealike 4 0 international",
        "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    ],
    "cc0": [
        "dedicated to the public domain under cc0 1 0 with no rights reserved",
        "dedicated under cc0",
        "spdx license identifier cc0 1 0",
        "creative commons cc0 1 0 universal",
        "released under the cc0 1 0 universal public domain license",
    ],
    "gpl": [
        "this work is licensed under the gnu general public license version 3",
        "licensed under the gpl",
        "gnu general public license",
        "gnu general public license version 2",
        "gnu general public license version 3",
        "spdx license identifier gpl 2 0 only",
        "spdx license identifier gpl 3 0 or later",
        "gplv3",
        "gplv2",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation "
        "either version 2 of the license or at your option any later version",
        "you should have received a copy of the gnu general public license along with this program",
        "this program is free software you can redistribute it under the terms of the gnu general public license",
    ],
    "isc": [
        "released under the isc license",
        "isc license",
        "spdx license identifier isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    ],
    "lgpl": [
        "licensed under the gnu lesser general public license version 2 1",
        "gnu lesser general public license version 3",
        "gnu lesser general public license",
        "gnu library general public license version 2",
        "spdx license identifier lgpl 2 1 or later",
        "lgpl v2 1",
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation "
        "either version 2 1 of the license or at your option any later version",
        "this library is free software under the gnu lesser general public license",
    ],
    "mit": [
        "released under the mit license",
        "licensed under the mit license",
        "licensed under mit",
        "available under the mit terms",
        "this project is licensed under the terms of the mit license",
        "the mit license",
        "mit license",
        "mit lizenz",
        "spdx license identifier mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
        "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense "
        "and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
    ],
    "mpl": [
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        "mozilla public license version 2 0",
        "spdx license identifier mpl 2 0",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file "
        "you can obtain one at https mozilla org mpl 2 0",
        "licensed under the mozilla public license version 2 0",
    ],
    "proprietary": [
        "all rights reserved",
        "copyright all rights reserved no part may be reproduced without permission",
    ],
}
#: Licence text of no family here, and prose about licences, much of it with a template's words: the classes 'unknown' and 'none'.
UNKNOWN = [
    "licensed under the terms of our house license",
    "released under the artistic license",
    "distributed under the open software license version 3",
    "this work is licensed under the free art license",
    "licensed under the european union public licence",
    "use is subject to the license agreement",
    "see the license file for the terms of use",
    "released under a permissive license",
    "the licensor grants you a limited license",
    "licensed under the ms reciprocal license",
    "the software is provided as is without warranty of any kind express or implied",
    "the above copyright notice and this permission notice shall be included in all copies",
    "distributed under the boost software license version 1 0",
    "boost software license version 1 0",
    "this work is licensed under a creative commons attribution noderivatives 4 0 international license",
    "licensed under the eclipse public license version 2 0",
    "eclipse public license v 2 0",
    "spdx license identifier zlib",
    "spdx license identifier epl 2 0",
    "the python software foundation license version 2",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it",
    "cc by nd 4 0",
]
NONE = [
    "the driver lost his license after the accident",
    "a fishing license costs ten dollars a year",
    "they debated copyright law for two hours",
    "the pub had no license to sell spirits",
    "all seats are reserved for members",
    "the city licensed two hundred taxis this year",
    "she works for the public radio",
    "a general question about the source of the river",
    "the company released its report on friday",
    "free admission for any person under ten",
    "the warranty covers the engine for two years",
    "use the form to renew your license plate",
    "no part of the road was closed",
    "artists fear that copyright reform hurts them",
    "he was granted permission to leave",
    "rights of way are reserved for walkers",
    "he showed the officer his license",
    "the clinic lost its license in march",
    "pilots need a license to fly at night",
    "the bar applied for a new license",
    "a license is required to hunt deer",
    "doctors licensed in other states may apply",
    "a fishing license fee is due in june",
    "the mit license number was painted on the van",
    "the license number of the car was hidden",
    "an mit license fee is due for the laboratory parking",
    "her driving license exam was hard",
    "the mit license plate holder hung in the hall",
    "an old license plate lay in the yard",
    "the mit license plates were stolen from the lot",
    "license holders must report to the office",
    "license exams take two hours",
    "the mit license exam takes two hours",
    "mit license holders got a letter from the dean",
    "all rights reserved for the owners of the land",
    "rights reserved to the crown under the charter",
    "all rights reserved to the crown were sold",
    "all rights reserved to the heirs were sold in spring",
    "voting is among rights reserved for citizens",
    "the rights reserved for members of the club",
    "the mit students went home",
    "under the treaty all rights reserved for fishermen were lost",
    "apache helicopters landed near the village",
    "the gnu herd crossed the public road in general calm",
    "the creative director gave attribution to the commons committee",
    "an international attribution of the painting is open",
    "the mozilla office hired two hundred people",
    "redistribution of land and use of water with or without a permit",
    "permission to use the hall is granted free of charge to any club",
    "the isc committee met for any purpose it liked",
    "a public license hearing on the general plan",
    "the bsd train line was modified and distributed over two tracks",
    "his license number is on the form",
    "mit license numbers are on the list",
    "a license plate holder of steel",
    "the mit license office is closed on monday",
    "an mit license plate hung on the wall",
    "a license fee of ten dollars is due",
]
FRAMES = [
    "{}",
    "note that {}",
    "{} see the file for details",
    "unless stated otherwise {}",
    "code and data {}",
    "copyright 2021 the authors {}",
    "{} by the project contributors",
    "documentation {} and others",
]
#: Words that tell nothing alone: n-grams of these and of numbers only are no features.
FUNCTION_WORDS = frozenset("a all and any as at be by for from in is it may no not of on or shall that the this to under use v with without you".split())
#: What a line may not end with to be continued by the next.
ENDINGS = r".!?:;"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once: in a lambda an expression from outside would be computed for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def grams_of(text: Column) -> Column:
    """The distinct 1- to GRAMS-grams of a text's words."""
    return _let(words_of(text), grams_of_words)


def grams_of_words(words: Column) -> Column:
    def of_length(n: int) -> Column:
        return F.transform(words, lambda w, i: F.when(i <= F.size(words) - n, F.array_join(F.slice(words, i + 1, n), " ")))

    parts = [of_length(n) for n in range(1, GRAMS + 1)]
    return F.array_distinct(F.filter(F.concat(*parts), lambda g: g.isNotNull()))


def _grams(words: list[str]) -> set[str]:
    return {" ".join(words[i : i + n]) for n in range(1, GRAMS + 1) for i in range(len(words) - n + 1)}


def marks(text: str) -> list[str]:
    """What confirms a template: its distinct pairs of neighbouring words, in order within the pair; a single word is its own mark."""
    words = text.split()
    return list(dict.fromkeys(map(" ".join, zip(words, words[1:])))) or words


def own_marks(family: str, text: str) -> list[str]:
    """Those of the template's marks that no template of another family and no text of the class 'unknown' has; all, if there are none."""
    others = {m for f, texts in {**TEMPLATES, "unknown": UNKNOWN}.items() if f != family for t in texts for m in marks(t)}
    return [m for m in marks(text) if m not in others] or marks(text)


def likeness(grams: set[str], family: str, text: str) -> float:
    """Share of the template's marks among the n-grams of a paragraph; 0 without one of the template's own."""
    return len(grams.intersection(marks(text))) / len(marks(text)) if grams.intersection(own_marks(family, text)) else 0.0


def _telling(word: str) -> bool:
    return word not in FUNCTION_WORDS and not word.isdecimal()


def examples() -> list[tuple[str, str, bool]]:
    """(class, text, held out): templates and counterexamples in all frames; whole texts are held out for calibration."""
    out = []
    for name, texts in {**TEMPLATES, "unknown": UNKNOWN, "none": NONE}.items():
        for i, t in enumerate(texts):
            held = i == len(texts) - 1 if name in TEMPLATES else i % 4 == 3
            out += [(name, frame.format(t), held) for frame in FRAMES]
    return out


@dataclass
class Model:
    classes: list[str]
    bias: list[float]
    weights: dict[str, list[float]]
    temperature: float = 1.0
    thresholds: list[float] = field(default_factory=lambda: [0.5] * len(TEMPLATES))

    def logits(self, text: str) -> list[float]:
        """By plain Python, for the few held-out examples: the scores that ``classify`` computes."""
        out = list(self.bias)
        for g in _grams(re.sub(r"[^\w]+|_", " ", text.lower()).split()):
            if g in self.weights:
                out = [x + w for x, w in zip(out, self.weights[g])]
        return out


def _probabilities(x: list[float], t: float) -> list[float]:
    e = [math.exp((v - max(x)) / t) for v in x]
    return [v / sum(e) for v in e]


def _confirmed(family: str, text: str) -> bool:
    of = _grams(text.split())
    return max(likeness(of, family, t) for t in TEMPLATES[family]) >= CONFIRM


def fit(spark: SparkSession, docs: DataFrame | None = None) -> Model:
    """Trains on the examples and on ordinary lines of about SAMPLE documents."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizerModel

    vocabulary = sorted({g for texts in (*TEMPLATES.values(), NONE) for t in texts for g in _grams(t.split()) if any(map(_telling, g.split()))})
    classes = [*sorted(TEMPLATES), "none", "unknown"]
    made = examples()
    rows = spark.createDataFrame([(*x, False) for x in made], "name string, text string, held boolean, plain boolean")
    if docs is not None:
        some = docs.select("doc_id", "text").where("text is not null and doc_id is not null")
        share = min(1.0, SAMPLE / max(1, some.count()))
        drawn = some.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).limit(2 * SAMPLE)
        lines = drawn.select(F.explode(F.split("text", "\n")).alias("text")).where(F.trim("text") != "").repartition(common.partitions(spark))
        # a line with a template's 3-gram is no example of ordinary prose
        telling = F.array(*(F.lit(g) for g in sorted({g for texts in TEMPLATES.values() for t in texts for g in _grams(t.split())}) if g.count(" ") == 2))
        plain = lines.where(~F.arrays_overlap(grams_of(F.col("text")), telling))
        rows = rows.unionByName(plain.select(F.lit("none").alias("name"), "text", F.lit(False).alias("held"), F.lit(True).alias("plain")))
    label = F.create_map(*(F.lit(x) for i, c in enumerate(classes) for x in (c, float(i))))[F.col("name")]
    counted = CountVectorizerModel.from_vocabulary(vocabulary, "grams", "features", binary=True)
    counted = counted.transform(rows.select("held", "plain", label.alias("label"), grams_of(F.col("text")).alias("grams")))
    # a few thousand short rows at most: the bounded sample and the examples
    counted = common.cut(counted.select("held", "plain", "label", "features"))
    lr = LogisticRegression(family="multinomial", regParam=0.0005, elasticNetParam=0.5, maxIter=60, weightCol="weight", standardization=False)

    def trained(part: DataFrame) -> Model:
        # a row a class; made examples of ordinary prose do not drown in the sampled lines
        size = part.groupBy("label", "plain").agg((1.0 / F.sqrt(F.count("*").cast("double"))).alias("weight"))
        part = common.cut(part.join(F.broadcast(size), ["label", "plain"]))
        got = lr.fit(part)
        matrix = got.coefficientMatrix.toArray()
        return Model(
            classes,
            [float(x) for x in got.interceptVector],
            {g: [float(x) for x in matrix[:, j]] for j, g in enumerate(vocabulary) if abs(matrix[:, j]).max() > 1e-6},
        )

    first = trained(counted.where("not held"))
    held = [(classes.index(name), text, first.logits(text)) for name, text, out in made if out]
    temperature = min(
        (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0),
        key=lambda t: -sum(math.log(max(1e-12, _probabilities(x, t)[k])) for k, _, x in held),
    )
    named = []
    for k, text, x in held:
        p = _probabilities(x, temperature)
        best = max(range(len(TEMPLATES)), key=p.__getitem__)
        if p[best] >= p[classes.index("none")] and _confirmed(classes[best], text):
            named.append((best, p[best], best == k))
    model = trained(counted)
    model.temperature = temperature
    model.thresholds = [least_threshold([(p, ok) for f, p, ok in named if f == i]) for i in range(len(TEMPLATES))]
    return model


def least_threshold(named: list[tuple[float, bool]]) -> float:
    """The least probability, of LEAST and those just above a wrong name, from which PRECISION of the named are right; MOST at most."""
    for cut_at in sorted({LEAST, *(p + 1e-6 for p, ok in named if not ok and p >= LEAST)}):
        right = [ok for p, ok in named if p >= cut_at]
        if sum(right) >= PRECISION * len(right):
            return min(cut_at, MOST)
    return MOST


def bounds(model: Model) -> tuple[dict[str, float], float]:
    """(word: most that n-grams with it can raise a class over 'none'), and the sum up to which 'none' stays the likeliest.

    Each n-gram counts at its longest word that tells something, which is there if the n-gram is.
    """
    none = model.classes.index("none")
    gain: dict[str, float] = {}
    for g, w in model.weights.items():
        word, most = max(g.split(), key=lambda x: (_telling(x), len(x))), max(x - w[none] for x in w)
        if most > 0:
            gain[word] = gain.get(word, 0.0) + most
    return gain, model.bias[none] - max(b for i, b in enumerate(model.bias) if i != none) - 1e-6


def telling_words(gain: dict[str, float], least: float) -> list[str]:
    """Words of which one must occur for the sum to reach ``least``: all others together stay below it."""
    out, rest = [], 0.0
    for w in sorted(gain, key=lambda w: (gain[w], w)):
        rest += gain[w]
        if rest >= least:
            out.append(w)
    return out


def may_tell(text: Column, model: Model) -> Column:
    """False only for texts none of whose paragraphs can be found: none of the telling words is in them."""
    gain, least = bounds(model)
    if least < 0:
        return F.lit(True)
    words = telling_words(gain, least)
    if not words:
        return F.lit(False)
    # by first letter, so that few alternatives are tried at a word
    rest = {x: sorted(w[1:] for w in words if w[0] == x) for x in sorted({w[0] for w in words})}
    any_of = "|".join(f"{x}(?:{'|'.join(r)})" for x, r in rest.items())
    return F.lower(text).rlike(rf"(?<![\p{{L}}\p{{N}}])(?:{any_of})(?![\p{{L}}\p{{N}}])")


def may_be_found(paragraph: Column, model: Model) -> Column:
    """False only for paragraphs that are surely 'none'."""
    gain, least = bounds(model)
    if least < 0 or not gain:
        return F.lit(least < 0)
    of = F.create_map(*(F.lit(x) for kv in gain.items() for x in kv))
    known = F.array_intersect(words_of(paragraph), F.array(*map(F.lit, gain)))
    return may_tell(paragraph, model) & (F.aggregate(known, F.lit(0.0), lambda a, w: a + of[w]) >= F.lit(least))


def classify(paragraph: Column, model: Model) -> Column:
    """struct(family, probability, similarity) of a paragraph; family is 'none' for ordinary prose."""
    table = F.create_map(*(x for g, w in model.weights.items() for x in (F.lit(g), F.array(*map(F.lit, w)))))
    families = sorted(TEMPLATES)
    def template(f, t):
        return F.struct(F.array(*map(F.lit, marks(t))).alias("all"), F.array(*map(F.lit, own_marks(f, t))).alias("own"))

    wanted = F.array(*(F.array(*(template(f, t) for t in TEMPLATES[f])) for f in families))

    def scored(words):
        logits = F.aggregate(
            F.filter(F.transform(grams_of_words(words), lambda g: table[g]), lambda w: w.isNotNull()),
            F.array(*map(F.lit, model.bias)),
            lambda a,
            w: F.zip_with(a, w, lambda x, y: x + y),
        )
        scaled = F.transform(logits, lambda x: x / F.lit(model.temperature))
        return _let(
            scaled,
            lambda z: _let(F.transform(z, lambda x: F.exp(x - F.array_max(z))), lambda e: F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, y: a + y))),
        )

    def decide(found, p):
        best = F.array_position(F.slice(p, 1, len(families)), F.array_max(F.slice(p, 1, len(families)))).cast("int")
        top = F.array_max(F.slice(p, 1, len(families)))
        like = F.array_max(F.transform(F.element_at(wanted, best), lambda t: F.when(F.arrays_overlap(t["own"], found), F.size(F.array_intersect(t["all"], found)) / F.size(t["all"])).otherwise(0.0)))
        none = F.element_at(p, model.classes.index("none") + 1)
        named = (top >= F.element_at(F.array(*map(F.lit, model.thresholds)), best)) & (like >= F.lit(CONFIRM)) & (top >= none)
        family = F.when(named, F.element_at(F.array(*map(F.lit, families)), best)).when(none >= F.array_max(p), "none").otherwise("unknown")
        return F.struct(family.alias("family"), top.alias("probability"), like.alias("similarity"))

    return _let(words_of(paragraph), lambda words: _let(scored(words), lambda p: _let(grams_of_words(words), lambda found: decide(found, p))))


FOUND = "array<struct<at int, c struct<family string, probability double, similarity double>>>"


def paragraphs(text: Column) -> Column:
    """array<struct<at, u>> of the paragraphs: at is the number of the first line, u the paragraph's lines (at, s)."""
    split = F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")
    numbered = F.transform(split, lambda s, i: F.struct(i.cast("int").alias("at"), F.trim(F.regexp_replace(s, r"[ \t\r]+", " ")).alias("s")))

    def of_lines(lines):
        # numbers of the lines that begin a paragraph: after a blank line, or after a line that ends a sentence
        starts = F.filter(lines, lambda x, i: (x.s != "") & ((i == 0) | F.get(lines, i - 1)["s"].rlike(rf"^$|[{ENDINGS}]$")))
        return _let(F.transform(starts, lambda x: x["at"]), lambda first: runs(lines, first))

    def runs(lines, first):
        cut_out = F.transform(
            first,
            lambda at,
            k: F.struct(at.alias("at"), F.slice(lines, at + 1, F.coalesce(F.get(first, k + 1), F.size(lines)) - at).alias("u")),
        )
        return F.transform(cut_out, lambda r: F.struct(r.at.alias("at"), F.filter(r.u, lambda x: x.s != "").alias("u")))

    return _let(numbered, of_lines)


def _found(text: Column, model: Model) -> Column:
    """array<struct<at, c>> of the paragraphs found, or else their lines."""

    def one(at, s):
        return _let(s, lambda t: F.struct(at.alias("at"), F.when(may_be_found(t, model), classify(t, model)).alias("c")))

    def of(p):
        def by_line(_):
            return F.filter(F.transform(p.u, lambda x: one(x["at"], x["s"])), lambda x: F.coalesce(x["c"]["family"], F.lit("none")) != "none")

        whole = one(p["at"], F.array_join(F.transform(p.u, lambda x: x["s"]), " "))
        return _let(
            whole,
            lambda w: F.when(F.coalesce(w["c"]["family"], F.lit("none")) != "none", F.array(w)).when(F.size(p.u) > 1, by_line(w)).otherwise(F.slice(F.array(w), 1, 0)),
        )

    return F.flatten(F.transform(paragraphs(text), of))


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per document: doc_id, licenses (families found, by name), n_paragraphs named or unknown, and the
    paragraphs found as a list of structs (at, family, probability, similarity); at is the number of the first line."""
    model = model or fit(docs.sparkSession, docs)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = _found(F.col("text"), model)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("like", may_tell(text, model))
    # texts without a telling word have no paragraph to look at
    rows = rows.select("doc_id", F.when(F.col("like"), found).otherwise(F.array().cast(FOUND)).alias("found"))
    return rows.select(
        "doc_id",
        F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda x: x.c.family))), ",").alias("licenses"),
        F.size("found").cast("long").alias("n_paragraphs"),
        F.transform(
            "found",
            lambda x: F.struct(x["at"].alias("at"), x.c.family.alias("family"), F.round(x.c.probability, 6).alias("probability"), F.round(x.c.similarity, 6).alias("similarity")),
        ).alias("found"),
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "licenses", "n_paragraphs", F.to_json("found").alias("found"))


QUERIES = {"op5_license_scan": op5_license_scan}
ORACLES: dict[str, str] = {}
