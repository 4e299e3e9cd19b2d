"""Licence statements in texts, by a trained paragraph classifier.

A paragraph is a run of lines between blank lines, or lines of comment marks alone; its words run
on over the ends of lines, so hard-wrapped notices are whole. A multinomial logistic regression
over hashed word unigrams and bigrams tells licence families and an unknown class apart. It is
fitted on the statements and names below with small variations and among other words, and on a
bounded, hash-chosen sample of the corpus's own lines as the unknown class, with anchor words (below)
and without. Every fourth statement, in all its forms, is held out to calibrate the probabilities with
a temperature; the model is then fitted again on all.

A paragraph is judged by overlapping windows of words, of several sizes, and by its short lines.
The model names a family for each window or says that it is none. What it names is then compared
with that family's statements: the family stands if the window holds ``CONFIRM`` of the word bigrams
of one of them, or the line is no more than a name of the licence. A family goes if a window that
overlaps holds more of another. As a statement takes at least one of its anchor words, and every
name has one, windows without any anchor are not classified, and nothing confirmed is lost by it.

Everything is DataFrame functions and Spark's own estimator, on the executors and in the JVM.

Defined results: for every paragraph that has an anchor word, one row for each family found in it,
or one with family ``unknown`` and what the model says of its likeliest window. Null and empty texts
have no rows; repeated rows are scanned each for itself; very long paragraphs cost time in proportion;
no rows give no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.shared_files import stored

FEATURES = 1 << 14
SAMPLE = 4000  # lines of the unknown class without, and as many with an anchor word, that the fit sees, whatever the corpus
UNLIKE = 0.3  # of a statement's bigrams: lines that hold less may stand for the unknown class
CONFIRM = 0.7
LEAST = 0.5
TEMPERATURES = (0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 4.0)
UNKNOWN = "unknown"

# The licences' own notices and the usual ways to name them.
STATEMENTS = {
    "Apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License 2.0.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GNU General Public License.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0": (
        "Released under CC0 1.0.",
        "To the extent possible under law, the author has dedicated all copyright to this work to the public domain under CC0.",
    ),
}
# Lines of nothing else.
NAMES = {
    "Apache": ("Apache License", "Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "License: Apache-2.0", "License: Apache 2.0"),
    "MIT": ("MIT License", "The MIT License", "MIT License (MIT)", "The MIT License (MIT)", "License: MIT", "License: MIT License"),
    "GPL": ("GNU General Public License", "GNU General Public License, version 3", "License: GPL", "License: GPLv3", "License: GPL-3.0", "License: GPL-3.0-or-later"),
    "LGPL": ("GNU Lesser General Public License", "GNU Lesser General Public License, version 2.1", "License: LGPL", "License: LGPL-2.1", "License: LGPLv3"),
    "BSD": ("BSD License", "BSD 3-Clause License", "The BSD 3-Clause License", "License: BSD", "License: BSD-3-Clause"),
    "MPL": ("Mozilla Public License", "Mozilla Public License 2.0", "Mozilla Public License Version 2.0", "License: MPL-2.0"),
    "CC-BY": ("License: CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA": ("License: CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC": ("License: CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC0": ("License: CC0", "License: CC0 1.0", "License: CC0-1.0"),
}
LINE = 12  # words of the longest line that may be a name
WINDOWS = (6, 12, 24, 48)  # words; each starts half a window after the last, and the longest statement has 22
LOOKALIKES = (
    "All rights reserved.",
    "You need a driving licence to work here.",
    "The license plate was found under the bridge.",
    "See the license terms for details.",
    "He was released under the supervision of the court.",
    "The general public was not permitted to use the source.",
    "The plan was permitted provided that the conditions are met.",
    "Copyright law is hard to obtain a copy of.",
)


def _words(text: str) -> list[str]:
    return [w for w in re.sub(r"[0-9]+", "#", re.sub(r"[^a-z0-9]+", " ", text.lower())).split(" ") if w]


def _pairs(words: list[str]) -> list[str]:
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def anchors() -> list[str]:
    """Words of which every confirmed paragraph has one: without them less than ``CONFIRM`` of a
    statement's bigrams are left."""
    chosen: set[str] = set()
    for statement in (s for family in STATEMENTS.values() for s in family):
        pairs = _pairs(_words(statement))
        while sum(not chosen & {*p.split(" ")} for p in pairs) >= CONFIRM * len(pairs):
            chosen.add(max(({w for p in pairs for w in p.split(" ")} - chosen), key=lambda w: (w.startswith("licen"), len(w), w)))
    return sorted(chosen)


def word_list(text: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]++", " "), "[0-9]++", "#")
    return F.filter(F.split(plain, " "), lambda w: w != "")


def bigrams(words: Column) -> Column:
    after = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    both = F.zip_with(F.slice(words, 1, F.size(after)), after, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(both)


def _features(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("grams", F.concat("words", bigrams(F.col("words"))))
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="features").transform(rows)


def _sampled(lines: DataFrame, sample: int) -> DataFrame:
    """The distinct lines of the smallest hashes: first the hashes alone, then the few texts."""
    lines = lines.select("paragraph", F.xxhash64("paragraph").alias("hash"))
    most = lines.select("hash").distinct().orderBy("hash").limit(sample).agg(F.max("hash").alias("most")).first()["most"]
    return lines.where(F.col("hash") <= F.lit(most)).distinct().withColumn("words", word_list(F.col("paragraph")))


def _examples(spark: SparkSession, lines: DataFrame, sample: int) -> DataFrame:
    """words, family, held: statements as they are, cut at either end and among other words; names;
    and of the corpus the beginnings of lines, and the surroundings of anchor words."""
    plain = _sampled(lines.where(~_anchored(F.col("paragraph"))), sample)
    plain = plain.select("hash", F.slice("words", 1, WINDOWS[-1]).alias("words"), F.row_number().over(Window.orderBy("hash", "paragraph")).alias("rank"))
    plain = stored(plain.where(F.size("words") > 0), "license-plain")  # ``sample`` rows
    near = _sampled(lines.where(_anchored(F.col("paragraph"))), sample).withColumn("id", F.monotonically_increasing_id())
    around = F.greatest(F.get(_anchor_places(F.col("words")), F.lit(0)) - WINDOWS[1], F.lit(1))
    near = stored(near.withColumn("words", F.slice("words", around, WINDOWS[2])).where(F.size("words") > 0), "license-anchored")
    names = sorted({" ".join(_words(n)) for all_ in NAMES.values() for n in all_})
    like = near.select("id", F.explode(bigrams(F.col("words"))).alias("pair")).join(_known(spark), "pair")
    like = like.groupBy("id", "statement", "parts").count().where(F.col("count") >= UNLIKE * F.col("parts")).select("id").distinct()
    near = near.join(like, "id", "left_anti").where(~F.array_join("words", " ").isin(names))

    said = [(f"statement {k}", f, _words(x)) for k, (f, x) in enumerate((f, x) for f, all_ in STATEMENTS.items() for x in all_)]
    said += [(f"other {k}", UNKNOWN, _words(x)) for k, x in enumerate(LOOKALIKES)]
    known = spark.createDataFrame(said, "name string, family string, words array<string>")
    known = known.withColumn("shape", F.explode(F.sequence(F.lit(0), F.lit(8))))
    known = known.withColumn("rank", F.pmod(F.xxhash64("name", "shape"), F.lit(max(plain.count(), 1))) + 1).join(F.broadcast(plain.select("rank", F.col("words").alias("rest"))), "rank", "left")
    n = F.size("words")
    rest = F.slice(F.coalesce("rest", F.array().cast("array<string>")), F.lit(1), F.greatest(n, F.lit(6)))
    half = F.ceil(F.size(rest) / 2).cast("int")
    quarter = F.floor(n / 4).cast("int")
    shapes = [
        F.col("words"), F.slice("words", 2, n), F.slice("words", F.lit(1), F.greatest(n - 1, F.lit(1))),
        F.slice("words", quarter + 1, n), F.slice("words", F.lit(1), n - quarter),
        F.concat(rest, "words"), F.concat("words", rest), F.concat(F.slice(rest, F.lit(1), half), "words", F.slice(rest, half + 1, n)),
        F.concat(F.slice(rest, F.lit(1), half), F.slice("words", F.lit(1), n - quarter)),
    ]
    known = known.withColumn("words", F.get(F.array(*shapes), F.col("shape")))
    named = spark.createDataFrame([(f"name {x}", f, _words(x)) for f, all_ in NAMES.items() for x in all_], "name string, family string, words array<string>")
    known = known.select("name", "family", "words").unionByName(named)
    other = plain.select("hash", "words").unionByName(near.select("hash", "words"))
    other = other.select(F.col("hash").cast("string").alias("name"), F.lit(UNKNOWN).alias("family"), "words")
    return stored(known.unionByName(other).withColumn("held", F.pmod(F.xxhash64("name"), F.lit(4)) == 0), "license-examples")


def _anchor_places(words: Column) -> Column:
    """The places, from 1, of the anchor words."""
    at = F.transform(words, lambda w, i: F.when(w.isin(anchors()), i + 1))
    return F.filter(at, lambda i: i.isNotNull())


def _anchored(text: Column) -> Column:
    return text.rlike(f"(?i)(?<![a-z0-9])(?:{'|'.join(re.escape(w).replace('\\#', '[0-9]+') for w in anchors())})(?![a-z0-9])")


def _lines(docs: DataFrame) -> DataFrame:
    return docs.select(F.explode(F.split("text", "\n")).alias("paragraph")).where(F.col("paragraph").rlike(r"[^\x20\x09-\x0D]"))


def _paragraphs(docs: DataFrame) -> DataFrame:
    blank = r"\n[\x20\x09\x0B-\x0D#*/;%>-]*+(?=\n)"
    runs = docs.select("key", F.posexplode(F.split("text", blank)).alias("place", "paragraph"))
    return runs.withColumn("paragraph", F.regexp_replace("paragraph", "^\n", "")).where(F.col("paragraph").rlike(r"[^\x20\x09-\x0D]"))


def _known(spark: SparkSession) -> DataFrame:
    """(pair, family, statement, parts): the word bigrams of the statements, and of how many each is one."""
    rows, number = [], 0
    for family, every in enumerate(STATEMENTS.values()):
        for pairs in (_pairs(_words(s)) for s in every):
            rows += [(p, family, number, len(pairs)) for p in pairs]
            number += 1
    return F.broadcast(spark.createDataFrame(rows, "pair string, family int, statement int, parts int"))


def _windows(found: DataFrame) -> DataFrame:
    """unit, size, start and words of every window, and of every line of up to ``LINE`` words
    (size 0, start its number), that has an anchor word."""
    n = F.size("words")

    def over(size: int) -> Column:
        """Of the windows that start every half ``size`` words, those with an anchor word, as start * 64 + size."""
        half = size // 2
        last = F.floor((F.greatest(n - half, F.lit(1)) - 1) / half)

        def starts(at: Column) -> Column:
            low = F.greatest(F.ceil((at - size) / half), F.lit(0))
            high = F.least(F.floor((at - 1) / half), last)
            return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))

        return F.transform(F.array_distinct(F.flatten(F.transform("places", starts))), lambda k: (k * half + 1) * 64 + size)

    rows = found.select("unit", "words", "lines", _anchor_places(F.col("words")).alias("places"))
    rows = rows.withColumn("codes", F.concat(*[over(size) for size in WINDOWS]))
    cut = F.transform("codes", lambda c: _window(c % 64, F.floor(c / 64), F.slice("words", F.floor(c / 64).cast("int"), (c % 64).cast("int"))))
    lines = F.transform("lines", lambda line, i: _window(F.lit(0), i, line))
    lines = F.filter(lines, lambda w: (F.size(w["words"]) <= LINE) & F.exists(w["words"], lambda x: x.isin(anchors())))
    return rows.select("unit", F.explode(F.concat(cut, lines)).alias("window")).select("unit", "window.*")


def _window(size: Column, start: Column, words: Column) -> Column:
    return F.struct(size.cast("int").alias("size"), start.cast("long").alias("start"), words.alias("words"))


def _shares(windows: DataFrame) -> DataFrame:
    """unit, size, start and held: for each family the share of the best statement's bigrams."""
    place = ["unit", "size", "start"]
    hits = windows.select(*place, F.explode(bigrams(F.col("words"))).alias("pair")).join(_known(windows.sparkSession), "pair")
    best = hits.groupBy(*place, "family", "statement", "parts").count().withColumn("share", F.col("count") / F.col("parts"))
    each = [F.coalesce(F.max(F.when(F.col("family") == k, F.col("share"))), F.lit(0.0)) for k in range(len(STATEMENTS))]
    return best.groupBy(*place).agg(F.array(*each).alias("held"))


def _confirmed(said: DataFrame, confirm: float) -> DataFrame:
    """unit and found: the families (with probability and similarity) that templates confirm among
    the windows the model gave a family."""
    families = F.array(*map(F.lit, STATEMENTS))
    names = [F.col("line").isin(sorted({" ".join(_words(x)) for x in all_})) & (F.col("predicted") == f) for f, all_ in NAMES.items()]
    named = F.when(F.col("size") == 0, reduce(or_, names)).otherwise(False)
    none = F.array_repeat(F.lit(0.0), len(STATEMENTS))
    rows = said.withColumn("line", F.array_join("words", " ")).select("unit", "size", "start", "predicted", "probability", named.alias("named"))
    rows = rows.join(_shares(said.where("size > 0")), ["unit", "size", "start"], "left").withColumn("held", F.coalesce("held", none))
    rows = rows.withColumn("own", F.element_at("held", F.array_position(families, F.col("predicted")).cast("int")))
    rows = rows.where(F.col("named") | (F.array_max("held") >= confirm))
    windows = rows.groupBy("unit").agg(F.collect_list(F.struct("size", "start", "predicted", "probability", "named", "own", "held")).alias("windows"))

    def best(family: str) -> Column:
        mine = F.filter("windows", lambda w: (w["predicted"] == family) & (w["named"] | (w["own"] >= confirm)))
        rank = lambda w: F.struct(
            w["named"].alias("named"), F.when(w["named"], 1.0).otherwise(w["own"]).alias("similarity"), (-w["size"]).alias("less"), w["probability"].alias("probability"), w["start"].alias("start")
        )
        return F.transform(F.array(F.array_max(F.transform(mine, rank))), lambda c: F.struct(F.lit(family).alias("family"), c.alias("at")))[0]

    over = lambda c, w: (w["size"] > 0) & (w["start"] < c["start"] - c["less"]) & (c["start"] < w["start"] + w["size"])
    more = lambda f, c, w: F.exists(F.arrays_zip(families.alias("family"), w["held"].alias("held")), lambda h: (h["family"] != f) & (h["held"] > c["similarity"]))
    claims = F.filter(F.array(*map(best, STATEMENTS)), lambda c: c["at"].isNotNull())
    windows = windows.withColumn("claims", claims)
    stands = lambda c: c["at"]["named"] | ~F.exists("windows", lambda w: over(c["at"], w) & more(c["family"], c["at"], w))
    found = F.transform(F.filter("claims", stands), lambda c: F.struct(c["family"].alias("family"), c["at"]["probability"].alias("probability"), c["at"]["similarity"].alias("similarity")))
    return windows.select("unit", F.explode(found).alias("found")).select("unit", "found.*")


def _chances(raw: Column, temperature: float) -> Column:
    """Softmax of the scores over the temperature."""
    scaled = F.transform(raw, lambda x: F.exp((x - F.array_max(raw)) / temperature))
    return F.transform(scaled, lambda x: x / F.aggregate(scaled, F.lit(0.0), lambda a, b: a + b))


class Classifier:
    """The fitted model and its temperature."""

    def __init__(self, spark: SparkSession, lines: DataFrame, sample: int):
        self.families = [*STATEMENTS, UNKNOWN]
        self.names = F.array(*map(F.lit, self.families))
        examples = _examples(spark, lines, sample)
        every = spark.range(len(self.families)).select(F.lit("").alias("name"), F.get(self.names, F.col("id").cast("int")).alias("family"), F.array().cast("array<string>").alias("words"), F.lit(False).alias("held"))
        # a family has some rows, the unknown class thousands; a row without words makes every class known
        weight = F.when(F.size("words") == 0, 1e-6).when(F.col("family") == UNKNOWN, 1.0).otherwise(20.0)
        rows = _features(examples.unionByName(every)).withColumn("weight", weight)
        rows = rows.withColumn("label", (F.array_position(self.names, F.col("family")) - 1).cast("double"))
        fit = LogisticRegression(family="multinomial", regParam=1e-3, maxIter=40, weightCol="weight")
        self.model = fit.fit(rows.where("NOT held"))
        scored = self.scores(rows.where("held")).withColumn("at", F.col("label").cast("int") + 1)
        loss = [F.avg(-F.log(F.greatest(F.element_at(_chances(F.col("raw"), t), F.col("at")), F.lit(1e-12)))).alias(str(k)) for k, t in enumerate(TEMPERATURES)]
        found = scored.agg(*loss).first()
        self.temperature = TEMPERATURES[min((v if v is not None else 0.0, abs(TEMPERATURES[k] - 1), k) for k, v in enumerate(found))[2]]
        self.model = fit.fit(rows)

    def scores(self, rows: DataFrame) -> DataFrame:
        return self.model.transform(rows).withColumn("raw", vector_to_array("rawPrediction"))

    def judge(self, windows: DataFrame) -> DataFrame:
        """``windows`` with predicted, the likeliest family, and probability, that it is any family's."""
        scored = self.scores(_features(windows)).withColumn("chances", _chances(F.col("raw"), self.temperature))
        known = F.slice("chances", 1, len(STATEMENTS))
        scored = scored.withColumn("predicted", F.element_at(self.names, F.array_position(known, F.array_max(known)).cast("int")))
        return scored.select(*windows.columns, "predicted", (1.0 - F.element_at("chances", len(self.families))).alias("probability"))


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE, confirm: float = CONFIRM, least: float = LEAST) -> DataFrame:
    """``key``, paragraph_no, paragraph, family, predicted, probability (that the model gives to its
    being a licence) and similarity (the share of the best statement's bigrams that the window holds,
    1 for a name, null if nothing was confirmed) of each paragraph with an anchor word, a row for each
    family found in it."""
    if confirm < CONFIRM:
        raise ValueError(f"anchor words hold for a confirmation of {CONFIRM} or more")
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    model = Classifier(spark, _lines(rows), sample)
    found = _paragraphs(rows.where(_anchored(F.col("text")))).where(_anchored(F.col("paragraph")))
    found = found.select("*", word_list(F.col("paragraph")).alias("words"), F.transform(F.split("paragraph", "\n"), word_list).alias("lines"))
    found = stored(found.withColumn("unit", F.monotonically_increasing_id()), "license-words")
    judged = model.judge(_windows(found)).withColumn("words", F.when(F.col("probability") >= least, F.col("words")))
    judged = stored(judged, "license-windows")
    claims = _confirmed(judged.where(F.col("probability") >= least), confirm).withColumn("predicted", F.col("family"))
    best = F.max(F.struct("probability", "predicted")).alias("best")
    rest = judged.groupBy("unit").agg(best).select("unit", "best.*").join(claims.select("unit").distinct(), "unit", "left_anti")
    rest = rest.withColumn("family", F.lit(UNKNOWN)).withColumn("similarity", F.lit(None).cast("double"))
    out = found.select("unit", "key", "place", "paragraph").join(claims.unionByName(rest), "unit", "left")
    out = out.withColumn("family", F.coalesce("family", F.lit(UNKNOWN)))  # an anchor that lower case makes part of a longer word has no window
    return out.select(F.col("key").alias(key), F.col("place").alias("paragraph_no"), "paragraph", "family", "predicted", "probability", "similarity")
