"""Licence scan: a trained paragraph classifier, confirmed against templates.

Paragraphs are the lines of a text, and runs of consecutive lines (up to the next line without
words, long enough for any template) in which a template is wrapped. Features are word n-grams (one to three words) of the
templates that hold at least one content word (a template word that the corpus' ordinary
paragraphs hardly ever have), so a paragraph without content words cannot be a licence and
is passed over in one array test. The others are classified by a multinomial logistic
regression over sparse n-gram features, with a class for anything unknown, and a family
counts only if its probability is above a threshold calibrated on paragraphs held out of the
training. A predicted family is confirmed if the paragraph holds at least 0.8 of the
five-word shingles of one of its templates (of the whole template, if that is shorter).

Training uses the templates, alone and inside ordinary paragraphs, and every ordinary paragraph
of the corpus: one with a word, that has neither a licence word nor a shingle of a template. Which
words are content words, the model and the threshold thus come from all paragraphs. Paragraphs alike
in all that the model sees are one training row with their number as its weight; all ordinary ones
together weigh at most ``ORDINARY``, else a few templates would count for nothing in a large corpus.
Equal paragraphs are classified once, so a licence line shared by a third of all documents is one row.
DataFrame functions and MLlib's DataFrame estimators only; what is collected is the counts of the
templates' words, the vocabulary, the model and the threshold.

Defined cases: null and empty texts have no paragraphs; repeated rows get equal results; an
empty table gives an empty result; a corpus without ordinary paragraphs is trained on the
templates and an empty paragraph; extra columns are kept unless they bear an output's name.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.llm.common import doc_key, written

# The customary short notices of common licences.
TEMPLATES = {
    "apache": ["Licensed under the Apache License, Version 2.0", "This project is released under the Apache License 2.0"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted", "Released under the BSD 3-Clause License"],
    "cc-by": ["This work is licensed under a Creative Commons Attribution 4.0 International License", "Licensed under CC BY 4.0"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc0": ["To the extent possible under law, the author has waived all copyright and related rights", "Released under CC0 1.0 Universal"],
    "gpl": ["This work is licensed under the GNU General Public License, version 3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"],
    "lgpl": ["This library is licensed under the GNU Lesser General Public License, version 3"],
    "mit": ["Released under the MIT License", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "proprietary": ["All rights reserved", "Copyright. All rights reserved", "No part of this publication may be reproduced without the prior written permission of the publisher"],
}
UNKNOWN = "unknown"
#: Words by which a paragraph is not ordinary, whatever else it says.
LICENCE_WORDS = ("license", "licensed", "copyright", "copyrighted")
#: A word is a content word up to once in so many ordinary paragraphs.
RARE = 2000
#: Most that all ordinary paragraphs weigh in training, and what the wrapped forms of a template weigh.
ORDINARY, WRAPPED = 1600.0, 7.0
PENALTY = 0.002


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}.+-]+|[.](?=\s|$)"), lambda w: w != "")


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def grams(words: Column, sizes: tuple[int, ...] = (1, 2, 3)) -> Column:
    """Word n-grams of each size, joined by blanks."""
    def of(n: int) -> Column:
        last = F.size(words) - n
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.array_join(F.slice(words, i + 1, n), " "))).otherwise(
            F.array().cast("array<string>"))

    return F.concat(*[of(n) for n in sizes])


def _templates(spark: SparkSession) -> DataFrame:
    rows = [F.struct(F.lit(f).alias("family"), F.lit(t).alias("template")) for f, ts in TEMPLATES.items() for t in ts]
    return spark.range(1).select(F.inline(F.array(*rows))).withColumn("words", words_of(F.col("template")))


def _paragraphs(docs: DataFrame, *columns: str) -> DataFrame:
    return docs.select(*columns, F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("at", "paragraph"))


def _wanted(spark: SparkSession) -> list[tuple[str, int, list[str]]]:
    """Family, shingle size and shingles of each template."""
    out = []
    for r in _templates(spark).collect():  # their number is fixed
        size = min(5, len(r.words))
        out.append((r.family, size, sorted({" ".join(r.words[i:i + size]) for i in range(len(r.words) - size + 1)})))
    return out


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _held(words: Column, wanted: list[tuple[str, int, list[str]]]) -> Column:
    """Numbers of the templates of which ``words`` hold at least 0.8."""
    def of(size: int):
        mine = [(i, F.array(*[F.lit(x) for x in xs]), 0.8 * len(xs)) for i, (_, n, xs) in enumerate(wanted) if n == size]
        return lambda g: F.filter(
            F.array(*[F.when(F.size(F.array_intersect(g, xs)) >= least, F.lit(i)) for i, xs, least in mine]), lambda t: t.isNotNull())

    return _once(words, lambda w: F.concat(*[_once(grams(w, (n,)), of(n)) for n in sorted({n for _, n, _ in wanted})]))


def _wrapped(docs: DataFrame, content: list[str], wanted: list[tuple[str, int, list[str]]]) -> DataFrame:
    """``_k``, ``at`` and ``paragraph``: the least runs of two or more lines that hold a template.

    From each line a run goes on until a line without words, or until the lines after the first
    have more words than any template: what starts in that line ends in the run."""
    longest = max(n + len(ws) - 1 for _, n, ws in wanted)

    def run(lines: Column, i: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("after"), F.lit(True).alias("on"))

        def add(s: Column, words: Column) -> Column:
            on = s["on"] & (F.size(words) > 0) & (s["after"] < longest)
            after = F.when(on & (s["n"] > 0), s["after"] + F.size(words)).otherwise(s["after"])
            return F.struct((s["n"] + on.cast("int")).alias("n"), after.alias("after"), on.alias("on"))

        return _once(F.slice(lines, i + 1, longest + 1), lambda near: F.slice(near, 1, F.aggregate(near, start, add)["n"]))

    def runs(lines: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.size(F.get(lines, i)) > 0)
        return F.filter(F.transform(starts, lambda i: F.struct(i.alias("at"), run(lines, i).alias("run"))),
                        lambda r: F.arrays_overlap(F.flatten(r["run"]), F.array(*[F.lit(w) for w in content])))

    lines = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), words_of)
    rows = docs.select("_k", F.inline(_once(lines, runs)))
    rows = written(rows.filter(F.size(_held(F.flatten("run"), wanted)) > 0), "runs")
    rows = rows.select("_k", "at", "run", F.explode(F.sequence(F.lit(1), F.size("run"))).alias("n"))
    rows = rows.withColumn("words", F.flatten(F.slice("run", 1, F.col("n"))))
    held = _held(F.col("words"), wanted)
    rows = rows.select("_k", "at", "n", F.array_join("words", " ").alias("paragraph"), F.explode(held).alias("template"))
    shortest = rows.groupBy("_k", "at", "template").agg(F.min(F.struct("n", "paragraph")).alias("x"))
    latest = shortest.groupBy("_k", "template", (F.col("at") + F.col("x.n")).alias("end")).agg(F.max(F.struct("at", "x")).alias("y"))
    return latest.filter("y.x.n > 1").select("_k", "y.at", "y.x.paragraph").distinct()


def _ordinary(docs: DataFrame, wanted: list[tuple[str, int, list[str]]], use: Callable[[Column], list[Column]]) -> DataFrame:
    """``h`` (a hash) and the columns that ``use`` makes of the words of each different ordinary paragraph."""
    sizes = sorted({n for _, n, _ in wanted})
    shingles = {n: sorted({x for _, m, xs in wanted if m == n for x in xs}) for n in sizes}
    # a paragraph with a shingle has the shingle's longest word, which is quickly seen
    longest = sorted({max(x.split(" "), key=len) for xs in shingles.values() for x in xs})

    def licence_like(words: Column) -> Column:
        held = reduce(Column.__or__, [F.arrays_overlap(grams(words, (n,)), _strings(shingles[n])) for n in sizes])
        return F.arrays_overlap(words, _strings(LICENCE_WORDS)) | F.when(F.arrays_overlap(words, _strings(longest)), held).otherwise(F.lit(False))

    def row(line: Column) -> Column:
        return _once(words_of(line), lambda w: F.when((F.trim(line) != "") & ~licence_like(w), F.struct(F.xxhash64(line).alias("h"), *use(w))))

    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    return docs.select(F.inline(F.filter(F.transform(lines, row), lambda r: r.isNotNull()))).distinct()


class LicenceModel:
    """Content words, the fitted model, and the calibrated threshold."""

    def __init__(self, docs: DataFrame, false_positives: float = 0.001):
        spark = docs.sparkSession
        templates = _templates(spark)
        self.wanted = _wanted(spark)
        self.words = sorted(r.w for r in templates.select(F.explode("words").alias("w")).distinct().collect())
        # ordinary paragraphs, and those with each template word
        holding = _ordinary(docs, self.wanted, lambda w: [F.array_intersect(w, _strings(self.words)).alias("words")])
        counts = {r.w: r["count"] for r in holding.select(F.explode(F.concat(_strings([""]), "words")).alias("w")).groupBy("w").count().collect()}
        most = max(1, counts.get("", 0) / RARE)
        self.content = [w for w in self.words if counts.get(w, 0) <= most]
        self.vectorizer = CountVectorizer(inputCol="grams", outputCol="features", binary=True).fit(
            templates.select(self._grams(F.col("words")).alias("grams")))
        # a row for all ordinary paragraphs alike; a fifth of the paragraphs is held out
        plain = _ordinary(docs, self.wanted, lambda w: [self._seen(w).alias("grams"), self._around(w).alias("around")])
        plain = written(plain.groupBy((F.pmod("h", F.lit(5)) == 4).alias("held"), "grams", "around").agg(F.count(F.lit(1)).alias("n")), "plain")
        number = {r.held: r.n for r in plain.groupBy("held").agg(F.sum("n").alias("n")).collect()}
        learnt = number.get(False, 0)
        # templates alone, and between the words of each ordinary paragraph
        around = plain.filter("not held").groupBy("around").agg(F.sum("n").alias("n")) if learnt else spark.range(1).select(_strings([]).alias("around"), F.lit(1).alias("n"))
        inside = around.crossJoin(templates).select("family", self._seen(F.concat("around", "words", "around")).alias("grams"), "n")
        ordinary = plain.filter("not held").groupBy("grams").agg(F.sum("n").alias("n"))
        one = F.lit(1.0).alias("weight")
        rows = templates.select("family", self._seen(F.col("words")).alias("grams"), one).union(
            inside.groupBy("family", "grams").agg((F.sum("n") * (WRAPPED / max(learnt, 1))).alias("weight"))).union(
            ordinary.select(F.lit(UNKNOWN), "grams", F.col("n") * min(1.0, ORDINARY / max(learnt, 1)))).union(
            # single content words out of place are no licence
            spark.range(1).select(F.explode(_strings(self.content)).alias("w")).select(F.lit(UNKNOWN), self._seen(F.array("w")), one))
        self.families = [UNKNOWN, *sorted(TEMPLATES)]
        train = written(rows.select((F.array_position(_strings(self.families), F.col("family")) - 1).cast("double").alias("label"), "grams", "weight"), "training")
        # the features' deviations, to which the penalty is scaled, are larger by this for rows with weights than for as many single rows
        total, squares = train.agg(F.sum("weight"), F.sum(F.col("weight") ** 2)).collect()[0]
        self.model = LogisticRegression(family="multinomial", regParam=PENALTY * (total - squares / total) / (total - 1), maxIter=60, weightCol="weight").fit(
            self.vectorizer.transform(train))
        held = self._probabilities(plain.filter("held").groupBy("grams").agg(F.sum("n").alias("n")))
        best = F.array_max(F.slice("p", 2, len(self.families)))
        # the least probability that all but false_positives of them do not pass
        last = number.get(True, 0) - 1
        rank = math.ceil((1 - false_positives) * (last + 1)) - 1
        far = held.agg(F.percentile(best, F.lit(rank / last if last > 0 else 1.0), F.col("n")).alias("x")).collect()[0].x
        self.threshold = max(0.5, far or 0.0)

    def _seen(self, words: Column) -> Column:
        """The n-grams of ``words`` that are features."""
        vocabulary = _strings(self.vectorizer.vocabulary)
        return _once(words, lambda w: F.when(self.candidates(w), F.array_sort(F.array_intersect(grams(w), vocabulary))).otherwise(_strings([])))

    def _around(self, words: Column) -> Column:
        """What a paragraph's first words add to the features of a template between them: template words in
        their places, blanks for others. Without a content word, at most two words at an end count."""
        near = F.transform(F.slice(words, 1, 12), lambda w: F.when(w.isin(self.words), w).otherwise(F.lit("")))
        blank = _strings([""])

        def ends(w: Column) -> Column:
            first = F.when(F.get(w, F.lit(0)) == "", blank).otherwise(F.slice(w, 1, 2))
            last = F.when(F.get(w, F.size(w) - 1) == "", blank).otherwise(F.slice(w, -2, 2))
            return F.when(self.candidates(w) | (F.size(w) < 5), w).otherwise(F.concat(first, blank, last))

        return _once(near, ends)

    def _grams(self, words: Column) -> Column:
        return F.filter(grams(words), lambda g: F.arrays_overlap(F.split(g, " "), _strings(self.content)))

    def _probabilities(self, rows: DataFrame) -> DataFrame:
        return self.model.transform(self.vectorizer.transform(rows)).withColumn("p", vector_to_array("probability"))

    def candidates(self, words: Column) -> Column:
        """Whether a paragraph can belong to a family at all."""
        return F.arrays_overlap(words, _strings(self.content))

    def classify(self, paragraphs: DataFrame) -> DataFrame:
        """``paragraph`` (distinct) with ``family``, ``probability`` and ``confirmed``."""
        paragraphs = paragraphs.select("paragraph", words_of(F.col("paragraph")).alias("words"))
        scored = self._probabilities(paragraphs.withColumn("grams", self._grams(F.col("words"))))
        names = F.array(*[F.lit(f) for f in self.families])
        best = F.array_max(F.slice("p", 2, len(self.families)))
        scored = scored.withColumn("probability", best).withColumn(
            "family", F.when(best >= self.threshold, F.element_at(names, F.array_position("p", best).cast("int"))).otherwise(F.lit(UNKNOWN)))
        # the family's templates as literals: their number is fixed
        of = F.array(*[F.lit(f) for f, _, _ in self.wanted])
        confirmed = F.exists(_held(F.col("words"), self.wanted), lambda t: F.get(of, t) == F.col("family"))
        return scored.select("paragraph", "family", "probability", confirmed.alias("confirmed"))


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` with ``licence`` (the family of the first confirmed paragraph; null if none),
    ``n_confirmed`` and ``n_unconfirmed`` (paragraphs classed as a family; runs only if confirmed),
    ``licence_at`` (the first line of the first confirmed one, from 0)."""
    model = LicenceModel(docs)
    keyed = docs.withColumn("_k", doc_key())
    lines = written(_paragraphs(keyed, "_k").filter(model.candidates(words_of(F.col("paragraph")))).distinct(), "candidates")
    with_lines = keyed.select("_k", "text").join(lines.select("_k").distinct(), "_k", "left_semi")
    runs = written(_wrapped(with_lines, model.content, model.wanted), "wrapped")
    found = lines.select("_k", "at", "paragraph", F.lit(False).alias("run")).union(runs.select("_k", "at", "paragraph", F.lit(True)))
    classes = model.classify(found.select("paragraph").distinct()).filter(F.col("family") != UNKNOWN)
    hits = found.join(classes, "paragraph").filter("confirmed or not run").groupBy("_k").agg(
        F.min(F.when(F.col("confirmed"), F.struct("at", "family"))).alias("_first"),
        F.count(F.when(F.col("confirmed"), 1)).alias("n_confirmed"),
        F.count(F.when(~F.col("confirmed"), 1)).alias("n_unconfirmed"))
    zero = F.lit(0).cast("long")
    return docs.drop("licence", "licence_at", "n_confirmed", "n_unconfirmed").withColumn("_k", doc_key()).join(hits, "_k", "left").withColumns({
        "licence": F.col("_first.family"), "licence_at": F.col("_first.at"),
        "n_confirmed": F.coalesce("n_confirmed", zero), "n_unconfirmed": F.coalesce("n_unconfirmed", zero)}).drop("_k", "_first")
