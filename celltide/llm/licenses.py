"""License scans: a trained paragraph classifier, confirmed by comparison with templates.

Paragraphs (lines of a text) are described by their word uni-, bi- and trigrams, as far as these occur in
some template, in a sparse vector of hashed features. A multinomial logistic regression tells the
licence families from each other and from an unknown class. It is trained on runs of words cut from the
templates and on half of all paragraphs that have little in common with any template; those with the same
n-grams are one row that weighs as many, and beyond 2 * `WEIGHT` paragraphs each weighs less, so that the
templates keep their share. The other half calibrates: a family is named only where its probability exceeds
what `FALSE` of them (of those with an n-gram of a template) reach, and at least one half. All of these
paragraphs tell which words of the templates are too common to count alone; their bi- and trigrams count.

A named family is confirmed by the templates: some template of that family must have `ALIKE` of its
bigrams in the paragraph.

A notice can be wrapped over lines. So each line that can begin one is also joined with the lines after it,
up to a line without words or until the longest template fits in, and these joins are scored as
paragraphs are. A template has some of its rarest bigrams in every join that it confirms: where none of these is
within reach, no join is formed. A join is listed under its first line, if it is confirmed, holds no line that is
confirmed as the same family by itself, and no listed join of the family that overlaps it is more alike, or as alike
and shorter; what is left of a template beside the listed notice of another one that it goes on in is not listed
again, nor is a line that a join holds and that is less like another family. Comment signs are no words.

All of it is DataFrame operations and Spark ML; no Python runs on the executors.

Defined cases: null and empty texts have no paragraphs; paragraphs without any n-gram of a template are
unknown and not listed; a paragraph can be of any length; repeated rows and repeated paragraphs are each
listed; rows without doc_id too; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from celltide.llm.frames import as_text, load, materialize

WEIGHT, FALSE, ALIKE, COMMON, FEATURES = 3000, 0.001, 0.6, 0.005, 1 << 14
NEXT = 4  # lines that are looked at first for the words that a notice can still have
UNKNOWN = "unknown"

# Short notices by which the families are commonly declared.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
        " compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
        "This project is released under the Apache License 2.0.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "This software is licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files, to deal in the Software without restriction.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Distributed under the GNU GPL version 2.",
    ],
    "BSD": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted"
        " provided that the following conditions are met.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC0": [
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "Released under CC0 1.0 Universal Public Domain Dedication.",
    ],
    "all-rights-reserved": ["All rights reserved.", "Copyright, all rights reserved. No part may be reproduced."],
}


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^a-z0-9.+]+|\.(?![0-9])"), lambda w: F.length(w) > 0)


def once(c: Column) -> Column:
    """A value that is computed once, however often it is used: Spark does not copy it past an explode."""
    return F.explode(F.array(c))


def grams(w: Column, n: int) -> Column:
    """The word n-grams of an array of words."""
    last = F.size(w) - (n - 1)
    return F.when(last >= 1, F.transform(
        F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.concat_ws(" ", F.slice(w, i, n))
    )).otherwise(F.array().cast("array<string>"))


def pairs(a: Column, b: Column) -> Column:
    """What stands at the same places of two arrays as n-grams; null where either is missing."""
    return F.zip_with(a, b, lambda x, y: F.concat(x, F.lit(" "), y))


def behind(w: Column, n: int) -> Column:
    """An array without its first n elements."""
    return F.slice(w, n + 1, F.size(w))


def reached(rows: DataFrame, share: float) -> float | None:
    """The least value t (0 to 1) that at least a share of all have at most; rows: t, n (how many have it).

    Exact to 48 binary digits, of which twelve at a time are counted.
    """
    rows = rows.select("t", "n", F.floor(F.col("t") * float(1 << 48)).cast("bigint").alias("b"))
    total = rows.agg(F.sum("n").alias("n")).first()["n"]
    if not total:
        return None
    left, at, part = math.ceil(share * total), 0, rows
    for digits in (36, 24, 12, 0):
        counts = part.groupBy(F.shiftright("b", digits).alias("d")).agg(F.sum("n").alias("n")).orderBy("d").collect()
        for r in counts:
            at = r["d"]
            if left <= r["n"]:
                break
            left -= r["n"]
        part = rows.where(F.shiftright("b", digits) == at)
    return part.agg(F.max("t").alias("t")).first()["t"]


def templates(spark: SparkSession) -> DataFrame:
    """family, template, w: the templates' words."""
    rows = [(family, text) for family, texts in TEMPLATES.items() for text in texts]
    return spark.createDataFrame(rows, "family STRING, template STRING").withColumn("w", words(F.col("template")))


class LicenseScan:
    """A scanner trained for a table; `scan` names the licences of any documents."""

    def __init__(self, sample=WEIGHT, false=FALSE, alike=ALIKE, features=FEATURES):
        """All unknown paragraphs are learned from; together they weigh as many as `sample`, if there are more."""
        self.sample, self.false, self.alike, self.features = sample, false, alike, features

    def paragraphs(self, docs: DataFrame, id_column="doc_id", text="text") -> DataFrame:
        """doc_id, paragraph (from 0), w: the words of every paragraph."""
        rows = docs.select(F.col(id_column).alias("doc_id"), as_text(docs, text).alias("text"))
        lines = rows.select("doc_id", F.posexplode(F.split("text", "\n")).alias("paragraph", "line"))
        return lines.select("doc_id", "paragraph", once(words(F.col("line"))).alias("w"))

    def count_lines(self, docs: DataFrame, text="text") -> int:
        """How many paragraphs have words; one sign of a word tells, so they are not cut into words for it."""
        lines = docs.select(as_text(docs, text).alias("text")).select(F.explode(F.split("text", "\n")).alias("line"))
        return lines.where(F.lower("line").rlike("[a-z0-9+]")).count()

    def _marked(self, w: Column) -> Column:
        """The words of templates in their places, null in place of all others."""
        return F.transform(w, lambda x: F.when(x.isin(self.words), x))

    def _pieces(self, docs: DataFrame, id_column, text) -> DataFrame:
        """uid, doc_id, paragraph, lines, w: the lines that can hold a part of a notice, and the joins that can be one."""
        rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_column).alias("doc_id"), as_text(docs, text).alias("text"))
        rows = rows.select("uid", "doc_id", once(F.transform(F.split("text", "\n"), lambda t: self._marked(words(t)))).alias("lines"))
        rows = rows.where(F.exists("lines", lambda w: F.exists(w, lambda x: x.isNotNull())))
        two = F.transform("lines", lambda w: F.filter(pairs(w, behind(w, 1)), self._in_vocabulary(2)))
        longest, last = F.lit(self.longest), F.size("lines") - 1
        every = F.sequence(F.lit(0), last)

        def line(i):
            return F.get("lines", i)

        # The bigram of a line's last word and the next one's first.
        over = F.transform(every, lambda i: F.concat(F.get(line(i), F.size(line(i)) - 1), F.lit(" "), F.get(line(i + 1), F.lit(0))))
        rows = rows.select("uid", "doc_id", "lines", once(two).alias("two"), over.alias("over"))

        def flag(c):
            return F.coalesce(c, F.lit(False))

        begins = F.transform(every, lambda i: F.exists(line(i), self._in_vocabulary(1)) | (F.size(F.get("two", i)) > 0) | flag(
            self._in_vocabulary(2)(F.get("over", i))))
        near = F.transform(every, lambda i: F.exists(F.get("two", i), lambda g: g.isin(self.anchors)) | flag(F.get("over", i).isin(self.anchors)))
        rows = rows.select("uid", "doc_id", "lines", once(F.struct(begins.alias("begins"), near.alias("near"))).alias("f"))

        def after(i):
            """The next lines, as many as can be needed, if one of them can tell of a notice."""
            held = sum((F.greatest(F.lit(0), F.coalesce(F.size(line(i + k)), F.lit(0))) for k in range(2, NEXT + 1)), F.size(line(i + 1)))
            end = F.least(last, i + F.when(held >= longest, NEXT).otherwise(longest))
            some = F.exists(F.slice("f.near", i + 1, end - i + 1), lambda x: x)
            return F.when((i < last) & (F.size(line(i + 1)) > 0) & some, F.transform(F.sequence(i + 1, F.greatest(i + 1, end)), line))

        begin = F.filter(every, lambda i: F.get("f.begins", i))
        rows = rows.select("uid", "doc_id", F.explode(F.transform(begin, lambda i: F.struct(
            i.alias("paragraph"), line(i).alias("w"), after(i).alias("next")))).alias("s")).select("uid", "doc_id", "s.*")
        # Up to a line without words, and no further than the words of the longest template.
        blank = F.array_position(F.transform("next", lambda w: F.size(w)), 0)
        rows = rows.select("uid", "doc_id", "paragraph", "w", once(F.coalesce(F.when(
            blank > 0, F.slice("next", F.lit(1), (blank - 1).cast("int"))).otherwise(F.col("next")), F.array().cast("array<array<string>>"))).alias("next"))
        ends = F.filter(F.sequence(F.lit(0), F.size("next")), lambda j: F.size(F.flatten(F.slice("next", F.lit(1), F.greatest(F.lit(0), j - 1)))) < longest)
        return rows.select("uid", "doc_id", "paragraph", "w", "next", F.explode(ends).alias("j")).select(
            "uid", "doc_id", "paragraph", (F.col("j") + 1).alias("lines"),
            once(F.concat("w", F.flatten(F.slice("next", F.lit(1), F.col("j"))))).alias("w"))

    def _known(self, rows: DataFrame) -> DataFrame:
        """Paragraphs with an n-gram of the vocabulary, all of these, and the bigrams among them."""
        names = rows.columns
        rows = rows.select(*names, once(pairs(F.col("w"), behind(F.col("w"), 1))).alias("pair"))
        rows = rows.select(*names, "pair", once(F.filter("pair", self._in_vocabulary(2))).alias("two"))
        three = F.when(F.size("two") > 1, F.filter(pairs(F.col("pair"), behind(F.col("w"), 2)), self._in_vocabulary(3)))
        every = F.concat(F.filter("w", self._in_vocabulary(1)), "two", F.coalesce(three, F.array().cast("array<string>")))
        return rows.select(*names, "two", once(every).alias("grams")).where(F.size("grams") > 0)

    def _in_vocabulary(self, n):
        return lambda gram: gram.isin(self.vocabulary[n])

    def _shares(self, texts) -> Column:
        """The shares of each template's bigrams that a paragraph has."""
        return F.array(*[
            F.size(F.array_intersect(F.array(*[F.lit(g) for g in t]), F.col("two"))) / F.lit(float(len(t))) for t in texts])

    def fit(self, docs: DataFrame, id_column="doc_id", text="text") -> LicenseScan:
        spark = docs.sparkSession
        known = templates(spark)
        self.bigrams: dict[str, list] = {}
        for r in known.select("family", F.array_distinct(grams(F.col("w"), 2)).alias("g")).collect():
            self.bigrams.setdefault(r["family"], []).append(r["g"] or ["-"])
        self.families = [*TEMPLATES, UNKNOWN]
        self.longest = known.agg(F.max(F.size("w")).alias("n")).first()["n"]
        number = F.create_map(*[x for i, f in enumerate(self.families) for x in (F.lit(f), F.lit(float(i)))])

        # Runs of the templates' words, two thirds of them at least, and whole templates among others' words.
        size = F.size("w")
        least = F.ceil(size * 2 / 3).cast("int")
        runs = known.select("family", "w", F.explode(F.sequence(least, size)).alias("n")).select(
            "family", "w", "n", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("n") + 1)).alias("i"))
        good = runs.select(F.slice("w", F.col("i"), F.col("n")).alias("w"), number[F.col("family")].alias("label"))

        self.vocabulary = {
            n: sorted({r["g"] for r in known.select(F.explode(grams(F.col("w"), n)).alias("g")).collect()}) for n in (1, 2, 3)}
        self.words = self.vocabulary[1]
        unknown = self._unknown(docs, id_column, text)
        count = self.count_lines(docs, text)
        # Words of the templates that are rare in other paragraphs; all these tell which.
        often = {r["g"]: r["n"] for r in unknown.select(F.explode("grams").alias("g")).groupBy("g").agg(F.count("*").alias("n")).collect()}
        self.vocabulary[1] = [w for w in self.words if often.get(w, 0) <= COMMON * max(count, 2 * self.sample)]
        # What confirms a template lacks fewer of its bigrams than these are, so it holds one of them: the rarest.
        self.anchors = sorted({
            g for texts in self.bigrams.values() for t in texts
            for g in sorted(t, key=lambda g: (often.get(g, 0), g))[: len(t) - self._least(len(t)) + 1]})

        every = F.filter("grams", lambda g: g.isin([g for n in (1, 2, 3) for g in self.vocabulary[n]]))
        none = unknown.select("learn", once(F.array_sort(every)).alias("grams")).where(F.size("grams") > 0)
        none = materialize(none.groupBy("grams").agg(
            F.count_if("learn").alias("learn"), F.count_if(~F.col("learn")).alias("test")), "kinds")
        weight = min(1.0, 2 * self.sample / max(1, count))
        train = self._known(good).select("grams", "label", F.lit(1.0).alias("weight")).coalesce(1).union(none.where("learn > 0").select(
            "grams", F.lit(float(len(self.families) - 1)).alias("label"), (F.col("learn") * F.lit(weight)).alias("weight")))
        self.hashing = HashingTF(numFeatures=self.features, inputCol="grams", outputCol="features", binary=True)
        train = self.hashing.transform(train)
        self.model = LogisticRegression(regParam=1e-4, maxIter=60, family="multinomial", weightCol="weight").fit(train)
        unseen = self._scored(none.where("test > 0"))
        top = unseen.select(F.array_max(F.slice("p", 1, len(self.families) - 1)).alias("t"), F.col("test").alias("n"))
        self.edge = max(0.5, reached(materialize(top, "unseen"), 1 - self.false) or 0.0)
        return self

    def _least(self, size: int) -> int:
        """How many of a template's bigrams confirm it."""
        return next(n for n in range(1, size + 1) if n / size >= self.alike or n == size)

    def _unknown(self, docs: DataFrame, id_column, text) -> DataFrame:
        """learn, grams: the paragraphs that have n-grams of templates but little in common with any of them."""
        lines = self.paragraphs(docs, id_column, text).where(F.exists("w", lambda x: x.isin(self.words)))
        learn = F.xxhash64("w", "doc_id", "paragraph") % 2 == 0
        lines = lines.select(learn.alias("learn"), once(self._marked(F.col("w"))).alias("w"))
        lines = self._known(lines).select("learn", "two", F.array_distinct("grams").alias("grams"))
        every = [t for texts in self.bigrams.values() for t in texts]
        few = F.when(F.size("two") == 0, F.lit(True)).otherwise(F.array_max(self._shares(every)) < 0.3)
        return materialize(lines.where(few).drop("two"), "unknown")

    def _probabilities(self, rows: DataFrame) -> DataFrame:
        return self._scored(self._known(rows))

    def _scored(self, rows: DataFrame) -> DataFrame:
        scored = self.model.transform(self.hashing.transform(rows))
        names = [c for c in rows.columns if c != "grams"]
        return scored.select(*names, vector_to_array("probability").alias("p"))

    def scan(self, docs: DataFrame, id_column="doc_id", text="text") -> DataFrame:
        """doc_id, paragraph, family, probability, alike, confirmed: the paragraphs of a known family."""
        found = self._probabilities(self._pieces(docs, id_column, text))
        k = len(self.families) - 1
        best = F.array_max(F.slice("p", 1, k))
        found = found.withColumn("p", once(F.col("p"))).withColumn("probability", best).where(F.col("probability") >= self.edge)
        names = F.array(*[F.lit(f) for f in self.families])
        found = found.withColumn("family", names[F.array_position("p", F.col("probability")).cast("int") - 1])
        shares = F.coalesce(*[F.when(F.col("family") == f, self._shares(t)) for f, t in self.bigrams.items()])
        found = found.withColumn("shares", once(shares)).withColumn("alike", F.array_max("shares")).withColumn("confirmed", F.col("alike") >= self.alike)
        found = found.withColumn("template", F.array_position("shares", F.col("alike")))
        found = materialize(found.where("lines = 1 OR confirmed").select(
            "uid", "doc_id", "paragraph", "lines", "family", "template", "probability", "alike", "confirmed"), "licences")
        out = ["doc_id", "paragraph", "family", "probability", "alike", "confirmed"]
        joins = materialize(self._notices(found), "notices")
        # A line that is only in part like one family is a part of the notice around it that is more like another.
        held = joins.select("uid", "family", "alike", F.explode(F.expr("sequence(paragraph, paragraph + lines - 1)")).alias("paragraph"))
        part = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("uid", "paragraph")]
        part += [F.col("a.family") != F.col("b.family"), F.col("a.confirmed"), F.col("a.alike") < F.col("b.alike")]
        lines = found.where("lines = 1").alias("a").join(held.alias("b"), part, "left_anti")
        return lines.select(*out).union(joins.select(*out))

    def _notices(self, found: DataFrame) -> DataFrame:
        """The joins that tell of a notice best: the most alike, then the most alike of those that do not overlap it.

        One that overlaps those listed, all of other templates, is a part of their notice, and so is what it holds
        of its own template. One of the same template only borrows from them.
        """
        by = Window.partitionBy("uid", "family").orderBy("paragraph")
        alone = F.min(F.when((F.col("lines") == 1) & F.col("confirmed"), F.col("paragraph"))).over(by.rangeBetween(0, self.longest))
        joins = found.withColumn("alone", alone).where("lines > 1 AND (alone IS NULL OR alone >= paragraph + lines)")
        joins = joins.withColumn("last", F.col("paragraph") + F.col("lines") - 1)
        # Of those as alike to one template, the shortest from each first and to each last line.
        least = [F.min("lines").over(Window.partitionBy("uid", "family", "template", "alike", c)) for c in ("paragraph", "last")]
        joins = joins.withColumn("least", F.greatest(*least)).where("lines = least").drop("least")
        # Only joins of one run of lines overlap.
        before = F.max(F.col("paragraph") + F.col("lines")).over(by.rangeBetween(Window.unboundedPreceding, -1))
        run = F.sum(F.when(before > F.col("paragraph"), 0).otherwise(1)).over(by)
        joins = joins.withColumn("run", run)
        rest = [c for c in joins.columns if c not in ("uid", "family", "lines", "paragraph", "run")]
        joins = joins.groupBy("uid", "family", "run").agg(F.array_sort(F.collect_list(F.struct(
            (-F.col("alike")).alias("rank"), "lines", "paragraph", *rest, F.lit(True).alias("listed")))).alias("joins"))

        def kept(some, x):
            over = F.filter(some, lambda y: y["listed"] & (x["paragraph"] <= y["last"]) & (y["paragraph"] <= x["last"]))
            part = F.exists(some, lambda y: ~y["listed"] & (x["template"] == y["template"]) & (y["paragraph"] <= x["paragraph"]) & (x["last"] <= y["last"]))
            other = F.forall(over, lambda y: x["template"] != y["template"])
            return F.when(part | ~other, some).otherwise(F.concat(some, F.array(x.withField("listed", F.size(over) == 0))))

        kept = F.filter(F.aggregate("joins", F.slice("joins", 1, 0), kept), lambda x: x["listed"])
        return joins.select("uid", "family", F.explode(kept).alias("x")).select("uid", "family", "x.*")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return LicenseScan().fit(docs).scan(docs)
