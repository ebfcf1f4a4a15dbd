"""Licence scans with a trained paragraph classifier.

A multinomial logistic regression with an elastic net on word one- and two-grams tells the licence families from
class 0, unknown. It learns from the notices below, alone and set into paragraphs of the corpus, and from corpus
paragraphs as unknown. Each family's threshold is calibrated on all paragraphs of the corpus: the score that all but
CALIBRATION of those without a notice do not exceed (to SCORE_STEPS-th parts), and one half at least. A prediction over its
threshold is confirmed if one of the family's notices has at least CONFIRM of its two-grams in the paragraph; else it
counts as unconfirmed.

All documents are scanned whole. As the model is linear, a paragraph cannot beat unknown with n-grams that together add
less than unknown is ahead; paragraphs with no stronger n-gram are left out by a pattern made from the model, exactly.
They score under one half, so the calibration counts them without their scores.

The corpus paragraphs to train on are bounded: every second of the first SAMPLE paragraphs by hash of the SAMPLE_DOCS
documents of smallest id hash, less those that hold a notice or are mostly (PIECE of their two-grams) a piece of one, as
a line of a wrapped notice is.

A paragraph is judged as a whole and sentence by sentence, so that a notice is also found beside other sentences.
Notices set in several lines are found in blocks: lines between blank ones, less comment marks, joined by spaces, and
judged like a paragraph. A block counts beside its lines (in n_confirmed or n_unconfirmed) if it tells more than they do:
a confirmed family that none of them has, or an unconfirmed one where none of them tells any.

Defined cases: null and empty texts have no paragraphs; a paragraph is a line with something but white space; documents
without id are scanned but never trained on; repeated rows are judged one by one; an empty table gives no rows; input
columns named like an output column are replaced.
"""

from __future__ import annotations

import re

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from orderflow.session import materialize

# Customary short notices of each licence family.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, either version 3 of the License, or any later version."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("LGPL", "This library is licensed under the GNU Lesser General Public License."),
    ("AGPL", "This program is licensed under the GNU Affero General Public License."),
    ("BSD", "Released under the BSD License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND", "Licensed under CC BY-ND 4.0."),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "Copyright. All rights reserved. No part may be reproduced without written permission of the publisher."),
]
FAMILIES = ["unknown", *dict.fromkeys(f for f, _ in NOTICES)]

SAMPLE_DOCS, SAMPLE, EMBEDDED = 400, 4000, 24
VOCABULARY, MIN_THRESHOLD, CALIBRATION, CONFIRM, PIECE = 4096, 0.5, 0.001, 0.7, 0.5
SCORE_STEPS = 1_000_000
PARAGRAPH, SENTENCE = r"\r?\n", r"(?<=[.!?])\s+"
# comment marks and white space at both ends of a line
MARK = r"""[ \t\r\f\x0B/*#;%<>|"'!-]"""
MARKS = rf"(?imd)^{MARK}++(?:(?:dnl|rem|\.\.)[ \t]++)?|^(?:dnl|rem|\.\.)[ \t]++|(?<!{MARK.replace('!', '')}){MARK.replace('!', '')}++$"
WORD = r"[a-z0-9]+(?:[.+\-][a-z0-9]+)*"


def words(paragraph: Column) -> Column:
    return F.regexp_extract_all(F.lower(paragraph), F.lit(WORD), 0)


def two_grams(w: Column) -> Column:
    """Pairs of neighbouring words; a lone word stands for itself."""
    n = F.greatest(F.size(w) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(w, F.lit(1), n), F.slice(w, F.lit(2), n), lambda a, b: F.concat_ws(" ", a, b))
    return F.when(F.size(w) > 1, pairs).otherwise(w)


def grams(paragraph: Column) -> Column:
    w = words(paragraph)
    return F.when(F.size(w) > 0, F.concat(w, two_grams(w))).otherwise(F.array().cast("array<string>"))


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), PARAGRAPH), lambda p: F.trim(p) != "")


def bare(column: Column) -> Column:
    """Lines without comment marks and white space around them."""
    return F.regexp_replace(column, MARKS, "")


def blocks(text: Column) -> Column:
    """Two lines or more between blank ones, joined by spaces."""
    found = F.filter(F.split(bare(F.coalesce(text, F.lit(""))), r"\n\n+"), lambda b: F.trim(b, F.lit("\n")).contains("\n"))
    return F.transform(found, lambda b: F.replace(F.trim(b, F.lit("\n")), F.lit("\n"), F.lit(" ")))


def notices(spark: SparkSession) -> DataFrame:
    table = spark.createDataFrame([(i, f, FAMILIES.index(f), t) for i, (f, t) in enumerate(NOTICES)], "notice int, family string, label int, text string")
    return table.withColumn("_two", F.array_distinct(two_grams(words(F.col("text")))))


def confirmed(rows: DataFrame, known: DataFrame) -> DataFrame:
    """(_row, _at, family, likeness): the best share of a notice of a predicted family that the paragraph holds."""
    pairs = rows.join(F.broadcast(known.select("family", "_two")), "family")
    share = F.size(F.array_intersect("_two", F.array_distinct(two_grams(words(F.col("paragraph")))))) / F.size("_two")
    return pairs.groupBy("_row", "_at", "family").agg(F.max(share).alias("likeness"))


def sample_paragraphs(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    order = F.md5(F.col(doc_id).cast("string"))
    some = docs.where(F.col(doc_id).isNotNull()).select(doc_id).distinct().orderBy(order, doc_id).limit(SAMPLE_DOCS)
    lines = docs.join(F.broadcast(some), doc_id).select(F.explode(paragraphs(F.col(text))).alias("paragraph")).distinct()
    lines = lines.withColumn("_hash", F.md5("paragraph")).orderBy("_hash").limit(SAMPLE)
    return materialize(lines, "licence-sample")


class Classifier:
    def __init__(self, model: PipelineModel):
        self.model = model
        counts, regression = model.stages
        weights, bias = regression.coefficientMatrix.toArray(), regression.interceptVector.toArray()
        # what each n-gram adds to a family against unknown, and what unknown is ahead without any n-gram
        more, ahead = (weights[1:] - weights[0]).clip(min=0), bias[0] - bias[1:]
        self.always = bool((ahead <= 0).any())  # then a paragraph needs no n-gram to be a candidate
        # the weakest n-grams are passed over as long as all of them together win no family
        spoken, passed = set(), 0 * ahead
        number = {w: i for i, w in enumerate(counts.vocabulary)}  # most frequent first
        for j in more.max(axis=0).argsort(kind="stable"):
            if (passed + more[:, j] < 0.999 * ahead).all():
                passed = passed + more[:, j]
            else:  # an n-gram is there only with its rarest word
                spoken.add(max(counts.vocabulary[j].split(" "), key=lambda w: (number.get(w, len(number)), w)))
        self.pattern = "(?<![a-z0-9])(?:" + "|".join(map(re.escape, sorted(spoken))) + ")(?![a-z0-9])"

    def candidate(self, column: Column) -> Column:
        return F.lit(True) if self.always else F.lower(column).rlike(self.pattern)

    def predict(self, rows: DataFrame) -> DataFrame:
        """Rows of ``paragraph`` with family and probability; unknown where no family reaches MIN_THRESHOLD."""
        scored = self.model.transform(rows.withColumn("_grams", grams(F.col("paragraph"))))
        p = vector_to_array("probability")
        best = F.array_max(F.transform(F.slice(p, 2, len(FAMILIES) - 1), lambda x, i: F.struct(x.alias("p"), (i + 1).alias("label"))))
        scored = scored.withColumn("_best", best)
        family = F.when(F.col("_best.p") >= MIN_THRESHOLD, F.get(F.array(*map(F.lit, FAMILIES)), F.col("_best.label")))
        return scored.select(*rows.columns, F.coalesce(family, F.lit("unknown")).alias("family"), F.col("_best.p").alias("probability"))


def without_notice(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of ``paragraph`` that neither hold a notice nor are mostly a piece of one."""
    listed = F.array(*(F.array(*map(F.lit, row["_two"])) for row in known.select("_two").collect()))

    def part_of(two: Column) -> Column:
        common = F.size(F.array_intersect(two, F.col("_pairs")))
        return (common >= CONFIRM * F.size(two)) | ((common >= 3) & (common >= PIECE * F.size("_pairs")))

    paired = rows.withColumn("_pairs", F.array_distinct(two_grams(words(F.col("paragraph")))))
    return paired.where(~F.exists(listed, part_of)).drop("_pairs")


def over_thresholds(found: DataFrame, total: int, known: DataFrame) -> DataFrame:
    """``found`` (predictions; ``_whole``: a paragraph as it is) less those that do not exceed their family's threshold.

    ``total``: number of paragraphs of the corpus.
    """
    lines = found.where("_whole")
    clean = materialize(without_notice(lines, known).select("family", F.ceil(F.col("probability") * SCORE_STEPS).alias("_step")), "licence-scores")
    allowed = CALIBRATION * (total - lines.count() + clean.count())
    steps = clean.groupBy("family", "_step").agg(F.count("*").alias("_n"))
    # SCORE_STEPS rows a family at most
    higher = F.coalesce(F.sum("_n").over(W.partitionBy("family").orderBy(F.desc("_step")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    limits = steps.withColumn("_higher", higher).groupBy("family").agg(
        F.when(F.sum("_n") > allowed, F.min(F.when(F.col("_higher") <= allowed, F.col("_step"))) / SCORE_STEPS).alias("_limit")
    )
    kept = found.join(F.broadcast(limits), "family", "left").where("_limit is null or probability > _limit")
    return kept.drop("_limit")


def train(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> Classifier:
    spark = docs.sparkSession
    known = notices(spark)
    sample = sample_paragraphs(docs, text, doc_id)
    numbered = sample.withColumn("_n", F.conv(F.substring("_hash", 1, 8), 16, 10).cast("long"))
    # lines that hold a notice, or are mostly a piece of one, teach nothing about unknown
    learn = without_notice(numbered.where("_n % 2 = 0"), known)
    # every notice also stands in up to EMBEDDED paragraphs, before, amid or after some of their words
    places = learn.select("paragraph", (F.col("_n") / 2 % (EMBEDDED * 8)).cast("int").alias("_slot")).dropDuplicates(["_slot"])
    slots = known.select("label", "text", F.explode(F.sequence(F.lit(0), F.lit(EMBEDDED - 1))).alias("_i"), "notice")
    slots = slots.withColumn("_slot", ((F.col("notice") * 7 + F.col("_i") * 8) % (EMBEDDED * 8)).cast("int"))
    some = F.array_join(F.slice(F.split("paragraph", " "), F.lit(1), 6 + 6 * (F.col("_i") % 5)), " ")
    set_in = F.concat_ws(" ", F.when(F.col("_i") % 3 > 0, some), "text", F.when(F.col("_i") % 3 < 2, some))
    inside = slots.join(places, "_slot").select("label", set_in.alias("paragraph"))
    unknown = learn.select(F.lit(0).alias("label"), "paragraph")
    empty = spark.createDataFrame([(0, "")], "label int, paragraph string")
    rows = known.select("label", F.col("text").alias("paragraph")).unionByName(inside).unionByName(unknown).unionByName(empty)
    # a bounded sample; in one partition the optimizer's rounds move no vectors between tasks
    rows = materialize(rows.withColumn("_grams", grams(F.col("paragraph"))).coalesce(1), "licence-training")
    counts = CountVectorizer(inputCol="_grams", outputCol="_features", vocabSize=VOCABULARY, minDF=2, binary=True)
    regression = LogisticRegression(
        featuresCol="_features", labelCol="label", family="multinomial", regParam=5e-4, elasticNetParam=0.9, maxIter=60
    )
    return Classifier(Pipeline(stages=[counts, regression]).fit(rows))


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """All columns but the text, with n_paragraphs, families (confirmed, sorted), n_confirmed, n_unconfirmed."""
    classifier = train(docs, text, doc_id)
    out = ("n_paragraphs", "families", "n_confirmed", "n_unconfirmed")
    rest = [f"`{c}`" for c in docs.columns if c != text and c not in out]
    lines = paragraphs(F.col(text))
    may = classifier.candidate(F.coalesce(F.col(text), F.lit("")))
    likely, joint = (F.when(may, F.filter(x, classifier.candidate)) for x in (lines, blocks(F.col(text))))
    rows = docs.select(
        *rest, F.size(lines).cast("long").alias("n_paragraphs"), likely.alias("_likely"), joint.alias("_joint"),
        F.monotonically_increasing_id().alias("_row"),
    )
    rows = materialize(rows, "licence-candidates")
    # blocks are numbered -1, -2, ..
    below = F.transform("_joint", lambda b, i: F.struct((-1 - i).alias("_at"), b.alias("_line")))
    above = F.transform("_likely", lambda x, i: F.struct(i.alias("_at"), x.alias("_line")))
    lines = rows.select("_row", F.inline(F.concat(above, below)))
    sentences = F.split("_line", SENTENCE)
    parts = F.array_union(F.array("_line"), F.when(F.col("_at") < 0, F.filter(sentences, classifier.candidate)).otherwise(sentences))
    units = lines.select("_row", "_at", F.posexplode(parts).alias("_part", "paragraph"))
    units = units.withColumn("_whole", F.expr("_at >= 0 and _part = 0")).drop("_part")
    found = materialize(classifier.predict(units).where("family <> 'unknown'"), "licence-found")
    listed = notices(docs.sparkSession)
    found = over_thresholds(found, rows.agg(F.sum("n_paragraphs")).first()[0] or 0, listed)
    judged = confirmed(found, listed).withColumn("_sure", F.col("likeness") >= CONFIRM)
    per_line = judged.groupBy("_row", "_at").agg(
        F.array_sort(F.collect_set(F.when(F.col("_sure"), F.col("family")))).alias("families"), F.max("_sure").alias("_sure")
    )
    # what the lines of a block tell, by their text; only documents with a judged block come here
    with_block = per_line.where("_at < 0").join(lines, ["_row", "_at"]).withColumnRenamed("_line", "_block")
    told = per_line.where("_at >= 0").join(lines, ["_row", "_at"])
    told = told.groupBy("_row").agg(F.collect_list(F.struct(bare(F.col("_line")).alias("line"), "families")).alias("_told"))
    own = F.filter(F.coalesce("_told", F.array().cast(told.schema["_told"].dataType)), lambda x: F.col("_block").contains(x["line"]))
    known = F.flatten(F.transform(own, lambda x: x["families"]))
    more = F.when(F.col("_sure"), F.size(F.array_except("families", known)) > 0).otherwise(F.size(own) == 0)
    extra = with_block.join(told, "_row", "left").where(more).select("_row", "families", "_sure")
    per_row = per_line.where("_at >= 0").select("_row", "families", "_sure").unionByName(extra).groupBy("_row").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("families")))).alias("families"),
        F.count_if("_sure").alias("n_confirmed"), F.count_if(~F.col("_sure")).alias("n_unconfirmed"),
    )
    joined = rows.join(per_row, "_row", "left").drop("_row", "_likely", "_joint")
    none = F.array().cast("array<string>")
    return joined.withColumns({
        "families": F.coalesce("families", none), "n_confirmed": F.coalesce("n_confirmed", F.lit(0)), "n_unconfirmed": F.coalesce("n_unconfirmed", F.lit(0)),
    })
