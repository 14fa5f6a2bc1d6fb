"""License scans by diagonal voting.

All three-word runs of a document meet the three-word runs of license notices in one join. A match votes for
the diagonal (place in the document less place in the notice) on which the notice would stand. Votes are added
per diagonal, neighbouring diagonals are merged so that a few changed words do not break a span, and a span
counts if the voting words cover enough of it and of the notice, and if it holds a run of words that stands in
notices of its own label only. So wording that licenses share ("licensed under the") names none of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talkmart.functions.once import computed_once
from talkmart.llm.text import alnum_words, keyed, shingles

GRAM = 3
#: Diagonals this close to each other belong to one span.
DRIFT = 4
#: Words of a notice's length that may lie between two votes of a span.
GAP = 12
#: Least share of a span's words that lie in voting runs, and of the notice that the span's votes reach.
MIN_DENSITY = 0.6
MIN_COVERAGE = 0.5
#: Notices of at most so many words must be covered almost whole.
SHORT_WORDS = 12
SHORT_COVERAGE = 0.8

# Wording of public license notices, by label.
NOTICES = (
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("apache", "licensed under the apache license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("gpl", "licensed under the gnu general public license"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl", "it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("agpl", "licensed under the gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc-sa", "licensed under cc by nc sa 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc-sa", "this work is licensed under a creative commons attribution noncommercial sharealike 4 0 international license"),
    ("reserved", "all rights reserved no part of this publication may be reproduced distributed or transmitted in any form or by any means"),
)
# The phrases that always count.
PHRASES = (("cc-by", ("cc", "by")), ("gpl", ("general", "public", "license")), ("reserved", ("all", "rights", "reserved")))


def notice_runs(spark: SparkSession, notices=NOTICES, gram: int = GRAM) -> DataFrame:
    """(notice, label, length, at, token, run, own): the runs of words of each notice. As many rows as the notices have words.

    ``own`` is 1 for a run that stands in notices of one label only, else 0.
    """
    table = spark.createDataFrame([(i, label, text) for i, (label, text) in enumerate(notices)], "notice int, label string, text string")
    words = table.withColumn("words", alnum_words(F.col("text")))
    runs = words.select("notice", "label", F.size("words").alias("length"), "words", F.posexplode(shingles(F.col("words"), gram)).alias("at", "token"))
    labels = F.size(F.collect_set("label").over(Window.partitionBy("token")))
    own = F.when(labels == 1, 1).otherwise(0).alias("own")
    return runs.select("notice", "label", "length", "at", "token", F.slice("words", F.col("at") + 1, gram).alias("run"), own)


def license_spans(docs: DataFrame, notices=NOTICES, gram: int = GRAM) -> DataFrame:
    """(row_key, label, first, last, votes, density, coverage) of each verified span of ``keyed`` documents.

    ``first`` and ``last`` are the span's first and last word, counted from 0. Density is the share of the span's
    words that lie in a voting run, coverage the share of the notice's words that the votes reach.
    """
    runs = notice_runs(docs.sparkSession, notices, gram)  # bounded by the notices, whatever the documents
    words = docs.select("row_key", alnum_words(F.col("text")).alias("words"))
    placed = words.select("row_key", "words", F.posexplode(shingles(F.col("words"), gram)).alias("place", "token"))
    votes = placed.join(F.broadcast(runs), "token").filter(F.slice("words", F.col("place") + 1, gram) == F.col("run"))
    diagonal = (F.col("place") - F.col("at")).alias("diagonal")
    each = ["row_key", "notice", "label", "length"]
    # A run of consecutive votes on a diagonal is one row from here on.
    votes = votes.select(*each, "place", "at", "own", diagonal).distinct()
    along = Window.partitionBy(*each, "diagonal").orderBy("place")
    pieces = (
        votes.withColumn("piece", F.col("place") - F.row_number().over(along))
        .groupBy(*each, "diagonal", "piece")
        .agg(F.min("place").alias("from"), (F.max("place") + gram).alias("to"), F.min("at").alias("at"), F.max("own").alias("own"))
    )
    # Pieces follow each other in the document; one far off the last diagonal, or far away, starts a new span.
    follow = Window.partitionBy(*each).orderBy("from", "to", "diagonal")
    new = (F.abs(F.col("diagonal") - F.lag("diagonal").over(follow)) > DRIFT) | (F.col("from") - F.lag("to").over(follow) > GAP)
    span = F.sum(F.when(F.coalesce(new, F.lit(False)), 1).otherwise(0)).over(follow)
    reach = Window.partitionBy(*each, "span").orderBy("from", "to", "diagonal").rowsBetween(Window.unboundedPreceding, -1)
    fresh = lambda low, high, top: F.greatest(F.lit(0), F.col(high) - F.greatest(F.col(low), F.coalesce(F.max(top).over(reach), F.lit(0))))
    spans = (
        pieces.withColumn("span", span)
        .withColumn("till", F.col("at") + F.col("to") - F.col("from"))
        .withColumn("words", fresh("from", "to", "to"))
        .withColumn("known", fresh("at", "till", "till"))
        .groupBy(*each, "span")
        .agg(
            F.min("from").alias("first"),
            (F.max("to") - 1).alias("last"),
            F.sum(F.col("to") - F.col("from") - gram + 1).alias("votes"),
            F.sum("words").alias("words"),
            F.sum("known").alias("known"),
            F.max("own").alias("own"),
        )
    )
    density = F.col("words") / (F.col("last") - F.col("first") + 1)
    least = F.when(F.col("length") <= SHORT_WORDS, SHORT_COVERAGE).otherwise(MIN_COVERAGE)
    coverage = F.col("known") / F.col("length")
    verified = spans.filter((F.col("own") == 1) & (density >= MIN_DENSITY) & (coverage >= least))
    return verified.select("row_key", "label", "first", "last", "votes", density.alias("density"), coverage.alias("coverage"))


def _places(words: Column, phrase: tuple[str, ...]) -> Column:
    """Where the words of a phrase stand one after another."""
    here = lambda i: F.slice(words, i + 1, len(phrase)) == F.array(*map(F.lit, phrase))
    every = F.filter(F.sequence(F.lit(0), F.size(words) - len(phrase)), here)
    some = (F.size(words) >= len(phrase)) & F.arrays_overlap(words, F.array(F.lit(phrase[-1])))
    return F.coalesce(F.when(some, every), F.array().cast("array<int>"))


def licenses(docs: DataFrame, notices=NOTICES, gram: int = GRAM) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``n_base`` counts the places of the fixed phrases; the labels are distinct, sorted and comma-joined. The score
    is the best coverage times density of a span, or half if only a phrase was found. NULL and empty texts have no
    words and no labels. Rows with the same id and text get equal answers; NULL ids are kept, other columns go.
    """
    docs = keyed(docs)
    spans = license_spans(docs, notices, gram).groupBy("row_key").agg(
        F.collect_set("label").alias("found"), F.max(F.col("coverage") * F.col("density")).alias("best")
    )
    words = computed_once(docs, ["doc_id", "row_key"], {"words": alnum_words(F.col("text"))})
    names = [label for label, _ in PHRASES]
    base = computed_once(
        words,
        ["doc_id", "row_key", F.size("words").cast("long").alias("n_words")],
        {name: _places(F.col("words"), phrase) for name, phrase in zip(names, (p for _, p in PHRASES), strict=True)},
    )
    every = F.concat(*(F.col(f"`{name}`") for name in names))
    base_labels = F.array_compact(F.array(*(F.when(F.size(F.col(f"`{name}`")) > 0, F.lit(name)) for name in names)))
    base = computed_once(
        base,
        ["doc_id", "row_key", "n_words"],
        {
            "n_base": F.size(every).cast("long"),
            "first_word": F.array_min(every).cast("long"),
            "last_word": F.array_max(every).cast("long"),
            "known": F.sort_array(base_labels),
        },
    )
    known, found = F.col("known"), F.coalesce(F.col("found"), F.array().cast("array<string>"))
    least = F.when(F.col("n_base") > 0, 0.5).otherwise(0.0)
    return base.join(spans, "row_key", "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.concat_ws(",", known).alias("base_labels"),
        F.concat_ws(",", F.sort_array(F.array_union(known, found))).alias("labels"),
        F.greatest(F.coalesce(F.col("best"), F.lit(0.0)), least).alias("score"),
    )
