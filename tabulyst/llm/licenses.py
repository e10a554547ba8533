"""Licence scan by a positional index of rare words; DataFrame functions only.

Notices of common licences are templates: words with their places. Of each file the licence words of highest inverse
document frequency (counted over all files) are looked up, for each template those it holds; their postings in the file and
in the template are intersected by relative position (place in the file less place in the template). The best
position carries the share of the looked-up weight that stands there; a template counts as found if that share is
enough and all of its mandatory key phrases stand in the file.

Scale. One scan splits each text into words and keeps the number of words, the distinct licence words and, for
files that hold all words of some key phrase, the places of licence words. No text is moved; everything after is on those
places, grouped by file and template or phrase, so no group is larger than a file. Templates and phrases are
parameters of fixed size, and broadcast.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulyst.llm.frames import Stages, pick

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Licence words of a file that are looked up in each template: those of highest inverse document frequency.
LOOKED_UP = 12
#: Hundredths of the weight of a template's rarest words that must stand at one relative position, and words there.
LEAST_SHARE, LEAST_WORDS = 60, 2

#: Phrases of the base labels; each ends in the word `license`.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: (label, words of a notice, mandatory key phrases); wordings are those of the licences themselves.
TEMPLATES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation the "
            "rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
     ("permission is hereby granted free of charge", "deal in the software without restriction")),
    ("apache", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
               "the license you may obtain a copy of the license at http www apache org licenses license 2 0",
     ("apache license version 2 0", "except in compliance with the license")),
    ("gpl", "this work is licensed under the gnu general public license version 3", ("gnu general public license",)),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
            "license as published by the free software foundation either version",
     ("gnu general public license", "free software foundation")),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation",
     ("gnu lesser general public license",)),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation",
     ("gnu affero general public license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
            "following conditions are met redistributions of source code must retain the above copyright notice",
     ("redistribution and use in source and binary forms", "with or without modification are permitted")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
            "provided that the above copyright notice and this permission notice appear in all copies",
     ("for any purpose with or without fee is hereby granted",)),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
            "distributed with this file you can obtain one at", ("mozilla public license",)),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable "
             "for any damages arising from the use of this software", ("in no event will the authors be held liable",)),
    ("boost", "distributed under the boost software license version 1 0", ("boost software license",)),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ("free and unencumbered software", "public domain")),
    ("cc-by", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work cc0",
     ("waived all copyright and related or neighboring rights",)),
)


def phrases_of(templates=TEMPLATES, base=BASE) -> list[str]:
    """All distinct key phrases, base phrases first."""
    return list(dict.fromkeys([*(phrase for phrase, _ in base), *(phrase for _, _, keys in templates for phrase in keys)]))


def vocabulary(templates=TEMPLATES, base=BASE) -> list[str]:
    return sorted({word for text in [*phrases_of(templates, base), *(text for _, text, _ in templates)] for word in text.split()})


def _checked(templates, base) -> None:
    for text in [*phrases_of(templates, base), *(text for _, text, _ in templates)]:
        if not re.fullmatch(r"[0-9a-z]+( [0-9a-z]+)*", text):
            raise ValueError(f"a template or phrase is lower-case words with one blank between; it was {text!r}")


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; null has none.

    lower() changes other letters too, but none of them becomes or stops being ASCII once the Kelvin sign, which it makes a
    k, is out of the way; so words keep their bounds and those of ASCII are the same.
    """
    return F.coalesce(F.regexp_extract_all(F.lower(F.replace(text, F.lit("K"), F.lit("ĸ"))), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _texts(*values: str) -> Column:
    return F.array(*[F.lit(x) for x in values])


def _read(plain: DataFrame, templates, base) -> DataFrame:
    """file (a number), doc_id, n_words, licence words, and the places (at, word) of files that may hold a phrase."""
    split = plain.select("doc_id", words(F.col("text")).alias("w"))
    known = split.withColumn("known", F.array_intersect("w", _texts(*vocabulary(templates, base))))
    some = None
    for phrase in phrases_of(templates, base):
        own = sorted(set(phrase.split()))
        has = F.size(F.array_intersect("known", _texts(*own))) == len(own)
        some = has if some is None else some | has
    places = F.filter(F.transform("w", lambda x, i: F.struct(i.alias("at"), x.alias("word"))), lambda x: F.array_contains("known", x["word"]))
    return known.select(
        F.monotonically_increasing_id().alias("file"), "doc_id", F.size("w").cast("bigint").alias("n_words"), "known", F.when(some, places).alias("places"))


def word_weights(read: DataFrame) -> DataFrame:
    """(word, idf): floor(1000 * ln((N + 1) / (df + 1))) + 1 over the N documents with words."""
    held = read.where("n_words > 0").select(F.explode("known").alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    total = read.where("n_words > 0").count()
    return held.select("word", (F.floor(1000 * F.log((F.lit(float(total)) + 1) / (F.col("df") + 1.0))) + 1).cast("bigint").alias("idf"))


def _postings(spark, texts: list[str], name: str) -> DataFrame:
    rows = [(i, place, word) for i, text in enumerate(texts) for place, word in enumerate(text.split())]
    return F.broadcast(spark.createDataFrame(rows, f"{name} int, place int, word string"))


def _phrase_places(at: DataFrame, phrases: list[str]) -> DataFrame:
    """(file, phrase, start) of every place where a phrase's words stand consecutively."""
    lengths = F.array(*[F.lit(len(x.split())) for x in phrases])
    met = at.join(_postings(at.sparkSession, phrases, "phrase"), "word").groupBy("file", "phrase", (F.col("at") - F.col("place")).alias("start"))
    return met.agg(F.count("*").alias("n")).where(F.col("n") == lengths[F.col("phrase")]).select("file", "phrase", "start")


def _aligned(at: DataFrame, idf: DataFrame, templates) -> DataFrame:
    """(file, template, share): the weight of the looked-up words that stand at the best relative position, of all of it."""
    postings = _postings(at.sparkSession, [text for _, text, _ in templates], "template")
    # The template's rarest words; a file is measured by all of them, not only by those it has.
    by_word = postings.select("template", "word").distinct().join(idf, "word", "left").select("template", "word", F.coalesce("idf", F.lit(0)).alias("idf"))
    rarest = Window.partitionBy("template").orderBy(F.desc("idf"), "word")
    weight = by_word.withColumn("r", F.row_number().over(rarest)).where(F.col("r") <= LOOKED_UP).groupBy("template").agg(F.sum("idf").alias("all"))
    held = at.select("file", "word").distinct().join(F.broadcast(by_word), "word")
    looked = held.withColumn("r", F.row_number().over(Window.partitionBy("file", "template").orderBy(F.desc("idf"), "word"))).where(F.col("r") <= LOOKED_UP)
    met = at.join(looked.select("file", "template", "word", "idf"), ["file", "word"]).join(postings, ["template", "word"])
    one = met.groupBy("file", "template", (F.col("at") - F.col("place")).alias("start"), "word").agg(F.first("idf").alias("idf"))
    best = one.groupBy("file", "template", "start").agg(F.sum("idf").alias("idf"), F.count("*").alias("n"))
    best = best.where(F.col("n") >= LEAST_WORDS).groupBy("file", "template").agg(F.max("idf").alias("idf"))
    shares = best.join(F.broadcast(weight), "template").where("all > 0").select("file", "template", (F.col("idf") / F.col("all")).alias("share"))
    return shares.withColumn("share", F.least("share", F.lit(1.0))).where(F.col("share") * 100 >= LEAST_SHARE)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates=TEMPLATES, base=BASE) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score (0 to 1).

    n_base, first_word and last_word are of the places of base phrases; labels are the base ones and those of the templates
    found; score is the greatest share of a template found, 0 if none is. A null, empty or wordless text has no words, no
    labels and score 0; whole texts are read, however long. Repeated rows are each reported. Without documents there is no
    row. Extra columns are ignored, whatever their names. Templates and phrases are lower-case ASCII words.
    """
    _checked(templates, base)
    stages, phrases = Stages(docs.sparkSession), phrases_of(templates, base)
    read = stages.keep(_read(pick(docs, {"doc_id": doc_id, "text": text}), templates, base), "read")
    idf = stages.keep(word_weights(read), "idf")
    some = read.where("places IS NOT NULL")
    at = some.select("file", F.explode("places").alias("p")).select("file", "p.at", "p.word")
    found = stages.keep(_phrase_places(at, phrases), "phrases")

    labels = F.array(*[F.lit(label) for _, label in base], *[F.lit("") for _ in phrases[len(base) :]])
    is_base = F.col("phrase") < len(base)
    by_file = found.groupBy("file").agg(
        F.count(F.when(is_base, 1)).alias("n_base"), F.min(F.when(is_base, F.col("start"))).alias("first_word"), F.max(F.when(is_base, F.col("start"))).alias("last_word"),
        F.collect_set(F.when(is_base, labels[F.col("phrase")])).alias("base"), F.collect_set("phrase").alias("held"))
    keys = F.array(*[F.array(*[F.lit(phrases.index(x)) for x in own]) for _, _, own in templates])
    names = F.array(*[F.lit(label) for label, _, _ in templates])
    shares = _aligned(at, idf, templates).groupBy("file").agg(F.collect_list(F.struct("template", "share")).alias("shares"))
    rows = some.select("file", "doc_id", "n_words").join(by_file, "file", "left").join(shares, "file", "left")
    verified = F.filter("shares", lambda x: F.size(F.array_except(keys[x["template"]], F.col("held"))) == 0)
    rows = rows.withColumn("v", F.coalesce(verified, F.filter("shares", lambda x: F.lit(False))))
    none = F.array().cast("array<string>")
    all_labels = F.array_union(F.coalesce("base", none), F.coalesce(F.transform("v", lambda x: names[x["template"]]), none))
    joined = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    with_places = rows.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
        F.col("first_word").cast("bigint").alias("first_word"), F.col("last_word").cast("bigint").alias("last_word"),
        joined(F.coalesce("base", none)).alias("base_labels"), joined(all_labels).alias("labels"),
        F.coalesce(F.array_max(F.transform("v", lambda x: x["share"])), F.lit(0.0)).alias("score"))
    nothing = F.lit(None).cast("bigint")
    return with_places.union(read.where("places IS NULL").select(
        "doc_id", "n_words", F.lit(0).cast("bigint"), nothing, nothing, F.lit(""), F.lit(""), F.lit(0.0)))
