"""Licences in texts: known phrases, and notices found through the positions of their rare words.

Templates of licence notices are indexed by word: which template has it and where. Of each template's
words that a text has, those rarest in all texts (highest inverse document frequency) are looked up; each posting
votes for its template at a relative position, and votes that agree on it, give or take a few words, are
counted once per word. A template counts if enough of its rare words agree and its mandatory phrase stands in the text.

Built-in functions only. One pass makes a stored profile per text; only texts with rare licence words are read
again. What is sent to every task, the index and word ranks, is bounded by the templates.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.llm.columns import bind, join_by_size
from stratamart.workspace import materialize

# Phrases that are reported wherever their words stand one after the other.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Licence notices as they are usually worded, each with its label and a phrase it must have.
TEMPLATES = (
    ("mit", "mit license", "released under the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
    ),
    ("apache-2.0", "apache license version 2 0", "licensed under the apache license version 2 0"),
    (
        "apache-2.0",
        "apache license version 2 0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
        "the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required "
        "by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
    ),
    ("gpl-3.0", "gnu general public license version 3", "this work is licensed under the gnu general public license version 3"),
    (
        "gpl",
        "gnu general public license",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation either version 3 of the license or at your option any later version",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met redistributions of source code must retain the above copyright notice",
    ),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "cc by sa", "licensed under cc by sa 4 0"),
    (
        "cc-by",
        "creative commons attribution",
        "this work is licensed under a creative commons attribution 4 0 international license",
    ),
    (
        "mpl-2.0",
        "mozilla public license",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    # Without the third clause the disclaimer follows the second.
    (
        "bsd-2-clause",
        "materials provided with the distribution this software is provided by",
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
        "disclaimer in the documentation and or other materials provided with the distribution this software is provided by "
        "the copyright holders and contributors as is and any express or implied warranties",
    ),
    (
        "bsd-3-clause",
        "neither the name of",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission",
    ),
    (
        "lgpl",
        "gnu lesser general public license",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general "
        "public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    ),
    (
        "agpl",
        "gnu affero general public license",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general "
        "public license as published by the free software foundation either version 3 of the license or at your option any later version",
    ),
    (
        "cc0",
        "waived all copyright and related or neighboring rights",
        "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    ),
    (
        "unlicense",
        "free and unencumbered software released into the public domain",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use "
        "compile sell or distribute this software either in source code form or as a compiled binary for any purpose "
        "commercial or non commercial and by any means",
    ),
    (
        "epl",
        "eclipse public license",
        "this program and the accompanying materials are made available under the terms of the eclipse public license",
    ),
    (
        "zlib",
        "permission is granted to anyone to use this software for any purpose",
        "in no event will the authors be held liable for any damages arising from the use of this software permission is "
        "granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely",
    ),
)

# What does not belong to words of lower-cased text: ASCII other than digits and letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_ANY_PHRASE = "(?i)" + "|".join(
    r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+".join(p.split()) for p in PHRASES
)

RARE = 12
LEAST_IDF = 1.5
LEAST_SHARE = 0.6
SLACK = 8
BASE_SCORE = 0.5
BROADCAST_BYTES = 16 << 20

_VOCABULARY = sorted({w for _, _, text in TEMPLATES for w in text.split()})


def license_words(text: Column) -> Column:
    # Of letters beyond A-Z the case stays: words are compared as they are written.
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def _places(words: Column) -> Column:
    """(place, label) of every phrase."""

    def label_at(i: Column) -> Column:
        found = F.lit(None).cast("string")
        for phrase, label in PHRASES.items():
            parts = phrase.split()
            same = reduce(lambda a, b: a & b, (F.get(words, i + k) == w for k, w in enumerate(parts)))
            found = F.when(same, label).otherwise(found)
        return F.struct(i.cast("long").alias("place"), found.alias("label"))

    every = F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(F.transform(every, label_at), lambda x: x["label"].isNotNull())


def _profiles(texts: DataFrame) -> DataFrame:
    """Word count, places of the phrases, and the templates' words that each text has."""

    def of_words(w: Column) -> Column:
        none = F.array().cast("array<struct<place:bigint,label:string>>")
        places = F.when(F.col("text").rlike(_ANY_PHRASE), _places(w)).otherwise(none)
        had = F.array_intersect(F.array(*map(F.lit, _VOCABULARY)), w)
        return F.struct(F.size(w).cast("long").alias("n_words"), places.alias("places"), had.alias("had"))

    return texts.select("doc_id", "key", bind(license_words(F.col("text")), of_words).alias("p")).select("doc_id", "key", "p.*")


def _ranked(profile: DataFrame) -> tuple[list[str], int]:
    """The templates' words that texts have, rarest first, and how many of them are rare in all texts."""
    texts = profile.count()
    counts = profile.select(F.explode("had").alias("word")).groupBy("word").count()
    idf = F.log((F.lit(float(texts)) + 1) / (F.col("count") + 1))
    rows = counts.select("word", idf.alias("idf")).collect()
    return [r.word for r in sorted(rows, key=lambda r: (-r.idf, r.word))], sum(r.idf >= LEAST_IDF for r in rows)


def _notices(texts: DataFrame, profile: DataFrame, ranked: list[str], n_rare: int) -> DataFrame:
    """Per key the labels of the notices found, and the best share of rare words that agree.

    Where the words rare in all texts do not show a notice, its rarest words are taken however frequent
    they are: those of a notice that much of the table carries are frequent.
    """
    # Only texts that have all words of a template's phrase can hold the phrase.
    phrases = [F.array(*map(F.lit, phrase.split())) for _, phrase, _ in TEMPLATES]
    possible = reduce(lambda a, b: a | b, (F.size(F.array_except(p, F.col("had"))) == 0 for p in phrases))
    looked_up = F.array_intersect(F.array(*map(F.lit, ranked)), F.col("had"))
    some = profile.where(possible).select("key", looked_up.alias("words")).distinct()
    some = materialize(some, "licence-words")
    again = join_by_size(texts.select("key", "text"), some, "key", "inner", 24 * F.size("words"), BROADCAST_BYTES).distinct()

    # A single rare word has nothing to agree with.
    rare_words = F.array_intersect("words", F.array(*map(F.lit, ranked[:n_rare])).cast("array<string>"))
    rare_words = F.when(F.size(rare_words) > 1, rare_words).otherwise(F.array().cast("array<string>"))

    def top(words: Column, text: str) -> Column:
        """The rarest words of a template that the text has, whatever other templates' words it has."""
        return F.slice(F.filter(words, lambda w: w.isin(*set(text.split()))), 1, RARE)

    def tops(t: int, text: str) -> Column:
        return F.struct(F.lit(t).alias("template"), top(rare_words, text).alias("rare"), top(F.col("words"), text).alias("top"))

    def of_words(w: Column) -> Column:
        line = F.concat(F.lit(" "), F.array_join(w, " "), F.lit(" "))
        held = bind(
            line,
            lambda x: F.array_compact(
                F.array(
                    *(
                        F.when(x.contains(f" {phrase} "), tops(t, text))
                        for t, (_, phrase, text) in enumerate(TEMPLATES)
                    )
                )
            ),
        )
        places = F.transform(w, lambda x, i: F.struct(x.alias("word"), i.alias("place")))

        def hits(h: Column) -> Column:
            every = bind(F.array_distinct(F.flatten(h["top"])), lambda t: F.filter(places, lambda x: F.array_contains(t, x["word"])))
            return F.struct(h.alias("held"), F.when(F.size(h) > 0, every).alias("hits"))

        return bind(held, hits)

    hits = (
        again.select("key", bind(license_words(F.col("text")), of_words).alias("w"))
        .select("key", "w.hits", F.explode("w.held").alias("held"))
        # The rare words of a template are the first of its top.
        .select(
            "key",
            "held.template",
            "held.rare",
            F.explode(F.filter("hits", lambda x: F.array_contains("held.top", x["word"]))).alias("hit"),
        )
        .select("key", "template", "hit", F.array_contains("rare", F.col("hit.word")).alias("is_rare"))
    )
    postings = [
        (t, label, word, place, *(min(RARE, len(set(text.split()) & set(some_words))) for some_words in (ranked[:n_rare], ranked)))
        for t, (label, _, text) in enumerate(TEMPLATES)
        for place, word in enumerate(text.split())
        if word in ranked
    ]
    index = texts.sparkSession.createDataFrame(postings, "of int, label string, word string, at int, n_rare int, n_top int")
    shift = F.col("hit.place") - F.col("at")
    # Two ways of cutting positions, so that votes a little apart meet in one of them.
    near = F.explode(F.array(2 * F.floor(shift / SLACK), 2 * F.floor((shift + SLACK // 2) / SLACK) + 1)).alias("near")
    votes = (
        hits.join(F.broadcast(index), (F.col("hit.word") == F.col("word")) & (F.col("template") == F.col("of")))
        .select("key", "template", "label", "n_rare", "n_top", "word", F.when(F.col("is_rare"), F.col("word")).alias("rare"), near)
        .groupBy("key", "template", "label", "n_rare", "n_top", "near")
        .agg(F.size(F.collect_set("rare")).alias("agree_rare"), F.size(F.collect_set("word")).alias("agree"))
    )
    best = votes.groupBy("key", "template", "label").agg(
        F.max(F.least(F.try_divide("agree_rare", "n_rare"), F.lit(1.0))).alias("share_rare"),
        F.max(F.least(F.col("agree") / F.col("n_top"), F.lit(1.0))).alias("share_top"),
    )
    share = F.when(F.col("share_rare") >= LEAST_SHARE, F.col("share_rare")).otherwise(F.col("share_top"))
    return (
        best.select("key", "label", share.alias("share"))
        .where(F.col("share") >= LEAST_SHARE)
        .groupBy("key")
        .agg(F.collect_set("label").alias("notices"), F.max("share").alias("share"))
    )


def licenses(docs: DataFrame) -> DataFrame:
    """Per row of docs: n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are those of the text with A-Z in lower case. ``n_base`` counts the places of all phrases; first_word and
    last_word are their smallest and largest word, null without any. ``labels`` adds those of notices
    found through rare words. ``score`` is the best share of a notice's rare words, at least 0.5 where a
    phrase was found, else 0. Null and empty texts have no words and no labels. Repeated rows give equal rows
    and count each in the frequencies; null ids are kept; an empty table gives no rows; other columns are ignored.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.xxhash64("doc_id", "text"))
    profile = materialize(_profiles(texts), "licence-profiles")
    ranked, n_rare = _ranked(profile)
    size_of = 16 * F.size("notices")
    if ranked:
        found = materialize(_notices(texts, profile, ranked, n_rare), "notices")
        profile = join_by_size(profile, found, "key", "left", size_of, BROADCAST_BYTES)
    else:
        profile = profile.withColumn("notices", F.lit(None).cast("array<string>")).withColumn("share", F.lit(None).cast("double"))
    places, base = F.col("places.place"), F.array_distinct("places.label")
    every = F.array_union(base, F.coalesce("notices", F.array().cast("array<string>")))
    return profile.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.greatest(F.coalesce("share", F.lit(0.0)), F.when(F.size("places") > 0, BASE_SCORE).otherwise(0.0)).alias("score"),
    )
