"""License scans with a positional rare-token index (DataFrame functions only).

Two parts.  The base finds every place of fixed phrases in the word sequence.
The index part recognises licence *texts*: the words of a few template lines
are indexed with their positions and their IDF over the templates.  Files that
hold all mandatory phrases of a template are looked up: the index entries of
their words are intersected by relative position (words that vote for one
(template, offset) stand as in the template), and the ``RARE`` agreeing words
of highest IDF are kept.  A template with ``VOTES`` of them gives its label;
the score is the share of the template's rare words that agree (1 for a
base phrase).

The index has a few hundred rows (a constant of the code) and is broadcast;
postings of the files are shuffled as ids and numbers only.

Defined results: null and empty texts have no words, no labels and score 0;
very long texts are searched whole; phrases that share a word count at each
place; rows with equal id and text share their (equal) results; a null id
stays null; an empty table gives an empty table; columns other than id and
text are not read, so clashing names do not matter.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Base phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
#: Opening lines of common licences: label, mandatory phrases, text.
TEMPLATES = (
    ("mit-text", ("permission is hereby granted", "without restriction"),
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction"),
    ("bsd-text", ("redistribution and use",),
     "redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met"),
    ("apache-text", ("licensed under the apache license",),
     "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
     "with the license"),
    ("gpl-text", ("free software", "gnu general public license"),
     "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation"),
    ("mpl-text", ("mozilla public license",),
     "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc-text", ("permission to use copy modify",),
     "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc-text", ("creative commons",),
     "this work is licensed under a creative commons attribution international license"),
)
RARE, VOTES = 8, 5
SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _index(templates) -> list[tuple[str, int, int, float]]:
    """(word, template, position, idf) of each template's words of three letters or more."""
    words = [t.split() for _, _, t in templates]
    held = {w: sum(w in t for t in words) for t in words for w in t}
    idf = {w: math.log((1 + len(templates)) / n) for w, n in held.items()}
    out = []
    for k, t in enumerate(words):
        out += [(w, k, p, idf[w]) for p, w in enumerate(t) if len(w) > 2]
    return out


def _has(phrase: str, padded=None):
    """The phrase's words stand consecutively in the padded word string."""
    return F.contains(F.col("_p") if padded is None else padded, F.lit(f" {phrase} "))


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, places, label_list, base_list, score)``; places is an
    array of (word position, label) of the base phrases."""
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_t"))
    d = d.select("doc_id", F.xxhash64("_t").alias("_row"), F.btrim(F.regexp_replace("_t", SEPARATOR, " ")).alias("_n"))
    d = d.withColumn("_p", F.concat(F.lit(" "), F.lower("_n"), F.lit(" ")))
    words = F.when(F.col("_n") == "", F.array().cast("array<string>")).otherwise(F.split("_n", " "))

    # Base phrases: the word array is searched only where a phrase occurs.
    found = []
    for phrase, label in phrases:
        w = phrase.split()
        # Of equal byte length: lower() also folds a few letters beyond A-Z, whose encodings are longer.
        test = " AND ".join(f"(octet_length(get(_w, i + {k})) = {len(x)} AND lower(get(_w, i + {k})) = '{x}')"
                            for k, x in enumerate(w))
        found.append(F.when(_has(phrase), F.expr(
            f"transform(filter(sequence(0, greatest(0, size(_w) - {len(w)})), i -> {test}), "
            f"i -> named_struct('start', cast(i as long), 'label', '{label}'))"))
            .otherwise(F.expr("cast(array() as array<struct<start: bigint, label: string>>)")))
    flags = [F.when(_all(_has(p) for p in must), F.lit(k)) for k, (_, must, _) in enumerate(templates)]
    base = d.select("doc_id", "_row", "_p", words.alias("_w")).select(
        "doc_id", "_row", F.size("_w").cast("long").alias("n_words"),
        F.array_sort(F.concat(*found)).alias("places"),
        (F.array_compact(F.array(*flags)) if flags else F.array().cast("array<int>")).alias("_phrases"))

    index = F.broadcast(spark.createDataFrame(_index(templates) or [("", -1, 0, 0.0)],
                                              "word string, tpl int, pos int, idf double"))
    # Labels need the phrases, so no other file is looked up.  The array keeps the filter from normalising a text anew for each phrase.
    near = d.where(F.exists(F.array("_p"), lambda p: _any(_all(_has(x, p) for x in must) for _, must, _ in templates)))
    hits = (near.select("doc_id", "_row", F.posexplode(F.split(F.lower("_n"), " ")).alias("at", "word"))
            .join(index, "word"))
    votes = hits.groupBy("doc_id", "_row", "tpl", (F.col("at") - F.col("pos")).alias("off")).agg(
        F.sort_array(F.collect_set(F.struct("idf", "word")), asc=False).alias("rare"))
    size = F.create_map(*[F.lit(x) for k in range(len(templates)) for x in (
        k, float(min(RARE, len({w for w, t, _, _ in _index(templates) if t == k}))))]) if templates else None
    votes = (votes.select("doc_id", "_row", "tpl", F.size(F.slice("rare", 1, RARE)).alias("n"))
             .where(F.col("n") >= VOTES)
             .groupBy("doc_id", "_row", "tpl").agg(F.max("n").alias("n"))
             .select("doc_id", "_row", "tpl", (F.col("n") / (size[F.col("tpl")] if templates else F.lit(1.0))).alias("share"))
             .groupBy("doc_id", "_row").agg(F.collect_set(F.struct("tpl", "share")).alias("votes"))
             .select(F.col("doc_id").alias("_d"), F.col("_row").alias("_r"), "votes"))
    names = F.array(*[F.lit(t[0]) for t in templates]) if templates else F.array().cast("array<string>")
    out = base.join(votes, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_row") == F.col("_r")), "left")
    sure = F.filter("votes", lambda v: F.array_contains(F.col("_phrases"), v["tpl"]))
    out = out.withColumn("_sure", F.coalesce(sure, F.expr("cast(array() as array<struct<tpl: int, share: double>>)")))
    based = F.array_sort(F.array_distinct(F.col("places.label")))
    return out.select(
        "doc_id", "n_words", "places", based.alias("base_list"),
        F.array_sort(F.array_distinct(F.concat(F.col("places.label"), F.transform("_sure", lambda v: F.get(names, v["tpl"])))))
        .alias("label_list"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(
            F.coalesce(F.array_max(F.transform("_sure", lambda v: F.least(F.lit(1.0), v["share"]))), F.lit(0.0))).alias("score"))


def _all(conditions):
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def _any(conditions):
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out
