"""License scans: word k-gram hits joined to template positions vote for offset diagonals.

The main path is DataFrame functions only. Templates are short license notices and phrases, a
parameter of bounded size, so their k-grams are the broadcast side of the join.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

K = 3
# Characters between words, before A-Z are lower-cased.
_BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Phrases whose places are counted, with their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Opening notices of public licenses, with their labels.
NOTICES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction, including without "
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so",
    "apache-2": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
    "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
    "on an \"AS IS\" BASIS",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met: Redistributions of source code must retain the above copyright notice, "
    "this list of conditions and the following disclaimer",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
    "any later version",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "mpl-2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
    "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
    "cc-by-nc": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
    "modify, publish, use, compile, sell, or distribute this software",
}


def _split(text: Column) -> Column:
    """Words in their original case."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), _BREAKS), lambda w: w != "")


def _kgrams(rows: DataFrame, keys: list[str], position: str) -> DataFrame:
    """All rolling k-grams of the array column `words`: keys, position, w0, w1, w2, hash of the lower-cased words."""
    n = F.size("words")
    shifted = [F.slice("words", i + 1, F.greatest(n - K + 1, F.lit(0))).alias(f"w{i}") for i in range(K)]
    grams = rows.select(*keys, F.posexplode(F.arrays_zip(*shifted)).alias(position, "g"))
    low = [F.lower(F.col(f"g.w{i}")).alias(f"w{i}") for i in range(K)]
    return grams.select(
        *keys,
        position,
        *low,
        # Only ASCII letters may differ in case, so a word must keep its bytes.
        F.octet_length(F.concat(*[f"g.w{i}" for i in range(K)])).alias("octets"),
        F.xxhash64(*low).alias("h"),
    )


def templates(spark: SparkSession, phrases: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """(template, label, exact, words) of all templates with at least K words."""
    short = [p for p in phrases if len([w for w in re.split(_BREAKS, p) if w]) < K]
    if short:
        raise ValueError(f"phrases need at least {K} words to have a k-gram: {short}")
    rows = [(p, label, True) for p, label in phrases.items()] + [(t, label, False) for label, t in notices.items()]
    literal = F.array(
        *[
            F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(exact).alias("exact"), F.lit(text).alias("t"))
            for i, (text, label, exact) in enumerate(rows)
        ]
    )
    return spark.range(1).select(F.inline(literal)).select("template", "label", "exact", _split(F.col("t")).alias("words"))


def scan_licenses(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    notices: dict[str, str] = NOTICES,
    least: float = 0.6,
    drift: int = 3,
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and spans of every document.

    All rolling k-grams of a text are joined to template positions on their hash and checked word by
    word. A hit votes for the diagonal (document position - template position). A phrase occurs where its
    diagonal has a vote for each of its k-grams. For notices, diagonals at most `drift` apart are merged,
    and a merged span counts when it holds at least `least` of the template's k-grams and is at most
    twice as long as the template. score is 1 with a phrase, else the best covered fraction of a kept span.

    NULL and empty texts have no words. A document is a (doc_id, text) pair: repeated rows get equal
    results, also with NULL ids, and rows that share only the id stay apart. Other columns are ignored.
    Only hits are shuffled, as counts of one row per vote.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), _split(F.col("text")).alias("words"))
    plan = templates(spark, phrases, notices)
    grams = _kgrams(plan.withColumn("grams", F.size("words") - (K - 1)), ["template", "label", "exact", "grams"], "t_pos")
    side = grams.select("template", "label", "exact", "grams", "t_pos", "h", *[F.col(f"w{i}").alias(f"t{i}") for i in range(K)])
    same = F.lit(True)
    for i in range(K):
        same = same & (F.col(f"w{i}") == F.col(f"t{i}"))
    hits = (
        _kgrams(rows, ["doc_id", "text_hash"], "d_pos")
        .join(F.broadcast(side), "h")
        .filter(same & (F.col("octets") == F.octet_length(F.concat("t0", "t1", "t2"))))
        .select("doc_id", "text_hash", "template", "label", "exact", "grams", "t_pos", "d_pos", (F.col("d_pos") - F.col("t_pos")).alias("diagonal"))
    )
    document = ["doc_id", "text_hash"]
    template = ["template", "label", "exact", "grams"]
    votes = hits.groupBy(*document, *template, "diagonal").agg(
        F.collect_set("t_pos").alias("covered"), F.min("d_pos").alias("low"), F.max("d_pos").alias("high")
    )
    phrase = votes.filter(F.col("exact") & (F.size("covered") == F.col("grams"))).select(
        *document, "label", F.col("diagonal").alias("start"), (F.col("diagonal") + F.col("grams") + (K - 1)).alias("end"),
        F.lit(1.0).alias("score"), F.lit(True).alias("base"),
    )
    order = Window.partitionBy(*document, "template").orderBy("diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(order)
    merged = (
        votes.filter(~F.col("exact"))
        .withColumn("new", F.when(step <= drift, 0).otherwise(1))
        .withColumn("band", F.sum("new").over(order))
        .groupBy(*document, *template, "band")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("covered")))).alias("seen"),
            F.min("low").alias("start"),
            (F.max("high") + K).alias("end"),
        )
        .withColumn("score", F.col("seen") / F.col("grams"))
        .filter((F.col("score") >= least) & (F.col("end") - F.col("start") <= 2 * (F.col("grams") + K - 1)))
        .select(*document, "label", "start", "end", "score", F.lit(False).alias("base"))
    )
    span = F.struct("start", "end", "label", "score", "base")
    found = phrase.unionByName(merged).groupBy(*document).agg(
        F.count(F.when(F.col("base"), 1)).alias("n_base"),
        F.min(F.when(F.col("base"), F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("base"), F.col("start"))).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
        F.max("score").alias("score"),
        F.sort_array(F.collect_list(span)).alias("license_spans"),
    )
    words = rows.select("doc_id", "text_hash", F.size("words").cast("long").alias("n_words"))
    key = (F.col("d.doc_id").eqNullSafe(F.col("f.doc_id"))) & (F.col("d.text_hash") == F.col("f.text_hash"))
    return words.alias("d").join(found.alias("f"), key, "left").select(
        "d.doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        "license_spans",
    )
