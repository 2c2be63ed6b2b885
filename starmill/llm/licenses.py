"""License scans by diagonal voting over word k-gram hashes.

Every pair of neighbouring words of every text is hashed and joined to the
same pairs of the templates. A hit at word p of a text and place q of a
template votes for the diagonal p - q, which is where the template would begin.
A phrase stands where its diagonal has all votes. Notices may have words put in
or left out: diagonals that lie close together are merged, and a merged span is
a finding if enough of the notice's pairs voted. The words themselves travel
with the hash and are compared, so no finding rests on a hash alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starmill.llm.common import lower_ascii, row_key, same, text_of, words_of


@dataclass(frozen=True)
class Template:
    """Text in lower case, words separated by blanks. ``exact``: all words must stand consecutively."""

    label: str
    text: str
    exact: bool = False


#: The phrases of the contract.
PHRASES = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
)

#: Openings of widely used license notices.
NOTICES = (
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    Template("apache", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license"),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
)

#: Words by which neighbouring diagonals of a notice may differ, and the share of its pairs that must vote.
DRIFT, SHARE = 4, 0.6


def _pairs(words: Column) -> Column:
    """struct(first, second) for every word and the one behind it; the last one's second is null."""
    return F.arrays_zip(words.alias("first"), F.slice(words, F.lit(2), F.size(words)).alias("second"))


def _hash(pair: str) -> Column:
    return F.xxhash64(F.col(f"{pair}.first"), F.col(f"{pair}.second"))


def template_pairs(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """Positions of all pairs of the templates; as many rows as the templates have words at most."""
    if short := [t.text for t in templates if len(t.text.split()) < 2]:
        raise ValueError(f"a template needs two words: {short}")
    rows = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(t.label).alias("label"), F.lit(t.exact).alias("exact"), F.array(*map(F.lit, t.text.split())).alias("words")) for i, t in enumerate(templates)])
    each = spark.range(1).select(F.inline(rows))
    return each.select("template", "label", "exact", (F.size("words") - 1).alias("n_pairs"), F.posexplode(_pairs(F.col("words"))).alias("place", "pair")).where(F.col("pair.second").isNotNull()).select(
        "template", "label", "exact", "n_pairs", "place", _hash("pair").alias("hash"), F.col("pair.first").alias("first"), F.col("pair.second").alias("second")
    )


def license_spans(docs: DataFrame, templates: tuple[Template, ...] = PHRASES + NOTICES, drift: int = DRIFT, share: float = SHARE) -> DataFrame:
    """Findings: doc_id, key, template, label, exact, first_word, n_found (words from 0), score (share of the template's pairs).

    ``key`` is a hash of the text: rows with one id and different texts have
    findings of their own, equal rows share theirs. Null texts and texts of
    fewer than two words have none. Other columns are left out.
    """
    text = text_of()
    docs = docs.select("doc_id", row_key(text).alias("key"), words_of(lower_ascii(text)).alias("words"))
    pairs = docs.select("doc_id", "key", F.posexplode(_pairs(F.col("words"))).alias("at", "pair"))
    known = template_pairs(docs.sparkSession, templates)
    wanted = (_hash("pair") == known["hash"]) & (F.col("pair.first") == known["first"]) & (F.col("pair.second") == known["second"])
    votes = (
        pairs.join(F.broadcast(known), wanted)  # the templates are a parameter of the call, a few hundred words
        .groupBy("doc_id", "key", "template", "label", "exact", "n_pairs", (F.col("at") - F.col("place")).alias("diagonal"))
        .agg(F.collect_set("place").alias("places"))
    )
    by_place = W.partitionBy("doc_id", "key", "template").orderBy("diagonal")
    near = (F.col("diagonal") - F.lag("diagonal").over(by_place)) <= F.when(F.col("exact"), 0).otherwise(drift)
    merged = (
        votes.withColumn("begins", (~F.coalesce(near, F.lit(False))).cast("int"))
        .withColumn("span", F.sum("begins").over(by_place))
        .groupBy("doc_id", "key", "template", "label", "exact", "n_pairs", "span")
        .agg(F.min(F.col("diagonal") + F.array_min("places")).cast("long").alias("first_word"), F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"))
        .withColumn("score", F.size("places") / F.col("n_pairs"))
    )
    return merged.where(F.when(F.col("exact"), F.col("score") == 1).otherwise(F.col("score") >= share)).select("doc_id", "key", "template", "label", "exact", "first_word", (F.size("places") + 1).cast("long").alias("n_found"), "score")


def license_report(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """One row per document: words, places of phrases, labels of phrases and of all findings, best score."""
    text = text_of()
    base = F.col("exact")
    joined = lambda labels: F.array_join(F.sort_array(labels), ",")
    found = spans.groupBy("doc_id", "key").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("first_word"))).alias("first_word"),
        F.max(F.when(base, F.col("first_word"))).alias("last_word"),
        joined(F.collect_set(F.when(base, F.col("label")))).alias("base_labels"),
        joined(F.collect_set("label")).alias("labels"),
        F.max("score").alias("score"),
    )
    every = docs.select("doc_id", row_key(text).alias("key"), F.size(words_of(text)).cast("long").alias("n_words"))
    return every.join(found, same(every, found, "doc_id", "key"), "left").select(
        every["doc_id"],
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
