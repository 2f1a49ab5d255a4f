"""Finding license texts by diagonal voting.

The hash of every rolling gram of ``k`` words of a document is joined to the places it has
in the templates.  A hit votes for the diagonal (place in the document minus place in the
template); neighbouring diagonals of one template are merged, so that a span may hold a
few added or lost words.  A span is verified by the longest chain of its hits in which both
places rise: it is kept if enough of the template's grams stand in it in their order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.text import any_lower, computed, small

NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases and the labels they stand for.
BASE_PHRASES = {
    "cc-by": "cc by",
    "gpl": "general public license",
    "reserved": "all rights reserved",
}

# Wordings of license notices and the labels they stand for.
NOTICES = {
    "apache-2.0": (
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license",
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without "
        "modification are permitted provided that the following conditions are met",
    ),
    "cc-by-nc-4.0": ("licensed under cc by nc 4 0",),
    "cc-by-sa-4.0": ("licensed under cc by sa 4 0",),
    "gpl-notice": (
        "this work is licensed under the gnu general public license version",
        "this program is free software you can redistribute it and or modify it",
    ),
    "mit": (
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
    ),
}
GRAM = 2
MAX_SHIFT = 2
MIN_SHARE = 0.8
WORDING = ["template", "label", "base", "grams"]

GRAMS = "template long, label string, base boolean, grams int, at int, gram array<string>"


def _parts(text: Column) -> Column:
    lowered = any_lower(F.coalesce(text, F.lit("")))
    return F.array_remove(F.split(lowered, NON_WORD), "")


def template_grams(texts: DataFrame, k: int = GRAM) -> DataFrame:
    """One row per gram of each template; ``texts`` has ``label``, ``base`` and ``text``.

    Repeated templates count once.  Null labels, and texts of fewer than ``k`` words, are
    errors when the rows are read.
    """
    short = F.raise_error(F.concat(F.lit(f"a template needs a label and {k} words: "), F.coalesce("text", F.lit(""))))
    listed = computed(texts.select("label", "base", "text").distinct(), "parts", _parts(F.col("text")))
    return listed.select(
        F.xxhash64("label", "base", "text").alias("template"),
        "label",
        F.coalesce("base", F.lit(False)).alias("base"),
        (F.size("parts") - (k - 1)).alias("grams"),
        F.explode(
            F.when(
                F.col("label").isNotNull() & (F.size("parts") >= k),
                F.transform(
                    F.sequence(F.lit(0), F.size("parts") - k),
                    lambda at: F.struct(at.alias("at"), F.slice("parts", at + 1, k).alias("gram")),
                ),
            ).otherwise(short)
        ).alias("found"),
    ).select(*WORDING, "found.*")


def templates(
    spark: SparkSession,
    phrases: Mapping[str, str] = BASE_PHRASES,
    notices: Mapping[str, Sequence[str]] = NOTICES,
    k: int = GRAM,
) -> DataFrame:
    """``template_grams`` of the given texts; no phrase may be shorter than ``k`` words."""
    wordings = [(label, True, text) for label, text in phrases.items()]
    wordings += [(label, False, text) for label, texts in notices.items() for text in texts]
    for _, _, text in wordings:
        if len(text.split()) < k:
            raise ValueError(f"a template needs {k} words at least: {text!r}")
    return template_grams(spark.createDataFrame(wordings, "label string, base boolean, text string"), k)


def least_grams(grams: Column) -> Column:
    """Grams a notice needs in order: ``MIN_SHARE`` of them, and of four three will do."""
    return F.when(grams == 4, 3).otherwise(F.ceil(MIN_SHARE * grams))


def _chain(hits: Column) -> Column:
    """``place, start`` of each length of rising chain of (at, back, place), shortest first.

    With hits in order of ``at`` and, for one ``at``, of falling place, a chain with rising
    places takes each ``at`` once; of each length the one that ends first is kept.
    """

    def longer(kept: Column, hit: Column) -> Column:
        before = F.size(F.filter(kept, lambda end: end["place"] < hit["place"]))
        start = F.when(before == 0, hit["place"]).otherwise(F.get(kept, before - 1)["start"])
        end = F.struct(hit["place"].alias("place"), start.alias("start"))
        return F.concat(
            F.slice(kept, F.lit(1), before),
            F.array(end),
            F.slice(kept, before + 2, F.size(kept)),
        )

    none = F.array().cast("array<struct<place:int,start:int>>")
    return F.aggregate(F.array_sort(hits), none, longer)


def scan_licenses(docs: DataFrame, wordings: DataFrame, k: int = GRAM) -> DataFrame:
    """``doc_id, n_words, spans`` per row of ``docs`` (``doc_id``, ``text``; others ignored).

    ``spans`` is an array of ``label, base, first_word, last_word, share`` by place.  Base
    phrases must stand word for word on one diagonal; notices need ``least_grams`` of their
    grams, in order, on diagonals at most ``MAX_SHIFT`` apart.  Null text is empty; equal rows
    stay apart rows; an empty table gives an empty one.  ``wordings`` are ``template_grams``
    with the same ``k``: counted, and broadcast if few; else grams are shuffled, never texts.

    The join is on the hash of a gram; its words decide in the same step.  Every document
    ends in one empty word, which hits an entry of its own: so documents without a hit
    stay, equal ones are counted, and the text is read once.
    """
    document = ["doc_id", "id_hash", "text_hash", "n_words"]
    words = [f"word_{i}" for i in range(k)]
    listed = computed(
        docs.select(
            "doc_id",
            F.xxhash64(F.lit(1), "doc_id", F.coalesce("text", F.lit(""))).alias("id_hash"),
            F.xxhash64(F.lit(2), F.coalesce("text", F.lit(""))).alias("text_hash"),
            "text",
        ),
        "parts",
        F.array_append(_parts(F.col("text")), F.lit("")),
    )
    ending = ["", *[None] * (k - 1)]
    own = wordings.sparkSession.createDataFrame([(None, None, None, None, None, ending)], GRAMS)
    entries = wordings.unionByName(own).select(
        *WORDING,
        "at",
        F.xxhash64(*[F.col("gram")[i] for i in range(k)]).alias("gram_hash"),
        *[F.col("gram")[i].alias(f"{word}_of") for i, word in enumerate(words)],
    )
    rest = [F.get("parts", F.col("place") + i).alias(word) for i, word in enumerate(words) if i]
    same = [F.col(word).eqNullSafe(F.col(f"{word}_of")) for word in words]
    hits = (
        listed.select(
            "doc_id",
            "id_hash",
            "text_hash",
            (F.size("parts") - 1).cast("long").alias("n_words"),
            "parts",
            F.posexplode("parts").alias("place", "word_0"),
        )
        .select(*document, "place", "word_0", *rest)
        .withColumn("gram_hash", F.xxhash64(*words))
        .join(small(entries), "gram_hash")
        .where(reduce(and_, same))
        .select(*document, *WORDING, "at", "place", (F.col("place") - F.col("at")).alias("diagonal"))
    )
    votes = hits.groupBy(*document, *WORDING, "diagonal").agg(
        F.collect_set("at").alias("ats"),
        F.min("place").alias("first"),
        (F.max("place") + (k - 1)).alias("last"),
        F.count("*").alias("copies"),
    )
    exact = votes.where("template is null or base and size(ats) = grams").withColumn("in_order", F.col("grams"))
    of_template = Window.partitionBy(*document, *WORDING).orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(of_template)
    on_diagonal = F.transform(
        "ats",
        lambda at: F.struct(
            at.alias("at"),
            (-at - F.col("diagonal")).alias("back"),
            (at + F.col("diagonal")).alias("place"),
        ),
    )
    # A diagonal with one vote may be a part of a notice that a few words were added to.
    merged = (
        votes.where("not base")
        .withColumn("apart", F.coalesce((gap > MAX_SHIFT).cast("int"), F.lit(0)))
        .withColumn("run", F.sum("apart").over(of_template))
        .groupBy(*document, *WORDING, "run")
        .agg(F.flatten(F.collect_list(on_diagonal)).alias("hits"), F.sum("copies").alias("copies"))
        # Most runs are a word or two that many texts share: they cannot be long enough.
        .where(F.size(F.array_distinct(F.col("hits.at"))) >= least_grams(F.col("grams")))
    )
    verified = (
        computed(merged, "chain", _chain(F.col("hits")))
        .withColumn("in_order", F.size("chain"))
        .where(F.col("in_order") >= least_grams(F.col("grams")))
        .withColumn("first", F.element_at("chain", -1)["start"])
        .withColumn("last", F.element_at("chain", -1)["place"] + (k - 1))
    )
    span = F.struct(
        F.col("first").cast("long").alias("first_word"),
        F.col("last").cast("long").alias("last_word"),
        "label",
        "base",
        (F.col("in_order") / F.col("grams")).alias("share"),
    )
    kept = [*document, "template", "label", "base", "grams", "copies", "in_order", "first", "last"]
    return (
        exact.select(*kept)
        .unionByName(verified.select(*kept))
        .groupBy(*document)
        .agg(
            F.max(F.when(F.col("template").isNull(), F.col("copies"))).cast("int").alias("copies"),
            F.sort_array(F.collect_list(F.when(F.col("template").isNotNull(), span))).alias("spans"),
        )
        .select("doc_id", "n_words", "spans", F.explode(F.array_repeat(F.lit(0), F.col("copies"))))
        .drop("col")
    )
