"""Benchmark decontamination: short test items found inside long documents.

An item is contained in a document when the document has at least ``threshold`` of the
item's distinct word shingles.  Items are partitioned by size; each partition has its own
length of bottom-k MinHash sketch, one more than the shingles that an item of that size may
lack.  So a document that contains an item holds at least one shingle of its sketch, however
long the document is.  Candidates found this way are verified on all shingles.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import computed, cut_lineage, free_name, small, words

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BROADCAST_ROWS = 500_000


def _document_keys() -> list[Column]:
    """128 bits that tell rows apart by id and text; equal rows share them."""
    return [
        F.xxhash64(F.lit(1), "doc_id", "text").alias("id_hash"),
        F.xxhash64(F.lit(2), "text").alias("text_hash"),
    ]


def item_shingles(benchmark: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """``item_id, n_words, shingles`` for items that have words.

    ``shingles`` are distinct arrays of ``width`` words; the whole text where it is shorter.
    """
    listed = benchmark.select("item_id", words(F.lower("text")).alias("item_words"))
    n = F.size("item_words")
    starts = F.sequence(F.lit(1), F.greatest(n - width + 1, F.lit(1)))
    return listed.where(n > 0).select(
        "item_id",
        n.alias("n_words"),
        F.array_distinct(
            F.transform(starts, lambda at: F.slice("item_words", at, width))
        ).alias("shingles"),
    )


def sketches(items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``item_key, n_words, shingle, word, offset``: the sketch of each item, a row a shingle.

    A size partition holds items of up to 2^p shingles; its sketch has the
    ``2^p (1 - threshold) + 1`` smallest hashes.  ``word`` is the longest in the shingle.
    """
    upper = F.pow(F.lit(2.0), F.ceil(F.log2(F.size("shingles"))))
    length = (F.floor(upper * (1 - threshold) + 1e-9) + 1).cast("int")
    hashed = F.array_sort(
        F.transform("shingles", lambda s: F.struct(F.xxhash64(s).alias("h"), s.alias("s")))
    )
    shingle = items.select(
        "item_key", "n_words", F.explode(F.slice(hashed, F.lit(1), length)["s"]).alias("shingle")
    )
    longest = F.array_max(
        F.transform("shingle", lambda w, at: F.struct(F.length(w), w.alias("w"), at.alias("at")))
    )
    return shingle.withColumn("longest", longest).select(
        "item_key",
        "n_words",
        "shingle",
        F.col("longest.w").alias("word"),
        F.col("longest.at").alias("offset"),
    )


def contained_items(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    width: int = SHINGLE_WORDS,
) -> DataFrame:
    """``doc_id, id_hash, text_hash, item_id, n_item, n_shared`` for each contained item.

    Uses ``doc_id``, ``text`` of ``docs`` and ``item_id``, ``text`` of ``benchmark``.  Null
    texts and texts without words contain nothing and are contained in nothing.  A document
    of fewer than ``width`` words has one shingle, its whole text; so has an item, which is
    then found only in documents with that very text.  Equal rows give one row per item.
    Items that share an id are told apart by it only.
    """
    items = cut_lineage(
        item_shingles(benchmark, width).withColumn(
            "item_key", F.coalesce(F.col("item_id").cast("string"), F.lit(""))
        )
    )
    sketch = sketches(items, threshold).withColumn("key", F.xxhash64("word"))
    # Broadcast only a sketch of checked size; a larger one is joined by shuffle.
    if sketch.count() <= BROADCAST_ROWS:
        sketch = F.broadcast(sketch)
    listed = computed(
        docs.select("doc_id", "text", *_document_keys()), "doc_words", words(F.lower("text"))
    )
    start = F.col("place") - F.col("offset")
    equal = [
        F.get("doc_words", start + k).eqNullSafe(F.get("shingle", F.lit(k))) for k in range(width)
    ]
    whole = [
        (F.get("shingle", F.lit(k)).isNotNull() & equal[k]) | (F.size("shingle") <= k)
        for k in range(width)
    ]
    found = (start >= 0) & functools.reduce(Column.__and__, whole)
    short = F.size("doc_words") == F.col("n_words")
    # The hits of a document are put together before the shuffle, with its text once.
    pairs = (
        listed.select("*", F.posexplode("doc_words").alias("place", "doc_word"))
        .withColumn("key", F.xxhash64("doc_word"))
        .join(sketch, "key")
        .where((F.col("doc_word") == F.col("word")) & found & ((F.col("n_words") >= width) | short))
        .groupBy("doc_id", "id_hash", "text_hash")
        .agg(F.max("text").alias("text"), F.collect_set("item_key").alias("found"))
        .withColumn(
            "spaced",
            F.concat(F.lit(" "), F.array_join(words(F.lower("text")), " "), F.lit(" ")),
        )
        .withColumn("item_key", F.explode("found"))
        .join(items, "item_key")
    )
    shared = F.size(
        F.filter(
            "shingles",
            lambda s: F.when(
                F.size(s) < width,
                F.col("spaced") == F.concat(F.lit(" "), F.array_join(s, " "), F.lit(" ")),
            ).otherwise(
                F.contains("spaced", F.concat(F.lit(" "), F.array_join(s, " "), F.lit(" ")))
            ),
        )
    )
    return (
        pairs.withColumn("n_item", F.size("shingles").cast("long"))
        .withColumn("n_shared", shared.cast("long"))
        .where(F.col("n_shared") >= F.lit(threshold) * F.col("n_item") - 1e-9)
        .select("doc_id", "id_hash", "text_hash", "item_id", "n_item", "n_shared")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that contain an item; all columns as they were."""
    names = [free_name(docs, "id_hash"), free_name(docs, "text_hash")]
    bad = contained_items(docs, benchmark).select("id_hash", "text_hash").distinct()
    bad = small(cut_lineage(bad.toDF(*names)))
    marked = docs.select("*", *[key.alias(name) for key, name in zip(_document_keys(), names)])
    return marked.join(bad, names, "left_anti").select(*docs.columns)
