"""Mixing sources to target weights by fitting each source's word budget exactly.

Documents are counted by length per source.  A bounded knapsack over those counts says
how many documents of each length fill what whole passes over the source leave open;
a seeded order says which ones.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.text import cut_lineage, null_safe_key, word_count

KNAPSACK_WORDS = 1 << 16
BUCKET_ROWS = 4096
PLAN_SCHEMA = (
    "skey string, size long, n long, source_size long, target double, "
    "passes long, take long"
)


def knapsack(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many items of each size bring the sum nearest to ``budget``.

    Ties go to the smaller sum.  Time is (sizes x log counts) x budget, memory
    10 bytes a word of budget.
    """
    taken = np.zeros(len(sizes), dtype=np.int64)
    fits = (sizes > 0) & (counts > 0)
    if budget <= 0 or not fits.any():
        return taken
    limit = 2 * budget  # to take nothing is as near as any larger sum
    reached = np.zeros(limit + 1, dtype=bool)
    reached[0] = True
    by_item = np.full(limit + 1, -1, dtype=np.int32)
    items: list[tuple[int, int]] = []
    for k in np.flatnonzero(fits)[::-1]:
        size, left, times = int(sizes[k]), min(int(counts[k]), limit // int(sizes[k])), 1
        while left > 0 and not reached[budget]:
            times = min(times, left)
            step = size * times
            fresh = np.flatnonzero(reached[: limit + 1 - step] & ~reached[step:]) + step
            reached[fresh] = True
            by_item[fresh] = len(items)
            items.append((int(k), times))
            left -= times
            times *= 2
    sums = np.flatnonzero(reached)
    at = int(sums[np.argmin(np.abs(sums - budget))])
    while at:
        k, times = items[by_item[at]]
        taken[k] += times
        at -= int(sizes[k]) * times
    return taken


def fit_budget(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Documents to take of each length (``sizes`` ascending) for ``budget`` words.

    What the knapsack cannot hold is shared out first, in proportion, so that the mix keeps
    the source's lengths; the longest documents left over fill what the shares round off.
    """
    total = int((sizes * counts).sum())
    if budget <= 0 or total == 0:
        return np.zeros(len(sizes), dtype=np.int64)
    shared = max(budget - KNAPSACK_WORDS, 0)
    taken = np.array([int(c) * shared // total for c in counts], dtype=np.int64)
    taken = np.minimum(taken, counts)
    rest = budget - int((taken * sizes).sum())
    for k in range(len(sizes) - 1, -1, -1):
        if rest <= KNAPSACK_WORDS:
            break
        if sizes[k]:
            more = min(int(counts[k] - taken[k]), rest // int(sizes[k]))
            taken[k] += more
            rest -= more * int(sizes[k])
    return taken + knapsack(sizes, counts - taken, rest)


def _plan_source(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("size", ignore_index=True)
    size, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
    passes = int(target // size) if size else 0
    budget = round(target - passes * size)
    group["passes"] = passes
    group["take"] = fit_budget(
        group["size"].to_numpy(np.int64), group["n"].to_numpy(np.int64), budget
    )
    return group[[part.split()[0] for part in PLAN_SCHEMA.split(", ")]]


def source_targets(
    counted: DataFrame, weights: Sequence[int] = (1, 2, 3), max_passes: int = 3
) -> DataFrame:
    """``skey, source_size, target`` from ``skey, size, n``, one row per source.

    Sources in code point order, null last, weigh ``weights`` in turn.  The level at
    which weight x level, cut at ``max_passes`` x size, adds up to the whole is the
    largest of the levels that hold the 0, 1, 2, ... sources with the lowest ceilings.
    The windows run over one row per source.
    """
    sizes = counted.groupBy("skey").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    order = Window.orderBy((F.col("skey") == "").cast("int"), "skey")
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (turn + 1).cast("int"))
    everything = Window.partitionBy()
    rising = Window.orderBy(F.col("ceiling") / F.col("weight"), "skey")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    onwards = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(everything)
        - F.coalesce(F.sum("ceiling").over(before), F.lit(0))
    ) / F.sum("weight").over(onwards)
    return (
        sizes.withColumn("weight", weight)
        .withColumn("ceiling", F.col("source_size") * max_passes)
        .withColumn("level", level)
        .withColumn("level", F.max("level").over(everything))
        .select(
            "skey",
            "source_size",
            F.least(F.col("weight") * F.col("level"), F.col("ceiling").cast("double")).alias("target"),
        )
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    max_passes: int = 3,
    seed: int = 17,
) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken, repeats`` per row of ``docs``.

    Uses ``doc_id``, ``text`` and ``source``; other columns are ignored.  Null text has
    size 0 and is taken 0 words; a null source is a source of its own, after all others.
    Equal rows are told apart by an arbitrary order, which changes no value.  An empty
    table gives an empty one.  ``repeats`` says how often the mix holds the document.
    """
    sized = cut_lineage(
        docs.select(
            "doc_id",
            "source",
            null_safe_key(F.col("source")).alias("skey"),
            word_count(F.col("text")).alias("size"),
        )
    )
    counted = sized.groupBy("skey", "size").agg(F.count("*").alias("n"))
    plan = (
        counted.join(source_targets(counted, weights, max_passes), "skey")
        .groupBy("skey")
        .applyInPandas(_plan_source, PLAN_SCHEMA)
    )
    # Each length of each source is one key; adaptive execution splits a crowded one.
    planned = cut_lineage(
        sized.join(plan, ["skey", "size"])
        .withColumn("order_hash", F.xxhash64(F.lit(seed), "doc_id"))
        .withColumn(
            "bucket",
            F.expr(f"pmod(order_hash, cast(ceil(n / {BUCKET_ROWS}) as bigint))"),
        )
    )
    key = ["skey", "size", "bucket"]
    some = planned.where((F.col("take") > 0) & (F.col("take") < F.col("n")))
    earlier = Window.partitionBy("skey", "size").orderBy("bucket")
    starts = (
        some.groupBy(*key)
        .agg(F.count("*").alias("rows"))
        .withColumn("start", F.sum("rows").over(earlier) - F.col("rows"))
        .drop("rows")
    )
    place = F.row_number().over(Window.partitionBy(*key).orderBy("order_hash", "doc_id"))
    chosen = (
        some.join(starts, key)
        .withColumn("extra", (F.col("start") + place <= F.col("take")).cast("long"))
        .drop("start")
    )
    whole = planned.where((F.col("take") <= 0) | (F.col("take") >= F.col("n"))).withColumn(
        "extra", (F.col("take") > 0).cast("long")
    )
    repeats = F.col("passes") + F.col("extra")
    return chosen.unionByName(whole).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (repeats * F.col("size")).alias("taken"),
        repeats.alias("repeats"),
    )
