"""Shards of equal size that cut few links: balanced label propagation.

Documents of one group are linked with each other through the group.  All links of a
group's documents in one shard are alike, so a *cell* (group, shard, number of
documents) stands for them.  Rounds of joins move cells towards the shard that holds
most of their group, within quotas that leave every shard its size.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.text import cut_lineage, null_safe_key

SHARDS = 16
ROUNDS = 40  # a bound on effort: the sizes are right after any number of rounds
BUCKET_ROWS = 20_000  # rows put in order by one task at a time
HOT_GROUPS = 10_000  # at most so many groups are split while their rows are ranked
PIECE = 1_000  # copies of one row that are written out together
LEVELS = 16
SPREAD = 64  # parts in which the proposals of a pair of shards are summed up


def starts(df: DataFrame, keys: list, bucket: Column, order: list, weight: str, out: str) -> DataFrame:
    """``out``: sum of ``weight`` over the rows of the same ``keys`` before each row.

    Rows go by ``bucket``, then by ``order``.  Totals of buckets are summed up first, so
    no task sees more than a bucket.
    """
    parted = df.withColumn("_bucket", bucket)
    totals = parted.groupBy(*keys, "_bucket").agg(F.sum(weight).alias("_total"))
    earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(*keys, "_bucket", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        parted.join(before, [*keys, "_bucket"])
        .withColumn(out, F.col("_before") + F.coalesce(F.sum(weight).over(inside), F.lit(0)))
        .drop("_bucket", "_before")
    )


def _buckets(rows: int) -> int:
    return max(1, -(-rows // BUCKET_ROWS))


def _spread(seed, *names: str) -> Column:
    return F.xxhash64(F.lit(seed), *names)


def _targets(cells: DataFrame, open_shards: list[int], seed: int) -> DataFrame:
    """For each cell that is not where most of its group is: where it wants to go, as proposals.

    Only ``open_shards`` take part in the vote, and ties fall as the round's seed has it.
    """
    strength = F.struct("n", _spread(seed, "g", "h", "shard").alias("tie"), "shard")
    votes = (
        cells.where(F.col("shard").isin(open_shards))
        .groupBy("g", "h")
        .agg(F.max(strength).alias("lead"))
    )
    wishes = cells.withColumn("own", strength).join(votes, ["g", "h"]).where("own < lead")
    return wishes.select(
        "g",
        "h",
        "n",
        F.col("shard").alias("source"),
        F.col("lead.shard").alias("target"),
        F.least(F.floor(F.log2(F.col("lead.n"))).cast("int"), F.lit(LEVELS - 1)).alias("level"),
        F.pmod(_spread(seed + 1, "g", "h"), F.lit(SPREAD)).cast("int").alias("part"),
    )


def _quotas(wanted: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """How many documents may go from one shard to another without making any too large.

    Wishes that go both ways between two shards are exchanged; what room a shard has is
    given to those who want it, the most wanted first.
    """
    quota = {pair: min(n, wanted.get(pair[::-1], 0)) for pair, n in wanted.items()}
    left = list(room)
    for pair in sorted(wanted, key=lambda pair: (-wanted[pair], pair)):
        more = min(wanted[pair] - quota[pair], left[pair[1]])
        quota[pair] += more
        left[pair[1]] -= more
    return quota


def _propagate(cells: DataFrame, sizes: list[int], rounds: int) -> DataFrame:
    """Cells after rounds of moves; ``sizes``: how many documents each shard takes in all.

    A group in one shard is done and leaves the rounds.  Every move makes a smaller part of a group
    join a larger or equal one, so the rounds come to an end.  In odd rounds groups
    ask only for shards with room, in even ones for all and trade places.  What the driver
    sees are sums by pairs of shards.
    """
    spark, shards = cells.sparkSession, len(sizes)
    done, idle = [], 0
    settled = [0] * shards
    for seed in range(rounds):
        load = dict(map(tuple, cells.groupBy("shard").agg(F.sum("n")).collect()))
        room = [sizes[k] - settled[k] - load.get(k, 0) for k in range(shards)]
        open_shards = [k for k in range(shards) if room[k] > 0 or seed % 2 == 0]
        if not load or idle == 2:
            break
        if not open_shards:
            idle += 1
            continue
        wishes = cut_lineage(_targets(cells, open_shards, seed))
        sums = wishes.groupBy("source", "target", "level", "part").agg(F.sum("n").alias("total"))
        earlier = (
            Window.partitionBy("source", "target")
            .orderBy(F.desc("level"), "part")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        sums = sums.withColumn("before", F.coalesce(F.sum("total").over(earlier), F.lit(0)))
        # At most shards^2 * LEVELS * SPREAD rows.
        sums = cut_lineage(sums)
        wanted = {(s, t): n for s, t, n in sums.groupBy("source", "target").agg(F.sum("total")).collect()}
        quota = [(s, t, n) for (s, t), n in _quotas(wanted, room).items() if n > 0]
        if not quota:
            idle += 1
            continue
        idle = 0
        allowed = spark.createDataFrame(quota, "source int, target int, quota long")
        passed = sums.join(F.broadcast(allowed), ["source", "target"]).where("before < quota")
        inside = (
            Window.partitionBy("source", "target", "level", "part")
            .orderBy(F.desc("n"), "g", "h")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        moves = (
            wishes.join(passed, ["source", "target", "level", "part"])
            .withColumn("before", F.col("before") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
            .select("g", "h", "source", "target", F.least("n", F.col("quota") - F.col("before")).alias("moved"))
            .where("moved > 0")
        )
        moved = moves.select(
            "g",
            "h",
            F.inline(
                F.array(
                    F.struct(F.col("source").alias("shard"), (-F.col("moved")).alias("n")),
                    F.struct(F.col("target").alias("shard"), F.col("moved").alias("n")),
                )
            ),
        )
        after = (
            cells.unionByName(moved)
            .groupBy("g", "h", "shard")
            .agg(F.sum("n").alias("n"))
            .where("n > 0")
            .withColumn("parts", F.count("*").over(Window.partitionBy("g", "h")))
        )
        after = cut_lineage(after)
        whole = after.where("parts = 1").drop("parts")
        done.append(whole)
        for shard, n in whole.groupBy("shard").agg(F.sum("n")).collect():
            settled[shard] += n
        cells = after.where("parts > 1").drop("parts")
    for part in done:
        cells = cells.unionByName(part)
    return cells


def _cells_of_groups(cells: DataFrame) -> DataFrame:
    """``g, h, cells``: the ranges of a group's ranks that each shard takes."""
    listed = cells.groupBy("g", "h").agg(F.array_sort(F.collect_list(F.struct("shard", "n"))).alias("c"))
    ends = F.aggregate(
        "c",
        F.expr("cast(array() as array<struct<shard: int, lo: bigint, hi: bigint>>)"),
        lambda out, cell: F.concat(
            out,
            F.array(
                F.struct(
                    cell["shard"].alias("shard"),
                    F.coalesce(F.try_element_at(out, F.lit(-1))["hi"], F.lit(0).cast("long")).alias("lo"),
                    (F.coalesce(F.try_element_at(out, F.lit(-1))["hi"], F.lit(0).cast("long")) + cell["n"]).alias("hi"),
                )
            ),
        ),
    )
    return listed.select("g", "h", ends.alias("cells"))


def _placed(rows: DataFrame) -> DataFrame:
    """Rows with ``rank`` in their group and ``cells``, cut where a shard ends."""
    low = lambda c: F.greatest(c["lo"], F.col("rank"))
    high = lambda c: F.least(c["hi"], F.col("rank") + F.col("n"))
    parts = F.filter(
        F.transform("cells", lambda c: F.struct(c["shard"].alias("shard"), (high(c) - low(c)).alias("m"))),
        lambda p: p["m"] > 0,
    )
    return rows.select("doc_id", "g", "h", "size", "text_crc32", F.inline(parts))


def balanced_shards(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for each row of ``docs``.

    Documents with equal texts are linked.  The law is ``rows``: shards 0 to ``shards - 1``
    differ by one document at most, slots count from 0 in each.  Linked
    documents start evenly dealt and move towards each other under that law; documents
    without links then fill the shards up.  A group larger than a shard fills as many as it
    needs.  A null text is an empty one (size 1, checksum 0).  Rows that agree
    in id (null too) and text are counted, not told apart; other columns are not read.  An
    empty table gives an empty result.  The same rows get the same places, however they are
    partitioned.  Texts are known by two 64-bit hashes and never shuffled.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    data = text.cast("binary")
    # A sort key for ids of any type, null included.
    name = null_safe_key(F.col("doc_id").cast("string"))
    rows = cut_lineage(
        docs.select(
            "doc_id",
            F.xxhash64(text).alias("g"),
            F.xxhash64(F.lit("second"), text).alias("h"),
            (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(data).alias("text_crc32"),
        )
        .groupBy("doc_id", "g", "h", "size", "text_crc32")
        .agg(F.count("*").alias("n"))
    )
    groups = cut_lineage(rows.groupBy("g", "h").agg(F.sum("n").alias("n")).where("n > 1"))
    n_rows = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    n_groups, n_linked = groups.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    sizes = [n_rows // shards + (k < n_rows % shards) for k in range(shards)]

    # Linked documents, counted through all groups, are dealt out in turn.
    numbered = starts(groups, [], F.pmod("g", F.lit(_buckets(n_groups))), ["g", "h"], "n", "at")
    dealt = numbered.select(
        "g", "h", "n", "at", F.explode(F.sequence(F.lit(0), F.least("n", F.lit(shards)).cast("int") - 1)).alias("k")
    )
    cells = cut_lineage(
        dealt.select(
            "g",
            "h",
            F.pmod(F.col("at") + F.col("k"), F.lit(shards)).cast("int").alias("shard"),
            F.floor((F.col("n") - F.col("k") + (shards - 1)) / shards).cast("long").alias("n"),
        )
    )
    cells = cut_lineage(_propagate(cells, sizes, rounds))
    taken = dict(map(tuple, cells.groupBy("shard").agg(F.sum("n")).collect()))

    # Large groups, few by their bound, are ranked in pieces.
    bound = max(BUCKET_ROWS, n_linked // HOT_GROUPS)
    members = _cells_of_groups(cells)
    hot = F.broadcast(
        groups.where(F.col("n") > bound)
        .join(members, ["g", "h"])
        .select("g", "h", F.ceil(F.col("n") / bound).alias("pieces"), F.col("cells").alias("hot_cells"))
    )
    marked = rows.withColumn("name", name).join(hot, ["g", "h"], "left")
    in_pieces = marked.where("pieces IS NOT NULL").withColumnRenamed("hot_cells", "cells")
    in_hot = starts(in_pieces, ["g", "h"], F.pmod(F.xxhash64("name"), F.col("pieces")), ["name"], "n", "rank")
    rest = marked.where("pieces IS NULL").join(members, ["g", "h"], "left")
    inside = Window.partitionBy("g", "h").orderBy("name").rowsBetween(Window.unboundedPreceding, -1)
    in_cool = rest.where("cells IS NOT NULL").withColumn("rank", F.coalesce(F.sum("n").over(inside), F.lit(0)))

    # Documents without links fill up what is left, in the order of their hashes.
    single = rest.where("cells IS NULL")
    single = starts(single, [], F.pmod("g", F.lit(_buckets(n_rows - n_linked))), ["g", "h"], "n", "rank")
    ends = list(accumulate(sizes[k] - taken.get(k, 0) for k in range(shards)))
    shard = F.coalesce(*[F.when(F.col("rank") < end, F.lit(k)) for k, end in enumerate(ends)])
    alone = single.select("doc_id", "g", "h", "size", "text_crc32", shard.alias("shard"), F.col("n").alias("m"))

    placed = _placed(in_hot).unionByName(_placed(in_cool)).unionByName(alone)
    steps = F.sequence(F.lit(0).cast("long"), F.col("m") - 1, F.lit(PIECE).cast("long"))
    pieces = placed.withColumn("first", F.explode(steps))
    pieces = cut_lineage(pieces.withColumn("m", F.least(F.col("m") - F.col("first"), F.lit(PIECE))))
    pieces = pieces.withColumn("name", name)
    bucket = F.pmod(F.xxhash64("name", "g", "first"), F.lit(_buckets(n_rows // shards)))
    slots = starts(pieces, ["shard"], bucket, ["name", "g", "h", "first"], "m", "slot")
    return slots.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.explode(F.sequence(F.col("slot"), F.col("slot") + F.col("m") - 1)).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
