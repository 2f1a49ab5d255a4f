"""Ordered event patterns per key.

A pattern is a list of stages; a match takes one row per stage, in strictly
increasing order, with any rows in between.  Every combination is a match.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import (
    BLOCK,
    DEFAULT_MAX_ROWS,
    Running,
    plan_blocks,
    running,
)
from millrace.operators.relational import integer_quotient
from millrace.session import checkpoint_root

COUNT_TYPE = "decimal(38,0)"
_BUCKET = "_bucket"
_SALT = "_salt"
_SALTS = "_salts"
_SPREAD = "_spread_stage"
_FRESH = "_fresh"


@dataclass(frozen=True)
class Stage:
    """A named step of a pattern and the rows that satisfy it."""

    name: str
    condition: Column


def _flag(position: int) -> str:
    return f"_is_{position}"


def _staged(
    df: DataFrame, keys: Sequence[str], kept: Sequence[str], stages: Sequence[Stage]
) -> DataFrame:
    """The rows some stage accepts, with one flag per stage; null keys match nothing."""
    some_stage = reduce(lambda a, b: a | b, [stage.condition for stage in stages])
    has_key = reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in keys])
    return df.where(some_stage & has_key).select(
        *dict.fromkeys([*keys, *kept]),
        *[
            F.coalesce(stage.condition, F.lit(False)).alias(_flag(position))
            for position, stage in enumerate(stages)
        ],
    )


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def _as_micros(duration: timedelta) -> int:
    return duration // timedelta(microseconds=1)


def _floor_quotient(number: Column, size: int) -> Column:
    rest = F.pmod(number, F.lit(size))
    return integer_quotient(number - rest, F.lit(size))


def _only_participants(
    staged: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    stages: Sequence[Stage],
    within: timedelta | None,
    max_rows: int,
) -> DataFrame:
    """Rows that belong to at least one match, with the end each can reach first.

    For a row of a stage, ``_from`` is the latest first row of a chain leading to
    it and ``_to`` the earliest last row of a chain leaving it.  The row belongs to
    a match exactly when both exist and lie within the bound.
    """
    last = len(stages) - 1
    position = F.struct(*order_by)
    blocks = plan_blocks(staged, keys, order_by, max_rows)

    def cut(rows: DataFrame) -> DataFrame:
        # With blocks a running aggregate reads its input twice, for the totals and
        # for the rows; uncut, that would double with each of the steps below.
        return rows.checkpoint() if blocks.split else rows

    rows = blocks.mark(staged)
    rows = rows.withColumn("_from_0", F.when(F.col(_flag(0)), position))
    for stage in range(1, last + 1):
        rows = running(
            cut(rows),
            blocks,
            {"_reached": Running("max", F.col(f"_from_{stage - 1}"), strict=True)},
        )
        rows = rows.withColumn(
            f"_from_{stage}", F.when(F.col(_flag(stage)), F.col("_reached"))
        ).drop("_reached")
    rows = rows.withColumn(f"_to_{last}", F.when(F.col(_flag(last)), position))
    for stage in range(last - 1, -1, -1):
        rows = running(
            cut(rows),
            blocks,
            {"_reached": Running("min", F.col(f"_to_{stage + 1}"), strict=True)},
            backwards=True,
        )
        rows = rows.withColumn(
            f"_to_{stage}", F.when(F.col(_flag(stage)), F.col("_reached"))
        ).drop("_reached")

    def takes_part(stage: int) -> Column:
        first, final = F.col(f"_from_{stage}"), F.col(f"_to_{stage}")
        both = first.isNotNull() & final.isNotNull()
        if within is None:
            return both
        ts = order_by[0]
        span = _micros(final[ts]) - _micros(first[ts])
        return F.coalesce(both & (span <= _as_micros(within)), F.lit(False))

    flagged = rows.select(
        *staged.drop(*[_flag(stage) for stage in range(len(stages))]).columns,
        *[takes_part(stage).alias(_flag(stage)) for stage in range(len(stages))],
        *[f"_to_{stage}" for stage in range(len(stages))],
    )
    return flagged.where(
        reduce(lambda a, b: a | b, [F.col(_flag(s)) for s in range(len(stages))])
    )


def pattern_matches(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    stages: Sequence[Stage],
    columns: Sequence[str],
    *,
    within: timedelta | None = None,
    max_rows: int = DEFAULT_MAX_ROWS,
    fresh: str | None = None,
) -> DataFrame:
    """Every match: the keys and, per stage, a struct of ``columns``.

    With a boolean column ``fresh``, only matches with at least one row where it is true,
    each once.  They are joined by the first stage that takes a fresh row, known
    rows before it and any after it, so known rows are not joined with each other alone.

    ``order_by`` must be unique within a key; with ``within`` its first column is
    the event time and the last row of a match is at most that much later than the
    first.  Give a bound whenever one makes sense: the number of matches grows with
    the product of the stages' row counts.

    Rows that belong to no match are removed before anything is joined, and a
    partial match is only built when it can be completed, so the work follows the
    size of the result.  The survivors are checkpointed because every stage reads
    them.  They are joined per key and time bucket; a bucket with too many rows of
    the second stage is split further by a salt.
    """
    spark = df.sparkSession
    carried = [*order_by, *columns, *([] if fresh is None else [fresh])]
    staged = _staged(df, keys, carried, stages)
    checkpoint_root(spark)
    rows = _only_participants(
        staged, keys, order_by, stages, within, max_rows
    ).checkpoint()

    ts = order_by[0]
    bucket = (
        F.lit(0).cast("bigint")
        if within is None
        else _floor_quotient(_micros(F.col(ts)), _as_micros(within))
    )

    def stage_rows(position: int) -> DataFrame:
        buckets = (
            F.array(bucket)
            if position == 0 or within is None
            else F.array(bucket, bucket - 1)
        )
        return rows.where(F.col(_flag(position))).select(
            *keys,
            F.explode(buckets).alias(_BUCKET),
            F.struct(*order_by).alias(f"_at_{position}"),
            F.col(f"_to_{position}"),
            F.struct(*columns).alias(stages[position].name),
            *([] if fresh is None else [F.col(fresh).alias(f"{_FRESH}_{position}")]),
        )

    group = [*keys, _BUCKET]
    parts = [stage_rows(position) for position in range(len(stages))]
    crowded = _crowded(parts, group, max_rows)
    if not crowded.isEmpty():
        parts = [
            _salted(part, crowded, group, position)
            for position, part in enumerate(parts)
        ]
        group = [*group, _SALT]

    if fresh is None:
        matches = _joined(parts, group, ts, within)
    else:
        # One join for each stage that may be the first with a fresh row.
        matches = reduce(
            DataFrame.unionByName,
            [
                _joined(
                    [
                        _of_age(part, position, None if position > first else position == first)
                        for position, part in enumerate(parts)
                    ],
                    group,
                    ts,
                    within,
                    first,
                )
                for first in range(len(parts))
            ],
        )
    return matches.select(*keys, *[stage.name for stage in stages])


def _of_age(part: DataFrame, position: int, fresh: bool | None) -> DataFrame:
    """Rows that are fresh, or known from before, or either."""
    if fresh is None:
        return part
    flag = F.col(f"{_FRESH}_{position}")
    return part.where(flag if fresh else ~flag)


def _joined(
    parts: Sequence[DataFrame],
    group: Sequence[str],
    ts: str,
    within: timedelta | None,
    first: int = 0,
) -> DataFrame:
    """Chains of one row from each part, in order and within the bound.

    They are built from the part ``first``, to the front and then to the back.
    """
    matches = parts[first]
    for position in [*range(first - 1, -1, -1), *range(first + 1, len(parts))]:
        back = position > first
        before, after = (position - 1, position) if back else (position, position + 1)
        matches = matches.join(parts[position], list(group)).where(
            F.col(f"_at_{after}") > F.col(f"_at_{before}")
        )
        if within is not None:
            begin, end = (0, position) if back else (position, first)
            start, reach = F.col(f"_at_{begin}.{ts}"), F.col(f"_to_{end}.{ts}")
            matches = matches.where(
                _micros(reach) - _micros(start) <= _as_micros(within)
            )
    return matches


def _crowded(
    parts: Sequence[DataFrame], group: Sequence[str], max_rows: int
) -> DataFrame:
    """The groups above the row limit, with their largest stage and number of salts."""
    per_stage = [
        part.groupBy(*group).count().withColumn("_position", F.lit(position))
        for position, part in enumerate(parts)
    ]
    return (
        reduce(DataFrame.unionAll, per_stage)
        .groupBy(*group)
        .agg(
            F.max(F.struct("count", "_position")).alias("_largest"),
            F.sum("count").alias("_rows"),
        )
        .where(F.col("_rows") > max_rows)
        .select(
            *group,
            F.col("_largest._position").alias(_SPREAD),
            F.ceil(F.col("_rows") / max_rows).cast("int").alias(_SALTS),
        )
    )


def _salted(
    part: DataFrame, crowded: DataFrame, group: Sequence[str], position: int
) -> DataFrame:
    """Spreads a crowded group's largest stage over the salts, repeats the others on each."""
    last_salt = F.coalesce(F.col(_SALTS), F.lit(1)) - 1
    one = F.pmod(F.xxhash64(f"_at_{position}"), last_salt + 1).cast("int")
    salts = F.when(F.col(_SPREAD) == position, F.array(one)).otherwise(
        F.sequence(F.lit(0), last_salt)
    )
    return (
        part.join(crowded, group, "left")
        .withColumn(_SALT, F.explode(salts))
        .drop(_SALTS, _SPREAD)
    )


def match_map(stages: Sequence[Stage]) -> Column:
    """A match as a map from stage name to the list of rows taken there."""
    return F.create_map(
        *[
            item
            for stage in stages
            for item in (F.lit(stage.name), F.array(F.col(stage.name)))
        ]
    )


def pattern_counts(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    stages: Sequence[Stage],
    *,
    out: str = "matches",
    max_rows: int = DEFAULT_MAX_ROWS,
) -> DataFrame:
    """Number of matches per key, without building one; keys without any are left out.

    Running sums count the chains: one shuffle and one sort.  A hot key's blocks are
    counted separately, for every run of consecutive stages, and then chained.
    """
    k = len(stages)
    staged = _staged(df, keys, order_by, stages)
    blocks = plan_blocks(staged, keys, order_by, max_rows)
    rows = blocks.mark(staged)
    for position in range(k):
        rows = rows.withColumn(
            _flag(position), F.col(_flag(position)).cast("int").cast("bigint")
        )
    whole = blocks if not blocks.split else _per_block(blocks)
    firsts = range(k) if blocks.split else range(1)

    def ending(first: int, last: int) -> Column:
        """Chains of stages first..last that end at the row."""
        flag = F.col(_flag(last))
        if first == last:
            return flag
        chains = flag * F.col(_before(first, last - 1))
        # Pairs of stages fit a bigint for any group up to four billion rows.
        return chains if last - first < 2 else chains.cast(COUNT_TYPE)

    for length in range(k - 1):
        rows = running(
            rows,
            whole,
            {
                _before(first, first + length): Running(
                    "sum", ending(first, first + length), strict=True
                )
                for first in firsts
                if first + length < k - 1
            },
        )
    totals = rows.groupBy(*whole.partition).agg(
        *[
            F.coalesce(
                F.sum(ending(first, last).cast("decimal(28,0)")), F.lit(0)
            )
            .cast(COUNT_TYPE)
            .alias(_total(first, last))
            for first in firsts
            for last in range(first, k)
        ]
    )
    if not blocks.split:
        counted = totals.select(*keys, F.col(_total(0, k - 1)).alias(out))
    else:
        counted = _chain_blocks(totals, keys, k, out)
    return counted.where(F.col(out) > 0)


def _before(first: int, last: int) -> str:
    return f"_before_{first}_{last}"


def _total(first: int, last: int) -> str:
    return f"_chains_{first}_{last}"


def _per_block(blocks):
    """The same blocks, each treated as a key of its own."""
    return type(blocks)((*blocks.keys, BLOCK), blocks.order_by)


def _chain_blocks(
    totals: DataFrame, keys: Sequence[str], k: int, out: str
) -> DataFrame:
    """Joins the counts of a key's blocks in order; their number is bounded."""
    names = [_total(first, last) for first in range(k) for last in range(first, k)]
    listed = totals.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(BLOCK, *names))).alias("_blocks")
    )
    zero = F.struct(*[F.lit(0).cast(COUNT_TYPE).alias(f"_upto_{i}") for i in range(k)])

    def add(done: Column, block: Column) -> Column:
        sums = []
        for last in range(k):
            total = done[f"_upto_{last}"] + block[_total(0, last)]
            for first in range(1, last + 1):
                total = total + done[f"_upto_{first - 1}"] * block[_total(first, last)]
            sums.append(total.cast(COUNT_TYPE).alias(f"_upto_{last}"))
        return F.struct(*sums)

    folded = F.reduce("_blocks", zero, add, lambda done: done[f"_upto_{k - 1}"])
    return listed.select(*keys, folded.alias(out))
