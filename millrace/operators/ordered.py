"""Running aggregates along the order of each key, safe against hot keys.

A window ``PARTITION BY key ORDER BY seq`` puts a whole key into one task.  That
is fine for ordinary keys and hopeless for a key that holds a third of the table.
Here the keys above a row limit are found first, from a sample of the key and order
columns.  Without any, the plan is the plain window.  Otherwise the rows of each
hot key are cut into blocks along their order, at quantiles of the key's own part of the
sample, so that

* the window runs per ``(key, block)``, which is one shuffle and bounded groups;
* the totals of the earlier blocks, a small table, are added to each row.

The result is exact either way: limits and samples only decide where to cut.
"""

from __future__ import annotations

import json
import warnings
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MAX_ROWS = 20_000_000
# The hot keys and the blocks' totals are broadcast: this bounds their number.  A table
# needs more than that only above MAX_CUTS / 2 * max_rows rows (10^12 by default);
# then the limit is raised to what fits, with a warning.
MAX_CUTS = 100_000
HITS_AT_LIMIT = 400

HOT = "_hot"
BLOCK = "_block"
_CARRY_HOT = "_carry_hot"
_CARRY_BLOCK = "_carry_block"


@dataclass(frozen=True)
class Running:
    """A running aggregate: ``how`` is ``sum``, ``max`` or ``min`` of ``value``.

    ``strict`` leaves the row itself out.  A sum over nothing is 0, a max or min
    over nothing is null.
    """

    how: str
    value: Column
    strict: bool = False


@dataclass(frozen=True)
class Blocks:
    """How the rows of a frame are split: nothing to split when ``hot`` is empty.

    ``bounds`` are, as JSON, a hot key's number and values of the leading order columns
    ``cut_by``.  A block is known by how many bounds of all keys are at or below it.  A
    bound may lose digits on the way, which moves the cut and changes nothing else.
    """

    keys: tuple[str, ...]
    order_by: tuple[str, ...]
    hot: tuple[Row, ...] = ()
    bounds: tuple[str, ...] = ()
    cut_by: tuple[str, ...] = ()

    @property
    def split(self) -> bool:
        return bool(self.hot)

    @property
    def partition(self) -> tuple[str, ...]:
        return (*self.keys, BLOCK) if self.split else self.keys

    def mark(self, df: DataFrame) -> DataFrame:
        """Adds the hot key number (null for ordinary keys) and the block number."""
        if not self.split:
            return df
        hot_schema = df.select(*self.keys).schema.add(HOT, T.IntegerType())
        hot = df.sparkSession.createDataFrame(
            [(*row, number) for number, row in enumerate(self.hot)], hot_schema
        )
        renamed = hot.toDF(*[f"_hot_{key}" for key in self.keys], HOT)
        same_key = [F.col(key).eqNullSafe(F.col(f"_hot_{key}")) for key in self.keys]
        marked = df.join(F.broadcast(renamed), same_key, "left")
        return marked.withColumn(
            BLOCK, F.when(F.col(HOT).isNotNull(), self._piece_of(marked)).otherwise(0)
        ).drop(*[f"_hot_{key}" for key in self.keys])

    def _piece_of(self, df: DataFrame) -> Column:
        """Number of bounds at or below the row: a binary search over a literal array."""
        if not self.bounds:
            return F.lit(0)
        names = (HOT, *self.cut_by)
        element = T.ArrayType(df.select(*names).schema)
        bounds = F.from_json(F.lit(f"[{','.join(self.bounds)}]"), element)
        here = F.struct(*[F.col(name) for name in names])
        # Folded into one literal array while planning.
        bounds = F.sort_array(bounds)
        top = 1 << (len(self.bounds).bit_length() - 1)
        steps = [top >> shift for shift in range(top.bit_length())]

        def descend(found: Column, step: Column) -> Column:
            below = F.get(bounds, found + step - 1) <= here
            return F.when(below, found + step).otherwise(found)

        return F.reduce(F.array(*[F.lit(step) for step in steps]), F.lit(0), descend)


def plan_blocks(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    max_rows: int = DEFAULT_MAX_ROWS,
) -> Blocks:
    """Finds the keys with about ``max_rows`` rows or more, and where to cut them.

    One scan of the key and order columns draws a sample in which a key at the limit
    shows up ``HITS_AT_LIMIT`` times, so no hot key is overlooked.  Samples of parts of the
    table add up to one of the whole, and a hot key's share of it, in order, gives the
    quantiles at which the key is cut: blocks hold about half the limit wherever its rows
    lie.  The driver receives the hot keys and the cut points.
    """
    keys, order_by = tuple(keys), tuple(order_by)
    fraction = min(1.0, HITS_AT_LIMIT / max_rows)
    sample = df.select(*dict.fromkeys([*keys, *order_by]))
    if fraction < 1.0:
        sample = sample.sample(fraction=fraction, seed=0)
    sample = sample.persist()
    try:
        counts = sample.groupBy(*keys).count()
        limit = _limit(counts, max_rows * fraction)
        hot = counts.where(F.col("count") > limit).collect()
        if not hot:
            return Blocks(keys, order_by)
        hot_keys = tuple(Row(*row[:-1]) for row in sorted(hot, key=lambda row: -row[-1]))
        in_order = Window.partitionBy(HOT).orderBy(*[F.asc_nulls_first(name) for name in order_by])
        found = (
            Blocks(keys, order_by, hot_keys)
            .mark(sample)
            .where(F.col(HOT).isNotNull())
            .select(HOT, *order_by, F.row_number().over(in_order).alias(BLOCK))
            .where(F.col(BLOCK) % max(1, int(limit / 2)) == 0)
            .orderBy(HOT, BLOCK)
            .select(F.to_json(F.struct(HOT, *order_by)))
            .collect()
        )
    finally:
        sample.unpersist()
    cut_by, bounds = _leading([json.loads(text) for (text,) in found], order_by)
    return Blocks(keys, order_by, hot_keys, bounds, cut_by)


def _limit(counts: DataFrame, limit: float) -> float:
    """Sampled rows above which a key is hot: ``limit``, unless that makes too many cuts."""
    in_hot = counts.where(F.col("count") > limit).agg(F.sum("count")).first()[0] or 0
    least = 2 * in_hot / MAX_CUTS
    if least > limit:
        warnings.warn(
            f"blocks are {least / limit:.1f} times as large as asked for: "
            f"the rows of the hot keys would need more than {MAX_CUTS} cuts",
            stacklevel=3,
        )
    return max(limit, least)


def _leading(
    cuts: Sequence[dict], order_by: tuple[str, ...]
) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """The fewest leading order columns that tell the cuts of each key apart."""
    for length in range(1, len(order_by) + 1):
        names = (HOT, *order_by[:length])
        texts = [
            json.dumps({name: cut[name] for name in names if name in cut})
            for cut in cuts
        ]
        # A value that stands for many cuts would be one huge block.
        repeats = max(Counter(texts).values(), default=0)
        if length == len(order_by) or repeats <= 2:
            return order_by[:length], tuple(dict.fromkeys(texts))
    return order_by, ()


def _combine(how: str, earlier: Column, here: Column) -> Column:
    if how == "sum":
        return F.coalesce(earlier, F.lit(0)) + F.coalesce(here, F.lit(0))
    return F.greatest(earlier, here) if how == "max" else F.least(earlier, here)


def _aggregate(how: str, value: Column) -> Column:
    return {"sum": F.sum, "max": F.max, "min": F.min}[how](value)


def running(
    marked: DataFrame,
    blocks: Blocks,
    columns: Mapping[str, Running],
    *,
    backwards: bool = False,
) -> DataFrame:
    """Adds running aggregates; ``marked`` comes from ``blocks.mark``.

    Backwards, the aggregates run from the last row of the key to the first.
    """
    direction = F.desc_nulls_last if backwards else F.asc_nulls_first
    order = [direction(name) for name in blocks.order_by]
    window = Window.partitionBy(*blocks.partition).orderBy(*order)

    def local(spec: Running) -> Column:
        last = -1 if spec.strict else 0
        frame = window.rowsBetween(Window.unboundedPreceding, last)
        return _aggregate(spec.how, spec.value).over(frame)

    if not blocks.split:
        return marked.select(
            "*",
            *[
                (
                    F.coalesce(local(spec), F.lit(0))
                    if spec.how == "sum"
                    else local(spec)
                ).alias(name)
                for name, spec in columns.items()
            ],
        )

    totals = (
        marked.where(F.col(HOT).isNotNull())
        .groupBy(F.col(HOT).alias(_CARRY_HOT), F.col(BLOCK).alias(_CARRY_BLOCK))
        .agg(
            *[
                _aggregate(spec.how, spec.value).alias(f"_total_{name}")
                for name, spec in columns.items()
            ]
        )
    )
    earlier = (
        Window.partitionBy(_CARRY_HOT)
        .orderBy(direction(_CARRY_BLOCK))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = totals.select(
        _CARRY_HOT,
        _CARRY_BLOCK,
        *[
            _aggregate(spec.how, F.col(f"_total_{name}"))
            .over(earlier)
            .alias(f"_carry_{name}")
            for name, spec in columns.items()
        ],
    )
    in_block = marked.select(
        "*", *[local(spec).alias(f"_local_{name}") for name, spec in columns.items()]
    )
    # At most 1.5 * MAX_CUTS rows of a few numbers each.
    joined = in_block.join(
        F.broadcast(carry),
        (F.col(HOT) == F.col(_CARRY_HOT)) & (F.col(BLOCK) == F.col(_CARRY_BLOCK)),
        "left",
    )
    return joined.select(
        *[F.col(name) for name in marked.columns],
        *[
            _combine(
                spec.how, F.col(f"_carry_{name}"), F.col(f"_local_{name}")
            ).alias(name)
            for name, spec in columns.items()
        ],
    )


def nothing_carried(df: DataFrame, schema: T.StructType) -> DataFrame:
    """No rows of ``schema``; the optimizer drops what is built on it."""
    return df.limit(0).select(
        *[F.lit(None).cast(field.dataType).alias(field.name) for field in schema]
    )


def with_carried(df: DataFrame, carried: DataFrame) -> DataFrame:
    """``df`` with the rows carried from before it, flagged by ``_carried``.

    A carried row lacks the order columns; null sorts first, so the running
    aggregates of a key start from what it carries.
    """
    new = df.withColumn("_carried", F.lit(False))
    return new.unionByName(
        carried.withColumn("_carried", F.lit(True)), allowMissingColumns=True
    )
