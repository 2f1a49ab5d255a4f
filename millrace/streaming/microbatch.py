"""Per-key state on streams, one table step per micro-batch.

Each micro-batch is a table, and so is what earlier ones left behind.  The batch
operators take both, which brings their treatment of hot keys to streams and keeps
all work in built-in functions; the micro-batches may be as large as the cluster
can take.  The carried table lies in buckets by a hash of the keys; a micro-batch reads and
writes the buckets of its own keys only.  With few rows per micro-batch and very many
keys, use ``streaming.stateful``.

Micro-batch ``n`` writes ``batch_id=n`` under the output, its buckets as version ``n``, and
a manifest of the version that holds for each bucket.  It reads by manifest ``n - 1``, so
repeating it gives the same files; what no manifest from ``n - 1`` on names is deleted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators import changelog, countwindow
from millrace.operators.ordered import DEFAULT_MAX_ROWS
from millrace.operators.pattern import Stage, pattern_matches
from millrace.session import remove_path
from millrace.streaming.run import start

# The result, the table to carry, and what both were cached from, if anything.
Step = Callable[[DataFrame, DataFrame], tuple[DataFrame, ...]]

BUCKETS = 64
BUCKET = "_bucket"
SWEEP = 50  # a pattern's idle keys are looked through every so many micro-batches
MANIFEST = T.StructType(
    [T.StructField(name, T.LongType()) for name in ("bucket", "version", "buckets")]
)


class Carried:
    """A table in buckets that are replaced one by one, in versions.

    ``buckets`` counts for the first micro-batch; later ones keep to its number.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        keys: Sequence[str],
        batch_id: int,
        buckets: int,
    ):
        self._spark, self._root, self._schema = spark, root, schema
        self._keys, self._batch_id = keys, batch_id
        self._held = self._manifest(batch_id - 1) if batch_id else []
        self._buckets = next((row["buckets"] for row in self._held), buckets)
        if batch_id and not self._held:  # nothing carried so far
            self._buckets = buckets

    def _manifest(self, batch_id: int) -> list:
        """At most one row for each bucket."""
        path = f"{self._root}/manifest/{batch_id}"
        return self._spark.read.schema(MANIFEST).parquet(path).collect()

    def _folder(self, version: int, bucket: int) -> str:
        return f"{self._root}/version={version}/{BUCKET}={bucket}"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self._keys), F.lit(self._buckets)).alias(BUCKET)

    def touched(self, batch: DataFrame) -> set[int]:
        return {row[0] for row in batch.select(self.bucket()).distinct().collect()}

    def all_buckets(self) -> set[int]:
        return {row["bucket"] for row in self._held}

    def read(self, buckets: set[int]) -> DataFrame:
        folders = [
            self._folder(row["version"], row["bucket"])
            for row in self._held
            if row["bucket"] in buckets
        ]
        if not folders:
            return self._spark.createDataFrame([], self._schema)
        return self._spark.read.schema(self._schema).parquet(*folders)

    def write(self, after: DataFrame, touched: set[int]) -> None:
        """Replaces the touched buckets, by what ``after`` holds for them, if anything."""
        version = f"{self._root}/version={self._batch_id}"
        in_buckets = after.select(*self._schema.names, self.bucket())
        # Rows of a bucket together; adaptive execution splits a large one.
        in_buckets.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(version)
        bucketed = T.StructType([*self._schema.fields, T.StructField(BUCKET, T.LongType())])
        written = self._spark.read.schema(bucketed).parquet(version).select(BUCKET).distinct()
        rows = [
            (row["bucket"], row["version"], self._buckets)
            for row in self._held
            if row["bucket"] not in touched
        ]
        rows += [(row[0], self._batch_id, self._buckets) for row in written.collect()]
        self._spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(
            f"{self._root}/manifest/{self._batch_id}"
        )
        self._clean()

    def _clean(self) -> None:
        """Deletes what the micro-batch before this one replaced: only manifest n - 2 names it."""
        if self._batch_id < 2:
            return
        kept = {(row["bucket"], row["version"]) for row in self._held}
        for row in self._manifest(self._batch_id - 2):
            if (row["bucket"], row["version"]) not in kept:
                remove_path(self._spark, self._folder(row["version"], row["bucket"]))
        if self._batch_id > 2:
            remove_path(self._spark, f"{self._root}/manifest/{self._batch_id - 3}")


def _run(
    stream: DataFrame,
    step: Step,
    carried_schema: T.StructType,
    keys: Sequence[str],
    out: str,
    checkpoint: str,
    interval: str | None,
    buckets: int = BUCKETS,
    sweep: int | None = None,
) -> StreamingQuery:
    """``sweep``: every so many micro-batches take all buckets, so that idle keys end."""

    def process(batch: DataFrame, batch_id: int) -> None:
        cached = [batch.persist()]
        try:
            carried = Carried(
                batch.sparkSession, f"{checkpoint}/carried", carried_schema, keys, batch_id, buckets
            )
            touched = carried.touched(batch)
            if sweep and batch_id % sweep == sweep - 1:
                touched |= carried.all_buckets()
            result, after, *more = step(batch, carried.read(touched))
            cached.extend(more)
            result.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
            carried.write(after, touched)
        finally:
            for frame in cached:
                frame.unpersist()

    writer = stream.writeStream.outputMode("append").foreachBatch(process)
    return start(writer, stream.sparkSession, checkpoint, interval=interval)


def _only(stream: DataFrame, names: Sequence[str]) -> DataFrame:
    """The columns a step reads: a cached micro-batch holds no others."""
    return stream.select(*dict.fromkeys(names))


def run_changelog_count(
    stream: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    counted: str | None,
    out: str,
    checkpoint: str,
    *,
    interval: str | None = None,
    max_rows: int = DEFAULT_MAX_ROWS,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """``changelog_count`` continued from micro-batch to micro-batch."""

    def step(rows: DataFrame, before: DataFrame) -> tuple[DataFrame, ...]:
        return changelog.changelog_count_step(
            rows, before, keys, order_by, counted, max_rows=max_rows
        )

    schema = changelog.carried_schema(stream, keys)
    needed = [*keys, *order_by, *([] if counted is None else [counted])]
    return _run(
        _only(stream, needed), step, schema, keys, out, checkpoint, interval, buckets
    )


def run_count_windows(
    stream: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    size: int,
    value: str,
    out: str,
    checkpoint: str,
    *,
    interval: str | None = None,
    max_rows: int = DEFAULT_MAX_ROWS,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Sum and truncated mean of every ``size`` consecutive rows of a key."""

    def step(rows: DataFrame, before: DataFrame) -> tuple[DataFrame, ...]:
        windows = countwindow.count_windows_step(
            rows, before, keys, order_by, size, value, max_rows=max_rows
        ).persist()
        return (
            countwindow.closed_windows(windows, keys, size),
            countwindow.open_windows(windows, keys, size),
            windows,
        )

    schema = countwindow.carried_schema(stream, keys)
    needed = [*keys, *order_by, value]
    return _run(
        _only(stream, needed), step, schema, keys, out, checkpoint, interval, buckets
    )


def run_pattern_matches(
    stream: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    stages: Sequence[Stage],
    columns: Sequence[str],
    within: timedelta,
    lateness: timedelta,
    out: str,
    checkpoint: str,
    *,
    interval: str | None = None,
    max_rows: int = DEFAULT_MAX_ROWS,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """``pattern_matches`` with at least one new row, over the rows kept from before.

    Rows of all stages are kept for ``within`` plus ``lateness`` behind the greatest
    event time, so the order of arrival makes no difference; a row arriving later than
    ``lateness`` may find its partners gone.
    """
    ts = order_by[0]
    conditions = [
        F.coalesce(stage.condition, F.lit(False)).alias(f"_stage_{position}")
        for position, stage in enumerate(stages)
    ]
    staged = stream.select(*dict.fromkeys([*keys, *order_by, *columns]), *conditions)
    flags = [F.col(f"_stage_{position}") for position in range(len(stages))]
    horizon = f"INTERVAL {(within + lateness) // timedelta(microseconds=1)} MICROSECONDS"

    def step(rows: DataFrame, before: DataFrame) -> tuple[DataFrame, ...]:
        both = before.withColumn("_new", F.lit(False)).unionAll(
            rows.withColumn("_new", F.lit(True))
        )
        found = pattern_matches(
            both,
            keys,
            order_by,
            [Stage(stage.name, flag) for stage, flag in zip(stages, flags)],
            columns,
            within=within,
            max_rows=max_rows,
            fresh="_new",
        )
        newest = both.agg(F.max(ts)).first()[0]
        waiting = flags[0]
        for flag in flags[1:]:
            waiting = waiting | flag
        recent = F.col(ts) >= F.lit(newest).cast(both.schema[ts].dataType) - F.expr(
            horizon
        )
        return found, both.where(waiting & recent).drop("_new")

    return _run(
        staged, step, staged.schema, keys, out, checkpoint, interval, buckets, SWEEP
    )
