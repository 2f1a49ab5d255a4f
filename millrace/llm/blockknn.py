"""Nearest neighbours by a block matrix join over int8 tiles.

Vectors are packed into tiles with one scale each.  A product of two int8 tiles gives every
distance between them up to a bound known from the rounding errors; pairs whose least possible
distance is above the k-th smallest of the greatest possible ones cannot be among the k
nearest.  What is left is computed again in double precision, and heaps of k per query
merge tiles, then cells of query block and row block.  The result is exact.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TILE_ROWS = 2048
QUERY_TILE_ROWS = 1024
QUERY_BYTES = 128 << 20
ROW_BYTES = 256 << 20
HELD_BYTES = 64 << 20


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, vector, dim`` without ids or vectors that are null, zero or not finite.

    Repeated rows count once: in a tile they would take the places of other neighbours.
    """
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return (
        vectors.select("vec_id", "embedding", vector.alias("vector"))
        .where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
        .where(finite & F.exists("vector", lambda x: x != 0))
        .select("vec_id", "embedding")
        .distinct()
        .select("vec_id", vector.alias("vector"))
        .withColumn("dim", F.size("vector"))
    )


class Tile:
    """Vectors of one dimension with their int8 form and the length of each rounding error."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.scale = max(float(np.abs(vectors).max()) / 127, np.finfo(float).tiny)
        self.whole = np.clip(np.rint(vectors / self.scale), -127, 127).astype(np.int8)
        self.error = np.sqrt(((vectors - self.whole * self.scale) ** 2).sum(axis=1))
        # Products of int8 sum to whole numbers that single precision holds up to 2^24.
        kind = np.float32 if vectors.shape[1] * 127 * 127 < 1 << 24 else np.float64
        self.factor = self.whole.astype(kind)
        self.square = (self.whole.astype(np.float64) ** 2).sum(axis=1) * self.scale**2

    def bounds(self, other: Tile) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible distance of each pair."""
        product = (self.factor @ other.factor.T).astype(np.float64) * (self.scale * other.scale)
        near = np.sqrt(np.maximum(self.square[:, None] + other.square[None, :] - 2 * product, 0))
        slack = self.error[:, None] + other.error[None, :] + 1e-7 * (1 + near)
        return near - slack, near + slack


def nearest_in_tile(queries: Tile, rows: Tile, k: int, heaps: list[list]) -> None:
    """Puts into each query's heap of (-distance, -id) what may be among its k nearest."""
    low, high = queries.bounds(rows)
    own = queries.ids[:, None] == rows.ids[None, :]
    high[own] = np.inf
    if high.shape[1] > k:
        limit = np.partition(high, k - 1, axis=1)[:, k - 1]
    else:
        limit = np.full(len(high), np.inf)
    for q, heap in enumerate(heaps):
        most = min(limit[q], -heap[0][0] * (1 + 1e-12)) if len(heap) == k else limit[q]
        left = np.flatnonzero((low[q] <= most) & ~own[q])
        exact = np.sqrt(((rows.vectors[left] - queries.vectors[q]) ** 2).sum(axis=1))
        for distance, vec_id in zip(exact.tolist(), rows.ids[left].tolist()):
            item = (-distance, -vec_id)
            if len(heap) < k:
                heapq.heappush(heap, item)
            elif item > heap[0]:
                heapq.heapreplace(heap, item)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _packed(dtype: type):
    """Vectors in pieces of one dimension and lane, at most ``TILE_ROWS`` each.

    Which vectors a lane gets does not depend on their order, so a task that runs again
    sends each lane the same.  At most ``HELD_BYTES`` wait at once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        waiting = 0

        def out(key: tuple[int, int]) -> Iterator[pa.RecordBatch]:
            parts = held.pop(key)
            ids = np.concatenate([i for i, _ in parts])
            vectors = np.concatenate([v for _, v in parts])
            for at in range(0, len(ids), TILE_ROWS):
                columns = [
                    pa.array([key[0]], pa.int32()),
                    pa.array([key[1]], pa.int32()),
                    pa.array([ids[at : at + TILE_ROWS].tobytes()], pa.binary()),
                    pa.array([vectors[at : at + TILE_ROWS].tobytes()], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["dim", "lane", "ids", "vectors"])

        for batch in batches:
            kinds = np.stack([batch["dim"].to_numpy(), batch["lane"].to_numpy()], axis=1)
            for dim, lane in np.unique(kinds, axis=0).tolist():
                some = batch.filter(pa.array((kinds == (dim, lane)).all(axis=1)))
                vectors = _matrix(some["vector"], dim).astype(dtype)
                held.setdefault((dim, lane), []).append((some["vec_id"].to_numpy(), vectors))
                waiting += vectors.nbytes
            if waiting > HELD_BYTES:
                for key in list(held):
                    yield from out(key)
                waiting = 0
        for key in list(held):
            yield from out(key)

    return run


def _tiles(pieces: list[tuple[np.ndarray, np.ndarray]], size: int) -> Iterator[Tile]:
    ids = np.concatenate([i for i, _ in pieces])
    vectors = np.concatenate([v for _, v in pieces])
    for at in range(0, len(ids), size):
        yield Tile(ids[at : at + size], vectors[at : at + size].astype(np.float64))


def _search(k: int, dtype: type):
    """One cell: its query pieces come first and get heaps, its rows stream past them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: dict[int, list] = {}
        queries: dict[int, list[tuple[Tile, list[list]]]] | None = None
        waiting: dict[int, list] = {}

        def meet(dim: int) -> None:
            for rows in _tiles(waiting.pop(dim), TILE_ROWS):
                for tile, heaps in queries.get(dim, []):
                    nearest_in_tile(tile, rows, k, heaps)

        for batch in batches:
            for piece in batch.to_pylist():
                dim = piece["dim"]
                vectors = np.frombuffer(piece["vectors"], dtype).reshape(-1, dim)
                part = np.frombuffer(piece["ids"], np.int64), vectors
                if not piece["is_row"]:
                    asked.setdefault(dim, []).append(part)
                    continue
                if queries is None:
                    queries = {
                        d: [(tile, [[] for _ in tile.ids]) for tile in _tiles(parts, QUERY_TILE_ROWS)]
                        for d, parts in asked.items()
                    }
                    asked = {}
                waiting.setdefault(dim, []).append(part)
                if sum(len(ids) for ids, _ in waiting[dim]) >= TILE_ROWS:
                    meet(dim)
        for dim in list(waiting):
            meet(dim)
        for tile, heaps in (pair for pairs in (queries or {}).values() for pair in pairs):
            found = [(q, -i, -d) for q, heap in zip(tile.ids.tolist(), heaps) for d, i in heap]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.int64(), pa.float64()))],
                    ["query_id", "vec_id", "score"],
                )

    return run


def nearest(
    vectors: DataFrame,
    is_query,
    k: int = 10,
    query_bytes: int = QUERY_BYTES,
    row_bytes: int = ROW_BYTES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` nearest other rows, exactly.

    ``vectors`` has ``vec_id`` and ``embedding``; other columns are ignored.  Rows without
    id and vectors null, zero or with a null or non-finite component take no part; vectors of
    different dimension are not compared.  Ties go to the smaller id; a row is never its own
    neighbour, nor is one with the same id; repeated rows count once.

    Queries lie in blocks of about ``query_bytes``, rows in blocks of about ``row_bytes``, both
    counted; a pair of blocks is a cell, and one task's work.  So rows are sent once for each
    block of queries and queries once for each block of rows; nothing passes the driver.
    """
    spark = vectors.sparkSession
    single = isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)
    dtype = np.float32 if single else np.float64
    rows = usable(vectors)
    width = F.coalesce(F.size("embedding"), F.lit(0)).cast("long") * np.dtype(dtype).itemsize
    asked = F.coalesce(F.sum(F.when(is_query, width)), F.lit(0))
    total = F.coalesce(F.sum(width), F.lit(0))
    query_size, row_size = vectors.where("vec_id is not null and embedding is not null").agg(asked, total).first()
    query_blocks = max(-(-query_size // query_bytes), 1)
    row_blocks = max(-(-row_size // row_bytes), -(-spark.sparkContext.defaultParallelism // query_blocks))

    def pieces(some: DataFrame, lanes: int) -> DataFrame:
        lane = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(lanes)).cast("int")
        packed = some.select("vec_id", "vector", "dim", lane.alias("lane"))
        return packed.mapInArrow(_packed(dtype), "dim int, lane int, ids binary, vectors binary")

    def every(blocks: int, step: int):
        return F.explode(F.sequence(F.lit(0), F.lit((blocks - 1) * step), F.lit(step)))

    content = ["dim", "ids", "vectors"]
    of_queries = pieces(rows.where(is_query), query_blocks).select(
        F.lit(False).alias("is_row"), *content, (F.col("lane") * row_blocks).alias("from"), every(row_blocks, 1).alias("block")
    )
    of_rows = pieces(rows, row_blocks).select(
        F.lit(True).alias("is_row"), *content, F.col("lane").alias("from"), every(query_blocks, row_blocks).alias("block")
    )
    found = (
        of_queries.unionByName(of_rows)
        .select("is_row", *content, (F.col("from") + F.col("block")).alias("cell"))
        .repartitionById(query_blocks * row_blocks, "cell")
        .sortWithinPartitions("is_row")
        .mapInArrow(_search(k, dtype), "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
