"""Removing long byte strings that occur more than once, by suffix arrays.

Every run of ``length`` bytes has an anchor, its least hashed gram.  Runs with equal bytes
have equal anchors, so runs are dealt to shards by anchor, together with the bytes around it
(an extract).  Anchors seen once need no look at any byte, and equal extracts are repeats
by themselves; only different extracts of one anchor are compared.  Each shard of them gets
a suffix array by Larsson-Sadakane refinement; the prefixes that neighbours in it have in
common (Kasai's pairs) tell repeated runs.  A shard that the last anchor fills over has two
suffix arrays, which are merged by binary search of the runs of one in another.  Anchors
with more extracts than a shard holds are hot: their runs are hashed and meet by hash, so that
no task gets all extracts of one anchor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import tokens
from millrace.llm.text import cut_lineage, free_name, small

LENGTH = 200
GRAM = 32
PLACE_BITS = 24
PIECE_BYTES = 8 << 20
SHARD_BYTES = 1 << 20
HASHED_BYTES = 1 << 18
FIRST_BYTES = 8
# Of 32 bytes each.
WANTED_AT_ONCE = 2_000_000


def _sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    step, low = 1, keys
    while 2 * step <= width:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    rest = width - step
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def _anchored(data: np.ndarray, offsets: np.ndarray, powers: tokens.Powers, length: int):
    """Arrays ``anchor, extract, row, first run, number of runs`` of a chunk."""
    n = len(data)
    if n < length:
        return None
    up, down = powers.upto(n + 1)
    sums = tokens.prefix_hashes(data, powers)
    grams = tokens.mixed((sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1])
    low = np.uint64((1 << PLACE_BITS) - 1)
    keys = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    least = _sliding_min(keys, length - GRAM + 1)
    valid = np.ones(len(least), bool)
    for start, end in zip(offsets[:-1], offsets[1:]):
        valid[max(end - length + 1, start) : end] = False
    runs = np.flatnonzero(valid)
    if not len(runs):
        return None
    cut = np.flatnonzero(least[runs][1:] != least[runs][:-1]) + 1
    first, last = runs[np.concatenate([[0], cut])], runs[np.concatenate([cut - 1, [len(runs) - 1]])]
    place = (least[first] & low).astype(np.int64)
    end = last + length
    extract = tokens.mixed((sums[end] - sums[first]) * down[first])
    extract = tokens.mixed(extract + (end - first).astype(np.uint64) * np.uint64(0x9E3779B1) + (place - first).astype(np.uint64))
    row = np.searchsorted(offsets, first, side="right") - 1
    return grams[place], extract, row, first - offsets[row], last - first + 1


def _pieces(column: pa.Array, length: int):
    """Chunks; a text longer than a piece comes in pieces that overlap by a run."""
    for at, to, data, offsets in tokens.chunks(column):
        if len(data) <= PIECE_BYTES:
            yield at, 0, data, offsets
            continue
        for start in range(0, len(data) - length + 1, PIECE_BYTES - length + 1):
            piece = data[start : start + PIECE_BYTES]
            yield at, start, piece, np.array([0, len(piece)])


def _occurrences(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, seen = tokens.Powers(), set()
        for batch in batches:
            keys = batch["text_key"].to_numpy()
            fresh = []
            for key in keys.tolist():
                fresh.append(key not in seen)
                seen.add(key)
            mask = pa.array(fresh, pa.bool_())
            column, keys = batch["text"].filter(mask), keys[np.array(fresh, bool)]
            for at, start, data, offsets in _pieces(column, length):
                found = _anchored(data, offsets, powers, length)
                if found is None:
                    continue
                anchor, extract, row, first, runs = found
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor.view(np.int64)),
                        pa.array(extract.view(np.int64)),
                        pa.array(keys[row + at]),
                        pa.array(first + start),
                        pa.array(runs.astype(np.int32)),
                    ],
                    ["anchor", "extract", "text_key", "first", "runs"],
                )

    return run


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches short enough to be turned into Python objects."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def _cut_extracts(length: int):
    """Bytes of the listed extracts of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            data, offsets = tokens.flat(batch["text"])
            out: list[list] = [[], [], []]
            for k, wanted in enumerate(batch["wanted"].to_pylist()):
                body = data[offsets[k] : offsets[k + 1]].tobytes()
                for w in wanted:
                    out[0].append(w["anchor"])
                    out[1].append(w["extract"])
                    out[2].append(body[w["first"] : w["first"] + w["runs"] - 1 + length])
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())],
                ["anchor", "extract", "body"],
            )

    return run


def _hashed_runs(length: int):
    """A hash of each run of the listed extracts of each text, and one of where it stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = tokens.Powers()

        def out(listed: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
            anchor, extract, runs = (np.array(c, np.int64) for c in list(zip(*listed))[:3])
            sizes = runs + length - 1
            at = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
            starts = np.repeat(np.cumsum(sizes) - sizes, runs) + at
            data = np.frombuffer(b"".join(row[3] for row in listed), np.uint8)
            sums = tokens.prefix_hashes(data, powers)
            found = tokens.mixed((sums[starts + length] - sums[starts]) * powers.down[starts])
            extract = np.repeat(extract, runs)
            place = tokens.mixed(extract.view(np.uint64) + at.astype(np.uint64))
            return pa.RecordBatch.from_arrays(
                [pa.array(c.view(np.int64)) for c in (np.repeat(anchor, runs), extract, at, found, place)],
                ["anchor", "extract", "run", "hash", "place"],
            )

        listed, filled = [], 0
        for batch in _slices(batches):
            data, offsets = tokens.flat(batch["text"])
            for k, wanted in enumerate(batch["wanted"].to_pylist()):
                body = data[offsets[k] : offsets[k + 1]]
                for w in wanted:
                    part = body[w["first"] : w["first"] + w["runs"] - 1 + length].tobytes()
                    listed.append((w["anchor"], w["extract"], w["runs"], part))
                    filled += len(part)
                    if filled >= HASHED_BYTES:
                        yield out(listed)
                        listed, filled = [], 0
        if listed:
            yield out(listed)

    return run


def _hot_repeats(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``anchor, extract, from_run, to_run`` of repeated runs of hot anchors.

    Copies of a text give the same place again, which is no repeat.
    """
    runs = (
        docs.join(small(wanted, "wanted", WANTED_AT_ONCE), "text_key")
        .select("text", "wanted")
        .mapInArrow(_hashed_runs(length), "anchor long, extract long, run long, hash long, place long")
    )
    repeats = cut_lineage(
        runs.groupBy("hash")
        .agg(F.min("place").alias("low"), F.max("place").alias("high"))
        .where("low <> high")
        .select("hash")
    )
    listed = (
        runs.join(small(repeats), "hash")
        .groupBy("anchor", "extract")
        .agg(F.array_sort(F.collect_set("run")).alias("found"))
    )
    # Runs in a row are one interval.
    first = F.filter("found", lambda x, k: (k == 0) | (F.get("found", k - 1) < x - 1))
    last = F.filter("found", lambda x, k: (k == F.size("found") - 1) | (F.get("found", k + 1) > x + 1))
    return listed.select(
        "anchor", "extract", F.explode(F.arrays_zip(first.alias("a"), last.alias("b"))).alias("span")
    ).select("anchor", "extract", F.col("span.a").alias("from_run"), F.col("span.b").alias("to_run"))


class SuffixArray:
    """Suffixes of ``data`` sorted by their first ``depth`` bytes at least.

    Larsson-Sadakane: suffixes are sorted by their first bytes; then groups that are still
    equal, and only those, are sorted by the rank of the suffix as many bytes further on,
    which doubles what is compared.  The ranks of each round are kept, so that equality
    of two substrings is a few comparisons.
    """

    def __init__(self, data: np.ndarray, depth: int):
        n = len(data)
        self.data = data
        padded = np.concatenate([data, np.zeros(FIRST_BYTES, np.uint8)]).astype(np.uint64)
        key = np.zeros(n, np.uint64)
        for k in range(FIRST_BYTES):
            key = (key << np.uint64(8)) | padded[k : k + n]
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
        order = order.astype(np.int32)
        rank = np.empty(n, np.int32)
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        self.ranks, h = {FIRST_BYTES: rank}, FIRST_BYTES
        while h < depth:
            group = rank[order]
            single = np.concatenate([[True], group[1:] != group[:-1]]) & np.concatenate([group[1:] != group[:-1], [True]])
            at = np.flatnonzero(~single)
            after = order[at].astype(np.int64) + h
            further = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
            pair = group[at].astype(np.int64) * (n + 1) + further
            by = np.argsort(pair, kind="stable")
            order, pair = order.copy(), pair[by]
            order[at] = order[at][by]
            rank = rank.copy()
            new = np.concatenate([[True], pair[1:] != pair[:-1]])[: len(at)]
            rank[order[at]] = np.maximum.accumulate(np.where(new, at, 0)) if len(at) else at
            h *= 2
            self.ranks[h] = rank
        self.order = order

    def same(self, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
        """Whether the ``length`` bytes from ``a`` and from ``b`` on are equal.

        ``length`` must be a multiple of the first bytes; both runs end inside the data.
        """
        equal, at = np.ones(len(a), bool), 0
        for h in sorted(self.ranks, reverse=True):
            while length - at >= h:
                equal &= self.ranks[h][a + at] == self.ranks[h][b + at]
                at += h
        return equal

    def sorted_starts(self, starts: np.ndarray) -> np.ndarray:
        is_start = np.zeros(len(self.data), bool)
        is_start[starts] = True
        return self.order[is_start[self.order]]

    def repeated(self, starts: np.ndarray, length: int) -> np.ndarray:
        """For each of ``starts``: does its run of ``length`` bytes start at another, too?"""
        mine = self.sorted_starts(starts)
        equal = self.same(mine[1:], mine[:-1], length)
        found = np.zeros(len(self.data), bool)
        found[mine[1:][equal]] = True
        found[mine[:-1][equal]] = True
        return found[starts]


def contained(data: np.ndarray, mine: np.ndarray, other: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """For each run ``at`` of ``other``: is it one of the runs ``mine`` of ``data``?

    ``mine`` are starts in the order of a suffix array; runs are found by binary search.
    """
    low, high = np.zeros(len(at), np.int64), np.full(len(at), len(mine))
    found = np.zeros(len(at), bool)
    while True:
        left = np.flatnonzero((low < high) & ~found)
        if not len(left):
            return found
        middle = (low[left] + high[left]) // 2
        sign = _compare(data, mine[middle], other, at[left], length)
        found[left[sign == 0]] = True
        low[left[sign < 0]] = middle[sign < 0] + 1
        high[left[sign > 0]] = middle[sign > 0]


def _compare(data: np.ndarray, a: np.ndarray, other: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Sign of the comparison of ``length`` bytes, byte column by byte column while equal."""
    sign, left = np.zeros(len(a), np.int8), np.arange(len(a))
    for k in range(length):
        x, y = data[a[left] + k], other[b[left] + k]
        sign[left[x < y]], sign[left[x > y]] = -1, 1
        left = left[x == y]
        if not len(left):
            break
    return sign


def _shard_repeats(shards: list[list[tuple]], length: int) -> Iterator[tuple]:
    """``anchor, extract, first, last`` of repeated runs; shards of one call are merged."""
    built = []
    for shard in shards:
        sizes = np.array([len(body) for _, _, body in shard])
        begin = np.cumsum(sizes) - sizes
        runs = sizes - length + 1
        starts = np.repeat(begin, runs) + np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
        array = SuffixArray(np.frombuffer(b"".join(body for _, _, body in shard), np.uint8), length)
        # Of the array the merge needs the order of the runs only.
        order = array.sorted_starts(starts) if len(shards) > 1 else None
        built.append((shard, runs, starts, array.data, order, array.repeated(starts, length)))
    for k, (_, _, starts, data, _, repeated) in enumerate(built):
        for m, (_, _, _, other, order, _) in enumerate(built):
            if m != k:
                todo = np.flatnonzero(~repeated)
                repeated[todo] = contained(other, order, data, starts[todo], length)
    for shard, runs, _, _, _, repeated in built:
        at = 0
        for (anchor, extract, _), n in zip(shard, runs):
            flags = np.concatenate([[False], repeated[at : at + n], [False]])
            at += n
            edges = np.flatnonzero(flags[1:] != flags[:-1])
            for first, end in zip(edges[::2], edges[1::2]):
                yield anchor, extract, int(first), int(end) - 1


def _compare_extracts(length: int):
    """Reads extracts sorted by anchor; whole anchors share a shard while it has room."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows):
            rows = list(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)],
                ["anchor", "extract", "from_run", "to_run"],
            )

        shards: list[list[tuple]] = [[]]
        filled, before = 0, None
        for batch in _slices(batches, 4096):
            for row in zip(*(batch[c].to_pylist() for c in ("anchor", "extract", "body"))):
                if row[0] != before and (filled >= SHARD_BYTES or len(shards) > 1):
                    yield out(_shard_repeats(shards, length))
                    shards, filled = [[]], 0
                elif filled >= SHARD_BYTES:
                    shards.append([])
                    filled = 0
                shards[-1].append(row)
                filled += len(row[2])
                before = row[0]
        if shards[0]:
            yield out(_shard_repeats(shards, length))

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``text_key, spans``: byte spans of each text that lie in repeated runs.

    Works on the distinct texts of ``docs`` (``text_key``, ``text``).  Spans may overlap;
    those of a text that several rows have reach past its end.
    """
    if length % FIRST_BYTES or length <= GRAM:
        raise ValueError(f"length must be a multiple of {FIRST_BYTES} above {GRAM}")
    occurrences = docs.mapInArrow(
        _occurrences(length), "anchor long, extract long, text_key long, first long, runs int"
    )
    often = occurrences.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    shared = cut_lineage(occurrences.join(often, "anchor"))
    extracts = cut_lineage(
        shared.groupBy("anchor", "extract").agg(
            F.count("*").alias("n"), F.min(F.struct("text_key", "first", "runs")).alias("place")
        )
    )
    # An extract has less than twice the bytes of a run, so that these fit a shard.
    kinds = cut_lineage(extracts.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1"))
    is_hot = F.col("kinds") > SHARD_BYTES // (2 * length)

    def by_text(some: DataFrame) -> DataFrame:
        return cut_lineage(
            extracts.join(some.select("anchor"), "anchor")
            .groupBy("place.text_key")
            .agg(F.collect_list(F.struct("anchor", "extract", "place.first", "place.runs")).alias("wanted"))
        )

    wanted = by_text(kinds.where(~is_hot))
    bodies = (
        docs.join(small(wanted, "wanted", WANTED_AT_ONCE), "text_key")
        .select("text", "wanted")
        .mapInArrow(_cut_extracts(length), "anchor long, extract long, body binary")
        .dropDuplicates(["anchor", "extract"])
    )
    compared = (
        bodies.repartition("anchor")
        .sortWithinPartitions("anchor", "extract")
        .mapInArrow(_compare_extracts(length), "anchor long, extract long, from_run long, to_run long")
    )
    hot = kinds.where(is_hot)
    if not hot.isEmpty():
        compared = compared.union(_hot_repeats(docs, by_text(hot), length))
    same = extracts.where("n > 1").select(
        "anchor", "extract", F.lit(0).cast("long").alias("from_run"), (F.col("place.runs") - 1).cast("long").alias("to_run")
    )
    found = shared.join(compared.union(same), ["anchor", "extract"]).select(
        "text_key",
        F.struct((F.col("first") + F.col("from_run")).alias("a"), (F.col("first") + F.col("to_run") + length).alias("b")).alias("span"),
    )
    copied = (
        docs.groupBy("text_key").agg(F.count("*").alias("n")).where("n > 1")
        .select("text_key", F.struct(F.lit(0).cast("long").alias("a"), F.lit((1 << 62)).alias("b")).alias("span"))
    )
    return found.union(copied).groupBy("text_key").agg(F.collect_list("span").alias("spans"))


def merged_spans(spans: list[dict] | None, size: int, length: int) -> list[tuple[int, int]]:
    """Maximal spans within ``size`` bytes; texts shorter than a run have none."""
    out: list[list[int]] = []
    for a, b in sorted((s["a"], min(s["b"], size)) for s in spans or []) if size >= length else []:
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _digest(length: int):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows = []
            data, offsets = tokens.flat(batch["text"])
            for k, spans in enumerate(batch["spans"].to_pylist()):
                body = memoryview(data[offsets[k] : offsets[k + 1]])
                cut, at, kept = merged_spans(spans, len(body), length), 0, hashlib.sha256()
                for a, b in cut:
                    kept.update(body[at:a])
                    at = b
                kept.update(body[at:])
                rows.append((len(body), sum(b - a for a, b in cut), len(cut), kept.hexdigest()))
            columns = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
                names,
            )

    return run


def _cut_text(length: int, names: list[str], spans_name: str):
    """Texts without their repeated spans, which shrink to whole characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            texts, stays = batch["text"].to_pylist(), [True] * len(batch)
            for k, spans in enumerate(batch[spans_name].to_pylist()):
                if spans and texts[k]:
                    body = texts[k].encode()
                    parts, at = [], 0
                    for a, b in merged_spans(spans, len(body), length):
                        while a < b and body[a] & 0xC0 == 0x80:
                            a += 1
                        while a < b < len(body) and body[b] & 0xC0 == 0x80:
                            b -= 1
                        parts.append(body[at:a])
                        at = b
                    texts[k] = b"".join([*parts, body[at:]]).decode()
                    stays[k] = bool(texts[k].strip()) or not body.strip()
            columns = [pa.array(texts, batch.schema.field("text").type) if n == "text" else batch[n] for n in names]
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(stays, pa.bool_()))

    return run


def _with_spans(docs: DataFrame, length: int) -> tuple[DataFrame, str]:
    """``docs`` with a column of spans more, and its name."""
    key, spans = free_name(docs, "text_key"), free_name(docs, "spans")
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce("text", F.lit(""))))
    found = cut_lineage(repeated_spans(keyed.select(F.col(key).alias("text_key"), "text"), length))
    found = small(found, "spans").withColumnsRenamed({"text_key": key, "spans": spans})
    return keyed.join(found, key, "left").select(*docs.columns, spans), spans


def removal_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row of ``docs``.

    Uses ``doc_id`` and ``text``; other columns are ignored.  A byte goes if a run of
    ``length`` UTF-8 bytes over it also starts elsewhere in any row, its own included.  Null
    text is empty.  Equal texts are known by 64-bit hashes.  Runs jobs when called.
    """
    marked, _ = _with_spans(docs.select("doc_id", "text"), length)
    return marked.mapInArrow(
        _digest(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with repeated runs cut out of ``text``; rows left without text go.

    Spans shrink to whole characters.  Other columns are as they were.
    """
    marked, spans = _with_spans(docs, length)
    return marked.mapInArrow(_cut_text(length, docs.columns, spans), docs.schema)
