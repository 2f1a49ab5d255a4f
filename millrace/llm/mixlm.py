"""A language model that mixes hashed-context bit predictors.

Text is its words, A-Z lower-cased, each followed by a blank, then an end sign.  Every byte
is eight binary decisions.  For each number of preceding bytes (0 to ``MOST_ORDER``), and for
the word so far within them, a table of counts predicts the next bit; a mixer adds the
predictions in the logistic domain, with weights chosen by how long a context was seen
before and by the bit's place, learned online; a last table, adapted to what the mixer got
right, refines the result.

All training text counts.  As a prediction depends on ``MOST_ORDER + 1`` bytes only, tasks
count and score distinct byte runs instead of every place.  Runs are dealt to shards by the
three bytes before the last one, so that a shard holds all counts of the contexts that it
owns: it builds its own segment of the tables and learns its own weights.  The number of
shards and of slots follows from the number of distinct runs, never from partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import tokens
from millrace.llm.text import cut_lineage

MOST_ORDER = 6
ORDERS = MOST_ORDER + 2
DENSE = 3
HASHED = ORDERS - DENSE
SLOTS_A_RUN = 4
MOST_SLOT_BITS = 23
SHARD_RUNS = 1 << 18
MOST_SHARD_BITS = 14
SPREAD = 10_368_889
HELD_GRAMS = 3_000_000
NEAR_BITS = 21
LEARN_AT_ONCE = 1024
LEARNING_RATE = 0.05
PASSES = 3
REFINE_STEPS = 33
FEWER = 0.85  # share of different predictions below which each is made once
HOT_WORDS = 1 << 17
CHUNK = 2 << 20


def plain(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes that are scored and their offsets by row."""
    starts, _, rows = tokens.word_bounds(data, offsets)
    solid = np.flatnonzero(~tokens.IS_GAP[data])
    is_start = np.zeros(len(data), np.int64)
    is_start[starts] = 1
    word = np.cumsum(is_start)[solid] - 1
    row_of_word = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    solid_before = np.searchsorted(solid, offsets)
    begin = solid_before + rows + np.arange(len(rows))
    out = np.full(int(begin[-1]), 32, np.uint8)
    out[np.arange(len(solid)) + word + row_of_word[word]] = tokens.LOWER[data[solid]]
    out[begin[1:] - 1] = 10
    return out, begin


def grams(text: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Each byte with up to ``MOST_ORDER`` before it in its row, the byte itself lowest."""
    key = text.astype(np.uint64)
    for step in (1, 2, 4):  # so many bytes are there, as many before them join
        key[step:] |= key[:-step] << np.uint64(8 * step)
    key &= np.uint64((1 << (8 * MOST_ORDER + 8)) - 1)
    for place in range(MOST_ORDER):
        at = begin[:-1] + place
        key[at[at < begin[1:]]] &= np.uint64((1 << (8 * place + 8)) - 1)
    return key


def nearest_first(key: np.ndarray) -> np.ndarray:
    """For sorting: the byte before the last one counts most, the one before it next; the last byte least."""
    return (key & np.uint64((1 << (8 * MOST_ORDER + 8)) - 256)).byteswap() | (key & np.uint64(255))


def contexts(key: np.ndarray) -> list[np.ndarray]:
    """What each predictor looks at: the last 0, 1, 2 bytes as they are, then hashes of the
    last 3, 4, ... bytes and of the word so far."""
    before = key >> np.uint64(8)
    found = [before & np.uint64((1 << (8 * order)) - 1) for order in range(MOST_ORDER + 1)]
    word, inside = np.zeros(len(key), np.uint64), np.ones(len(key), bool)
    for back in range(MOST_ORDER):
        byte = (before >> np.uint64(8 * back)) & np.uint64(255)
        inside = inside & (byte > 32)
        word[inside] |= byte[inside] << np.uint64(8 * back)
    found.append(word)
    return [
        c if k < DENSE else tokens.mixed(c * np.uint64(16) + np.uint64(k)) * np.uint64(_FACTOR)
        for k, c in enumerate(found)
    ]


def shard_of(key: np.ndarray, shard_bits: int) -> np.ndarray:
    """The shard by the three bytes before the last; all blanks and starts are alike."""
    near = np.zeros(len(key), np.int64)
    for back in (1, 2, 3):
        byte = (key >> np.uint64(8 * back)) & np.uint64(255)
        near |= np.maximum(byte, np.uint64(32)).astype(np.int64) << (8 * (back - 1))
    return ((near * SPREAD) & 0xFFFFFF) >> (24 - shard_bits)


def shard_column(key: Column, shard_bits: int) -> Column:
    """``shard_of`` as a column."""
    near = F.lit(0).cast("long")
    for back in (1, 2, 3):
        byte = F.shiftrightunsigned(key, 8 * back).bitwiseAND(255)
        near = near + F.greatest(byte, F.lit(32).cast("long")) * (1 << (8 * (back - 1)))
    return F.shiftright((near * SPREAD).bitwiseAND(0xFFFFFF), 24 - shard_bits).cast("int")


def sizes(runs: int) -> tuple[int, int]:
    """Bits of a slot and of a shard for so many distinct runs."""
    slot_bits = min(max((SLOTS_A_RUN * runs).bit_length(), 10), MOST_SLOT_BITS)
    shard_bits = min(max(runs // SHARD_RUNS, 0).bit_length(), MOST_SHARD_BITS)
    return slot_bits, shard_bits


_FACTOR = 0x81DADEF4BC2DD44D
_OF_NODE = np.arange(256, dtype=np.uint64) * np.uint64(tokens.BASE * _FACTOR % (1 << 64))


def _slots(context: np.ndarray, node: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Slot within a shard's segment of ``2^width``, and the sign that tells contexts of a slot apart."""
    return _parted(context + _OF_NODE.take(node), width)


def _parted(h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    return (h >> np.uint64(64 - width)).view(np.int64), h.view(np.uint8)[3::8]


def _bits(key: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``place, node, bit``: the decisions of each byte; a node is a 1 and the bits before."""
    byte = (key & np.uint64(255)).astype(np.int64)
    for place in range(8):
        yield place, (1 << place) | (byte >> (8 - place)), (byte >> (7 - place)) & 1


def _distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted; faster than ``np.unique``, which hashes or sorts places."""
    keys = np.sort(keys)
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)]]


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts by key of parts that are sorted and distinct each."""
    keys = _distinct(np.concatenate([k for k, _ in parts]))
    counts = np.zeros(len(keys), np.int64)
    for some, n in parts:
        counts[np.searchsorted(keys, some)] += n
    return keys, counts


class Counter:
    """Sums counts by key; ``add`` gives back what is too much to hold."""

    def __init__(self) -> None:
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        self.parts.append(np.unique(keys, return_counts=True))
        self.waiting += len(self.parts[-1][0])
        if self.waiting < HELD_GRAMS // 2:
            return None
        self.merge()
        if len(self.keys) < HELD_GRAMS:
            return None
        out = self.keys, self.counts
        self.keys, self.counts = self.keys[:0], self.counts[:0]
        return out

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        self.keys, self.counts = _summed([(self.keys, self.counts), *self.parts])
        self.parts, self.waiting = [], 0
        return self.keys, self.counts


def _counted(of_chunk):
    """``tune, key, n`` of the keys that ``of_chunk`` finds, combined within a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, counters = tokens.Powers(), (Counter(), Counter())

        def out(tune: int, found) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(found[0]), bool(tune))), pa.array(found[0].view(np.int64)), pa.array(found[1])],
                ["tune", "key", "n"],
            )

        for batch in batches:
            tunes = batch["tune"].to_numpy(zero_copy_only=False)
            for tune in (0, 1):
                column = batch["text"].filter(pa.array(tunes == bool(tune)))
                for _, _, data, offsets in tokens.chunks(column, CHUNK):
                    full = counters[tune].add(of_chunk(data, offsets, powers))
                    if full is not None:
                        yield out(tune, full)
        for tune in (0, 1):
            yield out(tune, counters[tune].merge())

    return run


def _chunk_grams(data, offsets, powers):
    return grams(*plain(data, offsets))


def _chunk_words(data, offsets, powers):
    return tokens.word_hashes(data, offsets, powers)[0]


def segment(key: np.ndarray, n: np.ndarray, tuned: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """``signs, first, whole`` by hashed order: predictions without the tuning text and with it.

    Where contexts meet in a slot the one of the most frequent run has it; the others stay
    unknown there and longer or shorter contexts speak for them.
    """
    order = np.lexsort((key, n))
    key, n, tuned = key[order], n[order].astype(float), tuned[order].astype(float)
    signs = np.zeros((HASHED, 1 << width), np.uint8)
    first, whole = (np.full((HASHED, 1 << width), -128, np.int8) for _ in range(2))
    for k, context in enumerate(contexts(key)[DENSE:]):
        places = [(*_slots(context, node, width), bit) for _, node, bit in _bits(key)]
        for slot, sign, _ in reversed(places):
            signs[k][slot] = sign
        counts = np.zeros((2, 2 << width))
        for slot, sign, bit in places:
            own = signs[k][slot] == sign
            at = 2 * slot[own] + bit[own]
            counts[0] += np.bincount(at, (n - tuned)[own], 2 << width)
            counts[1] += np.bincount(at, n[own], 2 << width)
        first[k], whole[k] = predictions(counts[0]), predictions(counts[1])
    return signs, first, whole


def dense_tables(gram: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """Predictions after the last 0, 1 and 2 bytes, from counts of runs of three bytes."""

    def table(low: np.ndarray, n: np.ndarray, order: int) -> np.ndarray:
        counts = np.zeros(2 << (8 * (order + 1)), np.int64)
        for _, node, bit in _bits(low.astype(np.uint64)):
            np.add.at(counts, 2 * ((low >> 8 << 8) | node) + bit, n)
        return predictions(counts)

    tables = [table(gram & 0xFF, n, 0), table(gram & 0xFFFF, n, 1)]
    # The largest one by its first byte, so that counts are held for a 256th of it.
    last = np.full(1 << 24, -128, np.int8)
    for byte in np.unique(gram >> 16):
        some = (gram >> 16) == byte
        last[byte << 16 : (byte + 1) << 16] = table(gram[some] & 0xFFFF, n[some], 1)
    return [*tables, last]


def predictions(counts: np.ndarray) -> np.ndarray:
    """log odds of a one in sixteenths, as int8; -128 for a context never seen."""
    zeros, ones = counts[0::2].astype(np.float32), counts[1::2].astype(np.float32)
    odds = np.rint(16 * np.log((ones + 0.3) / (zeros + 0.3))).clip(-127, 127)
    return np.where(zeros + ones > 0, odds, -128).astype(np.int8)


class Model:
    """Prediction tables, mixing weights and refinement of one model.

    ``dense`` holds the tables of the short contexts, ``signs`` and ``hashed`` those of the
    others: all shards' segments behind each other, or with ``shard_bits`` 0 a single one.
    A sign and its prediction are looked up as one number.
    """

    def __init__(self, dense, signs, hashed, shard_bits, weights=None, refine=None):
        self.dense, self.shard_bits = dense, shard_bits
        self.entries = [np.left_shift(sign, 8, dtype=np.uint16) | said.view(np.uint8) for sign, said in zip(signs, hashed)]
        self.width = len(self.entries[0]).bit_length() - 1 - shard_bits
        self.weights = np.full((8 * (MOST_ORDER + 2), ORDERS), 0.3) if weights is None else weights
        self.refine = refine

    def contexts(self, key: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        found = contexts(key)
        low = [c.astype(np.int64) << 8 for c in found[:DENSE]]
        return [*low, *found[DENSE:]], shard_of(key, self.shard_bits) << self.width

    def inputs(self, seen: tuple, place: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Predictions by order, and the gate: longest known context and bit place."""
        context, base = seen
        found = np.empty((ORDERS, len(node)), np.int8)
        longest, of_node = np.zeros(len(node), np.int8), _OF_NODE.take(node)
        for k in range(ORDERS):
            if k < DENSE:
                said = self.dense[k].take(context[k] | node)
                known = said != -128
            else:
                slot, sign = _parted(context[k] + of_node, self.width)
                slot |= base
                entry = self.entries[k - DENSE].take(slot)
                parts = entry.view(np.uint8)
                said = parts[0::2].view(np.int8)
                known = (parts[1::2] == sign) & (said != -128)
            np.multiply(said, known, out=found[k])
            if k <= MOST_ORDER:
                longest += known
        return found.astype(np.float32) * np.float32(1 / 16), longest.astype(np.int64) * 8 + place

    def mix(self, inputs: np.ndarray, gate: np.ndarray) -> np.ndarray:
        total = np.zeros(len(gate), np.float32)
        for k in range(ORDERS):
            total += inputs[k] * self.weights[:, k].astype(np.float32).take(gate)
        return np.clip(total, -15, 15)

    def learn(self, key: np.ndarray, n: np.ndarray) -> None:
        """Online: predicts some bits, then moves the weights of their gates."""
        for at in [*range(0, len(key), LEARN_AT_ONCE)] * PASSES:
            some, count = key[at : at + LEARN_AT_ONCE], n[at : at + LEARN_AT_ONCE].astype(float)
            context = self.contexts(some)
            for place, node, bit in _bits(some):
                inputs, gate = self.inputs(context, place, node)
                miss = (bit - 1 / (1 + np.exp(-self.mix(inputs, gate)))) * count
                total = np.maximum(np.bincount(gate, count, len(self.weights)), 1)
                for o in range(ORDERS):
                    self.weights[:, o] += LEARNING_RATE * np.bincount(gate, miss * inputs[o], len(self.weights)) / total

    def steps(self, mixed: np.ndarray, node: np.ndarray) -> np.ndarray:
        return node * REFINE_STEPS + np.rint(mixed + REFINE_STEPS // 2).clip(0, REFINE_STEPS - 1).astype(np.int64)

    def outcomes(self, key: np.ndarray, n: np.ndarray) -> np.ndarray:
        """How often bits were zero and one, by node and by what the mixer said."""
        counts = np.zeros(2 * 256 * REFINE_STEPS)
        for at in range(0, len(key), 1 << 15):
            some, count = key[at : at + (1 << 15)], n[at : at + (1 << 15)]
            context = self.contexts(some)
            for place, node, bit in _bits(some):
                step = self.steps(self.mix(*self.inputs(context, place, node)), node)
                counts += np.bincount(2 * step + bit, count, len(counts))
        return counts

    def log2_cost(self, key: np.ndarray) -> np.ndarray:
        """Bits that each byte costs, the refinement averaged with what it refines."""
        # Runs that end alike look at the same slots: one after the other, these stay in the cache.
        order = np.argsort(nearest_first(key))
        key, cost = key[order], np.zeros(len(key))
        for at in range(0, len(key), 1 << 15):
            some = key[at : at + (1 << 15)]
            context, base = self.contexts(some)
            for place, node, bit in _bits(some):
                # Neighbours that differ only in bits to come get the same prediction.
                differ = np.diff(some >> np.uint64(8 - place)) != 0
                fewer = np.count_nonzero(differ) < FEWER * len(some)
                seen, nodes = (context, base), node
                if fewer:
                    first = np.concatenate([[0], np.flatnonzero(differ) + 1])
                    seen, nodes = ([c.take(first) for c in context], base.take(first)), node.take(first)
                mixed = self.mix(*self.inputs(seen, place, nodes))
                one = (1 / (1 + np.exp(-mixed)) + self.refine[self.steps(mixed, nodes)]) / 2
                if fewer:
                    one = np.repeat(one, np.diff(first, append=len(some)))
                cost[at : at + (1 << 15)] -= np.log2(np.where(bit == 1, one, 1 - one))
        cost[order] = cost.copy()
        return cost


class Costs:
    """Costs of byte runs, kept from chunk to chunk while they are at most ``HELD_GRAMS``.

    Before them a table with a place by hash for one run each, the last one that wanted it:
    most bytes of a chunk are found there, and only the others are sorted.
    """

    def __init__(self, model: Model) -> None:
        self.model, self.keys, self.costs = model, np.zeros(0, np.uint64), np.zeros(0)
        self.near_keys, self.near_costs = np.zeros(1 << NEAR_BITS, np.uint64), np.zeros(1 << NEAR_BITS)
        # Empty places hold a run that belongs elsewhere: 0 has the first place, 1 another.
        self.near_keys[0] = 1

    def each(self, runs: np.ndarray) -> np.ndarray:
        """Bits that each of some runs costs, in their order."""
        place = _near(runs)
        cost = self.near_costs.take(place)
        far = np.flatnonzero(self.near_keys.take(place) != runs)
        if len(far):
            rest = runs[far]
            found = _distinct(rest)
            costs, slots = self.of(found), _near(found)
            self.near_keys[slots], self.near_costs[slots] = found, costs
            place = place[far]
            cost[far] = self.near_costs.take(place)
            # Of runs that want the same place one has it.
            crowded = np.flatnonzero(self.near_keys.take(place) != rest)
            cost[far[crowded]] = costs[np.searchsorted(found, rest[crowded])]
        return cost

    def of(self, found: np.ndarray) -> np.ndarray:
        """Bits that each of some sorted distinct runs costs."""
        near = np.searchsorted(self.keys, found)
        held = np.zeros(len(found), bool)
        inside = near < len(self.keys)
        held[inside] = self.keys[near[inside]] == found[inside]
        cost = np.empty(len(found))
        cost[held], new = self.costs[near[held]], found[~held]
        cost[~held] = self.model.log2_cost(new)
        if len(self.keys) + len(new) > HELD_GRAMS:
            self.keys, self.costs = found, cost
        else:
            self.keys = np.insert(self.keys, near[~held], new)
            self.costs = np.insert(self.costs, near[~held], cost[~held])
        return cost


def _near(key: np.ndarray) -> np.ndarray:
    return ((key * np.uint64(_FACTOR)) >> np.uint64(64 - NEAR_BITS)).view(np.int64)


def refinement(counts: np.ndarray) -> np.ndarray:
    """Chance of a one by node and step; what the mixer says counts as two outcomes."""
    zeros, ones = counts[0::2], counts[1::2]
    said = 1 / (1 + np.exp(-(np.arange(REFINE_STEPS) - REFINE_STEPS // 2).astype(float)))
    said = np.tile(np.clip(said, 1e-5, 1 - 1e-5), 256)
    return (ones + 2 * said) / (zeros + ones + 2)


def _packed(table: np.ndarray) -> bytes:
    return pa.compress(table.tobytes(), "zstd", asbytes=True)


def _unpacked(blob: bytes, kind, slots: int) -> np.ndarray:
    """Rows of ``slots`` one-byte entries."""
    return np.frombuffer(pa.decompress(blob, HASHED * slots, "zstd"), kind).reshape(HASHED, slots)


def _dense_blobs(tables: list[np.ndarray]) -> list[bytes]:
    return [_packed(t) for t in tables]


def _dense_tables(blobs: list[bytes]) -> list[np.ndarray]:
    return [
        np.frombuffer(pa.decompress(blob, 1 << (8 * k + 8), "zstd"), np.int8) for k, blob in enumerate(blobs)
    ]


def _shard_model(dense, width: int):
    """A shard's segment of the tables, its weights, and the outcomes under them."""

    def build(rows: pa.Table) -> pa.Table:
        key = rows["key"].to_numpy().view(np.uint64)
        n, tuned = rows["n"].to_numpy(), rows["tuned"].to_numpy()
        signs, first, whole = segment(key, n, tuned, width)
        model = Model(_dense_tables(dense.value), signs, first, 0)
        some = np.flatnonzero(tuned)
        # An order without pattern, the same each time.
        some = some[np.argsort(tokens.mixed(key[some]))]
        model.learn(key[some], tuned[some])
        learned = model.weights.tobytes(), model.outcomes(key[some], tuned[some]).tobytes()
        blobs = (*learned, _packed(signs), _packed(whole))
        return pa.table(
            [rows["shard"][:1], pa.array([int(tuned.sum())]), *(pa.array([b], pa.binary()) for b in blobs)],
            ["shard", "n", "weights", "outcomes", "signs", "whole"],
        )

    return build


def train(docs: DataFrame, tune: Column) -> tuple:
    """The arguments of ``Model`` for the texts of ``docs`` (``text``); the mixer learns from the rows where ``tune``.

    The tables have about ``SLOTS_A_RUN`` slots for each distinct run, up to
    ``2^MOST_SLOT_BITS`` an order; beyond that the most frequent contexts hold them.  The
    driver gets the tables (at most 101 MB), counts of runs of three bytes, and weights and
    outcomes of each shard.  Weights are averaged over shards in a fixed order.
    """
    spark = docs.sparkSession
    counted = cut_lineage(
        docs.select("text", tune.alias("tune"))
        .mapInArrow(_counted(_chunk_grams), "tune boolean, key long, n long")
        .groupBy("key")
        .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("tune"), F.col("n")).otherwise(0)).alias("tuned"))
    )
    slot_bits, shard_bits = sizes(counted.count())
    width = max(slot_bits - shard_bits, 4)
    low = (
        counted.groupBy(F.col("key").bitwiseAND((1 << (8 * DENSE)) - 1).alias("gram"))
        .agg(F.sum("n").alias("n"), F.sum("tuned").alias("tuned"))
        .toArrow()
    )
    gram, n, tuned = (low[c].to_numpy().astype(np.int64) for c in ("gram", "n", "tuned"))
    sent = spark.sparkContext.broadcast(_dense_blobs(dense_tables(gram, n - tuned)))
    built = cut_lineage(
        counted.withColumn("shard", shard_column(F.col("key"), shard_bits))
        .groupBy("shard")
        .applyInArrow(
            _shard_model(sent, width),
            "shard int, n long, weights binary, outcomes binary, signs binary, whole binary",
        )
    )
    signs = np.zeros((HASHED, 1 << (width + shard_bits)), np.uint8)
    hashed = np.full((HASHED, 1 << (width + shard_bits)), -128, np.int8)
    learned = {}
    for row in built.toLocalIterator():
        at = slice(row["shard"] << width, (row["shard"] + 1) << width)
        signs[:, at] = _unpacked(row["signs"], np.uint8, 1 << width)
        hashed[:, at] = _unpacked(row["whole"], np.int8, 1 << width)
        if row["n"]:
            learned[row["shard"]] = row["n"], np.frombuffer(row["weights"]), np.frombuffer(row["outcomes"])
    sent.unpersist()
    outcomes, weights = np.zeros(2 * 256 * REFINE_STEPS), None
    if learned:
        in_order = [learned[shard] for shard in sorted(learned)]
        weights = sum(n * w for n, w, _ in in_order) / sum(n for n, _, _ in in_order)
        weights = weights.reshape(-1, ORDERS)
        outcomes = sum(o for _, _, o in in_order)
    return dense_tables(gram, n), signs, hashed, shard_bits, weights, refinement(outcomes)


def _scored(model, hot):
    names = ["doc_id", "text_key", "held_out", "n_tokens", "n_known", "log_counts", "n_bytes", "score", "rare"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, seen = tokens.Powers(), set()
        dense, signs, hashed, slots, *rest = model.value
        # One order at a time, so that no second copy of the tables is held.
        scorer = Model(
            _dense_tables(dense),
            (np.frombuffer(pa.decompress(blob, slots, "zstd"), np.uint8) for blob in signs),
            (np.frombuffer(pa.decompress(blob, slots, "zstd"), np.int8) for blob in hashed),
            *rest,
        )
        known, (hot_words, hot_counts) = Costs(scorer), hot.value
        for batch in batches:
            for at, to, data, offsets in tokens.chunks(batch["text"], CHUNK):
                text, begin = plain(data, offsets)
                cost = np.concatenate([[0], np.cumsum(known.each(grams(text, begin)))])
                words, rows = tokens.word_hashes(data, offsets, powers)
                near = np.minimum(np.searchsorted(hot_words, words), max(len(hot_words) - 1, 0))
                is_hot = hot_words[near] == words if len(hot_words) else np.zeros(len(words), bool)
                logs = np.where(is_hot, np.log10(hot_counts[near] + 1.0) if len(hot_words) else 0.0, 0.0)
                sums = [np.concatenate([[0], np.cumsum(v)])[rows] for v in (logs, is_hot)]
                keys, rare = batch["text_key"].to_numpy()[at:to], []
                for k in range(to - at):
                    some = words[rows[k] : rows[k + 1]][~is_hot[rows[k] : rows[k + 1]]]
                    # Of equal texts one a partition asks for its rare words.
                    rare.append([] if keys[k] in seen else some.view(np.int64).tolist())
                    seen.add(keys[k])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"][at:to],
                        batch["text_key"][at:to],
                        batch["held_out"][at:to],
                        pa.array(np.diff(rows) + 1),
                        pa.array(np.diff(sums[1]).astype(np.int64)),
                        pa.array(np.diff(sums[0])),
                        pa.array(np.diff(begin)),
                        pa.array(-(cost[begin[1:]] - cost[begin[:-1]]) * np.log10(2)),
                        pa.array(rare, pa.list_(pa.int64())),
                    ],
                    names,
                )

    return run


def score(docs: DataFrame, held_out: Column, tune: Column) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes,
    bits_per_byte``.

    Per row of ``docs`` (``doc_id``, ``text``; others ignored).  Learns from rows that are
    not ``held_out``; null text is empty.  ``base_score`` is that of a unigram model with
    add-one counts.  Words are known by 64-bit hashes.  ``n_bytes`` counts the
    bytes scored: those of the words, and one after each word and at the end.  Without training rows every bit
    has the chance that untrained tables give.  Trains when called.
    """
    spark = docs.sparkSession
    keyed = docs.select(
        "doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), held_out.alias("held_out"), tune.alias("tune")
    )
    training = keyed.where(~F.col("held_out"))
    counts = cut_lineage(
        training.select("text", "tune")
        .mapInArrow(_counted(_chunk_words), "tune boolean, key long, n long")
        .groupBy("key")
        .agg(F.sum("n").alias("n"))
    )
    size = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("words"), F.count("*").alias("kinds")).first()
    ends = training.count()
    n_all, kinds = size["words"] + ends, size["kinds"] + (ends > 0)
    top = counts.orderBy(F.desc("n"), "key").limit(HOT_WORDS).toPandas()
    hot_words = top["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hot_words)
    hot = spark.sparkContext.broadcast((hot_words[order], top["n"].to_numpy(np.int64)[order]))
    dense, signs, hashed, *rest = train(training, F.col("tune"))
    sent = spark.sparkContext.broadcast(
        (_dense_blobs(dense), [*map(_packed, signs)], [*map(_packed, hashed)], hashed.shape[1], *rest)
    )
    id_type = docs.schema["doc_id"].dataType.simpleString()
    scored = cut_lineage(
        keyed.mapInArrow(
            _scored(sent, hot),
            f"doc_id {id_type}, text_key long, held_out boolean, n_tokens long, n_known long, "
            "log_counts double, n_bytes long, score double, rare array<long>",
        )
    )
    rare = (
        scored.select("text_key", F.explode("rare").alias("key"))
        .groupBy("text_key", "key")
        .agg(F.count("*").alias("times"))
    )
    # Texts that stand in several partitions asked several times, each time alike.
    asked = scored.where(F.size("rare") > 0).groupBy("text_key").agg(F.count("*").alias("asked"))
    found = (
        rare.join(counts, "key")
        .groupBy("text_key")
        .agg(F.sum("times").alias("known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("logs"))
        .join(asked, "text_key")
        .select("text_key", (F.col("known") / F.col("asked")).cast("long").alias("known"), (F.col("logs") / F.col("asked")).alias("logs"))
    )
    end_log = float(np.log10(ends + 1.0))
    return scored.join(found, "text_key", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0)) + int(ends > 0)).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (
            F.col("log_counts") + F.coalesce("logs", F.lit(0.0)) + end_log
            - F.col("n_tokens") * float(np.log10(n_all + kinds + 1.0))
        ).alias("base_score"),
        "score",
        "n_bytes",
        (-F.col("score") * float(np.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"),
    )
