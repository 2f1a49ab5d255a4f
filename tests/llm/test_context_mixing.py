"""Tables, shards and learners of the language model."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from millrace.llm import mixlm, tokens
from tests.llm.odd import documents, prose


def runs(texts):
    column = pa.array(texts, pa.string())
    (_, _, data, offsets), = tokens.chunks(column, 1 << 30)
    return mixlm.grams(*mixlm.plain(data, offsets))


def test_tables_hold_the_counts_of_every_context():
    # All contexts that a plain dictionary counts, where slots are many enough.
    every = runs([prose(k, 200) for k in range(6)])
    key, n = np.unique(every, return_counts=True)
    tuned = np.where(np.arange(len(key)) % 3 == 0, n, 0)
    signs, first, whole = mixlm.segment(key, n, tuned, 22)
    for order in range(mixlm.DENSE, mixlm.MOST_ORDER + 1):
        counts, untuned = Counter(), Counter()
        for k, times, tune in zip(key.tolist(), n.tolist(), tuned.tolist()):
            context, byte = (k >> 8) & ((1 << (8 * order)) - 1), k & 255
            for place in range(8):
                at = context, (1 << place) | (byte >> (8 - place)), (byte >> (7 - place)) & 1
                counts[at] += times
                untuned[at] += times - tune
        context = mixlm.contexts(key)[order]
        right = seen = 0
        for _, node, bit in mixlm._bits(key):
            slot, sign = mixlm._slots(context, node, 22)
            plain = (key >> np.uint64(8)) & np.uint64((1 << (8 * order)) - 1)
            for i in range(0, len(key), 7):
                seen += 1
                if signs[order - mixlm.DENSE][slot[i]] != sign[i]:
                    continue
                at = int(plain[i]), int(node[i])
                for table, of in ((whole, counts), (first, untuned)):
                    zeros, ones = of[(*at, 0)], of[(*at, 1)]
                    odds = round(16 * math.log((ones + 0.3) / (zeros + 0.3))) if zeros + ones else -128
                    right += abs(table[order - mixlm.DENSE][slot[i]] - max(odds, -128)) <= 1
        assert right > 2 * 0.99 * seen


def test_short_contexts_are_exact():
    gram = np.array([0x616263, 0x616264, 0x000061], np.int64)
    tables = mixlm.dense_tables(gram, np.array([2, 1, 5]))
    assert [len(t) for t in tables] == [1 << 8, 1 << 16, 1 << 24]
    # After "ab" the letters c (twice) and d (once) differ first at their sixth bit.
    node = (1 << 5) | (0x63 >> 3)
    assert tables[2][(0x6162 << 8) | node] == round(16 * math.log(1.3 / 2.3))
    assert tables[2][(0x6163 << 8) | node] == -128


def test_costs_are_the_same_kept_or_not(monkeypatch):
    monkeypatch.setattr(mixlm, "HELD_GRAMS", 900)

    class Plain:
        def log2_cost(self, key):
            return key.astype(float) * 3

    costs, draw = mixlm.Costs(Plain()), np.random.default_rng(5)
    for size in (0, 5, 300, 300, 800, 2000, 10, 0):
        found = np.unique(draw.integers(0, 1500, size).astype(np.uint64))
        assert (costs.of(found) == found * 3.0).all()
        assert (np.diff(costs.keys.astype(np.int64)) > 0).all()
        assert (costs.costs == costs.keys * 3.0).all()


def test_a_shard_is_the_same_in_a_column_and_in_tasks(spark):
    key = np.unique(runs([prose(9, 300), "né\tx y", ""]))
    df = spark.createDataFrame([(int(k),) for k in key], "key long")
    for bits in (0, 1, 5, 12):
        got = dict(df.select("key", mixlm.shard_column(F.col("key"), bits)).collect())
        assert [got[int(k)] for k in key] == mixlm.shard_of(key, bits).tolist()
        assert max(got.values()) < 1 << bits


def test_sizes_follow_the_runs():
    slots, shards = zip(*(mixlm.sizes(n) for n in (0, 1000, 10**6, 10**7, 10**9)))
    assert list(slots) == sorted(slots) and slots[-1] == mixlm.MOST_SLOT_BITS
    assert list(shards) == sorted(shards) and shards[0] == 0 and 10**9 >> shards[-1] <= mixlm.SHARD_RUNS


def test_partitions_do_not_change_scores(spark, monkeypatch):
    monkeypatch.setattr(mixlm, "SHARD_RUNS", 500)  # several learners
    docs = documents(spark).where("doc_id is not null")
    found = []
    for parts in (2, 9):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        rows = mixlm.score(docs.repartition(parts), F.col("doc_id") % 4 == 2, F.col("doc_id") % 4 == 1).collect()
        found.append(sorted((r.doc_id, r.score, r.n_bytes, r.bits_per_byte) for r in rows))
    spark.conf.set("spark.sql.shuffle.partitions", 2)
    assert np.allclose([r[1] for r in found[0]], [r[1] for r in found[1]], rtol=1e-12)
    for doc_id, score, n_bytes, bits in found[0]:
        assert math.isclose(bits, -score * math.log2(10) / n_bytes)


def test_texts_cost_less_than_their_letters_alone_and_copies_less_than_others(spark):
    rows = [(k, prose(k % 7, 150), k % 3 == 1) for k in range(40)] + [(109, prose(99, 150), False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tune boolean")
    got = mixlm.score(docs, F.col("doc_id") % 10 == 9, F.col("tune")).collect()
    cost = {r.doc_id: r.bits_per_byte for r in got if r.held_out}
    for doc_id, bits in cost.items():
        letters = Counter(next(t for k, t, _ in rows if k == doc_id).encode())
        n = sum(letters.values())
        alone = -sum(c / n * math.log2(c / n) for c in letters.values())
        assert bits < alone
        if doc_id != 109:  # a copy of trained texts
            assert bits < cost[109] / 1.5, cost


def test_neighbours_share_a_prediction(monkeypatch):
    """Runs that differ in bits to come only are looked up once, at the same cost to the bit."""
    rng = np.random.default_rng(5)
    hashed = rng.integers(-128, 127, (mixlm.HASHED, 1 << 12)).astype(np.int8)
    signs = rng.integers(0, 256, (mixlm.HASHED, 1 << 12)).astype(np.uint8)
    dense = [rng.integers(-128, 127, 1 << (8 * k + 8)).astype(np.int8) for k in range(mixlm.DENSE)]
    model = mixlm.Model(dense, signs, hashed, 0, None, rng.uniform(0.1, 0.9, 256 * mixlm.REFINE_STEPS))
    key = np.unique(rng.integers(0, 40, 3000).astype(np.uint64) << np.uint64(8) | rng.integers(97, 123, 3000).astype(np.uint64))
    made = []
    inputs = model.inputs
    monkeypatch.setattr(model, "inputs", lambda seen, place, node: made.append(len(node)) or inputs(seen, place, node))
    cost = model.log2_cost(key)
    assert made[0] == len(np.unique(key >> np.uint64(8))) and sum(made) < 4 * len(key)
    alone = np.concatenate([model.log2_cost(key[k : k + 1]) for k in range(len(key))])
    assert np.array_equal(cost, alone)


def test_runs_hold_the_bytes_before_in_their_row_and_sort_by_the_nearest():
    draw = np.random.default_rng(5)
    begin = np.concatenate([[0], np.cumsum(draw.integers(0, 12, 40))])
    text = draw.integers(0, 256, int(begin[-1])).astype(np.uint8)
    expected = []
    for a, b in zip(begin[:-1], begin[1:]):
        row = bytes(text[a:b])
        expected += [int.from_bytes(row[max(0, k - mixlm.MOST_ORDER) : k + 1], "big") for k in range(len(row))]
    key = mixlm.grams(text, begin)
    assert key.tolist() == expected
    by_near = sorted(expected, key=lambda k: (k >> 8).to_bytes(mixlm.MOST_ORDER, "little") + bytes([k & 255]))
    assert key[np.argsort(mixlm.nearest_first(key), kind="stable")].tolist() == by_near


def test_known_runs_are_neither_sorted_nor_scored_again(monkeypatch):
    class Plain:
        def log2_cost(self, key):
            return key % np.uint64(1009) + 0.25

    costs, draw, asked = mixlm.Costs(Plain()), np.random.default_rng(7), []
    of = costs.of
    monkeypatch.setattr(costs, "of", lambda found: asked.append(len(found)) or of(found))
    key = draw.integers(0, 5000, 40_000).astype(np.uint64)  # 0: a text that begins with a null byte
    for _ in range(3):
        assert np.array_equal(costs.each(key), key % np.uint64(1009) + 0.25)
    assert asked[0] == len(np.unique(key)) and sum(asked) < 1.1 * asked[0]


def test_runs_that_want_one_place_keep_their_own_costs(monkeypatch):
    class Plain:
        def log2_cost(self, key):
            return key + 0.5

    monkeypatch.setattr(mixlm, "NEAR_BITS", 4)
    costs, draw = mixlm.Costs(Plain()), np.random.default_rng(8)
    for _ in range(5):
        key = draw.integers(0, 300, 1000).astype(np.uint64)
        assert np.array_equal(costs.each(key), key + 0.5)
    assert np.array_equal(costs.each(key[:0]), np.zeros(0))


def test_counts_of_chunks_add_up(monkeypatch):
    monkeypatch.setattr(mixlm, "HELD_GRAMS", 400)
    counter, draw, given, all_keys = mixlm.Counter(), np.random.default_rng(9), Counter(), []
    assert [len(c) for c in mixlm.Counter().merge()] == [0, 0]
    for _ in range(20):
        all_keys.append(draw.integers(0, 600, 300).astype(np.uint64))
        for keys, counts in filter(None, [counter.add(all_keys[-1])]):
            given.update(dict(zip(keys.tolist(), counts.tolist())))
    keys, counts = counter.merge()
    given.update(dict(zip(keys.tolist(), counts.tolist())))
    assert given == Counter(np.concatenate(all_keys).tolist()) and (np.diff(keys.astype(np.int64)) > 0).all()
