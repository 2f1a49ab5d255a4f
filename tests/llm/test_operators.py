"""Operators against brute force, on tables with nulls, ties, repeats and clashing columns."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import blockknn, chat, decontaminate, jaccard, langid, licenses, mixing, mixlm, ordinal, suffix, tokens
from tests.llm.odd import documents, prose, rows


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, width):
    w = words(text)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)}


# 1: mixing


def test_knapsack_is_the_best_sum():
    pick = random.Random(0)
    for _ in range(60):
        sizes = np.array(sorted(pick.sample(range(1, 40), 4)))
        counts = np.array([pick.randint(0, 3) for _ in sizes])
        budget = pick.randint(0, 120)
        sums = {sum(c * s for c, s in zip(some, sizes)) for some in itertools.product(*(range(c + 1) for c in counts))}
        taken = mixing.knapsack(sizes, counts, budget)
        assert (taken <= counts).all() and (taken >= 0).all()
        reachable = {s for s in sums if s <= 2 * budget}
        assert abs(int((taken * sizes).sum()) - budget) == min(abs(s - budget) for s in reachable)


def test_mix(spark):
    docs = documents(spark)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows())
    size, taken = Counter(), Counter()
    for row, (_, text, _, source, *_) in zip(
        sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0)),
        sorted(rows(), key=lambda r: (r[0] is None, r[0] or 0)),
    ):
        assert row["size"] == len(words(text)) and row.taken <= 3 * row["size"]
    for row in got:
        size[row.source] += row["size"]
        taken[row.source] += row.taken
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    target, open_, rest = {}, set(order), float(sum(size.values()))
    while True:
        level = rest / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > 3 * size[s]}
        if not over:
            break
        for s in over:
            target[s] = 3.0 * size[s]
            rest -= target[s]
        open_ -= over
    target |= {s: weight[s] * level for s in open_}
    for row in got:
        assert math.isclose(row.target, target[row.source])
        assert row.source_size == size[row.source]
    for source in order:  # as near as whole documents allow
        passes = int(target[source] // size[source])
        budget, sums = target[source] - passes * size[source], {0}
        for row in got:
            if row.source == source:
                sums |= {s + row["size"] for s in sums}
        nearest = min(abs(s - budget) for s in sums)
        assert abs(taken[source] - target[source]) <= nearest + 1
    again = {tuple(r) for r in mixing.mix(docs.repartition(5)).collect()}
    assert again == {tuple(r) for r in got}
    assert mixing.mix(documents(spark, [])).count() == 0


# 2: decontamination


def test_contained_items(spark):
    items = [(1, prose(2, 70)), (2, prose(77, 20)), (3, "one"), (4, None), (5, ""), (6, "x y"), (None, prose(5, 9000)[500:900])]
    pick = prose(77, 20).split()
    pick[3] = "zzz"  # 5 of 16 shingles lost: too many
    extra = [(900, prose(6, 5000) + " " + prose(77, 20) + " " + prose(7, 50))] + [(901, " ".join(pick)), (902, "X  Y")]
    docs = documents(spark, rows() + [(*e, None, None, 0, 0, 0, 0, 0, 0.0) for e in extra])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.n_shared) for r in decontaminate.contained_items(docs, benchmark).collect()}
    expected = set()
    for doc_id, text in [(r[0], r[1]) for r in rows()] + extra:
        for item_id, item in items:
            mine, its = shingles((text or "").lower(), 5), shingles((item or "").lower(), 5)
            if its and 10 * len(mine & its) >= 8 * len(its):
                expected.add((doc_id, item_id, len(mine & its)))
    assert got == expected and {1, 2, 3, 6} <= {i for _, i, _ in got}
    kept = decontaminate.decontaminate(docs, benchmark)
    assert kept.columns == docs.columns
    bad = {d for d, _, _ in expected}
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(
        d for d in [r[0] for r in rows()] + [e[0] for e in extra] if d is not None and d not in bad
    )
    assert decontaminate.decontaminate(docs, benchmark.limit(0)).count() == docs.count()
    assert decontaminate.contained_items(documents(spark, []), benchmark).count() == 0


# 3: language model


def test_chances_of_all_continuations_add_up_to_one():
    pick = random.Random(1)
    key = np.array([pick.getrandbits(48) << 8 for _ in range(5)], np.uint64)
    draw = np.random.default_rng(0)
    dense = [draw.integers(-128, 127, 1 << (8 * k + 8), np.int8) for k in range(mixlm.DENSE)]
    signs = draw.integers(0, 4, (mixlm.HASHED, 1 << 10), np.uint8)
    hashed = draw.integers(-128, 127, (mixlm.HASHED, 1 << 10), np.int8)
    model = mixlm.Model(dense, signs, hashed, 2, refine=mixlm.refinement(np.zeros(2 * 256 * mixlm.REFINE_STEPS)))
    every = np.concatenate([k | np.arange(256, dtype=np.uint64) for k in key])
    assert np.allclose((2.0 ** -model.log2_cost(every)).reshape(5, 256).sum(axis=1), 1)


def test_scores(spark):
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    got = mixlm.score(documents(spark), held, F.coalesce(F.col("doc_id") % 5 == 1, F.lit(False))).collect()
    out = {r[0]: r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in rows()}
    seen = Counter()
    for doc_id, text, *_ in rows():
        if not out[doc_id]:
            seen.update(words(text))
            seen["end"] += 1
    n, kinds = sum(seen.values()), len(seen)
    text_of = {r[0]: r[1] for r in rows()}
    assert len(got) == len(rows())
    for row in got:
        said = words(text_of[row.doc_id]) + ["end"]
        assert (row.held_out, row.n_tokens, row.train_tokens) == (out[row.doc_id], len(said), n)
        assert row.n_known == sum(seen[w] > 0 for w in said)
        assert math.isclose(row.base_score, sum(math.log10((seen[w] + 1) / (n + kinds + 1)) for w in said))
        assert row.score < 0
    assert mixlm.score(documents(spark, []), held, F.lit(False)).count() == 0


# 4: similarity join


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_components(spark, width, percent):
    near = []
    for k in range(40):  # a chain of near copies: neighbours link, the ends do not
        w = prose(50, 200).split()
        w[: 3 * k] = [f"new{m}" for m in range(3 * k)]
        near.append((1000 + k, " ".join(w), None, None, 0, 0, 0, 0, 0, 0.0))
    near += [(2000 + k, prose(60, 30) + f" end{k}", None, None, 0, 0, 0, 0, 0, 0.0) for k in range(60)]
    listed = rows() + near
    docs = documents(spark, listed)
    got = jaccard.similar_documents(docs, width, percent).collect()
    sets = [(r[0], shingles(r[1], width)) for r in listed]
    label = list(range(len(sets)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a, b in itertools.combinations(range(len(sets)), 2):
        x, y = sets[a][1], sets[b][1]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            label[root(b)] = root(a)
    lowest: dict[int, int] = {}
    for k, (doc_id, _) in enumerate(sets):
        if doc_id is not None:
            lowest[root(k)] = min(lowest.get(root(k), doc_id), doc_id)
    expected = Counter((d, len(s), lowest.get(root(k)) if s else d) for k, (d, s) in enumerate(sets))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == expected
    kept = jaccard.one_of_each(docs, width, percent)
    assert kept.columns == docs.columns
    groups = {root(k) for k, (_, s) in enumerate(sets) if s}
    assert kept.count() == len(groups) + sum(not s for _, s in sets)
    assert jaccard.similar_documents(documents(spark, []), width, percent).count() == 0


# 5: languages


def test_languages(spark):
    en = [("the cat and the hat " + prose(k, 10), "en") for k in range(40)]
    de = [("der hund und die katze ist groß " * 2 + str(k), "de") for k in range(40)]
    docs = spark.createDataFrame(
        [(k, t, l) for k, (t, l) in enumerate(en + de)] + [(90, None, "en"), (91, "", None)], "doc_id long, text string, lang string"
    )
    model = langid.train(docs)
    assert model[0] == ["de", "en"]
    asked = spark.createDataFrame(
        [(1, "the cat"), (2, "der hund und die katze"), (3, None), (4, "123 ..."), (5, ""), (None, "die katze ist"),
         (6, "the cat and the hat and the cat " * 10 + "der hund und die katze ist groß " * 10)],
        "doc_id long, text string",
    )
    got = {r.doc_id: r for r in langid.identify(asked, *model).collect()}
    assert [got[k].lang_pred for k in (1, 2, 3, 4, 5, None)] == ["en", "de", "und", "und", "und", "de"]
    assert all(0 <= r.score <= 1 for r in got.values()) and got[3].score == 0
    assert set(got[6].languages) == {"de", "en"} and 0.3 < got[6].languages["de"] < 0.7
    assert langid.identify(asked, *langid.train(docs.limit(0))).where("lang_pred <> 'und'").count() == 0


# 6: nearest neighbours


def test_neighbours(spark):
    random_ = np.random.default_rng(3)
    listed = [(int(k), [float(x) for x in random_.normal(size=8).astype(np.float32)], 0) for k in range(400)]
    listed += [(400, listed[7][1], 0), (500, None, 0), (600, [0.0] * 8, 0), (700, [1.0, None] + [0.0] * 6, 0)]
    listed += [(800, [float("nan")] + [1.0] * 7, 0), (900, [float("inf")] + [1.0] * 7, 0), (1000, [1.0, 2.0], 0), (1001, [1.5, 2.0], 0)]
    listed += [(None, [1.0] * 8, 0), listed[3], listed[100]]
    vectors = spark.createDataFrame(listed, "vec_id long, embedding array<float>, rank int")
    got = [tuple(r) for r in blockknn.nearest(vectors, F.col("vec_id") % 100 == 0, 10, query_bytes=64, row_bytes=4096).collect()]
    good = {}
    for k, v, _ in listed:
        if k is not None and v is not None and None not in v and all(map(math.isfinite, v)) and any(v):
            good[k] = np.array(v, np.float32).astype(float)
    expected = []
    for q in (k for k in good if k % 100 == 0):
        near = sorted((math.sqrt(((good[q] - v) ** 2).sum()), k) for k, v in good.items() if k != q and len(v) == len(good[q]))
        expected += [(q, r + 1, k, d) for r, (d, k) in enumerate(near[:10])]
    assert [x[:3] for x in sorted(got)] == [x[:3] for x in sorted(expected)]
    assert np.allclose([x[3] for x in sorted(got)], [x[3] for x in sorted(expected)])
    assert blockknn.nearest(vectors.limit(0), F.col("vec_id") % 100 == 0).count() == 0


# 7: quality


def test_grades(spark):
    listed, labels = [], []
    for k in range(300):
        kind = k % 3
        text = prose(k, 40) + (" scum idiot" if kind == 0 else "")
        listed.append((k, " ".join(w + "!!" for w in text.upper().split()) if kind == 1 else text))
        labels.append((k, int(kind != 1), int(kind == 0)))
    labels += [(None, 1, 0), (1, None, None), (5000, 1, 0)]
    wide = [(*r, None, None, 0, 0, 0, 0, 0, 0.0) for r in listed + [(7000, None), (7001, ""), (7002, prose(9, 20_000))]]
    docs = documents(spark, wide)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in ordinal.rate(docs, marks).collect()}
    assert len(got) == len(wide) and all(0 <= r._tail_ <= 1 and 0 <= r._expected <= 2 for r in got.values())
    right = sum((got[k]._tail_ >= 0.5) == (k % 3 == 2) for k in range(300))
    assert right >= 295
    assert np.mean([got[k]._expected for k in range(0, 300, 3)]) < np.mean([got[k]._expected for k in range(1, 300, 3)])
    assert ordinal.keep_good(docs, marks).columns == docs.columns
    assert ordinal.rate(docs.limit(0), marks).count() == 0
    assert {r._tail_ for r in ordinal.rate(docs, marks.limit(0)).collect()} == {0.5}


# 8: licenses


def test_licenses(spark):
    said = [
        (1, "CC-BY and cc  by, Cc\nBY"),
        (2, "see the GNU General Public License; all rights reserved"),
        (3, "all rights are reserved"),
        (4, None),
        (5, ""),
        (6, "licensed under the Apache License, Version 2.0"),
        (7, "released, under the well known mit license"),
        (8, "released under the mit license " + prose(1, 5000) + " all rights reserved"),
        (9, "cc"),
        (9, "cc"),
        (None, "cc by"),
        (10, "cc bYK"),
    ]
    docs = spark.createDataFrame([(*r, 0, "x") for r in said], "doc_id long, text string, place int, label string")
    got = licenses.scan_licenses(docs, licenses.templates(spark)).collect()
    assert Counter(r.doc_id for r in got) == Counter(d for d, _ in said)
    by_id = {r.doc_id: r for r in got}
    for doc_id, text in said:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        found = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if w]
        spots = sorted(
            (k, label)
            for label, phrase in licenses.BASE_PHRASES.items()
            for k in range(len(found))
            if found[k : k + len(phrase.split())] == phrase.split()
        )
        row = by_id[doc_id]
        assert row.n_words == len(found)
        assert sorted((s.first_word, s.label) for s in row.spans if s.base) == spots
    assert {s.label for s in by_id[6].spans} == {"apache-2.0"}
    assert {s.label for s in by_id[8].spans} == {"mit", "reserved"}
    assert licenses.scan_licenses(docs.limit(0), licenses.templates(spark)).count() == 0


# 9: chat


def test_layouts_and_round_trip(spark):
    nasty = r"a\b \l <|end|> [INST] </s> \e" + "\n<|turn|>"
    records = [
        ('{"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "ho"}]}', "messages", [("user", "hi"), ("assistant", "ho")]),
        ('{"prompt": "p", "completion": "c"}', "prompt", [("user", "p"), ("assistant", "c")]),
        ('{"instruction": "i", "output": "o", "system": "s"}', "instruction with system", [("system", "s"), ("user", "i"), ("assistant", "o")]),
        ('{"instruction": "i", "output": null}', "instruction", [("user", "i"), ("assistant", "")]),
        ('{"conversations": [{"from": "user", "value": "x"}]}', "conversations", [("user", "x")]),
        ('{"other": 1}', None, None),
        ("not json", None, None),
        (None, None, None),
    ]
    frame = spark.createDataFrame([(k, r[0]) for k, r in enumerate(records)], "k int, record string")
    for row in chat.canonical_turns(frame).collect():
        _, layout, turns = records[row.k]
        assert row.layout == layout
        assert (row.turns and [tuple(t) for t in row.turns]) == turns
    turns = [[("user", nasty), ("assistant", "")], [("<|says|>", "\\"), ("assistant", "a" + nasty)], []]
    back = spark.createDataFrame([(t,) for t in turns], "turns array<struct<role: string, text: string>>").select(
        chat.formatted(F.col("turns")).alias("f"), "turns"
    )
    for row in back.select("f", "turns", chat.read_back(F.col("f")).alias("back"), chat.loss_text(F.col("turns")).alias("loss")).collect():
        assert row.turns == row.back
        assert row.f.count("<|end|>") == len(row.turns) and "[INST]" not in row.f
        assert row.loss == "".join(t.text for t in row.turns if t.role == "assistant")


def test_conversations_with_nulls(spark):
    rows_ = [(1, 0, None, None), (1, None, "user", "x"), (1, 0, None, None), (None, 1, "user", "n"), (2, 1, "assistant", "b"), (2, 0, "user", "a")]
    frame = spark.createDataFrame(rows_, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in chat.canonical_turns(chat.conversation_records(frame)).collect()}
    assert got == {1: [("user", "x"), ("", ""), ("", "")], None: [("user", "n")], 2: [("user", "a"), ("assistant", "b")]}


def test_conversations_beyond_the_limits_of_parser_and_variant(spark):
    frame = spark.sql(
        "select 1L conv_id, id turn, if(id = 0, 'user', 'assistant') role, repeat('x', 20200000) text from range(2) "
        "union all select 2L, id, if(id % 2 = 0, 'user', 'assistant'), repeat('<[y', 300000) from range(160)"
    )
    turns = chat.canonical_turns(chat.conversation_records(frame)).withColumn("n", F.size("turns"))
    got = {
        r.conv_id: (r.layout, r.n, r.loss)
        for r in turns.select("conv_id", "layout", "n", F.length(chat.loss_text(F.col("turns"))).alias("loss")).collect()
    }
    assert got == {1: ("prompt", 2, 20_200_000), 2: ("messages", 160, 80 * 900_000)}


def test_records_that_are_broken_or_look_like_others(spark):
    records = {
        r'{"prompt": "a \q", "completion": "b"}': None,
        '{"prompt": "a': None,
        '{"messages": [{"role": "user", "content": ["x"]}]}': None,
        '{"messages": ["x"]}': None,
        '{"messages": [{"role": "user"}, {"role": "user"}, {"content": "x"}]}': "messages",
        '{"prompt": "a", "completion": "b", "more": "c"}': None,
        r'{"prompt": "{\"messages\": [{}]}, \\\\", "completion": "\": "}': "prompt",
    }
    frame = spark.createDataFrame([(r,) for r in records], "record string").withColumn("said", F.col("record"))
    got = {r.said: (r.layout, r.turns is None) for r in chat.canonical_turns(frame).collect()}
    assert got == {r: (layout, layout is None) for r, layout in records.items()}


# 10: suffix arrays


def brute_removed(bodies, length):
    seen = Counter(b[k : k + length] for b in bodies for k in range(len(b) - length + 1))
    for b in bodies:
        cover = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                cover[k : k + length] = b"\1" * length
        yield cover


def test_suffix_array_repeats_and_merging():
    pick = random.Random(5)
    text = bytes(pick.choices(b"ab", k=300)) + b"abcab" * 40
    text += text[100:260]
    array = suffix.SuffixArray(np.frombuffer(text, np.uint8), 24)
    starts = np.arange(len(text) - 23)
    seen = Counter(text[k : k + 24] for k in starts)
    assert array.repeated(starts, 24).tolist() == [seen[text[k : k + 24]] > 1 for k in starts]
    other = bytes(pick.choices(b"ab", k=50)) + text[40:90]
    at = np.arange(len(other) - 23)
    mine = array.sorted_starts(starts)
    found = suffix.contained(array.data, mine, np.frombuffer(other, np.uint8), at, 24)
    assert found.tolist() == [other[k : k + 24] in seen for k in at]


@pytest.mark.parametrize("shard_bytes", [1 << 20, 600])
def test_removed_bytes(spark, monkeypatch, shard_bytes):
    monkeypatch.setattr(suffix, "SHARD_BYTES", shard_bytes)
    near = []
    for k in range(12):
        w = prose(2, 70).split()
        w[5 * k] = "changed"
        near.append((3000 + k, " ".join(w), None, None, 0, 0, 0, 0, 0, 0.0))
    listed = rows() + near
    docs = documents(spark, listed)
    bodies = [(r[1] or "").encode() for r in listed]
    expected = Counter()
    for row, body, cover in zip(listed, bodies, brute_removed(bodies, 200)):
        kept = bytes(x for x, c in zip(body, cover) if not c)
        spans = sum(1 for k in range(len(cover)) if cover[k] and not (k and cover[k - 1]))
        expected[row[0], len(body), sum(cover), spans, hashlib.sha256(kept).hexdigest()] += 1
    assert Counter(tuple(r) for r in suffix.removal_digests(docs).collect()) == expected
    cut = suffix.without_repeats(docs)
    assert cut.columns == docs.columns
    assert suffix.removal_digests(documents(spark, [])).count() == 0


# helpers


def test_word_hashes_tell_words_apart_across_chunks():
    import pyarrow as pa

    texts = [None, "", " a  B c", "a b\tC", "x", "é É", "abc"]
    column = pa.array(texts)
    one, several = [], []
    for limit, out in ((1 << 20, one), (1, several)):
        powers = tokens.Powers()
        for _, _, data, offsets in tokens.chunks(column, limit):
            hashes, begin = tokens.word_hashes(data, offsets, powers)
            out += [hashes[a:b].tolist() for a, b in zip(begin[:-1], begin[1:])]
    assert one == several
    assert one[2] == one[3] and len(set(one[5])) == 2 and one[0] == one[1] == []
