"""Count windows, changelogs and patterns: known results, hot keys and plans."""

import itertools
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.functions import render
from millrace.operators import ordered
from millrace.operators.changelog import changelog_count
from millrace.operators.countwindow import count_windows
from millrace.operators.ordered import Running, plan_blocks, running
from millrace.operators.pattern import Stage, match_map, pattern_counts, pattern_matches
from millrace.operators.relational import truncated_mean
from tests import fixtures
from tests.fixtures import tuples

NO_SPLIT = ordered.DEFAULT_MAX_ROWS


def stages():
    return [Stage(name, F.col("name") == name) for name in ("start", "middle", "end")]



@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows belong to one key, another third to null; times tie a lot."""
    dice = random.Random(5)
    rows = []
    for seq in range(600):
        key = ("hot", None, f"k{dice.randrange(40)}")[seq % 3]
        at = datetime(2024, 1, 1) + timedelta(hours=dice.randrange(0, 90))
        name = dice.choice(["start", "middle", "end", "other"])
        rows.append((key, at, seq, name, dice.randrange(-9, 10)))
    dice.shuffle(rows)
    df = spark.createDataFrame(
        rows, "key string, ts timestamp, seq bigint, name string, value bigint"
    )
    return df, sorted(rows, key=lambda r: (r[1], r[2]))


def by_key(rows):
    keys = {row[0] for row in rows}
    return {key: [row for row in rows if row[0] == key] for key in keys}


def test_count_window_of_scores(spark):
    found = count_windows(
        fixtures.scores(spark), ["grp"], ["seq"], 2, {"mean": truncated_mean("score")}
    )
    assert tuples(found, "grp", "mean") == [("class1", 89.0), ("class2", 70.0)]


def test_changelog_of_clicks(spark):
    df = fixtures.clicks(spark, fixtures.CLICKS_B)
    found = changelog_count(df, ["user"], ["seq"], "url").orderBy("seq", "is_add")
    assert [tuple(row)[:3] for row in found.collect()] == [
        (True, "marry", 1),
        (True, "Bob", 1),
        (True, "Liz", 1),
        (False, "marry", 1),
        (True, "marry", 2),
        (False, "Bob", 1),
        (True, "Bob", 2),
        (False, "Liz", 1),
        (True, "Liz", 2),
    ]


def test_changelog_of_nulls(spark):
    df = spark.createDataFrame(
        [(1, "a", None), (2, "a", "x"), (3, "a", None), (4, "a", "y"), (5, "b", "z")],
        "seq int, user string, url string",
    )
    found = changelog_count(df, ["user"], ["seq"], "url")
    assert tuples(found, "seq", "user", "is_add", "cnt") == [
        (1, "a", True, 0),
        (2, "a", False, 0),
        (2, "a", True, 1),
        (4, "a", False, 1),
        (4, "a", True, 2),
        (5, "b", True, 1),
    ]


@pytest.mark.parametrize("max_rows", [NO_SPLIT, 50, 7, 1])
def test_running_aggregates(skewed, max_rows):
    df, rows = skewed
    blocks = plan_blocks(df, ["key"], ["ts", "seq"], max_rows)
    assert blocks.split == (max_rows != NO_SPLIT)
    marked = blocks.mark(df)
    forward = running(
        marked,
        blocks,
        {
            "total": Running("sum", F.col("value")),
            "greatest": Running("max", F.col("value"), strict=True),
        },
    )
    both = running(
        forward, blocks, {"least": Running("min", F.col("value"))}, backwards=True
    )
    found = {
        row["seq"]: (row["total"], row["greatest"], row["least"]) for row in both.collect()
    }
    expected = {}
    for group in by_key(rows).values():
        values = [row[4] for row in group]
        for i, row in enumerate(group):
            expected[row[2]] = (
                sum(values[: i + 1]),
                max(values[:i], default=None),
                min(values[i:]),
            )
    assert found == expected


@pytest.mark.parametrize("max_rows", [NO_SPLIT, 20])
def test_hot_keys_change_nothing(skewed, max_rows):
    df, rows = skewed
    windows = count_windows(
        df, ["key"], ["ts", "seq"], 7, {"total": F.sum("value")}, max_rows=max_rows
    )
    expected = []
    for key, group in by_key(rows).items():
        for index in range(len(group) // 7):
            part = group[index * 7 : index * 7 + 7]
            expected.append((key, index, sum(row[4] for row in part)))
    assert tuples(windows) == sorted(expected, key=repr)

    changes = changelog_count(df, ["key"], ["ts", "seq"], max_rows=max_rows)
    expected = []
    for key, group in by_key(rows).items():
        for n, row in enumerate(group, 1):
            expected.append((True, key, n, row[2]))
            if n > 1:
                expected.append((False, key, n - 1, row[2]))
    assert tuples(changes, "is_add", "key", "cnt", "seq") == sorted(expected, key=repr)


def test_hot_key_is_spread(skewed):
    df, _ = skewed
    blocks = plan_blocks(df, ["key"], ["ts", "seq"], 20)
    sizes = (
        blocks.mark(df).where("key = 'hot'").groupBy(ordered.BLOCK).count().collect()
    )
    assert len(sizes) > 10
    assert max(row["count"] for row in sizes) <= 20


def test_one_value_of_the_first_order_column_is_spread(spark):
    df = spark.range(1000).selectExpr(
        "1 AS key", "timestamp'1970-01-01' AS ts", "id AS seq"
    )
    blocks = plan_blocks(df, ["key"], ["ts", "seq"], 50)
    assert blocks.cut_by == ("ts", "seq")
    sizes = blocks.mark(df).groupBy(ordered.BLOCK).count().collect()
    assert max(row["count"] for row in sizes) <= 50


def test_one_frequent_value_among_many_is_spread(spark):
    df = spark.range(1000).selectExpr(
        "1 AS key", "IF(id < 90, 0, id) AS at", "id AS seq"
    )
    blocks = plan_blocks(df, ["key"], ["at", "seq"], 20)
    sizes = blocks.mark(df).groupBy(ordered.BLOCK).count().collect()
    assert max(row["count"] for row in sizes) <= 20


def test_sampled_detection_on_a_larger_table(spark):
    """A third of the rows in one key, found from a sample of one row in twelve."""
    df = spark.range(240_000).selectExpr(
        "IF(id % 3 = 0, -1, id % 1000) AS key", "(id * 7919) % 240000 AS seq"
    )
    blocks = plan_blocks(df, ["key"], ["seq"], 5_000)
    assert [row[0] for row in blocks.hot] == [-1]
    marked = blocks.mark(df)
    sizes = marked.where("key = -1").groupBy(ordered.BLOCK).count().collect()
    assert max(row["count"] for row in sizes) <= 5_000
    numbered = running(marked, blocks, {"n": Running("sum", F.lit(1))})
    wrong = numbered.join(
        changelog_count(df, ["key"], ["seq"]).where("is_add"), ["key", "seq"]
    ).where("n <> cnt")
    assert numbered.count() == 240_000
    assert wrong.isEmpty()


def test_smaller_hot_keys_get_fewer_blocks(spark):
    """One key with a third of the rows beside many keys just above the limit."""
    df = spark.range(30_000).selectExpr(
        "IF(id % 3 = 0, -1, id % 100) AS key", "(id * 7919) % 30000 AS seq"
    )
    blocks = plan_blocks(df, ["key"], ["seq"], 150)
    marked = blocks.mark(df)
    sizes = marked.groupBy("key", ordered.BLOCK).count()
    blocks_of = sizes.groupBy("key").agg(F.count("*").alias("n")).collect()
    per_key = {row["key"]: row["n"] for row in blocks_of}
    assert len(blocks.hot) == len(per_key)
    assert per_key.pop(-1) > 60
    assert max(per_key.values()) <= 5
    assert sizes.agg(F.max("count")).first()[0] <= 300
    numbered = running(marked, blocks, {"n": Running("sum", F.lit(1))})
    whole = changelog_count(df, ["key"], ["seq"]).where("is_add")
    assert numbered.join(whole, ["key", "seq"]).where("n <> cnt").isEmpty()
    assert numbered.count() == 30_000


def clustered(spark, keys=40, rows=20_000):
    """Each key's rows lie together along the order, all keys far apart."""
    return spark.range(keys * rows).selectExpr(
        f"id DIV {rows} AS key", f"(id DIV {rows}) * 10000000 + (id * 7919) % {rows} AS seq"
    )


def test_clustered_hot_keys_have_their_own_cuts(spark):
    df = clustered(spark)
    blocks = plan_blocks(df, ["key"], ["seq"], 1_000)
    assert len(blocks.hot) == 40
    marked = blocks.mark(df)
    sizes = marked.groupBy("key", ordered.BLOCK).count().collect()
    assert max(row["count"] for row in sizes) <= 1_000
    assert len(sizes) <= 40 * 50
    wrong = running(marked, blocks, {"n": Running("sum", F.lit(1))}).where(
        "n <> seq % 10000000 + 1"
    )
    assert wrong.isEmpty()


def test_clustered_keys_in_all_operators(spark):
    df = clustered(spark, 6, 500).withColumn("name", F.expr("'v'"))
    few, many = (
        tuples(changelog_count(df, ["key"], ["seq"], max_rows=limit))
        for limit in (50, NO_SPLIT)
    )
    assert few == many
    few, many = (
        tuples(count_windows(df, ["key"], ["seq"], 7, {"n": F.sum("seq")}, max_rows=limit))
        for limit in (50, NO_SPLIT)
    )
    assert few == many


def test_too_many_cuts_are_said(spark, monkeypatch):
    monkeypatch.setattr(ordered, "MAX_CUTS", 50)
    df = clustered(spark, 10, 1_000)
    with pytest.warns(UserWarning, match="more than 50 cuts"):
        blocks = plan_blocks(df, ["key"], ["seq"], 100)
    assert 20 <= len(blocks.bounds) <= 50
    sizes = blocks.mark(df).groupBy("key", ordered.BLOCK).count()
    assert sizes.agg(F.max("count")).first()[0] <= 500


def brute_force(rows, within=None):
    matches = []
    for key, group in by_key(rows).items():
        if key is None:
            continue
        for a, b, c in itertools.combinations(group, 3):
            if (a[3], b[3], c[3]) == ("start", "middle", "end"):
                if within is None or c[1] - a[1] <= within:
                    matches.append((key, a[2], b[2], c[2]))
    return sorted(matches)


@pytest.mark.parametrize("max_rows", [NO_SPLIT, 20, 3])
@pytest.mark.parametrize("within", [timedelta(hours=5), timedelta(days=1), None])
def test_matches_equal_brute_force(skewed, within, max_rows):
    df, rows = skewed
    found = pattern_matches(
        df, ["key"], ["ts", "seq"], stages(), ["seq"], within=within, max_rows=max_rows
    ).select("key", "start.seq", "middle.seq", "end.seq")
    assert sorted(tuple(row) for row in found.collect()) == brute_force(rows, within)


@pytest.mark.parametrize("max_rows", [NO_SPLIT, 20, 3])
def test_counts_equal_brute_force(skewed, max_rows):
    df, rows = skewed
    found = pattern_counts(df, ["key"], ["ts", "seq"], stages(), max_rows=max_rows)
    expected = {}
    for key, *_ in brute_force(rows):
        expected[key] = expected.get(key, 0) + 1
    assert {key: int(n) for key, n in found.collect()} == expected


@pytest.mark.parametrize(
    ("names", "count"),
    [
        (["start", "start", "middle", "end"], 2),
        (["start", "middle", "middle", "end", "end"], 4),
        (["end", "middle", "start"], 0),
        (["start", "x", "middle", "x", "end"], 1),
    ],
)
def test_combinations(spark, names, count):
    df = fixtures.events(spark, names).withColumn("key", F.lit(1))
    assert pattern_matches(df, ["key"], ["seq"], stages(), ["id"]).count() == count
    counted = pattern_counts(df, ["key"], ["seq"], stages()).collect()
    assert [int(row["matches"]) for row in counted] == ([count] if count else [])


def test_named_events(spark):
    df = fixtures.generated.rows(
        spark, fixtures.PATTERN, fixtures.NAMED_EVENT, seq="seq"
    ).withColumn("key", F.lit(1))
    found = pattern_matches(df, ["key"], ["seq"], stages(), ["id", "name"])
    text = render.match_text(
        match_map(stages()), [stage.name for stage in stages()], ["id", "name"]
    )
    assert tuples(found.select(text)) == [
        ("start=(2|start);middle=(5|middle);end=(8|end)",)
    ]


def test_one_and_two_stages(skewed):
    df, rows = skewed
    one = pattern_matches(df, ["key"], ["ts", "seq"], stages()[:1], ["seq"])
    assert one.count() == sum(row[3] == "start" and row[0] is not None for row in rows)
    two = pattern_counts(df, ["key"], ["ts", "seq"], stages()[:2])
    joined = pattern_matches(df, ["key"], ["ts", "seq"], stages()[:2], ["seq"])
    assert {k: int(n) for k, n in two.collect()} == {
        row["key"]: row["count"] for row in joined.groupBy("key").count().collect()
    }


def test_a_row_may_satisfy_several_stages_but_is_taken_once(spark):
    df = spark.createDataFrame([(1, n) for n in range(5)], "key int, seq int")
    always = [Stage(name, F.lit(True)) for name in ("a", "b", "c")]
    assert pattern_matches(df, ["key"], ["seq"], always, ["seq"]).count() == 10
    assert int(pattern_counts(df, ["key"], ["seq"], always).first()["matches"]) == 10


def test_plans_hold_no_cross_join(skewed):
    df, _ = skewed
    for max_rows in (NO_SPLIT, 20):
        for frame in (
            pattern_matches(df, ["key"], ["ts", "seq"], stages(), ["seq"], max_rows=max_rows),
            pattern_counts(df, ["key"], ["ts", "seq"], stages(), max_rows=max_rows),
            changelog_count(df, ["key"], ["ts", "seq"], max_rows=max_rows),
        ):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert "CartesianProduct" not in plan
            assert "BroadcastNestedLoopJoin" not in plan
