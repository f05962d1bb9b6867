import pytest
from pyspark.sql import functions as F

from civiclens.operators import aggregates
from civiclens.operators.aggregates import fold_copies, unfold_copies
from civiclens.operators.joins import (
    STRATEGIES,
    choose_strategy,
    equi_join,
    fits,
    frequent_keys,
    hot_key_join,
    strategy_matrix,
)
from plans_helper import plan_of


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.range(50).select(F.lpad(F.col("id").cast("string"), 5, "0").alias("zip"), "id")
    # A third of all rows has one key; some keys have no partner; some are NULL.
    right = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "00007")
        .when(F.col("id") % 50 == 1, None)
        .otherwise(F.lpad((F.col("id") % 60).cast("string"), 5, "0"))
        .alias("zip"),
        (F.col("id") % 100).alias("value"),
    )
    return left, right


def answer(df):
    return sorted(map(tuple, df.select("zip", "id", "value").collect()))


NODES = {
    "BROADCAST": "BroadcastHashJoin",
    "MERGE": "SortMergeJoin",
    "SHUFFLE_HASH": "ShuffledHashJoin",
    "REPLICATE_HOT_KEYS": "BroadcastHashJoin",
}


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_every_strategy_gives_the_same_rows(sides, strategy):
    left, right = sides
    joined = equi_join(left, right, ["zip"], strategy)
    assert joined.columns == ["zip", "id", "value"]
    if strategy:
        assert NODES[strategy] in plan_of(joined)
    assert answer(joined) == answer(left.join(right, "zip"))


def test_unknown_strategy(sides):
    with pytest.raises(ValueError):
        equi_join(*sides, ["zip"], "SHUFFLE_REPLICATE_NL")


def test_broadcast_needs_a_small_side(spark, sides):
    left, right = sides
    assert fits(left, 50) and not fits(left, 49)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = equi_join(left, right, ["zip"], "BROADCAST", broadcast_rows=50)
        assert "BroadcastHashJoin" in plan_of(small) and "BuildLeft" in plan_of(small)
        with pytest.raises(ValueError):
            equi_join(left, right, ["zip"], "BROADCAST", broadcast_rows=49)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("hot_share", [2, 4, 1000])
def test_hot_key_join(spark, sides, hot_share):
    left, right = sides
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = hot_key_join(right, left, ["zip"], hot_share=hot_share)
        plan = plan_of(joined)
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
        assert answer(joined) == answer(left.join(right, "zip"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hash_tables_are_built_of_the_unique_side(sides):
    assert "BuildLeft" in plan_of(equi_join(*sides, ["zip"], "SHUFFLE_HASH"))


def test_hot_rows_have_to_be_unique(sides):
    left, right = sides
    with pytest.raises(ValueError):
        hot_key_join(right, left.unionByName(left).unionByName(left), ["zip"], hot_share=4)


def test_hot_key_join_of_nothing(sides):
    left, right = sides
    assert hot_key_join(right.filter("value < 0"), left, ["zip"]).count() == 0
    assert hot_key_join(right, left.filter("id < 0"), ["zip"]).count() == 0


def test_frequent_keys_by_one_scan(spark, sides):
    left, right = sides
    found = frequent_keys(right, ["zip"], 4)
    assert [tuple(r) for r in found.collect()] == [("00007",)]
    two = right.select(F.struct("zip").alias("s"), "zip", F.lit(1).alias("one b"))
    assert [tuple(r) for r in frequent_keys(two, ["zip", "one b"], 4).collect()] == [("00007", 1)]
    assert frequent_keys(right, ["zip"], 2).count() == 0
    assert frequent_keys(right.limit(0), ["zip"], 10).count() == 0


def test_the_data_choose_the_strategy(sides):
    left, right = sides
    even = right.filter("zip <> '00007'")
    choices = {
        (name, rows): choose_strategy(left, many, ["zip"], broadcast_rows=rows, hot_share=4)[0]
        for name, many in (("hot", right), ("even", even)) for rows in (10, 100)
    }
    assert choices == {
        ("hot", 10): "REPLICATE_HOT_KEYS", ("even", 10): "MERGE", ("hot", 100): "BROADCAST", ("even", 100): "BROADCAST",
    }


def test_matrix_labels_each_strategy(sides):
    left, right = sides
    matrix = strategy_matrix(
        lambda s: equi_join(left, right, ["zip"], s).agg(F.sum("value").alias("total"))
    )
    rows = dict(map(tuple, matrix.collect()))
    assert list(rows) == ["DEFAULT", *STRATEGIES[1:]]
    assert len(set(rows.values())) == 1


def test_copies_fold_and_unfold(spark):
    rows = spark.range(60_000).select(
        F.when(F.col("id") < 45_000, 1).otherwise(F.col("id") % 7).alias("a"), F.lit("x").alias("b")
    )
    folded = fold_copies(rows)
    assert folded.count() == 7
    back = unfold_copies(folded, [F.desc("a")])
    assert back.columns == ["a", "b"]
    values = [row["a"] for row in back.collect()]
    assert values == sorted((row["a"] for row in rows.collect()), reverse=True)


def test_numbers_of_copies_are_made_in_steps(spark, monkeypatch):
    monkeypatch.setattr(aggregates, "_COPIES_PER_ROW", 3)
    folded = spark.createDataFrame([(1, 1), (2, 9), (3, 10), (4, 29)], "part INT, copies BIGINT")
    rows = [row["part"] for row in unfold_copies(folded, [F.asc("part")]).collect()]
    assert rows == [1] + [2] * 9 + [3] * 10 + [4] * 29


def test_a_sorted_group_of_copies_is_split(spark):
    folded = fold_copies(spark.range(400_000).select(F.lit(1).alias("a")))
    sorted_back = unfold_copies(folded, [F.desc("a")])
    plan = plan_of(sorted_back)
    assert plan.count("rangepartitioning") == 1 and "part#" in plan.split("rangepartitioning")[1]
    assert sorted_back.count() == 400_000
