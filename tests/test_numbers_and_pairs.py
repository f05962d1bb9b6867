"""Row numbers, joins of keys that are hot on both sides, pairs within a distance, exact means."""

import math
import random
from collections import Counter

import pytest
from plans_helper import plan_of
from pyspark.sql import functions as F

from civiclens.operators import aggregates, joins
from civiclens.operators.aggregates import exact_mean_and_count_by
from civiclens.operators.joins import grid_join
from civiclens.operators.numbering import dense_keys
from civiclens.operators.within import pairs_within
from civiclens.plans.catalog import join_hot_both_sides


def test_numbers_are_ranks_however_rows_are_parted(spark, monkeypatch):
    monkeypatch.setattr(aggregates, "_COPIES_PER_ROW", 7)
    rng = random.Random(1)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice(["a", "b", None])) for _ in range(300)] + [(5, "hot")] * 400
    table = spark.createDataFrame(rows, "`a b` INT, s STRING")
    want = sorted(rows, key=lambda r: ((r[1] is not None, r[1] or ""), (r[0] is not None, r[0] or 0)))
    for parts in (1, 5):
        out = dense_keys(table.repartition(parts), "n", order=["s"]).collect()
        assert [tuple(r)[:2] for r in sorted(out, key=lambda r: r.n)] == want
        assert sorted(r.n for r in out) == list(range(700))
    assert dense_keys(table.limit(0)).count() == 0
    assert dense_keys(table).schema["row_key"].dataType.simpleString() == "bigint"
    with pytest.raises(ValueError, match="already"):
        dense_keys(table, "s")


def sides(spark, n, m):
    """A third of both sides on one key, NULL keys, keys on one side, repeated rows."""
    rng = random.Random(n)
    keys = lambda k: ["hot"] * (k // 3) + [rng.choice([None, *"abcdefgh", f"only {k}"]) for _ in range(k - k // 3)]
    left = [(key, i // 2) for i, key in enumerate(keys(n))]
    right = [(key, i // 3) for i, key in enumerate(keys(m))]
    return (spark.createDataFrame(left, "k STRING, x INT"), spark.createDataFrame(right, "k STRING, y INT")), left, right


def expected(left, right):
    other = Counter(right)
    found = Counter()
    for (k, x), n in Counter(left).items():
        for (k2, y), m in other.items():
            if k is not None and k == k2:
                found[k, x, y] += n * m
    return found


@pytest.mark.parametrize("share, least", [(1000, 5), (3, 1), (1000, 10_000)])
def test_keys_hot_on_both_sides(spark, share, least):
    (left, right), rows, others = sides(spark, 240, 150)
    got = Counter(map(tuple, grid_join(left, right, ["k"], hot_share=share, least_hot=least).collect()))
    assert got == expected(rows, others)
    assert grid_join(left.limit(0), right, ["k"]).count() == 0


def test_cells_of_a_hot_key_are_even(spark, monkeypatch):
    monkeypatch.setattr(joins, "unfold_copies", lambda df: df)
    (left, right), *_ = sides(spark, 9_000, 3_000)
    left = left.withColumn("x", F.col("x") + F.rand(1))  # no two rows alike
    right = right.withColumn("y", F.col("y") + F.rand(2))
    joined = grid_join(left, right, ["k"], least_hot=200)
    assert "CartesianProduct" not in plan_of(joined) and "NestedLoop" not in plan_of(joined)
    # 3,000 by 1,000 rows of the hot key in parts of 200: no task of 8 has over a few times the mean.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small inputs would be one task
    tasks = joined.filter("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in tasks) == 3_000_000
    assert max(r["count"] for r in tasks) < 3 * 3_000_000 / 8


def test_rows_that_come_often_are_folded_and_others_left(spark):
    (left, right), rows, others = sides(spark, 240, 150)
    rows, others = rows + [("hot", -1)] * 300, others + [("hot", -2)] * 90 + [(None, -3)] * 500
    left, right = spark.createDataFrame(rows, left.schema), spark.createDataFrame(others, right.schema)
    folded, any_ = joins.fold_frequent(left, 1000, 100)
    assert any_ and folded.columns == ["k", "x", "copies"]
    assert sorted(map(repr, folded.collect())) == sorted(
        [repr(r) for r in left.filter("x >= 0").withColumn("copies", F.lit(1)).collect()] + ["Row(k='hot', x=-1, copies=300)"]
    )
    same, any_ = joins.fold_frequent(left, 1000, 300)
    assert same is left and not any_
    for least in (400, 100, 50):  # rows to fold on no side, the left one, both
        got = Counter(map(tuple, grid_join(left, right, ["k"], least_hot=least).collect()))
        assert got == expected(rows, others)
    for kind in ("DOUBLE", "FLOAT"):  # NaN meets nothing, as NULL
        odd = spark.createDataFrame([(math.nan, 1), (None, 2), (-0.0, 3), (1.5, 4)], f"`a b` {kind}, x INT")
        met = grid_join(odd, odd.withColumnRenamed("x", "y"), ["a b"])
        assert sorted((r.x, r.y) for r in met.collect()) == [(3, 3), (4, 4)]


def test_points_are_shuffled_once(spark):
    """To the cells where they meet sites; not to be counted, nor to be folded, and nothing is unfolded per pair."""
    points = spark.range(500).selectExpr("id", "id % 7 AS unread", "33 + id / 5000 AS lat", "-118D AS lon")
    sites = spark.range(50).selectExpr("string(id) AS site", "33 + id / 500 AS lat", "-118D AS lon")
    found = pairs_within(points, sites, 3.0).select("id", "site")
    plan = plan_of(found)
    assert plan.count("Exchange hashpartitioning") == 2 and "HashAggregate" not in plan and "SortMergeJoin" in plan
    assert plan.index("SortMergeJoin") < plan.index("Generate")
    want = {(p, str(s)) for p in range(500) for s in range(50) if km_between((33 + p / 5000, -118), (33 + s / 500, -118)) <= 3}
    assert Counter(map(tuple, found.collect())) == Counter(want)


def test_sums_of_pairs_beyond_a_bigint_are_exact(spark, tmp_path):
    """The right rows times the left sums; both sides hot, sums beyond and within 64 bits."""
    for scale, kind in ((1, "bigint"), (10**13, "decimal(38,0)")):
        folder = str(tmp_path / kind[:3])
        spark.range(3_000).selectExpr("id AS o_orderkey", f"id % 700 * {scale} AS o_custkey").write.parquet(f"{folder}/orders.parquet")
        spark.range(900).selectExpr("IF(id % 9 = 4, NULL, id) AS s_suppkey").write.parquet(f"{folder}/supplier.parquet")
        want = {}
        key = lambda n: -1 if n % 3 == 0 else n % 50
        for o in range(3_000):
            for s in range(900):
                if s % 9 != 4 and key(o) == key(s):
                    n, total = want.get(key(o), (0, 0))
                    want[key(o)] = n + 1, total + o % 700 * scale * s
        found = join_hot_both_sides(spark, folder)
        assert dict(found.dtypes) == {"key": "bigint", "n": "bigint", "total": kind}
        assert {r.key: (r.n, int(r.total)) for r in found.collect()} == want


PLACES = [
    (0.0, 0.0), (0.0, 0.02), (10.0, 179.99), (10.0, -179.99), (10.0, 180.0), (89.99, 10.0), (89.99, -170.0), (90.0, 0.0),
    (-90.0, 5.0), (-89.98, 100.0), (45.0, 45.0), (45.0, 405.0), (45.01, 45.0), (91.0, 0.0), (None, 1.0), (math.nan, 1.0),
]


def km_between(a, b):
    (lat1, lon1), (lat2, lon2) = (tuple(map(math.radians, p)) for p in (a, b))
    chord = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(1.0, max(0.0, chord))))


@pytest.mark.parametrize("km", [0.0, 3.0, 700.0, 21_000.0])
def test_pairs_within_a_distance(spark, km):
    rng = random.Random(3)
    places = PLACES + [(rng.uniform(-90, 90), rng.uniform(-200, 200)) for _ in range(60)]
    places += [(33 + rng.random() / 10, -118 + rng.random() / 10) for _ in range(40)]
    points = [(i, lat, lon) for i, (lat, lon) in enumerate(places)] + [(0, 0.0, 0.0)]
    sites = [(f"s{i}", lat, lon) for i, (lat, lon) in enumerate(places)] + [(None, 0.0, 0.0), ("s0", 0.0, 0.0)]
    frames = (
        spark.createDataFrame([(*p, "old") for p in points], "id INT, lat DOUBLE, lon DOUBLE, site STRING"),
        spark.createDataFrame(sites, "site STRING, lat DOUBLE, lon DOUBLE"),
    )
    known = lambda p: p[1] is not None and abs(p[1]) <= 90
    want = Counter(
        (p[0], s[0]) for p in points for s in sites
        if known(p) and known(s) and s[0] and km_between(p[1:], s[1:]) <= km
    )
    found = pairs_within(*frames, km)
    assert found.columns == ["id", "lat", "lon", "site", "dist_km"]
    rows = found.collect()
    assert Counter((r.id, r.site) for r in rows) == want
    if km < 100:
        assert "NestedLoop" not in plan_of(found) and "Cartesian" not in plan_of(found)
    with pytest.raises(ValueError):
        pairs_within(*frames, -1.0)


def test_means_are_the_same_bits_in_any_parts(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), rng.choice([1e-9, 1.0, 1e9]) * rng.random()) for _ in range(5000)] + [("c", None), (None, 0.1)]
    table = spark.createDataFrame(rows, "k STRING, v DOUBLE")
    answers = set()
    for parts in (1, 8, 64):
        out = exact_mean_and_count_by(table.repartition(parts), ["k"], "v", digits=12, mean="m", count="n")
        answers.add(tuple(sorted((tuple(r) for r in out.collect()), key=repr)))
    assert len(answers) == 1
    for key, mean, n in answers.pop():
        values = [v for k, v in rows if k == key and v is not None]
        assert n == sum(k == key for k, _ in rows)
        assert mean == (pytest.approx(math.fsum(values) / len(values), abs=1e-9) if values else None)
    with pytest.raises(Exception, match="[Oo]verflow|NUMERIC|CAST"):
        exact_mean_and_count_by(spark.createDataFrame([("a", 1e25)], "k STRING, v DOUBLE"), ["k"], "v", digits=1, mean="m", count="n").collect()
