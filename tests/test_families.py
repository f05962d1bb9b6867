"""The query families on small files of the published shape, with answers by hand."""

import json

import pytest
from pyspark.sql import functions as F

from civiclens.operators import joins
from civiclens.plans import families
from civiclens.sources.writers import csv_to_parquet
from plans_helper import plan_of

CRIMES_A = """DR_NO,DATE OCC,TIME OCC,Premis Desc,LAT,LON
1,2010 Jan 01 12:00:00 AM,0045,STREET,34.0,-118.2
2,2010 Jan 02 12:00:00 AM,0600,STREET,34.1,-118.3
3,2010 Feb 02 12:00:00 AM,0700,"STREET, X",34.1,-118.3
4,2010 Feb 03 12:00:00 AM,1300,street,0,0
5,2010 Mar 03 12:00:00 AM,abc,STREET,0,-118.2
6,2010 Apr 03 12:00:00 AM,,STREET,,-118.2
"""
CRIMES_B = """LON,LAT,Premis Desc,TIME OCC,DATE OCC,DR_NO
-118.2,34.0,STREET,1800,02/20/2021 12:00:00 AM,7
-118.3,34.1,,1800,2/3/2021,8
-118.3,34.1,STREET,2300,n/a,9
"""
BLOCKS = [
    ("00001", 10, 4),
    ("00001", None, 6),
    ("00002", 10, None),
    ("00003", 0, 5),
    ("00004", None, 5),
    ("", 5, 5),
    (None, 7, 7),
    ("00009", 3, 3),
]
INCOME = """Zip Code;Community;Estimated Median Income
00001;"A; B";$52,806
00001;A;$52,806
00001;A;40000
00002;B;$30,000
00003;C;$1,000
;D;$2,000
00009;E;-
00010
"""
STATIONS = """X,Y,DIVISION
-118.2,34.0,CENTRAL
-118.3,34.1,NORTH
,34.0,AWAY
"""


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    root = tmp_path_factory.mktemp("files")
    features = [
        {"properties": {"ZCTA20": z, "POP20": p, "HOUSING20": h}} for z, p, h in BLOCKS
    ]
    texts = {
        "a.csv": CRIMES_A,
        "b.csv": CRIMES_B,
        "blocks.geojson": json.dumps({"features": features}),
        "income.csv": INCOME,
        "stations.csv": STATIONS,
    }
    for name, text in texts.items():
        (root / name).write_text(text, encoding="utf-8")
    return {name: str(root / name) for name in texts}


@pytest.fixture(scope="module")
def crimes(spark, files):
    return families.load_crimes(spark, [files["a.csv"], files["b.csv"]])


def tuples(df):
    return [tuple(row) for row in df.collect()]


# Six crimes on a street, one of them without a time and one with a bad one.
SHARE = [
    (None, 2, 33.33),
    ("night", 2, 33.33),
    ("evening", 1, 16.67),
    ("morning", 1, 16.67),
]


def test_share_counts_bad_times(crimes):
    assert tuples(families.day_part_share(crimes)) == SHARE
    assert tuples(families.day_part_share(crimes, udf=True)) == SHARE


def test_strict_share_leaves_bad_times_out_of_the_total(crimes):
    want = [("night", 2, 50.0), ("evening", 1, 25.0), ("morning", 1, 25.0)]
    assert tuples(families.day_part_share(crimes, strict=True)) == want
    assert tuples(families.day_part_share(crimes, strict=True, udf=True)) == want


def test_share_is_the_same_from_parquet(spark, files, tmp_path):
    folders = {files[name]: str(tmp_path / name) for name in ("a.csv", "b.csv")}
    csv_to_parquet(spark, folders)
    crimes = families.load_crimes(spark, list(folders.values()), "parquet")
    assert tuples(families.day_part_share(crimes)) == SHARE


def test_share_of_no_rows(crimes):
    assert tuples(families.day_part_share(crimes, "NOWHERE")) == []


def test_top_months(crimes):
    want = [(2010, 1, 2, 1), (2010, 2, 2, 2), (2010, 3, 1, 3), (2021, 2, 1, 1)]
    assert tuples(families.top_months(crimes)) == want
    assert tuples(families.top_months_sql(crimes)) == want
    assert tuples(families.top_months_sql(crimes, 1)) == [row for row in want if row[3] == 1]
    assert families.top_months(crimes).dtypes == [
        ("year", "int"),
        ("month", "int"),
        ("crime_total", "bigint"),
        ("ranking", "int"),
    ]


def test_top_months_agree_on_ties_and_never_exceed_three(spark, folder):
    from civiclens.plans import inputs

    dates = inputs.dates(spark, folder)
    months = families.top_months(dates)
    assert tuples(months) == tuples(families.top_months_sql(dates))
    assert months.groupBy("year").count().agg(F.max("count")).first()[0] <= 3


def test_per_capita(spark, files):
    blocks = families.load_blocks(spark, files["blocks.geojson"])
    income = families.load_income(spark, files["income.csv"])
    rows = tuples(families.per_capita(blocks, income))
    assert rows == [
        ("00001", 10, 10, 52806, 52806.0),
        ("00001", 10, 10, 52806, 52806.0),
        ("00001", 10, 10, 40000, 40000.0),
        ("00002", 10, None, 30000, None),
    ]
    for strategy in ("BROADCAST", "MERGE", "SHUFFLE_HASH", "REPLICATE_HOT_KEYS"):
        assert tuples(families.per_capita(blocks, income, strategy)) == rows


def test_an_empty_zip_is_a_zip_unless_strict(spark, files):
    blocks = families.load_blocks(spark, files["blocks.geojson"])
    assert ("", 5, 5) in tuples(families.by_zip(blocks))
    strict = families.load_blocks(spark, files["blocks.geojson"], strict=True)
    assert sorted(tuples(families.by_zip(strict, strict=True))) == [
        ("00001", 10, 10),
        ("00002", 10, 0),
        ("00009", 3, 3),
    ]


def test_strict_per_capita(spark, files):
    """Split lines know no quotes: the first income line has its text in another part."""
    blocks = families.load_blocks(spark, files["blocks.geojson"], strict=True)
    income = families.load_income(spark, files["income.csv"], strict=True)
    rows = tuples(families.per_capita(blocks, income, strict=True))
    assert rows == [
        ("00001", 10, 10, 52806, 52806.0),
        ("00001", 10, 10, 40000, 40000.0),
        ("00002", 10, 0, 30000, 0.0),
    ]
    assert tuples(families.top_per_capita(blocks, income, 2, strict=True)) == rows[:2]


def test_nearest_summary(spark, files, crimes):
    from civiclens.operators.nearest import METHODS, nearest_summary

    stations = families.load_stations(spark, files["stations.csv"])
    points = families.known_locations(crimes)
    for method in (None, *METHODS):
        summary = nearest_summary(points, stations, method, count="#")
        assert summary.columns == ["site", "average_distance", "#"]
        assert tuples(summary) == [("NORTH", 0.0, 4), ("CENTRAL", 0.0, 2)]


def test_timers(spark, tmp_path):
    (tmp_path / "q1.log").write_text("[TIMER] Q1: 1.5 s\nnoise\n")
    (tmp_path / "q2.log").write_text("noise\n[TIMER] Q2 (a=b): x: 2 s\n")
    assert sorted(tuples(families.load_timers(spark, str(tmp_path)))) == [
        ("q1", "Q1", 1.5),
        ("q2", "Q2 (a=b): x", 2.0),
    ]


def test_a_row_with_very_many_copies_is_not_unfolded(spark, monkeypatch):
    rows = [("z", 10, 5, 100, 50.0, 10**12), ("y", 10, 5, 90, 45.0, 1)]
    schema = "zip STRING, total_pop BIGINT, total_households BIGINT, median_income INT, per_capita_income DOUBLE, copies BIGINT"
    monkeypatch.setattr(families, "_per_capita_rows", lambda *_: spark.createDataFrame(rows, schema))
    assert [row["zip"] for row in families.top_per_capita(None, None, 3).collect()] == ["z"] * 3


def test_more_zips_than_may_be_broadcast(spark, monkeypatch):
    """All rows come out by another join; within the bound the hint stays."""
    blocks = spark.range(40).selectExpr("lpad(CAST(id AS STRING), 5, '0') AS zip", "id + 1 AS pop", "id AS households")
    income = blocks.selectExpr("zip", "CAST(households AS INT) AS median_income").union(
        spark.createDataFrame([("00007", 5)], "zip STRING, median_income INT")
    )
    want = sorted(map(tuple, families.zip_income(blocks, income).collect()))
    monkeypatch.setitem(joins.feasible.__kwdefaults__, "broadcast_rows", 39)
    many = families.zip_income(blocks, income, "BROADCAST")
    assert sorted(map(tuple, many.collect())) == want and len(want) == 41
    assert "SortMergeJoin" in plan_of(many)
    monkeypatch.setitem(joins.feasible.__kwdefaults__, "broadcast_rows", 40)
    assert "BroadcastHashJoin" in plan_of(families.zip_income(blocks, income, "BROADCAST"))
