import json

import pytest
from pyspark.sql import functions as F

from civiclens.contracts import BLOCK_PROPERTIES
from civiclens.operators.profile import dataset_profile, value_profile
from civiclens.sources.readers import (
    load_union,
    parse_csv_lines,
    parse_split_lines,
    read_csv,
    read_features,
    read_features_whole_text,
    read_lines,
    source_name,
)
from civiclens.sources import writers
from civiclens.sources.writers import convert_new, csv_to_parquet, read_converted, write_features
from plans_helper import plan_of


def tuples(df):
    return [tuple(row) for row in df.collect()]


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_keeps_text_quotes_and_missing_values(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'DR_NO,Premis Desc\n007,"STREET, X"\n8,\n9,""\n')
    table = read_csv(spark, path)
    assert table.dtypes == [("DR_NO", "string"), ("Premis Desc", "string")]
    assert tuples(table) == [("007", "STREET, X"), ("8", None), ("9", None)]


def test_csv_takes_doubled_quotes_and_backslashes_as_lines_do(spark, tmp_path):
    lines = ['1,"say ""hi"", ok",x', '2,"back\\",y', '3,a\\,z']
    table = read_csv(spark, write(tmp_path / "a.csv", "\n".join(["a,b,c", *lines]) + "\n"))
    texts = spark.createDataFrame([(line,) for line in lines], "line STRING")
    want = [("1", 'say "hi", ok', "x"), ("2", "back\\", "y"), ("3", "a\\", "z")]
    assert tuples(table) == want == tuples(parse_csv_lines(texts, "a STRING, b STRING, c STRING"))
    csv_to_parquet(spark, {str(tmp_path / "a.csv"): str(tmp_path / "p")})
    assert tuples(spark.read.parquet(str(tmp_path / "p"))) == want
    broken = write(tmp_path / "b.csv", 'a,b\n1,"two\nlines"\n')
    assert tuples(read_csv(spark, broken, multi_line=True)) == [("1", "two\nlines")]


def test_union_goes_by_name(spark, tmp_path):
    first = read_csv(spark, write(tmp_path / "a.csv", "x y,z,w\n1,2,3\n"))
    second = read_csv(spark, write(tmp_path / "b.csv", "w,z,x y\n6,5,4\n"))
    assert sorted(tuples(load_union([first, second], ["x y", "z"]))) == [("1", "2"), ("4", "5")]


def test_lines_drop_every_header(spark, tmp_path):
    write(tmp_path / "a.txt", "h1,h2\n1,2\nh1,h2\n")
    write(tmp_path / "b.txt", "h1,h2\n3,4\n")
    lines = read_lines(spark, str(tmp_path), "h1,h2")
    assert sorted(tuples(lines)) == [("1,2",), ("3,4",)]


def test_csv_lines(spark):
    lines = spark.createDataFrame([('1,"a, ""b""",',), ("2,c",)], "line STRING")
    parsed = parse_csv_lines(lines, "n INT, s STRING, e STRING")
    assert tuples(parsed) == [(1, 'a, "b"', None), (2, "c", None)]


def test_split_lines_drop_short_rows_and_keep_empty_parts(spark):
    lines = spark.createDataFrame([("z;c;$1",), ("z;c",), ("z;;",), ("a|b",)], "line STRING")
    parsed = parse_split_lines(lines, {"zip": 0, "money": 2}, sep=";", min_parts=3)
    assert tuples(parsed) == [("z", "$1"), ("z", "")]
    piped = parse_split_lines(lines, {"first": 0, "second": 1}, sep="|", min_parts=2)
    assert tuples(piped) == [("a", "b")]


FEATURES = {
    "type": "FeatureCollection",
    "features": [
        {
            "type": "Feature",
            "geometry": {"type": "Point", "coordinates": [1, 2]},
            "properties": {"ZCTA20": "00501", "POP20": 5, "HOUSING20": None, "X": "y"},
        },
        {"type": "Feature", "properties": {"ZCTA20": None, "POP20": 1}},
    ],
}


def test_features_by_both_readers(spark, tmp_path):
    path = write(tmp_path / "blocks.geojson", json.dumps(FEATURES, indent=1))
    want = [("00501", 5, None), (None, 1, None)]
    assert tuples(read_features(spark, path)) == want
    assert tuples(read_features_whole_text(spark, path)) == want


def test_features_are_written_in_bounded_documents(spark, tmp_path):
    rows = spark.range(120_000).select(
        "id", F.col("id").cast("string").alias("ZCTA20"), F.col("id").alias("POP20")
    )
    path = str(tmp_path / "features")
    write_features(rows, path, "id")
    documents = spark.read.text(path, wholetext=True)
    assert documents.count() == 3
    back = read_features(spark, path, BLOCK_PROPERTIES)
    assert back.agg(F.sum("POP20"), F.countDistinct("ZCTA20")).first()[:] == (
        sum(range(120_000)),
        120_000,
    )


def test_conversion_keeps_all_columns_and_overwrites(spark, tmp_path):
    source = write(tmp_path / "a.csv", "TIME OCC,Premis Desc\n0045,STREET\n")
    target = str(tmp_path / "parquet")
    for _ in range(2):
        csv_to_parquet(spark, {source: target})
    table = spark.read.parquet(target)
    assert table.dtypes == [("TIME OCC", "string"), ("Premis Desc", "string")]
    assert tuples(table) == [("0045", "STREET")]


def test_profile_counts_in_one_pass(spark):
    table = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "`a b` INT, c STRING")
    profile = dataset_profile(table)
    assert plan_of(profile).count("Scan") == 1
    assert sorted(tuples(profile)) == [("a b", 3, 2), ("c", 3, 1)]


def test_source_name(spark, tmp_path):
    write(tmp_path / "q1-run.log", "x")
    names = spark.read.text(str(tmp_path)).select(source_name())
    assert tuples(names) == [("q1-run",)]


def test_conversion_takes_new_and_changed_files_only(spark, tmp_path):
    target = str(tmp_path / "out")
    a, b = write(tmp_path / "a.csv", "x,y\n1,2\n"), write(tmp_path / "b.csv", "y,x\n3,4\n")
    with pytest.raises(ValueError, match="nothing"):
        read_converted(spark, target)
    assert convert_new(spark, [a], target) == [a]
    assert convert_new(spark, [a, b, b], target) == [b]
    assert convert_new(spark, [a, b], target) == []
    assert sorted(tuples(read_converted(spark, target))) == [("1", "2"), ("4", "3")]
    write(tmp_path / "a.csv", "x,y\n1,2\n5,6\n")
    assert convert_new(spark, [a, b], target) == [a]
    assert sorted(tuples(read_converted(spark, target))) == [("1", "2"), ("4", "3"), ("5", "6")]


def test_a_conversion_that_is_killed_leaves_nothing_half(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "out")
    paths = [write(tmp_path / f"{name}.csv", f"x\n{name}\n") for name in "abc"]
    convert_new(spark, paths[:1], target)

    def read(spark, path):
        if path == paths[2]:
            raise KeyboardInterrupt
        return read_csv(spark, path)

    with pytest.raises(KeyboardInterrupt):
        convert_new(spark, paths, target, read)
    assert tuples(read_converted(spark, target)) == [("a",)]
    monkeypatch.setattr(writers._Files, "publish", lambda *args: 1 / 0)  # killed before the manifest
    with pytest.raises(ZeroDivisionError):
        convert_new(spark, paths, target)
    monkeypatch.undo()
    assert tuples(read_converted(spark, target)) == [("a",)]
    assert convert_new(spark, paths, target) == paths[1:]
    assert sorted(tuples(read_converted(spark, target))) == [("a",), ("b",), ("c",)]
    assert sum(p.name.startswith("input-") for p in (tmp_path / "out").iterdir()) == 3


def test_values_of_columns(spark):
    rows = [(str(i), f"{i}.5", "2024-01-05", None, "x" if i % 3 else "yy", float(i)) for i in range(300)]
    table = spark.createDataFrame(rows, "a STRING, `b c` STRING, d STRING, e STRING, f STRING, g DOUBLE")
    profile = value_profile(table, frequent=2)
    assert plan_of(profile).count("Scan") == 1
    found = {r.column_name: r for r in profile.collect()}
    assert {n: r.fits for n, r in found.items()} == {
        "a": "BIGINT", "b c": "DOUBLE", "d": "DATE", "e": None, "f": "STRING", "g": "DOUBLE"
    }
    assert [found["a"][n] for n in ("row_count", "non_null_count", "shortest", "longest")] == [300, 300, 1, 3]
    assert abs(found["a"].distinct_estimate - 300) < 15 and found["e"].distinct_estimate == 0
    assert [abs(q - want) < 8 for q, want in zip(found["g"].quartiles, (75, 150, 225))] == [True] * 3
    assert found["f"].quartiles is None and found["f"].frequent[0][0] == "x"
    empty = {r.column_name: r for r in value_profile(table.limit(0)).collect()}
    assert all(r.row_count == 0 and r.fits is None and r.quartiles is None for r in empty.values())
