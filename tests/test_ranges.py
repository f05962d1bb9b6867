"""Records across byte ranges against readers that take a file as a whole."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import types as T

from civiclens.sources.readers import read_csv, read_csv_by_ranges, read_features, read_features_by_ranges, read_lines
from civiclens.sources.ranges import document_features, quoted_lines
from civiclens.sources import writers
from civiclens.sources.writers import write_feature_document, write_features
from plans_helper import plan_of


def tuples(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def write(path, text):
    path.write_bytes(text.encode())
    return str(path)


@pytest.fixture(params=[100, 1 << 20])
def ranges(spark, request):
    """Sizes of ranges: less than many a record, or more than a file."""
    names = dict.fromkeys(("spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes"), str(request.param))
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield request.param
    for name, value in before.items():
        spark.conf.set(name, value)


CELLS = ["", "a", "b c", 'say "hi"', "two\nlines", "\n", '"', ",", '""\n"', "ü" * 40, "x\n" * 30, "end\\", "tab\t", "{}"]


def csv_text(rows, header, newline="\n"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=newline)
    writer.writerow(header)
    writer.writerows(rows)
    return out.getvalue()


def test_csv_with_line_breaks_in_quotes(spark, tmp_path, ranges):
    rng = random.Random(ranges)
    files = []
    for name, header, newline in (("a", ["x y", "n,1", "z"], "\n"), ("b", ["z", "x y", "n,1"], "\n"), ("c", ["x y", "n,1", "z"], "\r\n")):
        rows = [[str(i) if h == "z" else rng.choice(CELLS) for h in header] for i in range(25)]
        write(tmp_path / f"{name}.csv", csv_text(rows, header, newline))
        files += [tuple(row[header.index(h)] or None for h in ("x y", "n,1", "z")) for row in rows]
    found = read_csv_by_ranges(spark, str(tmp_path)).select("`x y`", "`n,1`", "z")
    assert tuples(found) == sorted(files, key=repr)
    if ranges < 1000:
        assert found.rdd.getNumPartitions() > 3
    whole = read_csv(spark, str(tmp_path / "a.csv"), multi_line=True)
    assert tuples(read_csv_by_ranges(spark, str(tmp_path / "a.csv"))) == tuples(whole)


def test_odd_csv_files(spark, tmp_path, ranges):
    def read(text):
        return tuples(read_csv_by_ranges(spark, write(tmp_path / f"{abs(hash(text))}.csv", text)))

    assert read("a,b\n") == []
    assert read("a,b") == []
    assert read('"a\n1",b\n\n"1\n\n2",\n\n') == [("1\n\n2", None)]
    assert read("a,a,\n1,2,3,4\n5\n") == [("1", "2", "3"), ("5", None, None)]
    assert read('a,b\n1,"open\nto the end\n') [0][0] == "1"
    with pytest.raises(ValueError, match="header"):
        read("")
    texts, headers = quoted_lines(spark, write(tmp_path / "q.csv", 'h\nx\n"y\n"\n'))
    assert [r.record for r in texts.orderBy("record").collect()] == ['"y\n"', "h", "x"]
    assert headers.count() == 0


def test_the_first_line_goes_by_its_place(spark, tmp_path, ranges):
    write(tmp_path / "a.txt", "h1,h2\n1,2\nh1,h2\n" + "h1,h2\n" * 60)
    write(tmp_path / "b.txt", "other\r\nh1,h2\r\n3,4")
    write(tmp_path / "c.txt", "")
    write(tmp_path / "d.txt", "only")
    want = sorted([("1,2",), ("3,4",), *[("h1,h2",)] * 62])
    assert sorted(tuples(read_lines(spark, str(tmp_path), skip_first=True))) == want
    assert tuples(read_lines(spark, str(tmp_path / "d.txt"), skip_first=True)) == []


PROPERTIES = T.StructType([T.StructField("s", T.StringType()), T.StructField("n", T.LongType())])
STRINGS = ['q"uote', "br}ace{", "back\\slash", '\\"', "\\\\", "ü[", "]", "", None, 'x"},{"properties":{"s":"no"}}', "long " * 60]


def document(rng, n):
    features = []
    for i in range(n):
        feature = {"type": "Feature", "geometry": {"coordinates": [[1, {"a": "}"}], "]"]}}
        if i % 9:
            feature["properties"] = {"s": rng.choice(STRINGS), "n": i, "more": {"features": [{"properties": {}}]}}
        features.append(feature)
    crs = {"type": "name", "properties": {"name": "}", "features": [{"properties": {"s": "inner"}}]}}
    return {"type": "FeatureCollection", "a}b": [{"properties": {"s": "not"}}], "crs": crs, "features": features,
            "after": [{"properties": {"s": "nor this"}}], "feature\"s": [{"properties": {}}]}


@pytest.mark.parametrize("layout", [{}, {"indent": 1}, {"separators": (",", ":"), "ensure_ascii": False}])
def test_features_of_large_documents(spark, tmp_path, ranges, layout):
    rng = random.Random(5)
    for name, n in (("a", 12), ("b", 3), ("c", 0)):
        write(tmp_path / f"{name}.geojson", json.dumps(document(rng, n), **layout) + ("\n" if n == 3 else ""))
    want = tuples(read_features(spark, str(tmp_path), PROPERTIES))
    assert len(want) == 15
    assert tuples(read_features_by_ranges(spark, str(tmp_path), PROPERTIES)) == want
    texts = [r.record for r in document_features(spark, str(tmp_path)).collect()]
    assert all(json.loads(text)["type"] == "Feature" for text in texts)


def test_a_document_is_written_as_one_file(spark, tmp_path, ranges):
    rows = [(i, f"text }}{i}", i * i) for i in range(20)]
    path = str(tmp_path / "out")
    write_feature_document(spark.createDataFrame(rows, "at INT, s STRING, n BIGINT").repartition(4), path, "at")
    (file,) = (tmp_path / "out").glob("part-*")
    features = json.loads(file.read_text())["features"]
    assert [f["properties"]["n"] for f in features] == [i * i for i in range(20)]
    assert tuples(read_features_by_ranges(spark, path, PROPERTIES)) == tuples(read_features(spark, path, PROPERTIES))
    empty = str(tmp_path / "empty")
    write_feature_document(spark.createDataFrame([], "at INT, s STRING, n BIGINT"), empty, "at")
    assert tuples(read_features_by_ranges(spark, empty, PROPERTIES)) == []


def test_the_task_that_writes_a_document_sorts_nothing(spark, tmp_path, monkeypatch):
    """Parts of many tasks, more than nine, in their order; the last plan has no sort."""
    plans = []
    read = writers._in_order
    monkeypatch.setattr(writers, "_in_order", lambda parts: plans.append(read(parts)) or plans[0])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        rows = spark.range(5_000).selectExpr("4999 - id AS at", "id % 7 AS n").repartition(5)
        write_feature_document(rows, str(tmp_path / "out"), "at")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    (file,) = (tmp_path / "out").glob("part-*")
    features = json.loads(file.read_text())["features"]
    assert [f["properties"]["n"] for f in features] == [(4999 - at) % 7 for at in range(5_000)]
    plan = plan_of(plans[0])
    assert "Sort" not in plan and "Exchange" not in plan and plan.count("Scan parquet") > 9


def test_features_without_numbers_are_not_gathered(spark, tmp_path):
    rows = spark.range(60_000).selectExpr("CAST(NULL AS BIGINT) AS at", "id")
    with pytest.raises(ValueError, match="missing or repeated"):
        write_features(rows, str(tmp_path / "f"), "at")
