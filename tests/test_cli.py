import pytest
from test_families import files  # noqa: F401

from civiclens.__main__ import main


@pytest.fixture
def run(spark, capsys):
    def call(*arguments):
        main(list(arguments))
        return capsys.readouterr().out

    return call


def test_share_months_and_nearest(run, files):  # noqa: F811
    crimes = ["--crimes", files["a.csv"], files["b.csv"]]
    assert "|night   |2     |33.33     |" in run("share", *crimes)
    assert "|Νύχτα" in run("share", *crimes, "--udf", "--labels", "el")
    assert "|2010|1    |2          |1      |" in run("months", *crimes, "--sql")
    out = run("nearest", *crimes, "--stations", files["stations.csv"])
    assert "|division|average_distance|#  |" in out and "|NORTH   |0.0             |4  |" in out


def test_income_explained(run, files):  # noqa: F811
    inputs = ["--blocks", files["blocks.geojson"], "--income", files["income.csv"]]
    out = run("--explain", "income", *inputs, "--strategy", "MERGE")
    assert "SortMergeJoin" in out and "|40000.0          |" in out and "[TIMER] income: " in out
    assert "|0.0              |" in run("income", *inputs, "--strict")


def test_convert_then_query_parquet(run, files, tmp_path):  # noqa: F811
    targets = [str(tmp_path / "a"), str(tmp_path / "b")]
    run("convert", "--crimes", files["a.csv"], files["b.csv"], "--to", *targets)
    out = run("share", "--crimes", *targets, "--format", "parquet")
    assert "|night   |2     |33.33     |" in out


def test_all_rows_go_out(run, tmp_path, spark):
    lines = "".join(f"[TIMER] Q{i}: {i}.5 s\n" for i in range(1001))
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "q.log").write_text(lines)
    for fmt in ("csv", "parquet"):
        out = str(tmp_path / fmt)
        run("timers", "--path", str(tmp_path / "logs"), "--out", out, "--out-format", fmt)
        assert spark.read.format(fmt).options(header=True).load(out).count() == 1001


def test_features_are_converted(run, files, tmp_path, spark):  # noqa: F811
    run("convert_features", "--blocks", files["blocks.geojson"], "--to", str(tmp_path / "blocks"))
    assert "ZCTA20" in spark.read.parquet(str(tmp_path / "blocks")).columns


def test_profile_preview_and_timers(run, files, tmp_path):  # noqa: F811
    assert "|LAT        |6        |5             |" in run("profile", "--path", files["a.csv"])
    assert run("preview", "--path", files["a.csv"]).count("STREET") == 4
    (tmp_path / "q.log").write_text("[TIMER] Q: 1.5 s\n")
    assert "|q     |Q          |1.5    |" in run("timers", "--path", str(tmp_path))
