"""Physical plans: pruning, no shuffle too many, no Python and no product where none is due."""

import os
import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import Row
from pyspark.sql import functions as F

from civiclens import scratch
from civiclens.functions.buckets import day_part_udf
from civiclens.operators import joins, nearest
from civiclens.operators.aggregates import argmin_by, sum_by
from civiclens.operators.nearest import _nearest_listed, _nearest_of
from civiclens.operators.ranking import top_n_per_group
from civiclens.plans import families, inputs
from civiclens.plans.catalog import QUERIES
from plans_helper import plan_of

PYTHON = {
    "day_part_udf",
    "nearest_from_files",
    "nearest_site",
    "nearest_site_dense",
    "nearest_site_grid",
    "nearest_strategy_matrix",
    "nearest_summary",
    "nearest_summary_grid",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_multiplies_rows_or_leaves_the_jvm_unasked(name, spark, folder, monkeypatch):
    plans = []

    def recorded(df, name):
        plans.append(plan_of(df))
        return scratch.materialise(df, name)

    for module in (joins, nearest):
        monkeypatch.setattr(module, "materialise", recorded)
    plan = plan_of(QUERIES[name](spark, folder))
    for each in (plan, *plans):  # those of tables written on the way too
        assert "CartesianProduct" not in each
        assert "NestedLoop" not in each
    assert ("EvalPython" in plan) == (name in PYTHON)


def test_levels_of_the_grid_below_the_first_multiply_no_rows(spark, monkeypatch):
    plans = []

    def recorded(df, name):
        plans.append(plan_of(df))
        return scratch.materialise(df, name)

    monkeypatch.setattr(nearest, "materialise", recorded)

    def spread(n, factor):  # within a hundred metres of five spots
        part = lambda by: F.col("id") * by % 997 / 997.0 * 0.001
        lat = 34.0 + F.col("id") % 5 * 0.5 + part(factor)
        return spark.range(n).select("id", lat.alias("lat"), (part(factor + 5) - 118).alias("lon"))

    sites = spread(500, 331).withColumn("site", F.col("id").cast("string")).drop("id")
    assert nearest.nearest_site(spread(1500, 89), sites, "grid").count() == 1500
    levels = [each for each in plans if "closest_km" in each]
    assert len(levels) > 1
    assert not any("CartesianProduct" in each or "NestedLoop" in each for each in plans)


def test_share_shuffles_the_counts_and_sorts_them(spark, folder):
    plan = plan_of(QUERIES["share_of_total"](spark, folder)).split("Subquery")[0]
    assert "partial_count" in plan_of(QUERIES["share_of_total"](spark, folder))
    assert plan.count("Exchange") <= 2


def test_array_and_vector_forms_do_not_shuffle_points(spark, folder):
    for name in ("nearest_site", "nearest_site_array"):
        plan = plan_of(QUERIES[name](spark, folder)).split("Subquery")[0]
        assert "Exchange" not in plan


@pytest.fixture
def crimes_with_dates(spark, folder, tmp_path):
    path = str(tmp_path / "crimes")
    same = F.col("event_id") == F.col("o_orderkey")
    inputs.crimes(spark, folder).join(inputs.dates(spark, folder), same).write.parquet(path)
    return spark.read.parquet(path)


def below(plan, node):
    """What the last such node of a plan reads from."""
    return plan[plan.rindex(node) :]


def test_dates_are_parsed_once_per_text(crimes_with_dates):
    for months in (families.top_months, families.top_months_sql):
        plan = below(plan_of(months(crimes_with_dates)), "HashAggregate(keys=[date_text")
        assert "partial_count" in plan and "/dd" not in plan


def test_the_function_sees_times_once(crimes_with_dates):
    for strict in (False, True):
        share = families.day_part_share(crimes_with_dates, "click", udf=True, strict=strict)
        plan = plan_of(share)
        assert "EvalPython" in plan
        assert "EvalPython" not in below(plan, "HashAggregate(keys=[time_text")


def test_parquet_scan_is_pruned(spark, folder):
    plan = plan_of(QUERIES["scan_parquet_pruned"](spark, folder))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_csv_scan_reads_what_the_query_needs(spark, folder, tmp_path):
    path = str(tmp_path / "crimes")
    header = "DR_NO STRING, `DATE OCC` STRING, `TIME OCC` STRING, `Premis Desc` STRING, LAT STRING, LON STRING"
    spark.createDataFrame([("1", "a", "b", "STREET", "1", "2")], header).write.csv(path, header=True)
    crimes = families.load_crimes(spark, [path, path])
    plan = plan_of(families.day_part_share(crimes))
    assert "ReadSchema: struct<TIME OCC:string,Premis Desc:string>" in plan
    assert "EqualTo(Premis Desc,STREET)" in plan


def test_rank_filter_limits_groups_before_the_shuffle(spark, folder):
    months = plan_of(QUERIES["top_months"](spark, folder))
    assert months.count("WindowGroupLimit") == 2
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    order = [F.desc("o_totalprice"), F.asc("o_orderkey")]
    top = top_n_per_group(orders, ["o_orderstatus"], order, 3)
    plan = plan_of(top)
    assert plan.index("Partial") > plan.index("Exchange")
    assert top.groupBy("o_orderstatus").count().filter("count <> 3").isEmpty()


def test_top_k_sorts_nothing_as_a_whole(spark, folder):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["top_k_per_capita"](spark, folder))


def test_aggregates_combine_before_the_shuffle(spark, folder):
    blocks = inputs.blocks(spark, folder)
    assert "partial_sum" in plan_of(sum_by(blocks, ["zip"], {"n": "pop"}))
    assert "partial_min" in plan_of(argmin_by(blocks, ["zip"], "pop", "block"))


def test_sums_of_missing_values(spark):
    rows = spark.createDataFrame([("a", None), ("a", 2), ("b", None)], "k STRING, v INT")
    assert sorted(map(tuple, sum_by(rows, ["k"], {"s": "v"}).collect())) == [("a", 2), ("b", None)]
    zeros = sum_by(rows, ["k"], {"s": "v"}, missing_as_zero=True)
    assert sorted(map(tuple, zeros.collect())) == [("a", 2), ("b", 0)]


def test_argmin_skips_missing_values_and_breaks_ties(spark):
    rows = [("a", None, "x"), ("a", 1.0, "z"), ("a", 1.0, "y"), ("b", None, "x")]
    table = spark.createDataFrame(rows, "k STRING, v DOUBLE, l STRING")
    assert list(map(tuple, argmin_by(table, ["k"], "v", "l").collect())) == [("a", 1.0, "y")]


def test_shares_add_up(spark, folder):
    crimes = inputs.crimes(spark, folder)
    rows = families.day_part_share(crimes, "click").collect()
    assert sum(row["crimes"] for row in rows) == crimes.filter("place = 'click'").count()
    assert sum(row["percentage"] for row in rows) == pytest.approx(100, abs=0.03)
    percentages = [row["percentage"] for row in rows]
    assert percentages == sorted(percentages, reverse=True)


def test_dates_are_parsed_at_all(spark, folder):
    """All but the texts made unreadable."""
    dates = inputs.dates(spark, folder)
    bad = dates.filter("o_orderkey % 97 = 0 OR o_orderkey % 89 = 0").count()
    assert QUERIES["filter_valid"](spark, folder).count() == dates.count() - bad


def test_scratch_tables_go_where_the_cluster_says(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch.scratch_path(spark, "x").startswith(root.rstrip("/") + "/")
    assert scratch.scratch_path(spark, "x") != scratch.scratch_path(spark, "x")
    table = scratch.materialise(spark.range(3), "numbers")
    assert table.count() == 3 and root in table.inputFiles()[0]


def test_workers_need_not_have_the_package(spark, tmp_path):
    """Python functions unpickle in a process that knows pandas and NumPy only."""
    sites = [Row(site="a", site_lat=1.0, site_lon=2.0)]
    for number, udf in enumerate([day_part_udf(), _nearest_of(sites), _nearest_listed()]):
        path = tmp_path / f"{number}.pickle"
        path.write_bytes(cloudpickle.dumps(udf.func))
        code = f"import pickle; pickle.load(open({str(path)!r}, 'rb'))"
        environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
        subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=environment, check=True)


class FakeSession:
    def __init__(self, **settings):
        self.settings = {key.replace("_", "."): value for key, value in settings.items()}
        self.conf = self

    def get(self, key, default):
        return self.settings.get(key, default)


def test_only_a_local_master_may_lack_a_shared_folder():
    with pytest.raises(ValueError):
        scratch.scratch_path(FakeSession(spark_master="yarn"), "x")
    assert scratch.scratch_path(FakeSession(spark_master="local[2]"), "x")
