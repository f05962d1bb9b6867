"""Nearest site against brute force over all pairs in NumPy."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from civiclens.functions.geo import haversine_km, is_known_location
from civiclens.operators import nearest as module
from civiclens.operators.nearest import METHODS, nearest_site, nearest_summary
from plans_helper import plan_of


def frames(spark, points, sites):
    points = [(i, *map(as_float, p)) for i, p in enumerate(points)]
    sites = [(n, *map(as_float, p)) for n, *p in sites]
    return (
        spark.createDataFrame(points, "id INT, lat DOUBLE, lon DOUBLE"),
        spark.createDataFrame(sites, "site STRING, lat DOUBLE, lon DOUBLE"),
    )


def as_float(value):
    return None if value is None else float(value)


def km(lat1, lon1, lat2, lon2):
    lat1, lon1, lat2, lon2 = map(np.radians, (lat1, lon1, lat2, lon2))
    half = np.sin((lat2 - lat1) / 2) ** 2
    half = half + np.cos(lat1) * np.cos(lat2) * np.sin((lon2 - lon1) / 2) ** 2
    return 2 * 6371.0 * np.arcsin(np.sqrt(np.minimum(half, 1)))


def brute_force(points, sites):
    names = np.array([s[0] for s in sites])
    lat, lon = (np.array([s[i] for s in sites], dtype=float) for i in (1, 2))
    out = {}
    for i, (p_lat, p_lon) in enumerate(points):
        dist = km(p_lat, p_lon, lat, lon)
        out[i] = (min(names[dist <= dist.min() + 1e-9]), dist.min())
    return out


def check(spark, points, sites, method):
    nearest = nearest_site(*frames(spark, points, sites), method)
    assert nearest.columns == ["id", "lat", "lon", "site", "dist_km"]
    rows = nearest.collect()
    got = {row["id"]: (row["site"], row["dist_km"]) for row in rows}
    want = brute_force(points, sites)
    assert len(rows) == len(points) and got.keys() == want.keys()
    for i, (site, dist) in want.items():
        assert got[i][0] == site, (i, got[i], want[i])
        assert got[i][1] == pytest.approx(dist, abs=1e-6)


def scattered(seed, n, lat=(-90, 90), lon=(-180, 180)):
    rng = np.random.default_rng(seed)
    return list(zip(rng.uniform(*lat, n).tolist(), rng.uniform(*lon, n).tolist()))


def named(places):
    return [(f"s{i:05d}", *place) for i, place in enumerate(places)]


POLES = [(90, 0), (-90, 50), (89.9, 179.9), (89.9, -179.9), (0, 180), (0, -180), (0, 0), (12, 540)]


@pytest.mark.parametrize("method", METHODS)
def test_whole_earth(spark, method):
    check(spark, scattered(1, 300) + POLES, named(scattered(2, 200)), method)


def test_many_sites_go_to_the_grid(spark):
    sites = named(scattered(3, 2_000, (33.7, 34.4), (-118.7, -118.1)))
    points = scattered(4, 1_500, (33.7, 34.4), (-118.7, -118.1)) + [(51.5, 0.1), (-33.9, 151.2)]
    check(spark, points, sites, None)
    for method in ("vector", "array"):
        with pytest.raises(ValueError):
            nearest_site(*frames(spark, points, sites), method)
    plan = plan_of(nearest_site(*frames(spark, points, sites)))
    assert "Join [cell_lat" in plan


def test_crowded_cells_take_sites_row_by_row(spark, monkeypatch):
    """Sites packed more densely than the smallest cells, and a third of the points at one spot."""
    monkeypatch.setattr(module, "_SITES_PER_LIST", 3)
    monkeypatch.setattr(module, "_CELL_SIDES", module._CELL_SIDES[:6])
    sites = named(
        scattered(5, 400, (34.0, 34.001), (-118.001, -118.0)) + scattered(6, 100, (30, 40), (-120, -110))
    )
    points = scattered(7, 300, (33.99, 34.01), (-118.01, -117.99)) + scattered(8, 200, (30, 40), (-120, -110))
    points += [(34.0005, -118.0005)] * 250
    check(spark, points, sites, "grid")


def test_sites_on_a_ring_are_all_candidates(spark):
    angles = np.linspace(0, 2 * math.pi, 150, endpoint=False)
    sites = named([(10 * math.sin(a), 10 * math.cos(a)) for a in angles])
    check(spark, [(0.0, 0.0)] * 5 + scattered(9, 50, (-1, 1), (-1, 1)), sites, "grid")


@pytest.mark.parametrize("method", METHODS)
def test_ties_go_to_the_smaller_name(spark, method):
    sites = [("b", 34, -118.1), ("a", 34, -117.9), ("d", 40, 0), ("c", 40, 0)]
    points, sites = frames(spark, [(34, -118), (40, 0)], sites)
    rows = nearest_site(points, sites, method).orderBy("id").collect()
    assert [row["site"] for row in rows] == ["a", "c"]
    assert rows[1]["dist_km"] == 0.0


@pytest.mark.parametrize("method", METHODS)
def test_sites_and_points_without_a_location_take_no_part(spark, method):
    nan = float("nan")
    sites = [("a", None, 0), ("b", 1, None), ("c", 2, 2), ("d", nan, 1), ("e", 1, math.inf)]
    points, sites = frames(spark, [(1, 1), (None, 1), (nan, 1), (1, -math.inf)], sites)
    assert [tuple(r)[0::3] for r in nearest_site(points, sites, method).collect()] == [(0, "c")]


@pytest.mark.parametrize("method", METHODS)
def test_no_sites_or_no_points(spark, method):
    points, sites = frames(spark, [(1, 1)], [("a", 1, 1)])
    assert nearest_site(points, sites.filter("lat > 5"), method).collect() == []
    assert nearest_site(points.filter("lat > 5"), sites, method).collect() == []


@pytest.mark.parametrize("method", METHODS)
def test_sites_without_a_name_take_no_part(spark, method):
    points, sites = frames(spark, [(34, -118)], [(None, 34, -118), ("B", 35, -118), ("A", 35, -118)])
    assert [row["site"] for row in nearest_site(points, sites, method).collect()] == ["A"]


@pytest.mark.parametrize("method", METHODS)
def test_latitudes_beyond_the_poles_do_no_harm(spark, method):
    points, sites = frames(spark, [(135.0 + i / 7, i) for i in range(60)], [("a", 45, 180), ("b", 0, 0)])
    assert nearest_site(points, sites, method).count() == 60


@pytest.mark.parametrize("method", METHODS)
def test_columns_of_the_caller_keep_their_values(spark, method):
    names = ["sites", "cell_lat", "cell_lon", "at", "site_lat", "site_lon", "point", "a b"]
    points, sites = frames(spark, [(34, -118), (35, -118)], [("B", 34, -118), ("A", 35, -118)])
    points = points.select("*", *[F.lit(n).alias(n) for n in names], F.lit("x").alias("site"))
    nearest = nearest_site(points, sites, method)
    assert nearest.columns == ["id", "lat", "lon", *names, "site", "dist_km"]
    assert sorted((r["id"], r["sites"], r["at"], r["a b"], r["site"]) for r in nearest.collect()) == [
        (0, "sites", "at", "a b", "B"), (1, "sites", "at", "a b", "A"),
    ]


def test_the_limit_of_sites_changes_no_answer(spark):
    sites, points = named(scattered(21, 257, (30, 40), (-120, -110))), scattered(22, 300, (30, 40), (-120, -110))
    few = [nearest_site(*frames(spark, points, sites[:256]), m) for m in METHODS]
    many = nearest_site(*frames(spark, points, [*sites[:256], ("far", -80.0, 10.0)]))
    rows = [{r["id"]: (r["site"], round(r["dist_km"], 6)) for r in df.collect()} for df in (*few, many)]
    assert rows[0] == rows[1] == rows[2] == rows[3]


def test_summary_counts_every_point(spark):
    points, sites = frames(spark, scattered(10, 500), named(scattered(11, 30)))
    summaries = [nearest_summary(points, sites, m).collect() for m in METHODS]
    assert summaries[0] == summaries[1] == summaries[2]
    counts = [row["n_points"] for row in summaries[0]]
    assert sum(counts) == 500 and counts == sorted(counts, reverse=True)


def test_sentinels(spark):
    points, _ = frames(spark, [(0, 0), (0, 5), (5, 0), (None, 5), (5, 5)], [("a", 1, 1)])
    known = points.filter(is_known_location(F.col("lat"), F.col("lon")))
    assert [row["id"] for row in known.collect()] == [4]


def test_haversine_needs_all_coordinates_and_meets_the_opposite_point(spark):
    row = spark.range(1).select(
        haversine_km(F.lit(None).cast("double"), F.lit(0.0), F.lit(0.0), F.lit(0.0)).alias("none"),
        haversine_km(F.lit(90.0), F.lit(0.0), F.lit(-90.0), F.lit(77.0)).alias("far"),
        haversine_km(F.lit(float("nan")), F.lit(0.0), F.lit(0.0), F.lit(0.0)).alias("nan"),
    ).first()
    assert row["none"] is None
    assert row["far"] == pytest.approx(math.pi * 6371.0)


degrees = st.tuples(st.floats(-90, 90), st.floats(-180, 180))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(degrees, degrees), min_size=50, max_size=50))
def test_haversine_is_symmetric_and_zero_on_equal_points(spark, pairs):
    rows = spark.createDataFrame([(*a, *b) for a, b in pairs], "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE")
    a, b, c, d = map(F.col, "abcd")
    for there, back, same, *ends in rows.select(
        haversine_km(a, b, c, d), haversine_km(c, d, a, b), haversine_km(a, b, a, b), "*"
    ).collect():
        assert there == pytest.approx(back) and same == 0
        assert there == pytest.approx(km(*ends), abs=1e-3)


def test_the_array_method_is_compiled(spark):
    """No function over array elements, which Spark interprets; ties over all sites go to the smaller name."""
    sites = [(f"s{99 - i:02}", 10 + i % 5, 20.0) for i in range(30)]
    table = frames(spark, [(10 + i / 3, 20.5) for i in range(15)] + [(None, 1)], sites)
    found = nearest_site(*table, "array")
    assert "transform(" not in plan_of(found) and "lambda" not in plan_of(found)
    by = {m: {r.id: (r.site, r.dist_km) for r in nearest_site(*table, m).collect()} for m in ("vector", "array")}
    assert len(by["array"]) == 15 and by["array"].keys() == by["vector"].keys()
    for i, (site, dist) in by["array"].items():
        assert site == by["vector"][i][0] and dist == pytest.approx(by["vector"][i][1], abs=1e-9)
