"""Nearest site of every point, by great-circle distance.

``points`` have ``lat`` and ``lon`` in degrees and any other columns; ``sites``
have ``site``, ``lat`` and ``lon``. The result has the columns of ``points``
with ``site`` and ``dist_km`` (which replace columns of these names), one row per
point with a location. Sites without a name or a location take no part, and equal
distances go to the smaller name, whatever the method. None pairs all points with
all sites as rows:

``vector``
    Up to ``MAX_VECTOR_SITES`` sites travel with the task. One pass over the
    points, in Arrow batches, and no shuffle.
``array``
    The same in SQL functions only: an array with the distance of every site. Slower.
``grid``
    Any number of sites. Points meet the few sites that can be nearest within
    their cell by an equi-join on the cell, and these few in Arrow batches.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from civiclens import contracts
from civiclens.functions.geo import haversine_km, is_located
from civiclens.operators.aggregates import mean_and_count_by
from civiclens.operators.joins import hot_key_join
from civiclens.scratch import materialise

METHODS = ("vector", "array", "grid")
MAX_VECTOR_SITES = 256

# Cell sides in degrees, each a quarter of the one before. The last is a millimetre on the
# ground, less than coordinates tell apart. There are 529 cells of the first side at most.
_CELL_SIDES = tuple(16.0 / 4**level for level in range(16))
_FIRST_CELLS = 256
_ESTIMATED = 9
# Pairs of cells and sites that a step may make to save steps between.
_PAIRS = 2_000_000
_SITES_PER_POINT = 8
_SITES_PER_LIST = 64
_ROUNDING_KM = 1e-6
_CELL = ["cell_lat", "cell_lon"]
_PARENT = ["parent_lat", "parent_lon"]


def nearest_site(points: DataFrame, sites: DataFrame, method: str | None = None) -> DataFrame:
    """Nearest site of every point. Counts up to ``MAX_VECTOR_SITES`` sites first.

    Without a ``method`` it is ``vector`` for so many sites and ``grid`` beyond
    them. The first two methods take no more sites than that, and raise a ``ValueError``
    if there are. ``grid`` writes tables while the plan is built.
    """
    if method not in (None, *METHODS):
        raise ValueError(f"unknown method {method!r}")
    located = is_located(F.col("lat"), F.col("lon"))
    # The caller's columns travel as one, so that no name of theirs meets one of ours.
    own = [F.col(f"`{name}`") for name in points.columns if name not in ("site", "dist_km")]
    points = points.filter(located).select(F.struct(*own).alias("point"), "lat", "lon")
    sites = sites.filter(located & F.col("site").isNotNull()).select(
        "site", F.col("lat").alias("site_lat"), F.col("lon").alias("site_lon")
    )
    few = [] if method == "grid" else sites.take(MAX_VECTOR_SITES + 1)
    if len(few) > MAX_VECTOR_SITES and method is not None:
        raise ValueError(f"{method} takes at most {MAX_VECTOR_SITES} sites; use grid")
    if method == "grid" or len(few) > MAX_VECTOR_SITES:
        nearest = _nearest_by_grid(points, sites)
    elif not few:
        nearest = _with_nearest(points, F.lit(None).cast("struct<dist_km double, site string>"))
    elif method == "array":
        nearest = _nearest_by_array(points, few)
    else:
        nearest = _nearest_by_vector(points, few)
    return nearest.select("point.*", "site", "dist_km")


def nearest_summary(
    points: DataFrame, sites: DataFrame, method: str | None = None, *, count: str = "n_points"
) -> DataFrame:
    """Mean distance and number of the points nearest to each site, most points first."""
    nearest = nearest_site(points, sites, method)
    return mean_and_count_by(
        nearest, ["site"], "dist_km", digits=3, mean="average_distance", count=count
    ).orderBy(F.desc(count), F.asc("site"))


def _with_nearest(points: DataFrame, nearest: Column) -> DataFrame:
    """Points with the fields of the struct; `inline` keeps it from being computed per field."""
    return points.select("*", F.inline(F.array(nearest))).select(
        *points.columns, "site", "dist_km"
    ).filter(F.col("dist_km").isNotNull())


def _nearest_by_vector(points: DataFrame, sites: list[Row]) -> DataFrame:
    return _with_nearest(points, _nearest_of(sites)("lat", "lon"))


def _pair_distances():
    """Smallest distance of each row among (row, site) pairs sorted by row, and its pair.

    Workers may lack this package, so the functions they run refer to nothing in it.
    """
    diameter = 2 * contracts.EARTH_RADIUS_KM

    def smallest(row, lat, lon, site_lat, site_lon):
        half_lat = np.sin(np.radians(site_lat - lat) / 2)
        half_lon = np.sin(np.radians(site_lon - lon) / 2)
        chord = half_lat**2 + np.cos(np.radians(lat)) * np.cos(np.radians(site_lat)) * half_lon**2
        dist = diameter * np.arcsin(np.sqrt(np.clip(chord, 0.0, 1.0)))
        first = np.flatnonzero(np.diff(row, prepend=-1))
        ties = np.flatnonzero(dist == np.minimum.reduceat(dist, first)[row])
        best = ties[np.flatnonzero(np.diff(row[ties], prepend=-1))]
        return dist[best], best

    return smallest


def _nearest_of(sites: list[Row]):
    """UDF over these sites.

    The product of unit vectors rules out nearly all pairs; its error is far
    below the margin. What is left is compared by distance.
    """
    sites = sorted(sites, key=lambda row: row.site)
    names = np.array([row.site for row in sites], dtype=object)
    site_lat = np.array([row.site_lat for row in sites])
    site_lon = np.array([row.site_lon for row in sites])
    smallest = _pair_distances()
    margin = 1e-13

    def unit_vectors(lat, lon):
        lat, lon = np.radians(np.fmod(lat, 360)), np.radians(np.fmod(lon, 360))
        return np.stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)])

    site_vectors = unit_vectors(site_lat, site_lon)

    @F.arrow_udf("dist_km double, site string")
    def nearest(lat: pa.Array, lon: pa.Array) -> pa.Array:
        lat, lon = lat.to_numpy(zero_copy_only=False), lon.to_numpy(zero_copy_only=False)
        closeness = unit_vectors(lat, lon).T @ site_vectors
        row, site = np.nonzero(closeness >= closeness.max(axis=1, keepdims=True) - margin)
        dist, best = smallest(row, lat[row], lon[row], site_lat[site], site_lon[site])
        return pa.StructArray.from_arrays(
            [pa.array(dist), pa.array(names[site[best]], pa.string())], ["dist_km", "site"]
        )

    return nearest


def _nearest_listed():
    """UDF over a list of sites per point: smallest distance and its place in the list."""
    smallest = _pair_distances()

    @F.arrow_udf("dist_km double, at int")
    def nearest(lat: pa.Array, lon: pa.Array, lats: pa.Array, lons: pa.Array) -> pa.Array:
        lat, lon = lat.to_numpy(zero_copy_only=False), lon.to_numpy(zero_copy_only=False)
        counts = lats.value_lengths().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(counts)), counts)
        site_lat, site_lon = lats.flatten().to_numpy(), lons.flatten().to_numpy()
        dist, best = smallest(row, lat[row], lon[row], site_lat, site_lon)
        at = best - (np.cumsum(counts) - counts)
        return pa.StructArray.from_arrays(
            [pa.array(dist), pa.array(at, pa.int32())], ["dist_km", "at"]
        )

    return nearest


def _nearest_by_array(points: DataFrame, sites: list[Row]) -> DataFrame:
    """A distance per site, each an expression of its own: these are compiled, functions over elements are not."""
    each = [
        F.struct(
            haversine_km(F.col("lat"), F.col("lon"), F.lit(s.site_lat), F.lit(s.site_lon)).alias("dist_km"),
            F.lit(s.site).alias("site"),
        )
        for s in sites
    ]
    placed = points.withColumn("nearest", F.array_min(F.array(*each)))
    return _with_nearest(placed, F.col("nearest")).drop("nearest")


def _cell_index(degrees: str, side: float) -> Column:
    return F.floor(F.pmod(F.col(degrees), F.lit(360.0)) / side)


def _cells(side: float) -> dict[str, Column]:
    return {"cell_lat": _cell_index("lat", side), "cell_lon": _cell_index("lon", side)}


def _coarser(level: int) -> dict[str, Column]:
    """Cells of a level from those of the last."""
    return {cell: F.floor(F.col(cell) / 4 ** (len(_CELL_SIDES) - 1 - level)) for cell in _CELL}


def _first_level(fine: DataFrame) -> tuple[int, int, list[int]]:
    """Last level that has few cells, by an estimate, number of points, and the estimated cells per level."""
    levels = range(min(_ESTIMATED, len(_CELL_SIDES)))
    counts = fine.agg(
        F.sum("cell_points"),
        F.count("*"),
        *[F.approx_count_distinct(F.xxhash64(*_coarser(level).values())) for level in levels],
    ).first()
    few = [level for level in levels if counts[2 + level] <= _FIRST_CELLS]
    below = [counts[1]] * (len(_CELL_SIDES) - len(levels))  # no more than there are smallest cells
    return max(few, default=0), counts[0] or 0, [*counts[2:], *below]


def _candidates(points: DataFrame, sites: DataFrame) -> tuple[DataFrame, float, bool]:
    """Sites that can be nearest in each cell with points, and the side of the cells.

    The last value tells whether a cell has too many of them for a list.

    With ``r`` the farthest any point of a cell is from its centre, a site over
    ``2 r`` farther from the centre than the closest one cannot be nearest to
    any point of the cell. The few cells of the first level, no more than there are
    on the globe, are an array in each site's row. Each step quarters the sides, and
    what passes meets the cells inside its cell by an equi-join, so sites meet only
    the cells around them. It ends when a point has few sites to look at on average.

    The points are read once, into counts of the smallest cells. Each step
    writes one table and reads two numbers. A join with a written table is
    planned by its size: broadcast if small, and else shuffled on both sides, so
    that adaptive execution can split a crowded cell.
    """
    fine = materialise(
        points.select(*[index.alias(cell) for cell, index in _cells(_CELL_SIDES[-1]).items()])
        .groupBy(*_CELL)
        .agg(F.count("*").alias("cell_points")),
        "fine-cells",
    )
    level, all_points, cells_of = _first_level(fine)
    if not all_points:
        none = {cell: F.lit(0).cast("bigint") for cell in _CELL}
        return sites.limit(0).withColumns(none), _CELL_SIDES[0], False
    pool, above = None, level
    while True:
        side = _CELL_SIDES[level]
        cells = (
            fine.withColumns(_coarser(level))
            .groupBy(*_CELL)
            .agg(F.sum("cell_points").alias("cell_points"))
        )
        if pool is None:
            listed = F.array(
                *[
                    F.struct(*[F.lit(row[name]).alias(name) for name in cells.columns])
                    for row in cells.collect()
                ]
            )
            pairs = sites.select("*", F.inline(listed))
        else:
            inside = {parent: F.floor(F.col(cell) / 4 ** (level - above)) for parent, cell in zip(_PARENT, _CELL)}
            pairs = pool.join(cells.withColumns(inside), _PARENT).drop(*_PARENT)
        centre_lat = (F.col("cell_lat") + 0.5) * side
        centre_lon = (F.col("cell_lon") + 0.5) * side
        pairs = pairs.withColumn(
            "dist_km", haversine_km(centre_lat, centre_lon, F.col("site_lat"), F.col("site_lon"))
        )
        closest = pairs.groupBy(*_CELL).agg(F.min("dist_km").alias("closest_km"))
        radius = contracts.EARTH_RADIUS_KM * math.radians(side / 2) * math.sqrt(2)
        near = pairs.join(closest, _CELL).filter(
            F.col("dist_km") <= F.col("closest_km") + 2 * radius + _ROUNDING_KM
        )
        near = materialise(near.select(*_CELL, "cell_points", "site", "site_lat", "site_lon"), "near")
        sizes = near.groupBy(*_CELL).agg(
            F.count("*").alias("cell_sites"), F.sum("cell_points").alias("looks")
        )
        looks, largest, each = sizes.agg(F.sum("looks"), F.max("cell_sites"), F.avg("cell_sites")).first()
        near = near.drop("cell_points")
        if (looks or 0) <= _SITES_PER_POINT * all_points or level + 1 == len(_CELL_SIDES):
            break
        pool, above = near.withColumnsRenamed(dict(zip(_CELL, _PARENT))), level
        deeper = range(level + 1, len(_CELL_SIDES))
        level = max((at for at in deeper if each * cells_of[at] <= _PAIRS), default=level + 1)
    return near, side, (largest or 0) > _SITES_PER_LIST


def _nearest_by_grid(points: DataFrame, sites: DataFrame) -> DataFrame:
    """Equi-join of points and candidates on the cell.

    The candidates were written, so the planner knows their size and broadcasts
    them if they are small. Otherwise both sides are shuffled on the cell, and
    adaptive execution splits the points of a crowded one. Cells with too many
    candidates for a list take them row by row, once per spot with points.
    """
    # Of several sites at one place only the smallest name can win.
    places = sites.groupBy("site_lat", "site_lon").agg(F.min("site").alias("site"))
    near, side, any_crowded = _candidates(points, materialise(places, "sites"))
    listed = near
    if any_crowded:
        sizes = near.groupBy(*_CELL).agg(F.count("*").alias("cell_sites"))
        crowded = sizes.filter(F.col("cell_sites") > _SITES_PER_LIST).select(*_CELL)
        crowded = materialise(crowded, "crowded-cells")
        listed = near.join(crowded, _CELL, "left_anti")
    lists = listed.groupBy(*_CELL).agg(
        F.sort_array(F.collect_list(F.struct("site", "site_lat", "site_lon"))).alias("sites")
    )
    lists = materialise(
        lists.select(*_CELL, "sites.site", "sites.site_lat", "sites.site_lon"), "lists"
    )
    placed = points.withColumns(_cells(side))
    found = _nearest_listed()("lat", "lon", "site_lat", "site_lon")
    # A point that no list covers was not there when the lists were made: fail, do not lose it.
    missing = F.raise_error(F.lit("the points changed while their cells were read"))
    joined = placed if not any_crowded else placed.join(crowded, _CELL, "left_anti")
    joined = joined.join(lists, _CELL, "left")
    if not sites.isEmpty():
        joined = joined.withColumn("site", F.when(F.col("site").isNotNull(), F.col("site")).otherwise(missing))
    else:
        joined = joined.filter("site is not null")
    nearest = (
        joined.select(*points.columns, F.col("site").alias("sites"), F.inline(F.array(found)))
        .select(*points.columns, F.get("sites", F.col("at")).alias("site"), "dist_km")
    )
    if not any_crowded:
        return nearest
    inside = placed.join(crowded, _CELL, "left_semi")
    spots = inside.select(*_CELL, "lat", "lon").distinct()
    dist = haversine_km(F.col("lat"), F.col("lon"), F.col("site_lat"), F.col("site_lon"))
    closest = (
        spots.join(near, _CELL)
        .groupBy("lat", "lon")
        .agg(F.min(F.struct(dist.alias("dist_km"), "site")).alias("closest"))
        .select("lat", "lon", "closest.site", "closest.dist_km")
    )
    rows = hot_key_join(inside.drop(*_CELL), closest, ["lat", "lon"])
    return nearest.unionByName(rows.select(*nearest.columns))
