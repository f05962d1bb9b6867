"""Registered queries: every operator over the driver's tables.

A key that is about a file format writes the derived input in that format to
the shared scratch folder first, then reads it back.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiclens import contracts
from civiclens.functions.buckets import day_part
from civiclens.functions.geo import haversine_km, is_known_location
from civiclens.functions.parsing import lenient_int, money_to_int, parse_date_any
from civiclens.operators.aggregates import (
    COPIES,
    argmin_by,
    count_by,
    exact_mean_and_count_by,
    sum_by,
    unfold_copies,
)
from civiclens.operators.joins import STRATEGIES, choose_strategy, equi_join, grid_join, strategy_matrix
from civiclens.operators.nearest import METHODS, nearest_site, nearest_summary
from civiclens.operators.numbering import dense_keys
from civiclens.operators.profile import dataset_profile, value_profile
from civiclens.operators.within import pairs_within
from civiclens.plans import families, inputs
from civiclens.scratch import materialise, scratch_path
from civiclens.sources.readers import (
    load_union,
    parse_csv_lines,
    parse_split_lines,
    read_csv,
    read_csv_by_ranges,
    read_features,
    read_features_by_ranges,
    read_features_whole_text,
    read_lines,
    read_parquet,
)
from civiclens.sources.writers import (
    convert_new,
    csv_to_parquet,
    features_to_parquet,
    read_converted,
    write_feature_document,
    write_features,
)

CLICK = "click"
WITHIN_KM = 3.0
BLOCK_PROPERTIES = T.StructType(
    [
        T.StructField("zip", T.StringType()),
        T.StructField("pop", T.LongType()),
        T.StructField("households", T.LongType()),
    ]
)


def _table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _written(spark: SparkSession, df: DataFrame, name: str, fmt: str, **options) -> str:
    path = scratch_path(spark, name)
    df.write.format(fmt).options(**options).save(path)
    return path


def _written_csv(spark, df, name, **options):
    return _written(spark, df, name, "csv", header=True, escape='"', **options)


def _crime_files(spark, folder) -> list[str]:
    crimes = inputs.crimes(spark, folder)
    click = F.col("place") == CLICK
    return [
        _written_csv(spark, crimes.filter(rows), name)
        for rows, name in ((click, "crimes-a"), (~click, "crimes-b"))
    ]


def _blocks(spark, folder):
    return families.blocks_with_zip(inputs.blocks(spark, folder))


def _income(spark, folder):
    return families.income_of(inputs.income(spark, folder), "zip", "income_text")


def _known_points(spark, folder):
    return families.known_locations(inputs.points(spark, folder))


# ---- scans ----------------------------------------------------------------------------


def scan_csv(spark, folder):
    events = _table(spark, folder, "events").select("event_id", "user_id", "event_type", "props")
    return read_csv(spark, _written_csv(spark, events, "events"))


def scan_csv_semicolon(spark, folder):
    income = inputs.income(spark, folder)
    return read_csv(spark, _written_csv(spark, income, "income", sep=";"), ";")


def scan_csv_quoted(spark, folder):
    """Text with doubled quotes, commas and a backslash at the end, written by hand as lines."""
    quoted = F.concat(
        F.lit('"say ""'), F.col("event_type"), F.lit('"", '), F.replace("props", F.lit('"'), F.lit('""')), F.lit('"')
    )
    path = F.concat(F.lit('"'), F.col("event_type"), F.lit('\\"'))
    events = _table(spark, folder, "events")
    lines = events.select(F.concat_ws(",", F.col("event_id").cast("string"), quoted, path).alias("event_id,remark,path"))
    options = {"header": True, "quote": "", "sep": "\x01", "escape": "\x02"}
    return read_csv(spark, _written(spark, lines, "quoted", "csv", **options))


def _feature_files(spark, folder) -> str:
    path = scratch_path(spark, "features")
    write_features(inputs.blocks(spark, folder), path, "block")
    return path


def scan_feature_collection(spark, folder):
    return read_features(spark, _feature_files(spark, folder), BLOCK_PROPERTIES)


def explode_features(spark, folder):
    features = read_features(spark, _feature_files(spark, folder), BLOCK_PROPERTIES)
    return features.groupBy("pop").agg(
        F.count("*").alias("n"), F.sum("households").alias("households")
    )


def scan_whole_file_json(spark, folder):
    return read_features_whole_text(spark, _feature_files(spark, folder), BLOCK_PROPERTIES)


def scan_parquet_pruned(spark, folder):
    return read_parquet(spark, f"{folder}/lineitem.parquet").select("l_orderkey", "l_quantity")


CRIME_HEADER = "event_id,time_text,place"


def scan_text_lines(spark, folder):
    first, second = (read_lines(spark, p, CRIME_HEADER) for p in _crime_files(spark, folder))
    return first.union(second)


def parse_csv_text(spark, folder):
    """Lines whose last field holds JSON text: quotes doubled, commas inside."""
    props = F.concat(F.lit('"'), F.replace("props", F.lit('"'), F.lit('""')), F.lit('"'))
    events = _table(spark, folder, "events")
    lines = events.select(F.concat_ws(",", F.col("event_id").cast("string"), "event_type", props))
    path = _written(spark, lines, "lines", "text")
    return parse_csv_lines(
        read_lines(spark, path), "event_id BIGINT, event_type STRING, props STRING"
    )


def parse_split_text(spark, folder):
    """Lines of ZIPs that end in 01 are one part short."""
    last = F.when(~F.col("zip").endswith("01"), F.col("income_text"))
    lines = inputs.income(spark, folder).select(F.concat_ws(";", "zip", "community", last))
    path = _written(spark, lines, "lines", "text")
    positions = {"zip": 0, "income_text": 2}
    return parse_split_lines(read_lines(spark, path), positions, sep=";", min_parts=3)


def load_union_by_name(spark, folder):
    orders = _table(spark, folder, "orders")
    filled = F.col("o_orderstatus") == "F"
    columns = ["o_orderkey", "o_custkey", "o_orderstatus"]
    paths = [
        _written_csv(spark, orders.filter(filled).select(*columns), "orders-a"),
        _written_csv(spark, orders.filter(~filled).select(*columns[::-1]), "orders-b"),
    ]
    return load_union([read_csv(spark, path) for path in paths], columns)


REMARKS = """concat(event_type, ': "', props, '"', chr(10), CASE WHEN event_id % 3 = 0 THEN chr(10) ELSE '' END, user_id)"""


def scan_csv_line_breaks(spark, folder):
    """Text with line breaks, quotes and commas, and blank lines within quotes; many tasks per file."""
    events = _table(spark, folder, "events").selectExpr("event_id", f"{REMARKS} AS remark", "event_type")
    return read_csv_by_ranges(spark, _written_csv(spark, events, "remarks"))


def scan_feature_document(spark, folder):
    """All features in one document, on one line, read by many tasks."""
    path = scratch_path(spark, "document")
    write_feature_document(inputs.blocks(spark, folder), path, "block")
    return read_features_by_ranges(spark, path, BLOCK_PROPERTIES)


def scan_text_lines_after_header(spark, folder):
    """Files whose data repeat the header: only the first line of each goes."""
    again = F.when(F.col("event_id") % 40 == 3, F.lit(CRIME_HEADER)).otherwise(
        F.concat_ws(",", F.col("event_id").cast("string"), "place")
    )
    text = inputs.crimes(spark, folder).select(again.alias(CRIME_HEADER))
    options = {"header": True, "quote": "", "sep": "\x01", "escape": "\x02"}
    return read_lines(spark, _written(spark, text, "lines", "csv", **options), skip_first=True)


def dense_row_keys(spark, folder):
    """Numbers of rows most of which are repeated."""
    return dense_keys(inputs.crimes(spark, folder).select("place", "time_text"), order=["time_text"])


def exact_means(spark, folder):
    events = _table(spark, folder, "events").selectExpr("event_type", "value / 7 AS value")
    return exact_mean_and_count_by(events, ["event_type"], "value", digits=9, mean="mean_value", count="n")


def join_hot_both_sides(spark, folder):
    """A third of the rows of either side have one key; rows and sums per key of what meets.

    A sum over pairs is one over the right rows of each times the left sum of its key, so the left rows of a key are
    summed before they meet and no pair is made of them. Sums are exact, as decimals; they are BIGINT unless one
    is beyond it.
    """
    hot = lambda number: F.when(number % 3 == 0, F.lit(-1)).otherwise(number % 50).alias("key")
    orders = _table(spark, folder, "orders").select(hot(F.col("o_orderkey")), F.col("o_custkey").alias("customer"))
    parts = _table(spark, folder, "supplier").select(hot(F.col("s_suppkey")), F.col("s_suppkey").alias("supplier"))
    whole = lambda name: F.col(name).cast("decimal(19,0)")
    left = orders.groupBy("key").agg(F.count("*").alias("orders"), F.sum(whole("customer")).alias("customers"))
    met = grid_join(left, parts, ["key"])
    sums = met.groupBy("key").agg(
        F.sum("orders").alias("n"), F.sum((F.col("customers") * whole("supplier")).cast("decimal(38,0)")).alias("total")
    )
    sums = materialise(sums, "sums")  # a row per key
    fit = sums.agg(F.bool_and(F.col("total").between(-(2**63), 2**63 - 1))).first()[0]
    return sums.withColumn("total", F.col("total").cast("bigint")) if fit in (True, None) else sums


def join_chosen(spark, folder):
    """A third of all orders has one key; with the strategy that the data call for if nothing may be broadcast."""
    key = F.when(F.col("o_orderkey") % 3 == 0, F.lit(-1)).otherwise(F.col("o_orderkey") % 50).alias("key")
    orders = _table(spark, folder, "orders").select(key, F.col("o_custkey").alias("customer"))
    keys = orders.select("key").distinct().withColumn("weight", F.col("key") + 2)
    strategy, hot = choose_strategy(keys, orders, ["key"], broadcast_rows=0, hot_share=10)
    joined = equi_join(keys, orders, ["key"], strategy, hot_share=10)
    sums = joined.agg(F.count("*").alias("n"), F.sum(F.col("customer") * F.col("weight")).alias("checksum"))
    hot = hot.agg(F.array_join(F.sort_array(F.collect_list(F.col("key").cast("string"))), ",").alias("hot_keys"))
    return sums.select(F.lit(strategy).alias("strategy"), hot.scalar().alias("hot_keys"), "n", "checksum")


def sites_within_km(spark, folder):
    pairs = pairs_within(_known_points(spark, folder), inputs.depots(spark, folder), WITHIN_KM)
    return pairs.select("id", "site", F.round("dist_km", 6).alias("dist_km"))


def convert_resumed(spark, folder):
    """One file is converted by a first run, and by the second only the other."""
    first, second = _crime_files(spark, folder)
    target = scratch_path(spark, "resumed")
    for paths, new in (([first], [first]), ([first, second], [second])):
        if convert_new(spark, paths, target) != new:
            raise ValueError("other files were converted than the new ones")
    return read_converted(spark, target)


def profile(spark, folder):
    return dataset_profile(inputs.dates(spark, folder))


def profile_of_values(spark, folder):
    """What is counted exactly, and whether the estimates keep their bounds against exact counts.

    KLL ranks are off by under 2 percent and HyperLogLog counts by under 10; the count of the most frequent value
    is off by less than the share that is not tracked.
    """
    table = _values(spark, folder)
    found = value_profile(table)
    exact = table.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.col(name).cast("string").alias("text")) for name in table.columns
    ])))
    exact = exact.groupBy("column_name").agg(F.countDistinct("text").alias("n"), F.mode("text", deterministic=True).alias("top"))
    checked = found.join(exact, "column_name")
    near = F.abs(F.col("distinct_estimate") - F.col("n")) <= 0.1 * F.col("n")
    names = ["column_name", "row_count", "non_null_count", "shortest", "longest", "fits"]
    return checked.select(*names, near.alias("distinct_within_bound"))


def _values(spark, folder):
    """Columns of each kind as text; the numbers and dates read as such, others have odd values among them."""
    return _table(spark, folder, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS whole", "CAST(o_custkey / 4 AS STRING) AS fraction",
        "date_format(o_orderdate, 'yyyy-MM-dd') AS day", "o_orderstatus AS status",
        "CASE WHEN o_orderkey % 50 = 1 THEN 'none' WHEN o_orderkey % 7 <> 0 THEN CAST(o_custkey AS STRING) END AS mixed",
        "CAST(NULL AS STRING) AS missing",
    )


# ---- conversion and logs --------------------------------------------------------------


def _converted(spark, csv_paths) -> list[str]:
    folders = {path: scratch_path(spark, "converted") for path in csv_paths}
    csv_to_parquet(spark, folders)
    return list(folders.values())


def convert_csv(spark, folder):
    paths = _converted(spark, _crime_files(spark, folder))
    return load_union([read_parquet(spark, path) for path in paths])


def format_equivalence(spark, folder):
    csv_paths = _crime_files(spark, folder)
    loads = {
        "csv": load_union([read_csv(spark, path) for path in csv_paths]),
        "parquet": load_union([read_parquet(spark, p) for p in _converted(spark, csv_paths)]),
    }
    return load_union(
        [
            families.day_part_share(crimes, CLICK).select(F.lit(fmt).alias("format"), "*")
            for fmt, crimes in loads.items()
        ]
    )


def timer_log_extract(spark, folder):
    """A log per event type; each timer line is followed by a line of another kind."""
    events = _table(spark, folder, "events")
    timer = F.format_string(
        "[TIMER] %s (user=%d): wall: %.3f s", F.col("event_type"), F.col("user_id"), F.col("value")
    )
    noise = F.concat(F.lit("INFO [TIMER] "), F.col("props"), F.lit(": 1.0 s"))
    lines = events.select("event_type", F.explode(F.array(timer, noise)).alias("value"))
    path = scratch_path(spark, "logs")
    lines.write.partitionBy("event_type").text(path)
    source = F.regexp_extract(F.col("_metadata.file_path"), "event_type=([^/]+)/", 1)
    return families.load_timers(spark, path, source)


# ---- the published files, by their loaders ----------------------------------------------


def _published_crimes(spark, table):
    """A crime file with the columns of the table under their published names; others are empty."""
    names = {
        "time_text": contracts.CRIME_TIME,
        "place": contracts.CRIME_PLACE,
        "date_text": contracts.CRIME_DATE,
        "lat": contracts.CRIME_LAT,
        "lon": contracts.CRIME_LON,
    }
    picked = [
        (F.col(name) if name in table.columns else F.lit(None)).cast("string").alias(published)
        for name, published in names.items()
    ]
    return families.load_crimes(spark, [_written_csv(spark, table.select(*picked), "crimes")])


def share_from_files(spark, folder):
    crimes = _published_crimes(spark, inputs.crimes(spark, folder))
    return families.day_part_share(crimes, CLICK)


def top_months_from_files(spark, folder):
    return families.top_months(_published_crimes(spark, inputs.dates(spark, folder)))


def _per_capita_files(strict):
    def query(spark, folder):
        blocks = inputs.blocks(spark, folder).withColumnsRenamed(
            {
                "zip": contracts.BLOCK_ZIP,
                "pop": contracts.BLOCK_POPULATION,
                "households": contracts.BLOCK_HOUSING,
            }
        )
        features = scratch_path(spark, "blocks")
        write_features(blocks, features, "block")
        income = inputs.income(spark, folder).withColumnsRenamed(
            {"zip": contracts.INCOME_ZIP, "income_text": contracts.INCOME_MEDIAN}
        )
        table = _written_csv(spark, income, "income", sep=contracts.INCOME_SEPARATOR)
        return families.per_capita(
            families.load_blocks(spark, features, strict=strict),
            families.load_income(spark, table, strict=strict),
            strict=strict,
        )

    return query


def nearest_from_files(spark, folder):
    stations = inputs.sites(spark, folder).select(
        F.col("site").alias(contracts.STATION_NAME),
        F.col("lat").alias(contracts.STATION_LAT),
        F.col("lon").alias(contracts.STATION_LON),
    )
    crimes = _published_crimes(spark, inputs.points(spark, folder))
    sites = families.load_stations(spark, _written_csv(spark, stations, "stations"))
    return nearest_summary(families.known_locations(crimes), sites)


def convert_features(spark, folder):
    path = scratch_path(spark, "converted")
    features_to_parquet(spark, _feature_files(spark, folder), path, BLOCK_PROPERTIES)
    return read_parquet(spark, path)


# ---- filters and functions ------------------------------------------------------------


def filter_equals(spark, folder):
    return inputs.crimes(spark, folder).filter(F.col("place") == CLICK)


def filter_valid(spark, folder):
    dates = inputs.dates(spark, folder)
    return dates.filter(parse_date_any(F.col("date_text")).isNotNull())


def filter_sentinel_coords(spark, folder):
    points = inputs.points(spark, folder)
    return points.filter(is_known_location(F.col("lat"), F.col("lon"))).select("id")


def having_positive(spark, folder):
    return families.by_zip(_blocks(spark, folder))


def lenient_int_of(spark, folder):
    return inputs.crimes(spark, folder).select(
        "event_id", lenient_int(F.col("time_text")).alias("time_number")
    )


def money_to_int_of(spark, folder):
    return inputs.income(spark, folder).select(
        "zip", "community", money_to_int(F.col("income_text")).alias("median_income")
    )


def parse_date_multi(spark, folder):
    return inputs.dates(spark, folder).select(
        "o_orderkey", parse_date_any(F.col("date_text")).alias("day")
    )


def day_part_case(spark, folder):
    return inputs.crimes(spark, folder).select(
        "event_id", day_part(F.col("time_text")).alias("day_part")
    )


def haversine_of(spark, folder):
    """Distance of each order's place to the site of its customer's nation."""
    homes = _table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer"), F.col("c_nationkey").alias("nation")
    )
    sites = inputs.sites(spark, folder).withColumnsRenamed({"lat": "site_lat", "lon": "site_lon"})
    dist = haversine_km(F.col("lat"), F.col("lon"), F.col("site_lat"), F.col("site_lon"))
    joined = _known_points(spark, folder).join(homes.join(sites, "nation"), "customer")
    return joined.select("id", "site", F.round(dist, 6).alias("dist_km"))


# ---- aggregates -----------------------------------------------------------------------


def count_by_key(spark, folder):
    return count_by(inputs.crimes(spark, folder), ["place", "time_text"])


def sum_by_key(spark, folder):
    sums = {"total_pop": "pop", "total_households": "households"}
    return sum_by(inputs.blocks(spark, folder), ["zip"], sums)


def argmin_struct(spark, folder):
    """Cheapest order of each customer by price; equal prices go to the smaller key."""
    orders = _table(spark, folder, "orders")
    return argmin_by(orders, ["o_custkey"], "o_totalprice", "o_orderkey")


def share_of_total(spark, folder):
    return families.day_part_share(inputs.crimes(spark, folder), CLICK)


def share_of_total_strict(spark, folder):
    return families.day_part_share(inputs.crimes(spark, folder), CLICK, strict=True)


def day_part_udf(spark, folder):
    return families.day_part_share(inputs.crimes(spark, folder), CLICK, udf=True)


def top_months(spark, folder):
    return families.top_months(inputs.dates(spark, folder))


def top_months_sql(spark, folder):
    return families.top_months_sql(inputs.dates(spark, folder))


# ---- joins ----------------------------------------------------------------------------


def _joined_by(strategy):
    def query(spark, folder):
        rows = families.zip_income(_blocks(spark, folder), _income(spark, folder), strategy)
        return unfold_copies(rows)

    return query


def join_strategy_matrix(spark, folder):
    blocks, income = _blocks(spark, folder), _income(spark, folder)

    def digest(strategy):
        rows = families.zip_income(blocks, income, strategy)
        value = F.col("total_pop") + F.col("median_income")
        return rows.agg(
            F.sum(COPIES).alias("n_rows"), F.sum(value * F.col(COPIES)).alias("checksum")
        )

    return strategy_matrix(digest, STRATEGIES)


def per_capita_income(spark, folder):
    return families.per_capita(_blocks(spark, folder), _income(spark, folder))


def per_capita_strict(spark, folder):
    blocks = families.blocks_with_zip(inputs.blocks(spark, folder), strict=True)
    return families.per_capita(blocks, _income(spark, folder), strict=True)


def top_k_per_capita(spark, folder):
    blocks = families.blocks_with_zip(inputs.blocks(spark, folder), strict=True)
    return families.top_per_capita(blocks, _income(spark, folder), 20, strict=True)


# ---- nearest site ---------------------------------------------------------------------


def _nearest_by(method, sites):
    def query(spark, folder):
        nearest = nearest_site(_known_points(spark, folder), sites(spark, folder), method)
        return nearest.select("id", "site", F.round("dist_km", 6).alias("dist_km"))

    return query


def nearest_site_dense(spark, folder):
    nearest = nearest_site(inputs.dense_points(spark, folder), inputs.dense_sites(spark, folder), "grid")
    return nearest.select("id", "site", F.round("dist_km", 6).alias("dist_km"))


def _summary_by(method, sites):
    def query(spark, folder):
        return nearest_summary(_known_points(spark, folder), sites(spark, folder), method)

    return query


def nearest_strategy_matrix(spark, folder):
    points, sites = _known_points(spark, folder), inputs.sites(spark, folder)
    return strategy_matrix(lambda method: nearest_summary(points, sites, method), METHODS)


QUERIES = {
    "scan_csv": scan_csv,
    "scan_csv_quoted": scan_csv_quoted,
    "scan_csv_semicolon": scan_csv_semicolon,
    "scan_feature_collection": scan_feature_collection,
    "explode_features": explode_features,
    "scan_whole_file_json": scan_whole_file_json,
    "scan_parquet_pruned": scan_parquet_pruned,
    "scan_text_lines": scan_text_lines,
    "parse_csv_lines": parse_csv_text,
    "parse_split_lines": parse_split_text,
    "scan_csv_line_breaks": scan_csv_line_breaks,
    "scan_feature_document": scan_feature_document,
    "scan_text_lines_after_header": scan_text_lines_after_header,
    "dense_row_keys": dense_row_keys,
    "exact_means": exact_means,
    "value_profile": profile_of_values,
    "join_hot_both_sides": join_hot_both_sides,
    "join_chosen": join_chosen,
    "sites_within_km": sites_within_km,
    "convert_resumed": convert_resumed,
    "load_union": load_union_by_name,
    "dataset_profile": profile,
    "csv_to_parquet": convert_csv,
    "format_equivalence": format_equivalence,
    "timer_log_extract": timer_log_extract,
    "filter_equals": filter_equals,
    "filter_valid": filter_valid,
    "filter_sentinel_coords": filter_sentinel_coords,
    "having_positive": having_positive,
    "lenient_int": lenient_int_of,
    "money_to_int": money_to_int_of,
    "parse_date_multi": parse_date_multi,
    "day_part_case": day_part_case,
    "haversine_km": haversine_of,
    "count_by_key": count_by_key,
    "sum_by_key": sum_by_key,
    "argmin_struct": argmin_struct,
    "share_of_total": share_of_total,
    "share_of_total_strict": share_of_total_strict,
    "day_part_udf": day_part_udf,
    "top_months": top_months,
    "top_months_sql": top_months_sql,
    "join_inner_equi": _joined_by(None),
    "join_hint_broadcast": _joined_by("BROADCAST"),
    "join_hint_merge": _joined_by("MERGE"),
    "join_hint_shuffle_hash": _joined_by("SHUFFLE_HASH"),
    "join_replicate_hot_keys": _joined_by("REPLICATE_HOT_KEYS"),
    "join_strategy_matrix": join_strategy_matrix,
    "per_capita_income": per_capita_income,
    "per_capita_strict": per_capita_strict,
    "top_k_per_capita": top_k_per_capita,
    "nearest_site": _nearest_by(None, inputs.sites),
    "nearest_site_array": _nearest_by("array", inputs.sites),
    "nearest_site_grid": _nearest_by("grid", inputs.depots),
    "nearest_site_dense": nearest_site_dense,
    "share_from_files": share_from_files,
    "top_months_from_files": top_months_from_files,
    "per_capita_from_files": _per_capita_files(strict=False),
    "per_capita_strict_from_files": _per_capita_files(strict=True),
    "nearest_from_files": nearest_from_files,
    "convert_features": convert_features,
    "nearest_summary": _summary_by(None, inputs.sites),
    "nearest_summary_grid": _summary_by("grid", inputs.depots),
    "nearest_strategy_matrix": nearest_strategy_matrix,
}
