"""DuckDB SQL with the answer of each registered query.

Where Spark rounds, it rounds the shortest decimal text of the double half up;
a cast to a long decimal before rounding does the same here.
"""

from civiclens.plans.inputs import SQL


def _with(*names: str, **more: str) -> str:
    parts = {**{name: SQL[name] for name in names}, **more}
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in parts.items()) + "\n"


def _half_up(value: str, digits: int) -> str:
    return f"round(({value})::DECIMAL(38, 10), {digits})::DOUBLE"


def _haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    chord = (
        f"power(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * "
        f"cos(radians({lat2})) * power(sin(radians({lon2} - {lon1}) / 2), 2)"
    )
    return f"2 * 6371.0::DOUBLE * asin(sqrt(least(1.0::DOUBLE, {chord})))"


_DAY_PART = """CASE
    WHEN t >= 500 AND t < 1200 THEN 'morning'
    WHEN t >= 1200 AND t < 1700 THEN 'afternoon'
    WHEN t >= 1700 AND t < 2100 THEN 'evening'
    WHEN t >= 2100 OR t < 500 THEN 'night' END"""

_TIME = """CASE WHEN regexp_full_match(time_text, '[+-]?[0-9]+')
      THEN try_cast(time_text AS INTEGER) END"""

_PARTS = f"""SELECT event_id, place, {_DAY_PART} AS day_part
    FROM (SELECT *, {_TIME} AS t FROM crimes)"""


def _share(strict: bool = False, label: str = "") -> str:
    where = " AND day_part IS NOT NULL" if strict else ""
    percent = _half_up("crimes / sum(crimes) OVER () * 100", 2)
    return f"""SELECT {label} day_part, crimes, {percent} AS percentage
      FROM (SELECT day_part, count(*) AS crimes FROM parts
            WHERE place = 'click'{where} GROUP BY day_part)"""


_DAYS = """SELECT o_orderkey, CAST(coalesce(
      try_strptime(date_text, '%Y %b %d %I:%M:%S %p'),
      try_strptime(date_text, '%m/%d/%Y %I:%M:%S %p')) AS DATE) AS day, date_text
    FROM dates"""

_TOP_MONTHS = _with(
    "dates",
    days=_DAYS,
    months="""SELECT CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month,
        count(*) AS crime_total FROM days WHERE day IS NOT NULL GROUP BY ALL""",
    ranked="""SELECT *, CAST(row_number() OVER (
        PARTITION BY year ORDER BY crime_total DESC, month) AS INTEGER) AS ranking FROM months""",
) + "SELECT * FROM ranked WHERE ranking <= 3 ORDER BY year, ranking"

_MONEY = "try_cast(regexp_replace(income_text, '[$,]', '', 'g') AS INTEGER)"
_EARNED = f"""SELECT zip, {_MONEY} AS median_income FROM income
    WHERE {_MONEY} IS NOT NULL"""
_EARNED_FILE = _EARNED + " AND zip <> ''"  # an empty field of a file is a missing one
_BY_ZIP = """SELECT zip, CAST(sum(pop) AS BIGINT) AS total_pop,
      CAST(sum(households) AS BIGINT) AS total_households
    FROM blocks WHERE zip IS NOT NULL GROUP BY zip HAVING sum(pop) > 0"""
_BY_ZIP_STRICT = """SELECT zip, CAST(sum(coalesce(pop, 0)) AS BIGINT) AS total_pop,
      CAST(sum(coalesce(households, 0)) AS BIGINT) AS total_households
    FROM blocks WHERE zip <> '' GROUP BY zip HAVING sum(coalesce(pop, 0)) > 0"""
_ZIPS = _with("blocks", "income", earned=_EARNED, by_zip=_BY_ZIP)
_ZIPS_STRICT = _with("blocks", "income", earned=_EARNED, by_zip=_BY_ZIP_STRICT)
_JOINED = """SELECT zip, total_pop, total_households, median_income
    FROM by_zip JOIN earned USING (zip)"""
_RATIO = _half_up("median_income * total_households / total_pop", 2)
_PER_CAPITA = f"""SELECT zip, total_pop, total_households, median_income,
      {_RATIO} AS per_capita_income
    FROM by_zip JOIN earned USING (zip)
    ORDER BY per_capita_income DESC NULLS LAST, zip, median_income"""

_BLOCKS = _with("blocks") + "SELECT zip, pop, households FROM blocks"

_KNOWN = """SELECT * FROM points
    WHERE lat IS NOT NULL AND lon IS NOT NULL AND lat <> 0 AND lon <> 0"""


def _nearest(sites: str, points: str = "points") -> str:
    dist = _haversine("p.lat", "p.lon", "s.lat", "s.lon")
    return _with(
        points,
        sites,
        known=_KNOWN.replace("points", points),
        pairs=f"""SELECT id, site, {dist} AS dist_km FROM known p, {sites} s
            WHERE s.lat IS NOT NULL AND s.lon IS NOT NULL""",
        nearest="""SELECT * FROM pairs
            QUALIFY row_number() OVER (PARTITION BY id ORDER BY dist_km, site) = 1""",
    )


def _nearest_rows(sites: str, points: str = "points") -> str:
    return _nearest(sites, points) + "SELECT id, site, round(dist_km, 6) AS dist_km FROM nearest"


_SUMMARY = f"""SELECT site, {_half_up('avg(dist_km)', 3)} AS average_distance,
    count(*) AS n_points FROM nearest GROUP BY site"""


def _labelled(select: str, column: str, labels: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{label}' AS {column}, * FROM ({select})" for label in labels)


_STRATEGIES = ["DEFAULT", "BROADCAST", "MERGE", "SHUFFLE_HASH", "REPLICATE_HOT_KEYS"]
_CRIME_TEXT = """SELECT CAST(event_id AS VARCHAR) AS event_id, time_text, place FROM crimes"""

ORACLES = {
    "scan_csv": """SELECT CAST(event_id AS VARCHAR) AS event_id,
        CAST(user_id AS VARCHAR) AS user_id, event_type, props FROM events""",
    "scan_csv_quoted": """SELECT CAST(event_id AS VARCHAR) AS event_id,
        'say "' || event_type || '", ' || props AS remark, event_type || '\\' AS path FROM events""",
    "scan_csv_semicolon": _with("income")
    + "SELECT nullif(zip, '') AS zip, community, income_text FROM income",
    "scan_feature_collection": _BLOCKS,
    "explode_features": _with("blocks")
    + """SELECT pop, count(*) AS n, CAST(sum(households) AS BIGINT) AS households
        FROM blocks GROUP BY pop""",
    "scan_whole_file_json": _BLOCKS,
    "scan_csv_line_breaks": """SELECT CAST(event_id AS VARCHAR) AS event_id,
        event_type || ': "' || props || '"' || chr(10) || CASE WHEN event_id % 3 = 0 THEN chr(10) ELSE '' END
          || user_id AS remark, event_type FROM events""",
    "scan_feature_document": _BLOCKS,
    "scan_text_lines_after_header": """SELECT CASE WHEN event_id % 40 = 3 THEN 'event_id,time_text,place'
        ELSE event_id || ',' || event_type END AS line FROM events""",
    "dense_row_keys": _with("crimes")
    + """SELECT place, time_text, row_number() OVER (
          ORDER BY time_text NULLS FIRST, place NULLS FIRST) - 1 AS row_key FROM crimes""",
    "exact_means": f"""SELECT event_type,
        {_half_up("sum((value / 7)::DECIMAL(38, 18))::DOUBLE / count(value)", 9)} AS mean_value,
        count(*) AS n FROM events GROUP BY event_type""",
    "join_hot_both_sides": """WITH o AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE o_orderkey % 50 END AS key,
          o_custkey AS customer FROM orders),
        s AS (SELECT CASE WHEN s_suppkey % 3 = 0 THEN -1 ELSE s_suppkey % 50 END AS key, s_suppkey FROM supplier)
        SELECT key, count(*) AS n, CAST(sum(customer * s_suppkey) AS BIGINT) AS total
        FROM o JOIN s USING (key) GROUP BY key""",
    "join_chosen": """SELECT 'REPLICATE_HOT_KEYS' AS strategy, '-1' AS hot_keys, count(*) AS n,
        CAST(sum(o_custkey * (key + 2)) AS BIGINT) AS checksum
        FROM (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE o_orderkey % 50 END AS key FROM orders)""",
    "sites_within_km": _with("points", "depots", known=_KNOWN)
    + f"""SELECT id, site, round(dist_km, 6) AS dist_km FROM (
          SELECT id, site, {_haversine("p.lat", "p.lon", "s.lat", "s.lon")} AS dist_km
          FROM known p, depots s WHERE s.lat IS NOT NULL) WHERE dist_km <= 3""",
    "convert_resumed": _with("crimes") + _CRIME_TEXT,
    "value_profile": """WITH v AS (SELECT CAST(o_orderkey AS VARCHAR) AS whole, CAST(o_custkey / 4 AS VARCHAR) AS fraction,
          strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderstatus AS status,
          CASE WHEN o_orderkey % 50 = 1 THEN 'none' WHEN o_orderkey % 7 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS mixed,
          CAST(NULL AS VARCHAR) AS missing FROM orders),
        long AS (SELECT 'whole' AS column_name, whole AS text FROM v UNION ALL SELECT 'fraction', fraction FROM v
          UNION ALL SELECT 'day', day FROM v UNION ALL SELECT 'status', status FROM v
          UNION ALL SELECT 'mixed', mixed FROM v UNION ALL SELECT 'missing', missing FROM v)
        SELECT column_name, count(*) AS row_count, count(text) AS non_null_count,
          CAST(min(length(text)) AS INTEGER) AS shortest, CAST(max(length(text)) AS INTEGER) AS longest,
          CASE WHEN count(text) = 0 THEN NULL
            WHEN count(try_cast(CASE WHEN NOT contains(text, '.') THEN text END AS BIGINT)) = count(text) THEN 'BIGINT'
            WHEN count(try_cast(text AS DOUBLE)) = count(text) THEN 'DOUBLE'
            WHEN count(try_cast(text AS DATE)) = count(text) THEN 'DATE' ELSE 'STRING' END AS fits,
          TRUE AS distinct_within_bound
        FROM long GROUP BY column_name""",
    "scan_parquet_pruned": "SELECT l_orderkey, l_quantity FROM lineitem",
    "scan_text_lines": _with("crimes")
    + "SELECT event_id || ',' || coalesce(time_text, '') || ',' || place AS line FROM crimes",
    "parse_csv_lines": "SELECT event_id, event_type, props FROM events",
    "parse_split_lines": _with("income")
    + "SELECT zip, income_text FROM income WHERE zip NOT LIKE '%01'",
    "load_union": """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
        CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus FROM orders""",
    "dataset_profile": _with("dates")
    + """SELECT 'o_orderkey' AS column_name, count(*) AS row_count,
          count(o_orderkey) AS non_null_count FROM dates
        UNION ALL SELECT 'date_text', count(*), count(date_text) FROM dates""",
    "csv_to_parquet": _with("crimes") + _CRIME_TEXT,
    "format_equivalence": _with("crimes", parts=_PARTS)
    + _labelled(_share(), "format", ["csv", "parquet"]),
    "timer_log_extract": """SELECT event_type AS source,
        event_type || ' (user=' || user_id || '): wall' AS timer_label,
        value AS seconds FROM events""",
    "filter_equals": _with("crimes") + "SELECT * FROM crimes WHERE place = 'click'",
    "filter_valid": _with("dates", days=_DAYS)
    + "SELECT o_orderkey, date_text FROM days WHERE day IS NOT NULL",
    "filter_sentinel_coords": _with("points", known=_KNOWN) + "SELECT id FROM known",
    "having_positive": _with("blocks", by_zip=_BY_ZIP) + "SELECT * FROM by_zip",
    "lenient_int": _with("crimes")
    + f"SELECT event_id, {_TIME} AS time_number FROM crimes",
    "money_to_int": _with("income")
    + f"SELECT zip, community, {_MONEY} AS median_income FROM income",
    "parse_date_multi": _with("dates", days=_DAYS) + "SELECT o_orderkey, day FROM days",
    "day_part_case": _with("crimes", parts=_PARTS) + "SELECT event_id, day_part FROM parts",
    "haversine_km": _with("points", "sites", known=_KNOWN)
    + f"""SELECT p.id, s.site,
          round({_haversine("p.lat", "p.lon", "s.lat", "s.lon")}, 6) AS dist_km
        FROM known p JOIN customer c ON c.c_custkey = p.customer
        JOIN sites s ON s.nation = c.c_nationkey""",
    "count_by_key": _with("crimes")
    + "SELECT place, time_text, count(*) AS n FROM crimes GROUP BY place, time_text",
    "sum_by_key": _with("blocks")
    + """SELECT zip, CAST(sum(pop) AS BIGINT) AS total_pop,
          CAST(sum(households) AS BIGINT) AS total_households FROM blocks GROUP BY zip""",
    "argmin_struct": """SELECT o_custkey, o_totalprice, o_orderkey FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) = 1""",
    "share_of_total": _with("crimes", parts=_PARTS) + _share(),
    "share_of_total_strict": _with("crimes", parts=_PARTS) + _share(strict=True),
    "day_part_udf": _with("crimes", parts=_PARTS) + _share(),
    "top_months": _TOP_MONTHS,
    "top_months_sql": _TOP_MONTHS,
    "join_inner_equi": _ZIPS + _JOINED,
    "join_hint_broadcast": _ZIPS + _JOINED,
    "join_hint_merge": _ZIPS + _JOINED,
    "join_hint_shuffle_hash": _ZIPS + _JOINED,
    "join_replicate_hot_keys": _ZIPS + _JOINED,
    "join_strategy_matrix": _ZIPS
    + _labelled(
        f"""SELECT count(*) AS n_rows, CAST(sum(total_pop + median_income) AS BIGINT) AS checksum
            FROM ({_JOINED})""",
        "strategy",
        _STRATEGIES,
    ),
    "per_capita_income": _ZIPS + _PER_CAPITA,
    "per_capita_strict": _ZIPS_STRICT + _PER_CAPITA,
    "top_k_per_capita": _ZIPS_STRICT + _PER_CAPITA + " LIMIT 20",
    "nearest_site": _nearest_rows("sites"),
    "nearest_site_array": _nearest_rows("sites"),
    "nearest_site_dense": _nearest_rows("dense_sites", "dense_points"),
    "nearest_site_grid": _nearest_rows("depots"),
    "nearest_summary": _nearest("sites") + _SUMMARY,
    "nearest_summary_grid": _nearest("depots") + _SUMMARY,
    "convert_features": _BLOCKS,
    "share_from_files": _with("crimes", parts=_PARTS) + _share(),
    "top_months_from_files": _TOP_MONTHS,
    "per_capita_from_files": _with("blocks", "income", earned=_EARNED_FILE, by_zip=_BY_ZIP)
    + _PER_CAPITA,
    "per_capita_strict_from_files": _ZIPS_STRICT + _PER_CAPITA,
    "nearest_from_files": _nearest("sites") + _SUMMARY,
    "nearest_strategy_matrix": _nearest("sites")
    + _labelled(_SUMMARY, "strategy", ["vector", "array", "grid"]),
}
