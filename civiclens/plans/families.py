"""The four families of question, over any input with the right columns.

Loaders turn the published files into the columns the queries use: crimes into
``time_text``, ``place``, ``date_text``, ``lat``, ``lon``; blocks into ``zip``,
``pop``, ``households``; income into ``zip``, ``median_income``; stations into
``site``, ``lat``, ``lon``.
"""

import re
from collections.abc import Sequence
from string import Template

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclens import contracts
from civiclens.functions.buckets import day_part, day_part_udf
from civiclens.functions.geo import is_known_location
from civiclens.functions.parsing import (
    lenient_double,
    money_to_int,
    parse_date_any,
    timer_label,
    timer_seconds,
)
from civiclens.operators.aggregates import (
    COPIES,
    fold_copies,
    share_of_total,
    sum_by,
    unfold_copies,
    weighted_ratio,
)
from civiclens.operators.joins import equi_join, feasible
from civiclens.operators.ranking import top_k, top_n_per_group
from civiclens.sources.readers import (
    load_union,
    parse_split_lines,
    read_csv,
    read_features,
    read_features_whole_text,
    read_lines,
    source_name,
)

# ---- loaders --------------------------------------------------------------------------


def crime_columns(crimes: DataFrame) -> DataFrame:
    """Crime records of any format under the names the queries use."""
    return crimes.select(
        F.col(f"`{contracts.CRIME_TIME}`").alias("time_text"),
        F.col(f"`{contracts.CRIME_PLACE}`").alias("place"),
        F.col(f"`{contracts.CRIME_DATE}`").alias("date_text"),
        lenient_double(F.col(contracts.CRIME_LAT)).alias("lat"),
        lenient_double(F.col(contracts.CRIME_LON)).alias("lon"),
    )


def load_crimes(spark: SparkSession, paths: Sequence[str], fmt: str = "csv") -> DataFrame:
    """Crime files, CSV or converted to Parquet. What a query leaves out is not read."""
    frames = [
        read_csv(spark, path) if fmt == "csv" else spark.read.parquet(path) for path in paths
    ]
    return load_union([crime_columns(frame) for frame in frames])


def load_blocks(spark: SparkSession, path: str, *, strict: bool = False) -> DataFrame:
    """Census blocks with a ZIP; ``strict`` reads whole texts and drops empty ZIPs too."""
    features = (read_features_whole_text if strict else read_features)(spark, path)
    blocks = features.select(
        F.col(contracts.BLOCK_ZIP).alias("zip"),
        F.col(contracts.BLOCK_POPULATION).alias("pop"),
        F.col(contracts.BLOCK_HOUSING).alias("households"),
    )
    return blocks_with_zip(blocks, strict=strict)


def load_income(spark: SparkSession, path: str, *, strict: bool = False) -> DataFrame:
    """Income per ZIP; ``strict`` reads the header line and splits lines without regard to quotes."""
    if not strict:
        return income_of(
            read_csv(spark, path, contracts.INCOME_SEPARATOR),
            contracts.INCOME_ZIP,
            contracts.INCOME_MEDIAN,
        )
    positions = {
        "zip": contracts.INCOME_ZIP_POSITION,
        "income_text": contracts.INCOME_MEDIAN_POSITION,
    }
    header = read_lines(spark, path).first()["line"]
    lines = read_lines(spark, path, header)
    parts = parse_split_lines(
        lines, positions, sep=contracts.INCOME_SEPARATOR, min_parts=contracts.INCOME_MIN_PARTS
    )
    return income_of(parts, "zip", "income_text")


def load_stations(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path).select(
        F.col(contracts.STATION_NAME).alias("site"),
        lenient_double(F.col(contracts.STATION_LAT)).alias("lat"),
        lenient_double(F.col(contracts.STATION_LON)).alias("lon"),
    )


def load_timers(spark: SparkSession, path: str, source: Column | None = None) -> DataFrame:
    """Timer lines of job logs: ``source`` is the log's file name unless given."""
    lines = spark.read.text(path).select(
        (source_name() if source is None else source).alias("source"), F.col("value").alias("line")
    )
    return timers_of(lines)


def blocks_with_zip(blocks: DataFrame, *, strict: bool = False) -> DataFrame:
    present = F.col("zip").isNotNull()
    return blocks.filter(present & (F.col("zip") != "") if strict else present)


def income_of(table: DataFrame, zip_column: str, money_column: str) -> DataFrame:
    return table.select(
        F.col(f"`{zip_column}`").alias("zip"),
        money_to_int(F.col(f"`{money_column}`")).alias("median_income"),
    ).filter(F.col("median_income").isNotNull())


def timers_of(lines: DataFrame) -> DataFrame:
    return lines.select(
        "source",
        timer_label(F.col("line")).alias("timer_label"),
        timer_seconds(F.col("line")).alias("seconds"),
    ).filter(F.col("timer_label").isNotNull())


# ---- share per part of the day --------------------------------------------------------


def day_part_share(
    crimes: DataFrame,
    place: str = contracts.STREET,
    *,
    strict: bool = False,
    udf: bool = False,
    labels: Sequence[str] = contracts.DAY_PART_LABELS,
) -> DataFrame:
    """Crimes at a kind of place per part of the day, in percent of all of them.

    A time that is no number counts under a NULL part of the day, or not at all
    if ``strict``. With ``udf`` the part of the day is a Python function; it sees
    each distinct time once, not each row.
    """
    there = crimes.filter(F.col("place") == place)
    if not udf:
        parts = there.select(day_part(F.col("time_text"), labels).alias("day_part"))
        return share_of_total(parts, "day_part", strict=strict, count="crimes")
    times = there.groupBy("time_text").agg(F.count("*").alias("rows"))
    parts = times.select(day_part_udf(labels)("time_text").alias("day_part"), "rows")
    return share_of_total(parts, "day_part", strict=strict, count="crimes", weight="rows")


# ---- top months per year --------------------------------------------------------------

_TOP_MONTHS_SQL = """
WITH days AS (
  SELECT date_text, count(*) AS day_total
  FROM {crimes}
  WHERE date_text IS NOT NULL
  GROUP BY date_text
),
dated AS (
  SELECT day_total,
         $day AS day
  FROM days
),
months AS (
  SELECT year(day) AS year, month(day) AS month,
         sum(CASE WHEN day IS NOT NULL THEN day_total END) AS crime_total
  FROM dated
  GROUP BY year(day), month(day)
  HAVING crime_total IS NOT NULL
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY year ORDER BY crime_total DESC, month) AS ranking
  FROM months
)
SELECT year, month, crime_total, ranking
FROM numbered
WHERE ranking <= $n
ORDER BY year, ranking
"""


def top_months(crimes: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` months with most crimes of each year; the earlier of equal months first.

    Rows are counted per date text before the text is parsed: days are few,
    parsing is slow. Unreadable days are left out by their sum, since a filter
    on the day would be moved below the count and parse the text of every row.
    """
    days = crimes.filter(F.col("date_text").isNotNull()).groupBy("date_text").count()
    dated = days.select("count", parse_date_any(F.col("date_text")).alias("day"))
    months = (
        dated.groupBy(F.year("day").alias("year"), F.month("day").alias("month"))
        .agg(F.sum(F.when(F.col("day").isNotNull(), F.col("count"))).alias("crime_total"))
        .filter(F.col("crime_total").isNotNull())
    )
    ranked = top_n_per_group(months, ["year"], [F.desc("crime_total"), F.asc("month")], n)
    return ranked.orderBy("year", "ranking")


def _day_sql(formats: Sequence[tuple[int, str]] = contracts.DATE_FORMATS) -> str:
    """:func:`parse_date_any` of ``date_text`` in SQL, in the same order."""
    routed, plain = [], []
    for tokens, pattern in formats:
        parsed = f"try_to_date(substring_index(date_text, ' ', {tokens}), '{pattern}')"
        separator = re.search(r"[^A-Za-z ']", pattern)
        if separator:
            routed.append(f"CASE WHEN contains(date_text, '{separator.group()}') THEN {parsed} END")
        else:
            plain.append(parsed)
    return f"coalesce({', '.join(routed + plain)})"


def top_months_sql(crimes: DataFrame, n: int = 3) -> DataFrame:
    """The same in SQL."""
    text = Template(_TOP_MONTHS_SQL).substitute(day=_day_sql(), n=int(n))
    return crimes.sparkSession.sql(text, crimes=crimes)


# ---- income per head ------------------------------------------------------------------


def by_zip(blocks: DataFrame, *, strict: bool = False) -> DataFrame:
    """Population and households of each ZIP with inhabitants."""
    sums = {"total_pop": "pop", "total_households": "households"}
    return sum_by(blocks, ["zip"], sums, missing_as_zero=strict).filter(F.col("total_pop") > 0)


def zip_income(
    blocks: DataFrame, income: DataFrame, strategy: str | None = None, *, strict: bool = False
) -> DataFrame:
    """ZIPs with their incomes, identical rows folded into a count.

    A ZIP that the income table repeats comes out as often. Identical incomes
    are folded before the join, so a repeated ZIP is joined once per income. Too many
    ZIPs for ``BROADCAST`` are joined by ``MERGE``.
    """
    left, right = by_zip(blocks, strict=strict), fold_copies(income)
    return equi_join(left, right, ["zip"], feasible(left, strategy))


def per_capita(
    blocks: DataFrame, income: DataFrame, strategy: str | None = None, *, strict: bool = False
) -> DataFrame:
    """Income per head of each ZIP, highest first.

    The median household income stands for the mean. Without any household
    count the result is NULL and comes last, or is 0 if ``strict``.
    """
    return unfold_copies(_per_capita_rows(blocks, income, strategy, strict), _per_capita_order())


def top_per_capita(
    blocks: DataFrame, income: DataFrame, k: int = 20, *, strict: bool = False
) -> DataFrame:
    """The first ``k`` rows of :func:`per_capita`."""
    order = _per_capita_order()
    first = top_k(_per_capita_rows(blocks, income, None, strict), order, k)
    # No row shows more than k of its copies.
    first = first.withColumn(COPIES, F.least(COPIES, F.lit(k)))
    return top_k(unfold_copies(first), order, k)


def _per_capita_order() -> list[Column]:
    return [F.desc_nulls_last("per_capita_income"), F.asc("zip"), F.asc("median_income")]


def _per_capita_rows(
    blocks: DataFrame, income: DataFrame, strategy: str | None, strict: bool
) -> DataFrame:
    ratio = weighted_ratio(F.col("median_income"), F.col("total_households"), F.col("total_pop"))
    return zip_income(blocks, income, strategy, strict=strict).select(
        "zip",
        "total_pop",
        "total_households",
        "median_income",
        ratio.alias("per_capita_income"),
        COPIES,
    )


# ---- nearest station ------------------------------------------------------------------


def known_locations(points: DataFrame) -> DataFrame:
    """Points but those at 0, which stands for an unknown place."""
    return points.filter(is_known_location(F.col("lat"), F.col("lon")))
