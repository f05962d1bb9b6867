"""Inputs in the shape of the published files, derived from the driver's tables.

Each grows with its table and carries bad text, missing values, ties and
repeated keys. :data:`SQL` states the same in the oracle's dialect.
"""

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Times as they should not be: of these, +900, -5 and 2460 are whole numbers.
ODD_TIMES = ("12.7", "+900", "-5", "2460", "99999999999", "12a", "1e3")
_ODD = " ".join(f"WHEN event_id % 50 = {i} THEN '{text}'" for i, text in enumerate(ODD_TIMES, 2))


def crimes(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "events").selectExpr(
        "event_id",
        f"""CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 50 = 1 THEN 'abcd' {_ODD}
                ELSE date_format(ts, 'HHmm') END AS time_text""",
        "event_type AS place",
    )


def dates(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "orders").selectExpr(
        "o_orderkey",
        """CASE WHEN o_orderkey % 97 = 0 THEN 'n/a' WHEN o_orderkey % 89 = 0 THEN NULL
                WHEN o_orderkey % 2 = 0 THEN date_format(o_orderdate, 'yyyy MMM dd hh:mm:ss a')
                ELSE date_format(o_orderdate, 'MM/dd/yyyy hh:mm:ss a') END AS date_text""",
    )


def blocks(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "orders").selectExpr(
        "o_orderkey AS block",
        """CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 103 = 0 THEN ''
                ELSE lpad(string(o_custkey), 12, '0') END AS zip""",
        "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey % 50 END AS pop",
        "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 20 END AS households",
    )


def income(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "customer").selectExpr(
        """CASE WHEN c_custkey % 211 = 0 THEN '' ELSE lpad(string(c_custkey), 12, '0')
           END AS zip""",
        "c_name AS community",
        """CASE WHEN c_custkey % 7 = 3 THEN '-'
                ELSE concat('$', format_number(20000 + c_custkey * 1234 % 180000, 0))
           END AS income_text""",
    )


def points(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "orders").selectExpr(
        "o_orderkey AS id",
        "o_custkey AS customer",
        """CASE WHEN o_orderkey % 97 = 0 THEN 0.0D WHEN o_orderkey % 89 = 0 THEN NULL
                ELSE 33.7D + (o_orderkey * 7919 % 10007) / 10007.0D * 0.65D END AS lat""",
        """CASE WHEN o_orderkey % 83 = 0 THEN 0.0D
                ELSE -118.7D + (o_orderkey * 104729 % 10009) / 10009.0D * 0.6D END AS lon""",
    )


def sites(spark: SparkSession, folder: str) -> DataFrame:
    """A fixed number of sites."""
    return _table(spark, folder, "nation").selectExpr(
        "n_nationkey AS nation",
        "n_name AS site",
        "33.7D + (n_nationkey * 389 % 997) / 997.0D * 0.65D AS lat",
        "-118.7D + (n_nationkey * 613 % 991) / 991.0D * 0.6D AS lon",
    )


def depots(spark: SparkSession, folder: str) -> DataFrame:
    """Sites whose number grows with the data; some have no location."""
    return _table(spark, folder, "supplier").selectExpr(
        "s_name AS site",
        """CASE WHEN s_suppkey % 41 = 40 THEN NULL
                ELSE 33.7D + (s_suppkey * 3571 % 9973) / 9973.0D * 0.65D END AS lat""",
        "-118.7D + (s_suppkey * 7307 % 9967) / 9967.0D * 0.6D AS lon",
    )


def dense_points(spark: SparkSession, folder: str) -> DataFrame:
    """All orders within a hundred metres of five spots."""
    return _table(spark, folder, "orders").selectExpr(
        "o_orderkey AS id",
        "34.0D + o_orderkey % 5 * 0.5D + (o_orderkey * 7919 % 10007) / 10007.0D * 0.001D AS lat",
        "-118.0D + (o_orderkey * 104729 % 10009) / 10009.0D * 0.001D AS lon",
    )


def dense_sites(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "supplier").selectExpr(
        "s_name AS site",
        "34.0D + s_suppkey % 5 * 0.5D + (s_suppkey * 3571 % 9973) / 9973.0D * 0.001D AS lat",
        "-118.0D + (s_suppkey * 7307 % 9967) / 9967.0D * 0.001D AS lon",
    )


SQL = {
    "dense_points": """SELECT o_orderkey AS id,
        34.0::DOUBLE + o_orderkey % 5 * 0.5::DOUBLE
          + (o_orderkey * 7919 % 10007) / 10007.0::DOUBLE * 0.001::DOUBLE AS lat,
        -118.0::DOUBLE + (o_orderkey * 104729 % 10009) / 10009.0::DOUBLE * 0.001::DOUBLE AS lon
      FROM orders""",
    "dense_sites": """SELECT s_name AS site,
        34.0::DOUBLE + s_suppkey % 5 * 0.5::DOUBLE
          + (s_suppkey * 3571 % 9973) / 9973.0::DOUBLE * 0.001::DOUBLE AS lat,
        -118.0::DOUBLE + (s_suppkey * 7307 % 9967) / 9967.0::DOUBLE * 0.001::DOUBLE AS lon
      FROM supplier""",
    "crimes": f"""SELECT event_id,
        CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 50 = 1 THEN 'abcd' {_ODD}
             ELSE strftime(ts, '%H%M') END AS time_text,
        event_type AS place
      FROM events""",
    "dates": """SELECT o_orderkey,
        CASE WHEN o_orderkey % 97 = 0 THEN 'n/a' WHEN o_orderkey % 89 = 0 THEN NULL
             WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y %b %d %I:%M:%S %p')
             ELSE strftime(o_orderdate, '%m/%d/%Y %I:%M:%S %p') END AS date_text
      FROM orders""",
    "blocks": """SELECT o_orderkey AS block,
        CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 103 = 0 THEN ''
             ELSE lpad(o_custkey::VARCHAR, 12, '0') END AS zip,
        CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey % 50 END AS pop,
        CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 20 END AS households
      FROM orders""",
    "income": """SELECT
        CASE WHEN c_custkey % 211 = 0 THEN '' ELSE lpad(c_custkey::VARCHAR, 12, '0') END AS zip,
        c_name AS community,
        CASE WHEN c_custkey % 7 = 3 THEN '-'
             ELSE '$' || format('{:,}', 20000 + c_custkey * 1234 % 180000) END AS income_text
      FROM customer""",
    "points": """SELECT o_orderkey AS id, o_custkey AS customer,
        CASE WHEN o_orderkey % 97 = 0 THEN 0.0::DOUBLE WHEN o_orderkey % 89 = 0 THEN NULL
             ELSE 33.7::DOUBLE + (o_orderkey * 7919 % 10007) / 10007.0::DOUBLE * 0.65::DOUBLE
             END AS lat,
        CASE WHEN o_orderkey % 83 = 0 THEN 0.0::DOUBLE
             ELSE -118.7::DOUBLE + (o_orderkey * 104729 % 10009) / 10009.0::DOUBLE * 0.6::DOUBLE
             END AS lon
      FROM orders""",
    "sites": """SELECT n_nationkey AS nation, n_name AS site,
        33.7::DOUBLE + (n_nationkey * 389 % 997) / 997.0::DOUBLE * 0.65::DOUBLE AS lat,
        -118.7::DOUBLE + (n_nationkey * 613 % 991) / 991.0::DOUBLE * 0.6::DOUBLE AS lon
      FROM nation""",
    "depots": """SELECT s_name AS site,
        CASE WHEN s_suppkey % 41 = 40 THEN NULL
             ELSE 33.7::DOUBLE + (s_suppkey * 3571 % 9973) / 9973.0::DOUBLE * 0.65::DOUBLE
             END AS lat,
        -118.7::DOUBLE + (s_suppkey * 7307 % 9967) / 9967.0::DOUBLE * 0.6::DOUBLE AS lon
      FROM supplier""",
}
