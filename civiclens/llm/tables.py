"""Small helpers around Spark tables."""

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civiclens.scratch import materialise

_ROWS_PER_CHUNK = 400_000
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@contextmanager
def short_lived_shuffles(spark: SparkSession):
    """Within it, the shuffle files of a finished write are removed at once."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder; its shuffle files go when it is written."""
    with short_lived_shuffles(df.sparkSession):
        return materialise(df, name)


def fold(id_column: str = "doc_id") -> Column:
    """The fold of a row: crc32 of its id as text, modulo 5. Fold 0 is held out."""
    return F.crc32(F.encode(F.coalesce(F.col(id_column).cast("string"), F.lit("")), "UTF-8")) % 5


def numbered(rows: DataFrame, key: str, order: list[str], name: str, total: int) -> DataFrame:
    """``rows`` with a number per key, gapless from 0, in the bigint column ``name``.

    Rows of a key are dealt to chunks by the hash of the ``order`` columns, numbered within
    their chunk, and chunk after chunk, so no task needs all rows of a hot key. ``total`` is the
    number of rows, by which the number of chunks goes. ``rows`` should be a written table: it
    is read twice.
    """
    chunks = max(64, total // _ROWS_PER_CHUNK)
    chunk, first, n = (f"{name} {part}" for part in ("chunk", "first", "n"))
    dealt = rows.withColumn(chunk, F.pmod(F.xxhash64(*order), F.lit(chunks)))
    counts = dealt.groupBy(key, chunk).agg(F.count("*").alias(n))
    before = F.sum(n).over(Window.partitionBy(key).orderBy(chunk)) - F.col(n)
    firsts = counts.select(key, chunk, before.alias(first))
    within = F.row_number().over(Window.partitionBy(key, chunk).orderBy(*order)) - 1
    return (
        dealt.withColumn(name, within)
        .join(firsts, [key, chunk])
        .select(*rows.columns, (F.col(first) + F.col(name)).cast("bigint").alias(name))
    )
