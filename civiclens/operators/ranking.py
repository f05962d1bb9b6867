"""Top rows per group and overall."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "ranking"
) -> DataFrame:
    """The first ``n`` rows of each group, numbered.

    ``order`` has to end in a column that settles ties. The filter on the row
    number lets Spark cut each group to ``n`` rows before the shuffle.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def top_k(df: DataFrame, order: Sequence[Column], k: int = 20) -> DataFrame:
    """The first ``k`` rows overall. Each task keeps ``k``; nothing is sorted as a whole."""
    return df.orderBy(*order).limit(k)
