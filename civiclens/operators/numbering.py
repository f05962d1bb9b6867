"""Dense row numbers."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civiclens.operators.aggregates import COPIES, fold_copies, unfold_copies
from civiclens.scratch import materialise

_PART, _FIRST, _ROWS = "number part", "number first", "number rows"


def dense_keys(df: DataFrame, name: str = "row_key", order: Sequence[str] = ()) -> DataFrame:
    """``df`` with a number per row in the bigint column ``name``, gapless from 0.

    Numbers go by the order of all columns, those of ``order`` first, and missing values come first. So a row's
    number depends on the rows alone: not on their partitions, and a task that runs again gives the
    same. Equal rows are folded to one with a count before the sort, so that no task gets all rows
    of a repeated one; the sorted rows are written, numbered part by part, and their copies come back
    last. Columns need an order (no maps).
    """
    if name in df.columns:
        raise ValueError(f"there is a column {name!r} already")
    columns = [*order, *[c for c in df.columns if c not in order]]
    by: list[Column] = [F.asc_nulls_first(f"`{c}`") for c in columns]
    ranged = fold_copies(df).repartitionByRange(*by).withColumn(_PART, F.spark_partition_id())
    parts = materialise(ranged, "numbered-parts")
    sizes = parts.groupBy(_PART).agg(F.sum(COPIES).alias(_ROWS))
    before = F.sum(_ROWS).over(Window.orderBy(_PART)) - F.col(_ROWS)
    firsts = sizes.select(_PART, before.alias(_FIRST))  # a row per part
    within = F.sum(COPIES).over(Window.partitionBy(_PART).orderBy(*by).rowsBetween(Window.unboundedPreceding, 0))
    numbered = parts.withColumn(_ROWS, within - F.col(COPIES)).join(F.broadcast(firsts), _PART)
    number = (F.col(_FIRST) + F.col(_ROWS)).cast("bigint")
    rows = numbered.select(*[f"`{c}`" for c in df.columns], COPIES, number.alias(name))
    return unfold_copies(rows, number=name)
