"""Grouped counts, sums, shares, arg-min and handling of identical rows.

All group operators combine rows in each task before they shuffle, so a key
that holds a third of all rows costs each task one row.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COPIES = "copies"
_COPIES_PER_ROW = 10_000


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Rows per key; NULL is a key."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def sum_by(
    df: DataFrame, keys: Sequence[str], sums: Mapping[str, str], *, missing_as_zero: bool = False
) -> DataFrame:
    """Sums per key, given as output name to column.

    By default missing values are skipped and a key with none at all sums to
    NULL; with ``missing_as_zero`` it sums to 0.
    """
    values = {
        name: F.coalesce(F.col(column), F.lit(0)) if missing_as_zero else F.col(column)
        for name, column in sums.items()
    }
    return df.groupBy(*keys).agg(*[F.sum(value).alias(name) for name, value in values.items()])


def mean_and_count_by(
    df: DataFrame, keys: Sequence[str], value: str, *, digits: int, mean: str, count: str
) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.round(F.avg(value), digits).alias(mean), F.count("*").alias(count)
    )


def exact_mean_and_count_by(
    df: DataFrame, keys: Sequence[str], value: str, *, digits: int, mean: str, count: str
) -> DataFrame:
    """Mean of doubles and rows per key, the same to the last bit however the rows are parted.

    A sum of doubles depends on its order. Here values are taken as decimals with 18 places, whose partial sums are
    exact in any order, and only the total is rounded. Values from 1e20 on are an error, NaN and infinite ones
    too, not a wrong mean; missing ones are skipped.
    """
    exact = F.sum(F.col(value).cast("decimal(38,18)"))
    mean_of = F.round(exact.cast("double") / F.count(value), digits)
    return df.groupBy(*keys).agg(F.when(F.count(value) > 0, mean_of).alias(mean), F.count("*").alias(count))


def argmin_by(df: DataFrame, keys: Sequence[str], value: str, label: str) -> DataFrame:
    """Smallest value per key and its label; equal values go to the smaller label.

    Missing values are left out first: they would sort before every number.
    """
    smallest = F.min(F.struct(value, label)).alias("smallest")
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys)
        .agg(smallest)
        .select(*keys, f"smallest.{value}", f"smallest.{label}")
    )


def share_of_total(
    df: DataFrame,
    key: str,
    *,
    strict: bool = False,
    count: str = "n",
    share: str = "percentage",
    weight: str | None = None,
) -> DataFrame:
    """Rows per key with their share of all rows in percent, largest first.

    Rows without a key form a group of their own, unless ``strict`` leaves them
    out before the total. ``weight`` names a column of row counts, for input
    that is aggregated already. The total is a subquery over the same counts:
    its exchange is reused, so the input is read once.
    """
    if weight is None:
        rows = df.filter(F.col(key).isNotNull()) if strict else df
        counts = rows.groupBy(key).agg(F.count("*").alias(count))
    elif strict:
        # A filter on the key would be moved below the aggregation that made
        # the weights, and the key computed for every row there.
        known = F.sum(F.when(F.col(key).isNotNull(), F.col(weight)))
        counts = df.groupBy(key).agg(known.alias(count)).filter(F.col(count).isNotNull())
    else:
        counts = df.groupBy(key).agg(F.sum(weight).alias(count))
    total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn(share, F.round(F.col(count) / total * 100, 2)).orderBy(
        F.desc(share), F.asc(key)
    )


def weighted_ratio(value: Column, weight: Column, base: Column, digits: int = 2) -> Column:
    """``value * weight / base``, multiplied first."""
    return F.round(value * weight / base, digits)


def fold_copies(df: DataFrame) -> DataFrame:
    """Distinct rows with the number of their copies."""
    return df.groupBy(*df.columns).agg(F.count("*").alias(COPIES))


def unfold_copies(df: DataFrame, order: Sequence[Column] = (), number: str | None = None) -> DataFrame:
    """Inverse of :func:`fold_copies`, sorted by ``order`` if given.

    The column ``number``, if given, has the number of the first copy, and those that follow count on.

    A sort sees one row per ten thousand copies, numbered as the last key, so
    that the range partitioning can split a group of copies too. The copies
    come back after it, without a further shuffle. Numbers are made in three
    steps, so that no row holds a long list of them, however many copies it has.
    """
    columns = [f"`{name}`" for name in df.columns if name != COPIES]
    high, part, copy, left = (f"copies {name}" for name in ("high", "part", "copy", "left"))
    per_high = _COPIES_PER_ROW * _COPIES_PER_ROW

    def numbers(of: Column, each: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.floor((of - 1) / each)))

    parts = df.withColumn(high, numbers(F.col(COPIES), per_high))
    parts = parts.withColumn(left, F.least(F.col(COPIES) - F.col(high) * per_high, F.lit(per_high)))
    parts = parts.withColumn(part, numbers(F.col(left), _COPIES_PER_ROW))
    if order:
        parts = parts.orderBy(*order, high, part)
    last = F.least(F.col(left) - F.col(part) * _COPIES_PER_ROW, F.lit(_COPIES_PER_ROW))
    copies = parts.withColumn(copy, F.explode(F.sequence(F.lit(1), last)))
    if number is not None:
        place = F.col(high) * per_high + F.col(part) * _COPIES_PER_ROW + F.col(copy) - 1
        copies = copies.withColumn(number, F.col(number) + place)
    return copies.select(*columns)
