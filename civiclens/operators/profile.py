"""First look at a data set."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dataset_profile(df: DataFrame) -> DataFrame:
    """One row per column: its name, the rows of ``df``, and those with a value.

    All columns are counted in one pass.
    """
    columns = df.columns
    counts = [F.count(F.col(f"`{name}`")).alias(f"c{i}") for i, name in enumerate(columns)]
    entries = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col("all_rows").alias("row_count"),
            F.col(f"c{i}").alias("non_null_count"),
        )
        for i, name in enumerate(columns)
    ]
    return df.agg(F.count("*").alias("all_rows"), *counts).select(F.inline(F.array(*entries)))


FITS = ("BIGINT", "DOUBLE", "DATE", "STRING")


def value_profile(df: DataFrame, frequent: int = 5) -> DataFrame:
    """One row per column on what its values are like, for columns of plain types.

    Counted exactly: ``row_count``, ``non_null_count``, ``shortest`` and ``longest`` text in characters, and the first
    of ``FITS`` that all values read as (``fits``; NULL without values). By mergeable sketches: ``distinct_estimate``
    (HyperLogLog, about 2 percent off), ``quartiles`` of the numbers (KLL, about 1 percent of rank off) and
    the ``frequent`` values with most rows, each with an estimate. All in one scan; a task sends a sketch per column.
    """
    columns = df.columns
    aggregates = []
    for i, name in enumerate(columns):
        text = F.col(f"`{name}`").cast("string")
        number, trimmed = text.try_cast("double"), F.trim(text)
        day = F.coalesce(F.try_to_timestamp(trimmed, F.lit("yyyy-MM-dd")), F.try_to_timestamp(trimmed))
        kinds = zip(FITS, (text.try_cast("bigint"), number, day))
        values = [
            F.count(text).alias("non_null"),
            F.min(F.length(text)).alias("shortest"),
            F.max(F.length(text)).alias("longest"),
            F.hll_sketch_estimate(F.hll_sketch_agg(text)).alias("distinct"),
            F.kll_sketch_agg_double(F.when(~F.isnan(number), number)).alias("sketch"),
            F.expr(f"approx_top_k(CAST(`{name.replace('`', '``')}` AS STRING), {int(frequent)})").alias("frequent"),
            *[F.count(as_kind).alias(kind) for kind, as_kind in kinds],
        ]
        aggregates += [value.alias(f"c{i} {j}") for j, value in enumerate(values)]
    entries = []
    for i, name in enumerate(columns):
        got = [F.col(f"`c{i} {j}`") for j in range(9)]
        fits = F.when(got[0] == 0, None)
        for kind, count in zip(FITS, got[6:]):
            fits = fits.when(count == got[0], kind)
        numbers = F.kll_sketch_get_n_double(got[4])
        quartiles = F.kll_sketch_get_quantile_double(got[4], F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
        entries.append(
            F.struct(
                F.lit(name).alias("column_name"), F.col("all_rows").alias("row_count"), got[0].alias("non_null_count"),
                got[1].alias("shortest"), got[2].alias("longest"), fits.otherwise("STRING").alias("fits"),
                got[3].alias("distinct_estimate"), F.when(numbers > 0, quartiles).alias("quartiles"),
                got[5].alias("frequent"),
            )
        )
    return df.agg(F.count("*").alias("all_rows"), *aggregates).select(F.inline(F.array(*entries)))
