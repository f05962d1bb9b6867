"""Vector bin packing: shards that are even in bytes, tokens and rows at once.

Groups of equal texts stay together. Each is a vector of its bytes, tokens and rows, as
shares of the whole. The vectors are placed from large to small, each in the shard, among
those it fits, whose residual capacity has the highest dot product with it.

So that this holds at any size, the many light groups are first summed in a fixed number of
cells by the hash of their text, and the cells are placed. A heavy group, with more than
``1 / (shards * CELLS_PER_SHARD)`` of any dimension, is placed alone; there are fewer than
``3 * shards * CELLS_PER_SHARD`` of those, whatever the data. One that is larger than a whole
shard cannot stay together: it is cut by the hash of the id into pieces of a quarter shard.
"""

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclens.llm.tables import numbered, read_table, written

SHARDS = 24
CELLS_PER_SHARD = 256
PIECE = 0.25
ROW_BYTES = 8
_SIZES = ["bytes", "tokens", "rows"]


def place(vectors: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each vector: largest first, to the highest dot product with what is left.

    Capacities are the mean of the shards; what fits nowhere goes where it overflows least.
    """
    total = np.maximum(vectors.sum(axis=0), 1)
    sizes = vectors / total * shards  # a shard's share is 1
    left = np.ones((shards, sizes.shape[1]))
    placed = np.zeros(len(vectors), np.int64)
    for i in np.argsort(-sizes.max(axis=1), kind="stable"):
        after = left - sizes[i]
        lowest = after.min(axis=1)
        fits = lowest >= 0
        score = np.where(fits, left @ sizes[i], -np.inf) if fits.any() else lowest
        best = placed[i] = int(score.argmax())
        left[best] -= sizes[i]
    return placed


def shard_by_vectors(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shards: int = SHARDS,
    cells_per_shard: int = CELLS_PER_SHARD,
) -> DataFrame:
    """A row per document: its id, ``bytes`` (with 8 for the row), ``tokens`` (words), ``crc32``,
    ``shard`` and ``slot``, gapless from 0 within a shard.

    A NULL text has 8 bytes, no tokens and the checksum of no bytes; such rows are a group.
    Rows with a NULL or repeated id are rows like others. Any other columns are not looked at.
    An empty table gives an empty result.
    """
    spark, text = docs.sparkSession, F.coalesce(F.col(text_column), F.lit(""))
    words = F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))
    sized = written(
        docs.select(
            F.col(id_column).alias("id"),
            F.when(F.col(text_column).isNull(), F.lit(0)).otherwise(F.xxhash64(text)).alias("key"),
            (F.octet_length(text).cast("bigint") + ROW_BYTES).alias("bytes"),
            words.cast("bigint").alias("tokens"),
            F.crc32(F.encode(text, "UTF-8")).alias("crc32"),
        ),
        "sized",
    )
    cells = shards * cells_per_shard
    sums = [F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens")]
    groups = written(sized.groupBy("key").agg(*sums, F.count("*").alias("rows")), "groups")
    total = groups.agg(*[F.sum(name) for name in _SIZES]).first()
    if not total[2]:
        return sized.select(
            F.col("id").alias(id_column), "bytes", "tokens", "crc32",
            F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot"),
        )
    share = F.greatest(*[F.col(name) / max(whole, 1) for name, whole in zip(_SIZES, total)])
    light = groups.filter(share * cells <= 1)
    cell = F.pmod(F.col("key"), F.lit(cells)).cast("int")
    per_cell = light.groupBy(cell.alias("cell")).agg(*[F.sum(n).alias(n) for n in _SIZES])
    pieces = F.when(share * shards > 1, F.ceil(share * shards / PIECE)).otherwise(1).cast("int")
    heavy = groups.filter(share * cells > 1).select("key", pieces.alias("pieces"))
    heavy_rows = (
        sized.join(F.broadcast(heavy), "key")
        .groupBy("key", _piece())
        .agg(*sums, F.count("*").alias("rows"))
    )
    items = (
        per_cell.select(F.lit(None).cast("bigint").alias("key"), "cell", *_SIZES)
        .unionByName(heavy_rows.select("key", F.col("piece").alias("cell"), *_SIZES))
        .orderBy("key", "cell")
        .collect()
    )
    placed = place(np.array([[row[n] for n in _SIZES] for row in items], float), shards)
    rows = [(row["key"], row["cell"], int(to)) for row, to in zip(items, placed)]
    plan = spark.createDataFrame(rows, "key bigint, cell int, shard int")
    by_cell = F.broadcast(plan.filter("key is null").select("cell", F.col("shard").alias("by_cell")))
    by_piece = plan.filter("key is not null").withColumnsRenamed({"cell": "piece"})
    assigned = (
        sized.join(F.broadcast(heavy), "key", "left")
        .withColumn("piece", _piece())
        .withColumn("cell", cell)
        .join(F.broadcast(by_piece), ["key", "piece"], "left")
        .join(by_cell, "cell", "left")
        .select(
            "id", "bytes", "tokens", "crc32",
            F.coalesce("shard", "by_cell").alias("shard"),
        )
    )
    slots = numbered(written(assigned, "assigned"), "shard", ["id", "crc32"], "slot", total[2])
    return slots.withColumnRenamed("id", id_column)


def _piece():
    return F.pmod(F.xxhash64("id"), F.coalesce(F.col("pieces"), F.lit(1))).cast("int").alias("piece")


def op2_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = shard_by_vectors(read_table(spark, sf_dir, "documents"))
    return shards.select(
        "doc_id", F.col("bytes").alias("size"), F.col("crc32").alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "tokens",
    )
