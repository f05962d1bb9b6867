"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes what the one before kept, as written, and its decisions take effect. All but the
last return the columns of ``documents``. Rows with a NULL id or text and empty tables pass
through as the operators of the stages say. ``ORACLE_SQL`` is None, as SQL cannot express
trained stages; tests compare the stages with plain versions.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclens.llm import language, minhash, packing, suffixes, toxicity
from civiclens.llm.tables import read_table, written

ORACLE_SQL = None


def _nested(docs: DataFrame) -> DataFrame:
    """Texts, with all columns as one, so that no name of theirs meets one of ours."""
    return docs.select("text", F.struct(*[f"`{column}`" for column in docs.columns]).alias("row"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that compression distance calls toxic (score of 0.5 or more)."""
    model = toxicity.train_on(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(_nested(docs), model, score_column="score")
    return scored.filter("score < 0.5").select("row.*")


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents in no known language: no letters, or too unsure a prediction.

    Where no document has a language there is nothing to learn, and all stay.
    """
    model = language.train_on(docs)
    if model is None:
        return docs
    named = language.identify(_nested(docs), model, prefix="lang_")
    return named.filter("lang_accepted").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8), that with the smallest id.

    Of an id with several texts each text is a document of its own, the one with the smaller digest before the
    other, so none goes that is not near to one that stays. Rows that repeat an id and its text are one
    document, of which the row with the smallest values stays. Rows with a NULL id stay. Only
    ids that go are joined with the documents.
    """
    text = F.md5(F.coalesce("text", F.lit(""))).alias("text")
    name = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", text)).alias("name")
    judged = written(minhash.near_duplicates(docs.select(name, "text"), "name"), "near-duplicates")
    gone = judged.filter("not kept").select("name").distinct()
    named = F.when(F.col("row.doc_id").isNotNull(), F.struct("row.doc_id", text)).alias("name")
    rows = _nested(docs).select(named, "row")
    left = rows.join(gone, "name", "left_anti")
    again = judged.filter("name is not null").groupBy("name").count().filter("count > 1").select("name")
    again = written(again, "repeated rows")
    if again.isEmpty():
        return left.select("row.*")
    firsts = left.join(again, "name", "left_semi").groupBy("name").agg(F.min("row").alias("row"))
    return left.join(again, "name", "left_anti").unionByName(firsts).select("row.*")


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 200 bytes that are repeated, and their new ``n_chars``.

    No document goes: one that only holds repeated text stays with what is left, maybe nothing.
    """
    left = suffixes.remove_repeats(docs)
    counted = F.coalesce(F.length("text").cast("bigint"), F.lit(0).cast("bigint"))
    return left.withColumn("n_chars", counted).select(*[f"`{column}`" for column in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 4,096 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_language),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_array", drop_repeats),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
