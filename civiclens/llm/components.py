"""Connected components by alternating large-star and small-star steps."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclens.llm.tables import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(``id``, ``component``) for every id in ``edges`` (``a``, ``b``): the smallest id it is linked with.

    A large star moves the larger neighbours of an id to its smallest neighbour, a small star does so
    with the id and its smaller neighbours. No step adds edges or parts what is connected, and about
    as many are needed as the logarithm of the number of ids. They end when one changes nothing:
    then every id hangs on the smallest of its component. Edges are written to the shared folder
    between steps. A hot id costs each task one row in the minimum, and the join that follows is one
    that adaptive execution can split.
    """
    edges = written(_oriented(edges), "edges")
    state = None
    while True:
        edges = written(_small_star(_large_star(edges)), "edges")
        # Number and checksum of the edges, which tell whether a step has changed any.
        checksum = F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
        before, state = state, edges.agg(F.count("*"), checksum).first()
        if state == before:
            break
    members = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return members.unionByName(roots)


def _oriented(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger to the smaller id."""
    return edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    larger = edges.select(F.col("b").alias("a"), F.col("a").alias("v"))  # neighbours v over a
    return larger.join(least, "a").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
