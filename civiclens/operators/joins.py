"""Equi-joins under a chosen strategy."""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclens.operators.aggregates import COPIES, fold_copies, unfold_copies
from civiclens.scratch import materialise

BROADCAST_ROWS = 100_000
HOT_SHARE = 1_000

# The strategies of `equi_join`. None leaves the choice to the planner.
STRATEGIES = (None, "BROADCAST", "MERGE", "SHUFFLE_HASH", "REPLICATE_HOT_KEYS")


def fits(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows. Runs a job that stops once it knows."""
    return df.select(F.lit(1)).limit(rows + 1).count() <= rows


def equi_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    strategy: str | None = None,
    *,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_share: int = HOT_SHARE,
) -> DataFrame:
    """Inner join on equal column names; ``left`` is the side with few rows per key.

    The strategies are hints on ``left``, so that no hash table is built of a hot
    key's rows. ``BROADCAST`` counts it first, and raises a ``ValueError`` if it has
    over ``broadcast_rows`` rows. ``REPLICATE_HOT_KEYS`` is :func:`hot_key_join`
    with ``left`` unique per key.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown join strategy {strategy!r}")
    on = list(on)
    if strategy == "REPLICATE_HOT_KEYS":
        columns = [*left.columns, *[name for name in right.columns if name not in on]]
        right = materialise(right, "many")  # it is read three times
        return hot_key_join(right, left, on, hot_share=hot_share).select(*columns)
    if strategy == "BROADCAST" and not fits(left, broadcast_rows):
        raise ValueError(f"the side to broadcast has over {broadcast_rows} rows")
    return (left.hint(strategy) if strategy else left).join(right, on)


def feasible(left: DataFrame, strategy: str | None, *, broadcast_rows: int = BROADCAST_ROWS) -> str | None:
    """The strategy, or ``MERGE`` in place of a ``BROADCAST`` of over ``broadcast_rows`` rows: the same rows by a
    shuffle that spills, for tables that grow past what every executor can hold."""
    return "MERGE" if strategy == "BROADCAST" and not fits(left, broadcast_rows) else strategy


def with_keys(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose keys are all there: ``dropna``, which leaves out NaN too, but without computing keys that are never missing."""
    for name, kind in df.select(*on).dtypes:
        df = df.filter(F.col(f"`{name}`").isNotNull())
        if kind in ("float", "double"):
            df = df.filter(~F.isnan(f"`{name}`"))
    return df


def frequent_keys(df: DataFrame, on: Sequence[str], share: int) -> DataFrame:
    """Keys that hold over ``1 / share`` of the rows without a missing key, and no more than ``share`` keys.

    Found in one scan by a mergeable sketch of frequent items: each task sends one, of a fixed size. It
    counts no key too low, so none over the bound is missed, and too high by less than a third of the bound, so
    that a key somewhat below it may be among them.
    """
    return _as_rows(_frequent(df, on, share), df.select(*on))


def _frequent(df: DataFrame, on: Sequence[str], share: int, least: int = 0) -> list[str]:
    """Frequent keys as JSON, of those that come over ``least`` times."""
    keys = with_keys(df, on).select(F.to_json(F.struct(*on)).alias("key"))
    tracked = max(1024, 32 * share)
    top = keys.agg(F.count("*").alias("rows"), F.expr(f"approx_top_k(key, {share}, {tracked})").alias("top")).first()
    bound = max(least, top["rows"] / share)
    return [item["item"] for item in top["top"] or () if item["count"] > bound]


def _as_rows(texts: list[str], keys: DataFrame) -> DataFrame:
    rows = keys.sparkSession.createDataFrame([(text,) for text in texts], "key STRING")
    return rows.select(F.inline(F.array(F.from_json("key", keys.schema))))


def choose_strategy(
    left: DataFrame, right: DataFrame, on: Sequence[str], *, broadcast_rows: int = BROADCAST_ROWS, hot_share: int = HOT_SHARE
) -> tuple[str, DataFrame]:
    """The strategy of :func:`equi_join` that the data call for, and the hot keys of ``right``.

    ``BROADCAST`` if ``left`` has few rows; else ``REPLICATE_HOT_KEYS`` if ``right`` has hot keys, or ``MERGE``.
    """
    hot = frequent_keys(right, on, hot_share)
    if fits(left, broadcast_rows):
        return "BROADCAST", hot
    return ("MERGE" if hot.isEmpty() else "REPLICATE_HOT_KEYS"), hot


def hot_key_join(
    many: DataFrame, one: DataFrame, on: Sequence[str], *, hot_share: int = HOT_SHARE
) -> DataFrame:
    """Inner join of ``many`` rows per key with ``one`` row per key, safe for hot keys.

    A key is hot if it holds over ``1 / hot_share`` of ``many``, by :func:`frequent_keys`, so no more than
    ``hot_share`` keys are. Their rows of ``one`` are written first: if these are more than the
    keys, ``one`` is not unique and a ``ValueError`` is raised. Else they are replicated to every task, and
    their rows of ``many`` stay where they are; the rest is shuffled.
    """
    on = list(on)
    hot = frequent_keys(many, on, hot_share)
    n_hot = hot.count()
    hot = F.broadcast(hot)
    few = materialise(one.join(hot, on, "left_semi"), "hot-rows")
    if not fits(few, n_hot):
        raise ValueError("the side to replicate has several rows per key")
    replicated = many.join(F.broadcast(few), on)
    shuffled = many.join(hot, on, "left_anti").join(one, on)
    return replicated.unionByName(shuffled)


def fold_frequent(rows: DataFrame, share: int, least: int) -> tuple[DataFrame, bool]:
    """``rows``, and whether any row comes often: over ``1 / share`` of all, and over ``least`` times, by its hash.

    If so, these are folded, as by :func:`fold_copies`, and each other row has one copy; folding shuffles the former only.
    """
    digest = "row digest"
    known = rows.withColumn(digest, F.xxhash64(*[f"`{c}`" for c in rows.columns]))
    frequent = _frequent(known, [digest], share, least)
    if not frequent:
        return rows, False
    frequent = F.broadcast(_as_rows(frequent, known.select(digest)))  # no more than ``share`` rows
    seldom = known.join(frequent, digest, "left_anti").drop(digest).withColumn(COPIES, F.lit(1).cast("bigint"))
    return seldom.union(fold_copies(known.join(frequent, digest, "left_semi").drop(digest))), True


def grid_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], *, hot_share: int = HOT_SHARE, least_hot: int = 10_000
) -> DataFrame:
    """Inner join on equal column names, of keys with many rows on both sides.

    A key is hot on a side if it has over ``1 / hot_share`` of the rows there, and over ``least_hot``. Its rows are
    cut into parts of that size by a hash of all their columns, ``p`` on the left and ``q`` on the right; the
    rows of a left part go to ``q`` cells and those of a right one to ``p``, so each pair meets in one cell
    of the grid, and a cell has about as many rows as a key that is not hot. Rows that come so often by themselves are folded
    before, as a hash cannot part them; other rows are shuffled once, to their cell, and columns that the caller does not
    go on with are not. The hot keys are counted and written first; there are fewer than twice ``hot_share``. NULL equals nothing.
    """
    on = list(on)
    parts, cells = ("left parts", "right parts"), ("left cell", "right cell")
    sides, copies = [], []
    for side, name in ((left, "left copies"), (right, "right copies")):
        rows, folded = fold_frequent(with_keys(side, on), hot_share, least_hot)
        sides.append(rows.withColumnRenamed(COPIES, name) if folded else rows)
        copies += [name] if folded else []
    hot = None
    for rows, part in zip(sides, parts):
        counts = materialise(rows.groupBy(*on).agg(F.count("*").alias("rows")), "key-counts")
        most = max(least_hot, (counts.agg(F.sum("rows")).first()[0] or 0) // hot_share)
        some = counts.filter(F.col("rows") > most).select(*on, F.ceil(F.col("rows") / most).alias(part))
        hot = some if hot is None else hot.join(some, on, "full")
    hot = F.broadcast(materialise(hot.na.fill(1, list(parts)), "hot-keys"))  # fewer than 2 * hot_share rows
    dealt = []
    for rows, own, other, cell, across in zip(sides, parts, parts[::-1], cells, cells[::-1]):
        columns = [f"`{c}`" for c in rows.columns]
        number = F.pmod(F.xxhash64(*columns), F.coalesce(F.col(own), F.lit(1)))
        others = F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col(other), F.lit(1)).cast("bigint") - 1)
        dealt.append(
            rows.join(hot, on, "left").select(*columns, number.cast("bigint").alias(cell), F.explode(others).alias(across))
        )
    joined = dealt[0].hint("MERGE").join(dealt[1], [*on, *cells]).drop(*cells)
    if not copies:
        return joined
    times = F.col(copies[0]) * F.col(copies[1]) if len(copies) == 2 else F.col(copies[0])
    return unfold_copies(joined.withColumn(COPIES, times).drop(*copies))


def strategy_matrix(
    run: Callable[[str | None], DataFrame], strategies: Sequence[str | None] = STRATEGIES
) -> DataFrame:
    """The result of ``run`` under each strategy, one below the other, labelled."""
    results = [
        run(strategy).select(F.lit(strategy or "DEFAULT").alias("strategy"), "*")
        for strategy in strategies
    ]
    whole = results[0]
    for result in results[1:]:
        whole = whole.unionByName(result)
    return whole
