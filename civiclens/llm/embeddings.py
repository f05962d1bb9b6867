"""Near duplicates among embeddings by NN-descent.

Equal vectors are one class. Every class has a list of neighbours. The first lists come from
neighbours in several random orders, each along a long code of random hyperplanes. Then lists
are refined: the classes that one class lists, or is listed by, are compared with each other,
and lists keep the nearest, until few of them change. Pairs at the threshold are links
whenever they are seen.

A list that links fill is saturated and may lack some. It is enlarged to its whole component:
members of a component are compared in blocks, which counts all links within it. An audit
compares a bounded sample of classes with all others; below the recall asked for, refinement
goes on with longer lists. If the longest lists do not reach it either, every class is compared
with every other, in parts.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civiclens.llm.components import connected_components
from civiclens.llm.tables import numbered, read_table, written

THRESHOLD = 0.95
NEIGHBOURS = 10
RECALL = 0.97
AUDITED = 200
_ORDERS = 8
_REACH = 4
_KEPT = 4
_ROUNDS = 4
_STEADY = 0.02
_ENLARGED = 2
_BLOCK = 512
_PART = 8_192


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, components) to a digest of the vector and the vector at length 1, NULL if it has none."""
    for batch in batches:
        keys, units = [], []
        for value in batch.column(1):
            parts = value.as_py()
            vector = np.array(parts if parts and None not in parts else [0.0], np.float64)
            with np.errstate(over="ignore", invalid="ignore"):
                vector = vector / max(np.abs(vector).max(), 1e-300)  # else a square may overflow
                length = np.sqrt(vector @ vector)
            if not np.isfinite(length) or length == 0 or not np.isfinite(vector).all():
                keys.append(None)
                units.append(None)
                continue
            unit = vector / length + 0.0
            keys.append(hashlib.blake2b(np.array(parts, np.float64) + 0.0, digest_size=16).digest())
            units.append(unit.tobytes())
        arrays = [batch.column(0), pa.array(keys, pa.binary()), pa.array(units, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["id", "key", "unit"])


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, unit) to a row per order: its number, the size of the vector and its place in the order."""
    planes = {}
    weights = np.uint64(1) << np.arange(63, dtype=np.uint64)[::-1]
    for batch in batches:
        units = [np.frombuffer(u.as_buffer()) for u in batch.column(1)]
        for size in sorted({len(u) for u in units}):
            rows = [i for i, u in enumerate(units) if len(u) == size]
            if size not in planes:
                planes[size] = np.random.default_rng(size).normal(size=(_ORDERS, size, 63))
            x = np.stack([units[i] for i in rows])
            part = batch.take(pa.array(rows))
            for order in range(_ORDERS):
                code = ((x @ planes[size][order] > 0) @ weights).astype(np.int64)
                arrays = [
                    pa.array(np.full(len(rows), order, np.int32)),
                    pa.array(np.full(len(rows), size, np.int32)),
                    pa.array(code),
                    *part.columns,
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["order", "size", "code", "id", "unit"])


def _adjacent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of :func:`_codes` to each one's nearest among those within reach in the order."""
    ids, units, keys = [], [], []

    def compared():
        lists = []
        for key in dict.fromkeys(keys):
            at = [i for i, k in enumerate(keys) if k == key]
            x, names = np.stack([units[i] for i in at]), np.array([ids[i] for i in at])
            n = len(at)
            sims = np.full((n, 2 * _REACH), -2.0)
            other = np.zeros((n, 2 * _REACH), np.int64)
            for step in range(1, min(_REACH, n - 1) + 1):
                s = np.einsum("ij,ij->i", x[:-step], x[step:])
                sims[:-step, step - 1], other[:-step, step - 1] = s, names[step:]
                sims[step:, -step], other[step:, -step] = s, names[:-step]
            lists.append(_best(names, other, sims))
        return _edge_batch(lists)

    for batch in batches:
        ids += batch.column(3).to_pylist()
        keys += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        units += [np.frombuffer(u.as_buffer()) for u in batch.column(4)]
        if len(ids) > 4_000:
            yield compared()
            ids, units, keys = ids[-_REACH:], units[-_REACH:], keys[-_REACH:]
    if ids:
        yield compared()


def _best(names: np.ndarray, other: np.ndarray, sims: np.ndarray):
    """The nearest few of each row, and all links."""
    top = np.argsort(-sims, axis=1)[:, :_KEPT]
    keep = sims >= THRESHOLD
    keep[np.arange(len(names))[:, None], top] = True
    keep &= sims > -2.0
    row, column = np.nonzero(keep)
    return names[row], other[row, column], sims[row, column]


def _edge_batch(lists) -> pa.RecordBatch:
    columns = [np.concatenate([part[i] for part in lists]) for i in range(3)]
    kinds = [pa.int64(), pa.int64(), pa.float64()]
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
    return pa.RecordBatch.from_arrays(arrays, ["id", "near", "cosine"])


def _join_locally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of one class's neighbourhood, compared with each other."""
    for batch in batches:
        lists = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for members in batch.column(0):
            names = np.array([m["id"].as_py() for m in members.values])
            x = np.stack([np.frombuffer(m["unit"].as_buffer()) for m in members.values])
            sims = x @ x.T
            np.fill_diagonal(sims, -2.0)
            lists.append(_best(names, np.broadcast_to(names, sims.shape), sims))
        yield _edge_batch(lists)


_EDGES = "id bigint, near bigint, cosine double"


def _nearest(edges: DataFrame, size: int) -> DataFrame:
    """The ``size`` nearest of each class, one row each."""
    once = edges.groupBy("id", "near").agg(F.max("cosine").alias("cosine"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("cosine"), "near"))
    return once.withColumn("rank", rank).filter(F.col("rank") <= size).drop("rank")


def _refined(lists: DataFrame, units: DataFrame, size: int) -> DataFrame:
    """Edges that neighbours of neighbours bring."""
    reverse = lists.select(F.col("near").alias("centre"), F.col("id").alias("id"))
    # Of those that list a class, as many as its own list holds; others meet elsewhere.
    rank = F.row_number().over(Window.partitionBy("centre").orderBy(F.xxhash64("centre", "id")))
    reverse = reverse.withColumn("rank", rank).filter(F.col("rank") <= size).drop("rank")
    around = lists.select(F.col("id").alias("centre"), F.col("near").alias("id"))
    own = lists.select(F.col("id").alias("centre"), "id")
    members = around.unionByName(reverse).unionByName(own).distinct().join(units, "id")
    groups = members.groupBy("centre").agg(F.collect_list(F.struct("id", "unit")).alias("members"))
    return groups.select("members").mapInArrow(_join_locally, _EDGES)


def _links_of(edges: DataFrame) -> DataFrame:
    near = edges.filter((F.col("cosine") >= THRESHOLD) & (F.col("id") != F.col("near")))
    return near.select(F.greatest("id", "near").alias("a"), F.least("id", "near").alias("b")).distinct()


def _count_in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of blocks of a component to the links that each member has in the other block."""
    for batch in batches:
        ids, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for one, two, same in zip(*batch.columns):
            (a, wa, x), (b, wb, y) = _matrix(one), _matrix(two)
            linked = x @ y.T >= THRESHOLD
            if same.as_py():
                np.fill_diagonal(linked, False)
            ids.append(a)
            counts.append(linked @ wb)
            if not same.as_py():
                ids.append(b)
                counts.append(wa @ linked)
        arrays = [pa.array(np.concatenate(ids)), pa.array(np.concatenate(counts).astype(np.int64))]
        yield pa.RecordBatch.from_arrays(arrays, ["id", "links"])


def _matrix(block: pa.Scalar):
    rows = block.values
    columns = [np.array(rows.field(i).to_pylist(), np.int64) for i in (0, 1)]
    return *columns, np.stack([np.frombuffer(u.as_buffer()) for u in rows.field(2)])


def _count_links(links: DataFrame, units: DataFrame, copies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Components of the links, and per class the rows it is linked with in its component."""
    parts = connected_components(links)
    rows = written(parts.join(units, "id").join(copies, "id"), "component members")
    at = numbered(rows.select("component", "id"), "component", ["id"], "at", rows.count())
    block = F.floor(F.col("at") / _BLOCK).alias("block")
    blocks = written(
        rows.join(at.select("id", block), "id")
        .groupBy("component", "block")
        .agg(F.collect_list(F.struct("id", "copies", "unit")).alias("members")),
        "blocks",
    )
    # Blocks are dealt by the pair they make with each other, so a large component is many tasks.
    last = blocks.groupBy("component").agg(F.max("block").alias("last"))
    dealt = blocks.join(last, "component").withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), "last")))
    pair = ["component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")]
    one = dealt.filter("block <= other").select(*pair, F.col("members").alias("a"))
    two = dealt.filter("block >= other").select(*pair, F.col("members").alias("b"))
    pairs = one.join(two, ["component", "low", "high"])
    counted = pairs.select("a", "b", (F.col("low") == F.col("high")).alias("same"))
    counted = counted.mapInArrow(_count_in_blocks, "id bigint, links bigint")
    return parts, written(counted.groupBy("id").agg(F.sum("links").alias("links")), "links")


def audit(
    units: DataFrame, copies: DataFrame, parts: DataFrame, counted: DataFrame, rows: int = AUDITED
) -> float:
    """Share of its links that was found for a class, as the mean over the groups that a bounded
    sample of classes falls in; 1 if none of them has a link.

    A group is a component as found, and has the mean of its sampled classes. So a large group,
    with most of the links, counts no more than a lost pair.
    """
    sample = units.orderBy(F.xxhash64("id", F.lit("audit"))).limit(rows).collect()
    if not sample:
        return 1.0
    names = [row["id"] for row in sample]
    vectors = [np.frombuffer(row["unit"]) for row in sample]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(len(vectors), np.int64)
        for batch in batches:
            weights = np.array(batch.column(2).to_pylist(), np.int64)
            units = [np.frombuffer(u.as_buffer()) for u in batch.column(1)]
            for size in {len(u) for u in units}:
                at = [i for i, u in enumerate(units) if len(u) == size]
                some = [i for i, v in enumerate(vectors) if len(v) == size]
                if some:
                    linked = np.stack([units[i] for i in at]) @ np.stack([vectors[i] for i in some]).T >= THRESHOLD
                    totals[some] += weights[at] @ linked
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(totals)], ["id", "links"])

    whole = units.join(copies, "id").select("id", "unit", "copies").mapInArrow(compare, "id bigint, links bigint")
    whole = whole.groupBy("id").agg(F.sum("links").alias("links"))
    true, own, found, group = [
        dict(df.filter(F.col("id").isin(names)).collect()) for df in (whole, copies, counted, parts)
    ]
    shares: dict[int, list[float]] = {}
    for name in names:
        if (links := true[name] - own[name]) > 0:
            shares.setdefault(group.get(name, name), []).append(min(1.0, found.get(name, 0) / links))
    return float(np.mean([np.mean(share) for share in shares.values()])) if shares else 1.0


def _compare_parts(part: pa.Table) -> pa.Table:
    """All classes of two parts: the links of each with the other part, and a class that stands
    for those that the links of these two parts tie together."""
    columns = [np.array(part.column(name).to_pylist(), np.int64) for name in ("id", "copies", "part", "one", "two")]
    ids, weights, at = columns[:3]
    units = np.stack([np.frombuffer(u.as_buffer()) for u in part.column("unit")])
    same = columns[3][0] == columns[4][0]
    first = np.flatnonzero(at == columns[3][0])
    second = first if same else np.flatnonzero(at == columns[4][0])
    links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
    for start in range(0, len(first), _BLOCK):
        rows = first[start : start + _BLOCK]
        linked = units[rows] @ units[second].T >= THRESHOLD
        if same:
            linked[np.arange(len(rows)), np.arange(start, start + len(rows))] = False
        links[rows] += linked @ weights[second]
        if not same:
            links[second] += weights[rows] @ linked
        for row, near in zip(rows, linked):
            tied = root[second[near]]
            if (tied != root[row]).any():
                tied = np.append(tied, root[row])
                root[np.isin(root, tied)] = tied.min()
    some = np.flatnonzero(links)
    return pa.table([ids[some], ids[root[some]], links[some]], ["id", "near", "links"])


def _compare_all(units: DataFrame, copies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As :func:`_count_links`, from comparing every class with every other of its size, without lists.

    Classes are dealt to parts of ``_PART``, and a task has two parts at a time.
    """
    rows = written(units.join(copies, "id").withColumn("size", F.octet_length("unit")), "all classes")
    at = numbered(rows.select("size", "id"), "size", ["id"], "at", rows.count())
    dealt = written(at.select("id", F.floor(F.col("at") / _PART).alias("part")), "parts")
    dealt = rows.join(dealt, "id")
    last = dealt.groupBy("size").agg(F.max("part").alias("last"))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), "last"))
    pairs = dealt.join(F.broadcast(last), "size").withColumn("other", other).select(
        "id", "copies", "unit", "size", "part",
        F.least("part", "other").alias("one"), F.greatest("part", "other").alias("two"),
    )
    found = pairs.groupBy("size", "one", "two").applyInArrow(_compare_parts, "id bigint, near bigint, links bigint")
    found = written(found, "all links")
    tied = found.filter("id != near").select(F.greatest("id", "near").alias("a"), F.least("id", "near").alias("b"))
    return connected_components(tied.distinct()), found.groupBy("id").agg(F.sum("links").alias("links"))


def near_duplicate_vectors(
    table: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
    neighbours: int = NEIGHBOURS, recall: float = RECALL,
) -> DataFrame:
    """A row per row of ``table``: its id, ``n_links``, ``component_id`` (the smallest id that links
    reach) and ``kept`` (whether that is its own).

    Links have a cosine of ``THRESHOLD`` or more in double precision, between vectors of as many
    components. A vector that is NULL, zero, or holds NULL or something not finite has none; nor has a
    row with a NULL id, which has no component and is kept. Rows that repeat an id are one vector,
    the first of theirs by digest. Other columns are not looked at.
    """
    source = table.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    prepared = written(source.mapInArrow(_prepare, "id bigint, key binary, unit binary"), "vectors")
    usable = prepared.filter("id is not null and key is not null")
    chosen = usable.groupBy("id").agg(F.min("key").alias("key"))
    # A vector that repeats under many ids is one class; its smallest id names it.
    named = chosen.groupBy("key").agg(F.min("id").alias("top"), F.count("*").alias("copies"))
    vectors = usable.groupBy("key").agg(F.first("unit").alias("unit"))
    classes = written(
        named.join(vectors, "key").select(F.col("top").alias("id"), "key", "copies", "unit"), "classes"
    )
    units, copies = classes.select("id", "unit"), classes.select("id", "copies")
    n = classes.count()
    coded = units.mapInArrow(_codes, "`order` int, size int, code bigint, id bigint, unit binary")
    sorted_rows = coded.repartitionByRange(max(8, n // 100_000), "order", "size", "code", "id")
    sorted_rows = sorted_rows.sortWithinPartitions("order", "size", "code", "id")
    edges = written(sorted_rows.mapInArrow(_adjacent, _EDGES), "edges")
    links = _links_of(edges)
    lists = written(_nearest(edges, neighbours), "lists")
    size = neighbours
    while True:
        for _ in range(_ROUNDS):
            edges = written(_refined(lists, units, size), "edges")
            links = links.unionByName(_links_of(edges))
            after = written(_nearest(lists.unionByName(edges), size), "lists")
            changed = after.join(lists, ["id", "near"], "left_anti").count()
            lists = after
            if changed <= _STEADY * n * size:
                break
        parts, counted = _count_links(links, units, copies)
        if audit(units, copies, parts, counted) >= recall:
            break
        if size >= _ENLARGED**4 * neighbours or size >= n:
            parts, counted = _compare_all(units, copies)
            break
        size *= _ENLARGED
    result = classes.join(parts, "id", "left").join(counted, "id", "left").select(
        "key", F.coalesce("component", "id").alias("component"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    by_id = chosen.join(result, "key").drop("key")
    component = F.coalesce("component", "id")
    return prepared.select("id").join(by_id, "id", "left").select(
        F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )


def op10_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"))
