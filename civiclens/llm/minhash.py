"""Near duplicates by MinHash: banding, verification, connected components.

Texts are sets of word shingles. Equal sets are one class, named by a digest of the whole set. A class
has the minima of many universal hash functions; classes that agree in all rows of a band meet
in a bucket. Pairs are verified by their signatures first and by their full sets then.

A bucket of many near copies is never paired with itself. Every bucket has a hub, to which its
members are compared, and then another, for those that are not in one component yet. What
hubs leave open are members outside the main component of their bucket. They are taken in blocks of
near relatives, and a block meets all members of its buckets once, however many buckets they share: a
task holds the sets of a block, goes through those of the others, and passes on only the
links that join two components. So no link that the bands have found is lost to the components.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclens.llm.components import connected_components
from civiclens.llm.tables import read_table, written
from civiclens.llm.texts import distinct_by_row, flat, ragged, random_words, shingles, slices

WORDS = 5
PERCENT = 80
BANDS = 25
ROWS = 5
# Hash functions of a signature; the bands take the first of them.
HASHES = 200
# Signatures of a pair of the least similarity agree less than so many deviations below the
# mean once in a hundred thousand times.
_DEVIATIONS = 4.2
# Open members of a block, bytes of their sets, and members that a task compares with a block.
_BLOCK, _BLOCK_BYTES, _PARTNERS = 512, 16_000_000, 4096
_SEED = 5
_SHIFT = np.uint64(32)


def _digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(np.ascontiguousarray(values).view(np.uint8), digest_size=16).digest()


class Signer:
    """Sets, digests and signatures of many texts at a time."""

    def __init__(self, words: int, size: int = HASHES):
        self.words, self.size = words, size
        self.factors = random_words(self.size, 21) | np.uint64(1)
        self.terms = random_words(self.size, 22)

    def sets(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles of each text in order, and where each text starts among them."""
        values, rows = distinct_by_row(*shingles(data, offsets, self.words, _SEED))
        counts = np.bincount(rows, minlength=len(offsets) - 1)
        return values, np.append(0, np.cumsum(counts))

    def signatures(self, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Minima per text and hash function; zeros for an empty set."""
        out = np.zeros((len(starts) - 1, self.size), np.uint32)
        some = np.flatnonzero(np.diff(starts))
        if len(some):
            keys, firsts = values >> _SHIFT, starts[some]
            for i in range(self.size):
                hashed = (keys * self.factors[i] + self.terms[i]) >> _SHIFT
                out[some, i] = np.minimum.reduceat(hashed, firsts)
        return out


def describe(docs: DataFrame, words: int) -> DataFrame:
    """(``id``, ``n_shingles``, ``digest``, ``signature``) of each row of (``id``, ``text``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(words)
        for batch in batches:
            data, offsets = flat(batch.column(1))
            counts, digests, signatures = [], [], []
            for start, end in slices(offsets):
                part = offsets[start : end + 1]
                values, starts = signer.sets(data[part[0] : part[-1]], part - part[0])
                counts += np.diff(starts).tolist()
                digests += [_digest(values[a:b]) for a, b in zip(starts[:-1], starts[1:])]
                signatures += [s.tobytes() for s in signer.signatures(values, starts)]
            kinds = [pa.int64(), pa.binary(), pa.binary()]
            arrays = [pa.array(c, k) for c, k in zip((counts, digests, signatures), kinds)]
            names = ["id", "n_shingles", "digest", "signature"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(
        run, f"id {kind}, n_shingles bigint, digest binary, signature binary"
    )


def _buckets(bands: int, rows: int):
    factors, seeds = random_words(rows, 31) | np.uint64(1), random_words(bands, 32)

    @F.arrow_udf("array<bigint>")
    def buckets(signatures: pa.Array) -> pa.Array:
        minima = np.frombuffer(b"".join(signatures.to_pylist()), np.uint32)
        minima = minima.reshape(len(signatures), -1)[:, : bands * rows]
        keys = minima.reshape(-1, bands, rows).astype(np.uint64)
        out = np.broadcast_to(seeds, keys.shape[:2]).copy()
        for i in range(rows):
            out = (out ^ keys[:, :, i]) * factors[i]
            out ^= out >> np.uint64(29)
        offsets = pa.array(np.arange(len(out) + 1, dtype=np.int32) * bands)
        return pa.ListArray.from_arrays(offsets, pa.array(out.ravel().view(np.int64)))

    return buckets


def _set_rows(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(words, 0)
        for batch in batches:
            data, offsets = flat(batch.column(0))
            digests, out = [], []
            for start, end in slices(offsets):
                part = offsets[start : end + 1]
                values, starts = signer.sets(data[part[0] : part[-1]], part - part[0])
                sets = [values[a:b] for a, b in zip(starts[:-1], starts[1:])]
                digests += map(_digest, sets)
                out += [one.tobytes() for one in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), pa.array(out, pa.binary())], ["digest", "members"]
            )

    return run


def _least_agreement(percent: int) -> float:
    p = percent / 100
    return p - _DEVIATIONS * (p * (1 - p) / HASHES) ** 0.5


def _verify(percent: int):
    least = _least_agreement(percent)

    @F.arrow_udf("boolean")
    def verified(sig_a: pa.Array, set_a: pa.Array, sig_b: pa.Array, set_b: pa.Array) -> pa.Array:
        out = []
        for sa, a, sb, b in zip(sig_a, set_a, sig_b, set_b):
            agree = np.frombuffer(sa.as_buffer(), np.uint32) == np.frombuffer(sb.as_buffer(), np.uint32)
            if agree.mean() < least:
                out.append(False)
                continue
            a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (a, b))
            both = np.concatenate([a, b])
            both.sort()
            shared = int((both[1:] == both[:-1]).sum())
            out.append(100 * shared >= percent * (len(both) - shared))
        return pa.array(out, pa.bool_())

    return verified


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """A row per document: its id, ``n_shingles``, ``component_id`` (the smallest id that can be reached
    by links) and ``kept`` (whether that is its own).

    Two sets are linked if 100 times their intersection is at least ``percent`` times their
    union. A text without words, NULL among them, has an empty set and no links. An id is one
    document: rows that repeat it belong together, each linked by its own text. A row with a NULL id is
    linked with nothing and kept, without a component. Any other columns are not looked at. Ids may be
    of any type that has an order.
    """
    if bands * rows > HASHES:
        raise ValueError(f"the bands take more than {HASHES} hashes")
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    described = written(describe(texts, words), "described")
    linkable = described.filter("id is not null and n_shingles > 0")
    classes = written(
        linkable.groupBy("digest").agg(F.min("id").alias("top"), F.first("signature").alias("signature")),
        "classes",
    )
    banded = classes.select("digest", F.posexplode(_buckets(bands, rows)("signature")).alias("band", "bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("n"), F.min("digest").alias("hub"))
    members = banded.join(shared.filter("n > 1").select("bucket", "hub"), "bucket")
    members = written(members.select("bucket", "digest", "hub").distinct(), "members")
    found = classes.join(members.select("digest").distinct(), "digest", "left_semi")
    sets = (
        texts.join(found.select(F.col("top").alias("id")).distinct(), "id", "left_semi")
        .select("text")
        .mapInArrow(_set_rows(words), "digest binary, members binary")
    )
    # An id may have other texts too, and a text may come twice.
    sets = written(found.select("digest", "signature").join(sets, "digest").dropDuplicates(["digest"]), "sets")
    links = _links(members, sets, percent)
    # Classes that share an id belong together.
    owned = linkable.select("id", "digest").distinct()
    several = owned.groupBy("id").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).filter("a <> b")
    several = written(several.select("id", "a"), "repeated ids")
    if not several.isEmpty():
        links = links.unionByName(owned.join(several, "id").select("a", F.col("digest").alias("b")))
    parts = connected_components(links).select(F.col("id").alias("digest"), "component")
    placed = classes.select("digest", "top").join(parts, "digest", "left")
    placed = placed.withColumn("component", F.coalesce("component", "digest"))
    smallest = placed.groupBy("component").agg(F.min("top").alias("component_id"))
    placed = placed.join(smallest, "component").select("digest", "component_id")
    of_id = linkable.select("id", "digest").join(placed, "digest")
    of_id = of_id.groupBy("id").agg(F.min("component_id").alias("component_id"))
    known = F.coalesce("component_id", "id")
    return described.join(of_id, "id", "left").select(
        F.col("id").alias(id_column), "n_shingles",
        known.alias("component_id"), F.coalesce(F.col("id") == known, F.lit(True)).alias("kept"),
    )


def _links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Verified links (``a``, ``b``), enough of them for the components that all links make."""
    pairs = members.select(F.col("hub").alias("a"), F.col("digest").alias("b")).filter("a <> b")
    tested = _judged(pairs, sets, percent)
    links = tested.filter("linked").select("a", "b")
    placed = _placed(members.select("bucket", "digest"), links)
    if placed.isEmpty():
        return links
    judged = _judged(_star_pairs(placed), sets, percent, tested)
    links = links.unionByName(judged.filter("linked").select("a", "b"))
    placed = _placed(placed.select("bucket", "digest"), links)
    return links if placed.isEmpty() else links.unionByName(_open_links(placed, sets, percent))


def _judged(pairs: DataFrame, sets: DataFrame, percent: int, tested: DataFrame | None = None) -> DataFrame:
    """(``a``, ``b``, ``linked``) for pairs that were not tested before."""
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    if tested is not None:
        pairs = pairs.join(tested, ["a", "b"], "left_anti")
    left, right = sets.toDF("a", "sig_a", "set_a"), sets.toDF("b", "sig_b", "set_b")
    linked = _verify(percent)("sig_a", "set_a", "sig_b", "set_b").alias("linked")
    return written(pairs.join(left, "a").join(right, "b").select("a", "b", linked), "judged")


def _placed(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members of buckets that are not known to be in one component, with the name of what they are in.

    A name is that of the smallest neighbour of the smallest neighbour, which is surely linked with the
    member. So pairs with one name need no test, and some with two names are tested though linked.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    nearest = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("b"))
    tops = nearest.toDF("b", "top")
    named = nearest.join(tops, "b").select(F.col("a").alias("digest"), F.col("top").alias("component"))
    placed = members.join(named, "digest", "left").select(
        "bucket", "digest", F.coalesce("component", "digest").alias("component")
    )
    placed = written(placed, "placed")
    split = placed.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    ).filter("low < high")
    return written(placed.join(split.select("bucket"), "bucket"), "placed")


def _star_pairs(placed: DataFrame) -> DataFrame:
    """The members of each bucket with a hub chosen by a hash, unless they are in one component."""
    drawn = F.struct(F.xxhash64("bucket", "digest"), "digest", "component")
    hubs = placed.groupBy("bucket").agg(F.min(drawn).alias("hub"))
    pairs = placed.join(hubs, "bucket").filter("component <> hub.component")
    return pairs.select(F.col("hub.digest").alias("a"), F.col("digest").alias("b"))


def _open_links(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components: of members outside the main component of a bucket with all others there.

    The open members go to blocks by the smallest member of their buckets, so that near copies
    share one, and a block meets every member of any of its buckets, once. Those it meets are dealt
    to parts of some ``_PARTNERS``, each with the sets of the block.
    """
    sizes = placed.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.min("digest").alias("least"))
    main = sizes.groupBy("bucket").agg(
        F.max(F.struct("n", "component"))["component"].alias("main"), F.min("least").alias("least")
    )
    outside = written(
        placed.join(main, "bucket").filter("component <> main").select("bucket", "digest", "component", "least"),
        "outside",
    )
    opened = outside.groupBy("digest", "component").agg(F.min("least").alias("family"))
    opened = opened.join(sets.select("digest", F.octet_length("members").alias("bytes")), "digest")
    each = opened.groupBy("family").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    blocks = F.ceil(F.greatest(F.col("n") / _BLOCK, F.col("bytes") / _BLOCK_BYTES))
    block = F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("bigint").alias("block")
    opened = opened.join(each.select("family", blocks.alias("blocks")), "family")
    opened = written(opened.select("family", block, "digest", "component"), "open")
    reached = outside.select("bucket", "digest").join(opened.drop("component"), "digest")
    reached = reached.select("family", "block", "bucket").distinct()
    met = written(reached.join(placed, "bucket").select("family", "block", "digest", "component").distinct(), "met")
    each = met.groupBy("family", "block").agg(F.ceil(F.count("*") / _PARTNERS).cast("bigint").alias("parts"))
    part = F.pmod(F.xxhash64("digest"), F.col("parts"))
    met = met.join(each, ["family", "block"]).withColumn("part", part).withColumn("met", F.lit(True))
    own = opened.join(each, ["family", "block"]).withColumn("met", F.lit(False))
    own = own.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    key = ["family", "block", "part"]
    rows = met.select(*key, "met", "digest", "component").unionByName(own.select(*key, "met", "digest", "component"))
    rows = rows.join(sets.select("digest", "members"), "digest").repartition(*key)
    rows = rows.sortWithinPartitions(*key, "met").select(*key, "met", "digest", "component", "members")
    return written(rows.mapInArrow(_forest(percent), "a binary, b binary"), "open links")


def _forest(percent: int):
    """Links between the sets of a block, which come first, and those it meets, but only such as join
    two components that the task has not joined yet."""

    class Block:
        def __init__(self):
            self.digests, self.sets, self.top = [], [], {}
            self.index = None

        def find(self, component: bytes) -> bytes:
            top = self.top
            while top.setdefault(component, component) != component:
                top[component] = component = top[top[component]]
            return component

        def add(self, digest: bytes, component: bytes, members: np.ndarray) -> None:
            self.digests.append((digest, component))
            self.sets.append(members)

        def links(self, digest: bytes, component: bytes, members: np.ndarray) -> Iterator[tuple[bytes, bytes]]:
            if self.index is None:
                self.lengths = np.array([len(one) for one in self.sets])
                values = np.concatenate(self.sets)
                owners = np.repeat(np.arange(len(self.sets)), self.lengths)
                order = np.argsort(values, kind="stable")
                self.owners = owners[order]
                self.index, self.starts = np.unique(values[order], return_index=True)
                self.sizes = np.diff(self.starts, append=len(values))
                self.sets = []
            at = np.minimum(np.searchsorted(self.index, members), len(self.index) - 1)
            at = at[self.index[at] == members]
            shared = np.bincount(self.owners[ragged(self.starts[at], self.sizes[at])], minlength=len(self.lengths))
            union = self.lengths + len(members) - shared
            for i in np.flatnonzero(100 * shared >= percent * union).tolist():
                other, its = self.digests[i]
                one, two = self.find(its), self.find(component)
                if one != two:
                    self.top[max(one, two)] = min(one, two)
                    yield other, digest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, block = None, Block()
        for batch in batches:
            out = []
            keys = zip(*(batch.column(i).to_pylist() for i in range(3)))
            for key, met, digest, component, members in zip(keys, *(batch.column(i) for i in range(3, 7))):
                if key != last:
                    last, block = key, Block()
                row = digest.as_py(), component.as_py(), np.frombuffer(members.as_buffer(), np.uint64)
                if met.as_py():
                    out += block.links(*row)
                else:
                    block.add(*row)
            columns = list(zip(*out)) or [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], ["a", "b"])

    return run


def op8_minhash_stars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), words=2)
