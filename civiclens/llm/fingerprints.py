"""Document fingerprints by one-permutation MinHash.

The shingles of a text (five words) are hashed once. The high bits of a hash choose one of
``bins``, and each bin keeps its smallest hash. An empty bin takes the value of another one,
found by a fixed sequence of draws that depends on the bin alone (optimal densification), so
equal sets stay equal and the estimate unbiased. The low ``bits`` of each bin are packed.
Two such fingerprints agree in a bin by chance too, which the likeness corrects for.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civiclens.llm.tables import read_table, written
from civiclens.llm.texts import SLICE_BYTES, flat, mix, random_words, shingles, slices

BINS = 512
BITS = 4
WORDS = 5
_SEED = 3
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_ROWS = 256


class Fingerprinter:
    """Fingerprints of many texts at a time."""

    def __init__(self, bins: int = BINS, bits: int = BITS, words: int = WORDS):
        if bins & (bins - 1) or bits not in (1, 2, 4, 8):
            raise ValueError("bins must be a power of two, and bits 1, 2, 4 or 8")
        self.bins, self.bits, self.words = bins, bits, words

    def of(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """A row of packed bytes per text; without any word, zeros (see ``is_blank``)."""
        values, rows = shingles(data, offsets, self.words, _SEED)
        texts = len(offsets) - 1
        shift = np.uint64(64 - (self.bins.bit_length() - 1))
        at = rows * self.bins + (values >> shift).astype(np.int64)
        lowest = np.full(texts * self.bins, _EMPTY)
        np.minimum.at(lowest, at, mix(values))
        lowest = self._densified(lowest.reshape(texts, self.bins))
        # The bits depend on the bin too, else bins with one source would agree or differ together.
        salted = mix(lowest + random_words(self.bins, 41))
        kept = (salted & np.uint64((1 << self.bits) - 1)).astype(np.uint8)
        kept[lowest == _EMPTY] = 0
        return self._packed(kept)

    def _densified(self, lowest: np.ndarray) -> np.ndarray:
        filled = lowest != _EMPTY
        some = filled.any(axis=1)
        row, bin_ = np.nonzero(~filled & some[:, None])
        out, turn = lowest.copy(), 1
        while len(row):
            draw = mix((bin_ + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(turn))
            source = (draw & np.uint64(self.bins - 1)).astype(np.int64)
            found = filled[row, source]
            out[row[found], bin_[found]] = lowest[row[found], source[found]]
            row, bin_ = row[~found], bin_[~found]
            turn += 1
        return out

    def _packed(self, kept: np.ndarray) -> np.ndarray:
        each = 8 // self.bits
        parts = kept.reshape(len(kept), -1, each)
        shifts = (np.arange(each) * self.bits).astype(np.uint8)
        return np.bitwise_or.reduce(parts << shifts, axis=2).astype(np.uint8)

    def agreement(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Share of bins that agree, for rows of packed bytes."""
        differ = np.bitwise_xor(a, b)
        each, mask = 8 // self.bits, np.uint8((1 << self.bits) - 1)
        equal = sum(((differ >> np.uint8(i * self.bits)) & mask) == 0 for i in range(each))
        return equal.sum(axis=1) / self.bins

    def likeness(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Estimated Jaccard similarity: the agreement less what chance brings, from 0 to 1."""
        chance = 0.5**self.bits
        return np.clip((self.agreement(a, b) - chance) / (1 - chance), 0, 1)

    def compared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Likeness where zeros stand for a text without words: alike among themselves only."""
        blank = ~a.any(axis=1), ~b.any(axis=1)
        out = self.likeness(a, b)
        out[blank[0] ^ blank[1]] = 0.0
        out[blank[0] & blank[1]] = 1.0
        return out


def with_next(docs: DataFrame, id_column: str, name: str = "next_id") -> DataFrame:
    """Distinct non-NULL ids, each with the next one in ascending order (the first after the last).

    Ids are sorted in ranges. Within a range the next row is a window away, and the last of a
    range looks up the first of the next: a table with a row per range.
    """
    ids = docs.select(F.col(id_column).alias("id")).filter("id is not null").distinct()
    ranges = max(8, docs.sparkSession.sparkContext.defaultParallelism)
    ranged = written(
        ids.repartitionByRange(ranges, "id").withColumn("range", F.spark_partition_id()), "ranged-ids"
    )
    firsts = ranged.groupBy("range").agg(F.min("id").alias("first"))
    bound = firsts.agg(F.sort_array(F.collect_list(F.struct("range", "first"))).alias("firsts"))
    following = F.lead("id").over(Window.partitionBy("range").orderBy("id"))
    later = F.filter("firsts", lambda f: f.range > F.col("range"))
    wrapped = F.coalesce(F.get(later, F.lit(0)), F.get(F.col("firsts"), F.lit(0))).first
    return (
        ranged.withColumn(name, following)
        .withColumn("firsts", bound.scalar())
        .select(F.col("id").alias(id_column), F.coalesce(name, wrapped).alias(name))
    )


def fingerprint_documents(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    bins: int = BINS, bits: int = BITS, words: int = WORDS,
) -> DataFrame:
    """A row per document: its id and ``fingerprint`` (hexadecimal).

    A text without words, NULL among them, has a fingerprint of zeros. Repeated rows and rows
    with a NULL id are rows like others; any other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Fingerprinter(bins, bits, words)
        for batch in batches:
            data, offsets = flat(batch.column(1))
            out = []
            for start, end in _parts(offsets):
                part = offsets[start : end + 1]
                out += _hex(maker.of(data[part[0] : part[-1]], part - part[0]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.string())], [id_column, "fingerprint"]
            )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(run, f"`{id_column}` {kind}, fingerprint string")


def _parts(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    for start, end in slices(offsets, SLICE_BYTES):
        for first in range(start, end, _ROWS):
            yield first, min(first + _ROWS, end)


def _hex(packed: np.ndarray) -> list[str]:
    text, width = packed.tobytes().hex(), packed.shape[1] * 2
    return [text[i : i + width] for i in range(0, len(text), width)]


def _edited(text: str, head: str) -> str:
    keep = len(text) - len(text) // 4
    return text[:keep] + head


def _compare_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, next id, text, head of the next text), both packed, to fingerprints of the text and
    the edited one."""
    maker = Fingerprinter()
    for batch in batches:
        columns = [[] for _ in range(5)]
        for start in range(0, batch.num_rows, _ROWS):
            rows = batch.slice(start, _ROWS)
            texts = [_unpacked(t) for t in rows.column(2).to_pylist()]
            heads = [_unpacked(h)[: len(t) // 4] for t, h in zip(texts, rows.column(3).to_pylist())]
            edited = [_edited(t, h) for t, h in zip(texts, heads)]
            prints = [maker.of(*flat(pa.array(part, pa.large_string()))) for part in (texts, edited)]
            columns[0] += map(len, texts)
            columns[1] += [hashlib.sha256(t.encode()).hexdigest() for t in edited]
            columns[2] += [p.tobytes() for p in prints[0]]
            columns[3] += [p.tobytes() for p in prints[1]]
            columns[4] += maker.compared(*prints).tolist()
        kinds = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        names = ["doc_id", "next_id", "n_chars", "edited_sha256", "print", "edited_print", "near_edited"]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names)


def _unpacked(body: bytes | None) -> str:
    return zstandard.decompress(body).decode() if body else ""


def _pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) to texts in about half the bytes, for a shuffle of them."""
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        bodies = [packer.compress((t.as_py() or "").encode()) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(bodies, pa.binary())], ["doc_id", "body"]
        )


def _head_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(asker, next id, packed text, size) to the first ``size`` characters, packed."""
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        pairs = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
        heads = [packer.compress(_unpacked(body)[: size or 0].encode()) for body, size in pairs]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(heads, pa.binary())], ["asker", "next_id", "head"]
        )


def _near():
    @F.arrow_udf("double")
    def near(a: pa.Array, b: pa.Array) -> pa.Array:
        maker = Fingerprinter()
        left, right = (np.frombuffer(b"".join(x.to_pylist()), np.uint8).reshape(len(x), -1) for x in (a, b))
        return pa.array(maker.compared(left, right))

    return near


def op3_one_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text. An id that repeats has one next document,
    and one of its texts, always the same, stands for it towards others; a NULL id has no next
    document, and its text is edited with nothing. The texts are shuffled once, packed: both joins read
    the same exchange.
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    after = written(with_next(docs, "doc_id"), "next-ids")
    sizes = docs.groupBy("doc_id").agg(F.max(F.floor(F.length("text") / 4)).alias("size"))
    wanted = after.join(sizes, "doc_id").select(
        F.col("doc_id").alias("asker"), F.col("next_id").alias("doc_id"), "size"
    )
    packed = docs.mapInArrow(_pack_rows, "doc_id bigint, body binary")
    heads = (
        packed.join(wanted, "doc_id")
        .select("asker", F.col("doc_id").alias("next_id"), "body", "size")
        .mapInArrow(_head_rows, "asker bigint, next_id bigint, head binary")
        .groupBy(F.col("asker").alias("doc_id"), "next_id")
        .agg(F.min("head").alias("head"))
    )
    rows = packed.join(heads, "doc_id").select("doc_id", "next_id", "body", "head")
    nothing = F.lit(None)
    unnamed = docs.filter("doc_id is null").mapInArrow(_pack_rows, "doc_id bigint, body binary").select(
        "doc_id", nothing.cast("bigint").alias("next_id"), "body", nothing.cast("binary").alias("head")
    )
    rows = rows.unionByName(unnamed)
    compared = written(
        rows.mapInArrow(
            _compare_rows,
            "doc_id bigint, next_id bigint, n_chars bigint, edited_sha256 string, "
            "print binary, edited_print binary, near_edited double",
        ),
        "fingerprints",
    )
    prints = compared.groupBy("doc_id").agg(F.min(F.hex("print")).alias("next_print"))
    paired = compared.join(prints.withColumnRenamed("doc_id", "next_id"), "next_id", "left")
    return paired.select(
        "doc_id", "n_chars", "edited_sha256",
        F.lower(F.hex("print")).alias("fingerprint"),
        F.lower(F.hex("edited_print")).alias("edited_fingerprint"),
        "near_edited",
        _near()("print", F.coalesce(F.unhex("next_print"), "print")).alias("near_next"),
    )
