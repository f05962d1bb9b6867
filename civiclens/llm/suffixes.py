"""Removal of repeated byte strings by distributed prefix doubling.

A string of ``length`` bytes is repeated if it starts at two or more positions of the corpus. To rank
all positions would sort every byte several times, so positions that cannot repeat, and
equal surroundings, are taken out first; what is left is exact all the same:

1. Each window of ``length`` bytes has an anchor, its start of half a length (a gram) with the smallest
   hash. Equal windows have equal anchors at equal places, and neighbouring windows
   share one, so there is an anchor every fifty bytes or so. Where the gram of an anchor is
   unique, none of its windows is repeated.
2. The windows of an anchor and the bytes they span are a context. Equal contexts are folded into one
   with a weight. From a weight of two on, all its windows are repeated.
3. Where a context occurs once but shares its gram with others, each of its windows is a
   position for prefix doubling: ranked by the first half, positions of a unique rank
   leave; the others are ranked by the pair of that rank and the rank at the doubled offset,
   where the threshold is reached. Positions whose rank has a weight of two are repeated.

Ranks are names of classes (64-bit hashes of bytes, paired), which serve as well as numbers in
sorted order, as only equality matters here. Spark shuffles and groups them.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclens.llm.tables import read_table, written
from civiclens.scratch import discard
from civiclens.llm.texts import RollingHash, flat, release_memory, slices

LENGTH = 200
_PIECE = 1 << 19
_OUT_BYTES = 1 << 22  # text whose results go out together
_AT = np.uint64((1 << 20) - 1)
_TEXT = "repeat text"
_SPANS = "repeat spans"


class Anchors:
    """Contexts of many texts at a time."""

    def __init__(self, length: int):
        if not 16 <= length <= 254 or length % 2:
            raise ValueError("the length must be even, from 16 to 254")
        self.length, self.gram = length, length // 2
        self.width = length - self.gram + 1  # grams of a window
        self.hashes = RollingHash(11), RollingHash(12)

    def of(self, data: np.ndarray, offsets: np.ndarray, contents: bool):
        """Gram hash, row, first window, anchor's distance from it, windows, and two content hashes."""
        parts = []
        for start, end in slices(offsets, _PIECE):
            part = offsets[start : end + 1]
            base, top = int(part[0]), int(part[-1])
            if top - base <= _PIECE:
                parts.append((*self._piece(data[base:top], part - base, contents), start, 0))
                continue
            for at in range(base, top - self.length + 1, _PIECE):  # one long text
                piece = data[at : min(at + _PIECE + self.length - 1, top)]
                parts.append((*self._piece(piece, np.array([0, len(piece)]), contents), start, at - base))
        columns = [[] for _ in range(7)]
        for gram, row, first, far, windows, one, two, start, base in parts:
            for column, values in zip(columns, (gram, row + start, first + base, far, windows, one, two)):
                column.append(values)
        return [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns]

    def _piece(self, data: np.ndarray, offsets: np.ndarray, contents: bool):
        none = np.zeros(0, np.int64)
        if len(data) < self.length:
            return none.astype(np.uint64), none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
        sums = self.hashes[0].prepare(data)
        place = np.arange(len(data) - self.gram + 1)
        grams = self.hashes[0].of(sums, place, place + self.gram)
        lowest = self._lowest(grams & ~_AT | place.astype(np.uint64))
        anchor = (lowest & _AT).astype(np.int64)
        window = np.arange(len(anchor))
        sizes = np.diff(offsets)
        row = np.repeat(np.arange(len(sizes)), sizes)[: len(anchor)]
        inside = window + self.length <= offsets[row + 1]
        window, anchor, row = window[inside], anchor[inside], row[inside]
        first = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (np.diff(window, prepend=-2) != 1))
        windows = np.diff(first, append=len(window))
        start, anchor, row = window[first], anchor[first], row[first]
        one = two = np.zeros(len(start), np.uint64)
        if contents:
            end = start + windows + self.length - 1
            one = self.hashes[0].of(sums, start, end)
            two = self.hashes[1].of(self.hashes[1].prepare(data), start, end)
        return grams[anchor], row, start - offsets[row], anchor - start, windows, one, two

    def _lowest(self, keys: np.ndarray) -> np.ndarray:
        """Minimum of every run of ``width`` keys, by minima from both ends of blocks."""
        width, n = self.width, len(keys)
        blocks = np.full(-(-n // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
        blocks[:n] = keys
        blocks = blocks.reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def _grams(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(length)
        for batch in batches:
            data, offsets = flat(batch.column(0))
            for start, end in slices(offsets, _OUT_BYTES):
                part = offsets[start : end + 1]
                grams = anchors.of(data[part[0] : part[-1]], part - part[0], contents=False)[0]
                yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64))], ["gram"])
            release_memory()

    return run


def _contexts(length: int):
    """(text key, text) to contexts: gram, two content hashes, text key and ``place``, which packs the
    first window, the distance of the anchor from it and the number of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(length)
        for batch in batches:
            data, offsets = flat(batch.column(1))
            for start, end in slices(offsets, _OUT_BYTES):
                part = offsets[start : end + 1]
                found = anchors.of(data[part[0] : part[-1]], part - part[0], contents=True)
                gram, row, first, far, windows, one, two = found
                place = first << 16 | far << 8 | windows
                hashes = [pa.array(x.view(np.int64)) for x in (gram, one, two)]
                keys = batch.column(0).take(pa.array(row.astype(np.int64) + start))
                yield pa.RecordBatch.from_arrays(
                    [*hashes, keys, pa.array(place.astype(np.int64))], ["gram", "one", "two", "text", "place"]
                )
            release_memory()

    return run


def _cut_out(length: int):
    """(text, places with the number of their context) to the bytes of each context."""

    def table(names: list, heavy: list, out: list) -> pa.RecordBatch:
        columns = list(zip(*names)) or [[]] * 3
        kinds = [pa.int64(), pa.int64(), pa.int64()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        arrays += [pa.array(heavy, pa.bool_()), pa.array(out, pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, ["one", "two", "windows", "heavy", "bytes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, heavy, out, size = [], [], [], 0
            for text, places in zip(batch.column(0), batch.column(1)):
                data = text.as_py().encode()
                for place in places:
                    place = place.as_py()
                    first, windows = place["place"] >> 16, place["place"] & 0xFF
                    names.append((place["one"], place["two"], windows))
                    heavy.append(place["weight"] > 1)
                    out.append(data[first : first + windows + length - 1])
                    size += windows + length - 1
                    if size >= _OUT_BYTES:
                        yield table(names, heavy, out)
                        names, heavy, out, size = [], [], [], 0
            yield table(names, heavy, out)
            release_memory()

    return run


def _positions(length: int, second: bool):
    """(number of the context, whether it weighs more than 1, bytes) to a row per window: ``position``
    (context, window, and the weight in the last bit) with the rank of its first half and the
    rank at the doubled offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling, half = RollingHash(13), length // 2
        for batch in batches:
            data, offsets = flat_binary(batch.column(2))
            number = batch.column(0).to_numpy()
            heavy = np.array(batch.column(1).to_pylist(), bool).astype(np.int64)
            for start, end in slices(offsets):
                part = offsets[start : end + 1]
                sums = rolling.prepare(data[part[0] : part[-1]])
                windows = np.diff(part) - length + 1
                row = np.repeat(np.arange(len(windows)), windows)
                window = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
                at = (part[:-1] - part[0])[row] + window
                position = number[start:end][row] << 9 | window << 1 | heavy[start:end][row]
                columns = [position, rolling.of(sums, at, at + half).view(np.int64)]
                if second:
                    columns.append(rolling.of(sums, at + half, at + length).view(np.int64))
                names = ["position", "rank", "rank_ahead"][: len(columns)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)
            release_memory()

    return run


def flat_binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def repeated_windows(docs: DataFrame, text_column: str = "text", length: int = LENGTH) -> DataFrame:
    """(``text``, ``ranges``) for texts with repeated windows: a digest of the text, and the first window and
    number of windows of each range."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    keyed = docs.select(_key(text).alias("text"), text.alias("body"))
    keyed = keyed.filter(F.octet_length("body") >= length)
    grams = keyed.select("body").mapInArrow(_grams(length), "gram bigint")
    shared = written(grams.groupBy("gram").count().filter("count > 1").select("gram"), "grams")
    contexts = keyed.mapInArrow(
        _contexts(length), "gram bigint, one bigint, two bigint, text binary, place bigint"
    )
    found = written(contexts.join(shared, "gram", "left_semi"), "contexts")
    discard(shared)
    # Copies of a text have the same contexts; each is taken once, with their number.
    once = written(found.groupBy(*found.columns).agg(F.count("*").alias("copies")), "contexts")
    discard(found)
    contexts = once.withColumn("windows", F.col("place").bitwiseAND(0xFF))
    name = ["one", "two", "windows"]
    folded = written(
        contexts.groupBy("gram", *name).agg(
            F.sum("copies").alias("weight"), F.min(F.struct("text", "place")).alias("sample")
        ),
        "folded",
    )
    shared = folded.groupBy("gram").agg(F.min("weight").alias("least"), F.count("*").alias("n"))
    unsure = folded.join(shared.filter("least = 1 and n > 1").select("gram"), "gram")
    places = unsure.select("sample.text", "sample.place", "one", "two", "weight")
    places = places.groupBy("text").agg(F.collect_list(F.struct("place", "one", "two", "weight")).alias("places"))
    # Of rows with equal texts, any one will do; contexts are numbered once they are written.
    bodies = keyed.join(places, "text").dropDuplicates(["text"]).select("body", "places")
    cut = bodies.mapInArrow(
        _cut_out(length), "one bigint, two bigint, windows bigint, heavy boolean, bytes binary"
    )
    numbers = written(cut.withColumn("number", F.monotonically_increasing_id()), "numbered contexts")
    doubled = _doubled(numbers, length)
    repeated = numbers.filter("not heavy").join(doubled, "number").select(*name, "repeated")
    sure = folded.select(*name, (F.col("weight") > 1).alias("all"))
    first = F.shiftright("place", 16)
    whole = F.array(F.struct(first.alias("first"), F.col("windows").alias("n")))
    each = F.transform("repeated", lambda w: F.struct((first + w).alias("first"), F.lit(1).cast("bigint").alias("n")))
    known = sure.join(repeated, name, "left").filter("all or repeated is not null")
    ranges = (
        contexts.select("text", "place", *name).join(known, name)
        .select("text", F.when(F.col("all"), whole).otherwise(each).alias("ranges"))
        .groupBy("text").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    )
    ranges = written(ranges, "ranges")
    discard(once, numbers, folded, doubled)
    return ranges


def _doubled(numbers: DataFrame, length: int) -> DataFrame:
    """(``number``, ``repeated``): windows of contexts of weight 1 that are repeated elsewhere."""
    weight = F.sum(F.col("position").bitwiseAND(1) + 1)
    numbers = numbers.select("number", "heavy", "bytes")
    once = numbers.mapInArrow(_positions(length, second=False), "position bigint, rank bigint")
    firsts = once.groupBy("rank").agg(weight.alias("weight")).filter("weight > 1").select("rank")
    pairs = numbers.mapInArrow(
        _positions(length, second=True), "position bigint, rank bigint, rank_ahead bigint"
    )
    firsts = written(firsts, "ranks")
    left = written(pairs.join(firsts, "rank", "left_semi"), "positions")
    discard(firsts)
    ranked = left.groupBy("rank", "rank_ahead").agg(weight.alias("weight")).filter("weight > 1")
    again = left.filter(F.col("position").bitwiseAND(1) == 0).join(
        ranked.select("rank", "rank_ahead"), ["rank", "rank_ahead"], "left_semi"
    )
    window = F.shiftright("position", 1).bitwiseAND(0xFF)
    doubled = again.groupBy(F.shiftright("position", 9).alias("number")).agg(
        F.collect_list(window).alias("repeated")
    )
    doubled = written(doubled, "repeated windows")
    discard(left)
    return doubled


def _key(text):
    return F.unhex(F.md5(F.encode(text, "UTF-8")))


def _spans(ranges: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the windows cover."""
    spans = []
    for one in sorted((r["first"], r["first"] + r["n"] - 1 + length) for r in ranges or []):
        if spans and one[0] <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(one[1], spans[-1][1]))
        else:
            spans.append(one)
    return spans


def kept_bytes(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for start, end in spans:
        out.append(data[at:start])
        at = end
    return b"".join([*out, data[at:]])


def with_repeats(
    docs: DataFrame, text_column: str = "text", length: int = LENGTH, column: str = _SPANS
) -> DataFrame:
    """``docs`` with the spans of repeated bytes (start and end in UTF-8), in order and apart, in ``column``.

    NULL and texts shorter than ``length`` have none. Rows count as they come: a text that is there twice
    is repeated as a whole, whatever the ids.
    """
    key = _free(docs, _TEXT)
    ranges = repeated_windows(docs, text_column, length).toDF(key, "repeat ranges")
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    own = [f"`{c}`" for c in docs.columns if c != column]
    keyed = docs.select(*own, F.when(F.octet_length(text) >= length, _key(text)).alias(key))

    @F.arrow_udf("array<struct<start:bigint,end:bigint>>")
    def spans(column: pa.Array) -> pa.Array:
        out = [[{"start": a, "end": b} for a, b in _spans(r.as_py(), length)] for r in column]
        out = pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
        release_memory()
        return out

    found = ranges.select(key, spans("repeat ranges").alias(column))
    return keyed.join(found, key, "left").select(*own, f"`{column}`")


def _free(docs: DataFrame, name: str) -> str:
    """A name that no column of ``docs`` has."""
    while name.lower() in (c.lower() for c in docs.columns):
        name += " too"
    return name


def remove_repeats(docs: DataFrame, text_column: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with their texts less all repeated spans, each cut to whole characters."""

    @F.arrow_udf("string")
    def kept(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for text, found in zip(texts, spans):
            text, found = text.as_py(), found.as_py()
            if not text or not found:
                out.append(text)
                continue
            data = text.encode()
            whole = []
            for span in found:
                start, end = span["start"], span["end"]
                while start < end and data[start] & 0xC0 == 0x80:
                    start += 1
                while end < len(data) and end > start and data[end] & 0xC0 == 0x80:
                    end -= 1
                whole.append((start, end))
            out.append(kept_bytes(data, whole).decode())
        out = pa.array(out, pa.string())
        release_memory()
        return out

    found = _free(docs, _SPANS)
    marked = with_repeats(docs, text_column, length, found)
    texts = kept(F.col(f"`{text_column}`"), F.col(f"`{found}`")).alias(text_column)
    return marked.select(*[texts if c == text_column else F.col(f"`{c}`") for c in docs.columns])


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            data = (text or "").encode()
            runs = [(s["start"], s["end"]) for s in spans or []]
            left = kept_bytes(data, runs)
            rows.append((len(data), len(data) - len(left), len(runs), hashlib.sha256(left).hexdigest()))
        columns = list(zip(*rows)) or [[]] * 4
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)


def op4_prefix_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_repeats(docs).select("doc_id", "text", _SPANS).mapInArrow(
        _digest_rows, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    )
