"""Records of large files that do not end where lines do, read by many tasks per file.

A file is read in byte ranges, as Spark splits text: in pieces that end with a separator. Whether a
separator ends a record depends on all that comes before it (quotes, brackets), so a file is read three times:

1. each range says how it changes the state, whatever its state is at the start, and a prefix over the
   ranges of a file gives each its state;
2. each range gives up the parts of records that cross its borders, a few per range, which are put
   together by a small shuffle;
3. each range gives its whole records.

Nothing but these parts is shuffled, and a task never holds more than a batch and one record. States go to
the tasks as one array per file, for at most ``MOST_RANGES`` ranges in all.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civiclens.scratch import materialise

MOST_RANGES = 2_000_000
# Parts of records in the order they have in a range: the first record of a file if it is asked for apart, a whole
# one, the end of one, its middle, its beginning, and the beginning of that first record.
FIRST, WHOLE, END, MIDDLE, BEGIN, FIRST_BEGIN = range(-1, 5)
_RECORDS = "file bigint, block bigint, part int, record string"
_KINDS = {"file": pa.int64(), "block": pa.int64(), "part": pa.int32(), "record": pa.string(),
          "name": pa.string(), "quotes": pa.int64(), "outside": pa.int64(), "inside": pa.int64()}

# What a range is at its start, by file and first byte.
States = dict[tuple[int, int], tuple]


def pieces(spark: SparkSession, path, separator: str | None) -> DataFrame:
    """Pieces of files without their separator (None: any line break), with the hash of the file's path
    and the first byte of the range that they were read in. A task has the pieces of a range in order."""
    reader = spark.read if separator is None else spark.read.option("lineSep", separator)
    text = reader.text(path)
    return text.select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )


def by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int] | None, pa.Array]]:
    """Pieces (file, block, value) of each range, batch by batch; None for the range when one has ended."""
    last = None
    for batch in batches:
        file, block = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
            if start == end:
                continue
            key = int(file[start]), int(block[start])
            if last is not None and key != last:
                yield None, None
            last = key
            yield key, batch.column(2).slice(start, end - start)
    if last is not None:
        yield None, None


def joined(values: pa.Array, separator: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all pieces, each followed by its separator, and where each ends."""
    values = values.cast(pa.large_string())
    places = np.frombuffer(values.buffers()[1], np.int64, len(values) + 1, 8 * values.offset)
    whole = values.buffers()[2]
    data = np.frombuffer(whole, np.uint8)[places[0] : places[-1]] if whole is not None else np.zeros(0, np.uint8)
    ends = places[1:] - places[0]
    return np.insert(data, ends, separator[0]), ends + np.arange(1, len(ends) + 1)


def states_of(changes: DataFrame, prefix: dict, columns: list[str]) -> States:
    """State at the start of each range, from expressions over the window of the ranges before it."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    for name, column in prefix.items():
        changes = changes.withColumn(name, column(before))
    rows = changes.select("file", "block", *columns).limit(MOST_RANGES + 1).collect()
    if len(rows) > MOST_RANGES:
        raise ValueError(f"the files have over {MOST_RANGES} ranges: raise spark.sql.files.maxPartitionBytes")
    return {(row[0], row[1]): tuple(row[2:]) for row in rows}


def state_at(states: States, key: tuple[int, int]) -> tuple:
    if key not in states:
        raise ValueError("the ranges of a file changed while it was read: read it again")
    return states[key]


def table(rows: list[tuple], *names: str) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[n]) for c, n in zip(columns, names)], list(names))


def record_batch(rows: list[tuple]) -> pa.RecordBatch:
    return table(rows, "file", "block", "part", "record")


def records(cut: Callable[[bool], DataFrame], joint: str) -> tuple[DataFrame, DataFrame]:
    """All records (file, record), those across ranges put together with ``joint``, and the first ones of files.

    ``cut(True)`` has the whole records of all ranges, ``cut(False)`` their other parts.
    """
    parts = materialise(cut(False), "parts-of-records")
    opened = F.sum(F.when(F.col("part").isin(BEGIN, FIRST, FIRST_BEGIN), 1).otherwise(0))
    order = Window.partitionBy("file").orderBy("block", "part")
    put = parts.withColumn("number", opened.over(order)).groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("block", "part", "record"))).alias("parts"),
        F.max(F.col("part").isin(FIRST, FIRST_BEGIN)).alias("first"),
    )
    put = put.withColumn("record", F.array_join(F.transform("parts", lambda p: p.record), joint))
    rest = put.filter("not first").select("file", "record")
    return cut(True).select("file", "record").unionByName(rest), put.filter("first").select("file", "record")


# ---- lines with quoted line breaks --------------------------------------------------------


def _quotes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Quotes of each range."""
    key, total = None, 0
    for now, values in by_range(batches):
        if now is None:
            yield table([(*key, total)], "file", "block", "quotes")
            total = 0
        else:
            key = now
            total += int((joined(values, b"\n")[0] == 0x22).sum())


def _lines(states: States, header: bool, whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, inside, open_, begun, skip = None, False, [], True, False
        for now, values in by_range(batches):
            if now is None:  # what is open now goes on in the next range, or ends with the file
                if open_ and not whole:
                    begin = FIRST_BEGIN if skip else BEGIN
                    yield record_batch([(*key, begin if begun else MIDDLE, "\n".join(open_))])
                key, open_ = None, []
                continue
            if key is None:
                key, inside = now, bool(state_at(states, now)[0] % 2)
                begun, skip = not inside, header and now[1] == 0
            data, ends = joined(values, b"\n")
            quotes = np.add.reduceat(data == 0x22, np.append(0, ends[:-1]), dtype=np.int64)
            odd = (np.cumsum(quotes) + inside) % 2 == 1  # within quotes after each line
            inside, out = bool(odd[-1]), []
            lines, start = values.to_pylist(), 0
            for at in np.flatnonzero(~odd).tolist():
                record = lines[start] if start == at else "\n".join(lines[start : at + 1])
                if open_:
                    record, open_ = "\n".join([*open_, record]), []
                if skip:
                    out += [] if whole else [(*key, FIRST, record)]
                    skip = False
                elif begun == whole:
                    out.append((*key, WHOLE if begun else END, record))
                begun, start = True, at + 1
            open_ += lines[start:]
            yield record_batch(out)

    return run


def quoted_lines(spark: SparkSession, path, header: bool = False) -> tuple[DataFrame, DataFrame]:
    """Records of CSV files (file, record), line breaks within quotes included; with ``header`` without the
    first record of each file, and these (file, record).

    Quotes come in pairs (RFC 4180: a quote within quotes is doubled), so a line break ends a record after
    an even number of them. A carriage return before it goes with it. A file whose last quote is missing
    ends with one long record. Blank lines are records.
    """
    read = pieces(spark, path, "\n")
    changes = materialise(read.mapInArrow(_quotes, "file bigint, block bigint, quotes bigint"), "quotes")
    before = {"before": lambda w: F.coalesce(F.sum("quotes").over(w), F.lit(0))}
    states = states_of(changes, before, ["before"])
    found = records(lambda whole: read.mapInArrow(_lines(states, header, whole), _RECORDS), "\n")
    return tuple(rows.withColumn("record", _stripped("record")) for rows in found)


def _stripped(name: str) -> Column:
    text = F.col(name)
    return F.when(text.endswith("\r"), F.expr(f"left({name}, length({name}) - 1)")).otherwise(text)


# ---- first lines by their place ------------------------------------------------------------


def _after_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key = None
    for now, values in by_range(batches):
        if now is None:
            key = None
            continue
        first = key is None and now[1] == 0
        key = now
        yield pa.RecordBatch.from_arrays([values.slice(int(first)).cast(pa.string())], ["line"])


def lines_after_first(spark: SparkSession, path) -> DataFrame:
    """Lines of text files as column ``line``, without the first line of each file: that at byte 0 of its
    path, whatever it says and however often its text comes again."""
    return pieces(spark, path, None).mapInArrow(_after_first, "line string")


# ---- features of one large document -------------------------------------------------------


_OPEN, _CLOSE = np.zeros(256, bool), np.zeros(256, bool)
_OPEN[list(b"{[")] = _CLOSE[list(b"}]")] = True


def _real_quotes(data: np.ndarray) -> np.ndarray:
    """Which bytes are quotes that no backslash escapes."""
    quote = data == 0x22
    back = data == 0x5C
    if not back.any():
        return quote
    # A run of backslashes escapes what follows if it is odd.
    at = np.flatnonzero(quote[1:] & back[:-1]) + 1
    other = np.flatnonzero(~back)
    run = at - 1 - np.where(len(other), np.append(-1, other)[np.searchsorted(other, at, "left")], -1)
    quote[at[run % 2 == 1]] = False
    return quote


def _structure(data: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Quotes, and what each byte does to the depth of brackets, for a start within a string or not."""
    quotes = _real_quotes(data)
    string = (np.cumsum(quotes) + inside) % 2 == 1
    step = np.where(string, 0, _OPEN[data].astype(np.int64) - _CLOSE[data])
    return quotes, string, step


def _nesting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each range: its quotes, and its brackets if it starts outside of a string, or within."""
    key, sums = None, [0, 0, 0]
    for now, values in by_range(batches):
        if now is None:
            yield table([(*key, *sums)], "file", "block", "quotes", "outside", "inside")
            key, sums = None, [0, 0, 0]
        else:
            key = now
            data, _ = joined(values, b"}")
            starts = [(sums[0] + i) % 2 == 1 for i in (0, 1)]
            (quotes, _, out), (_, _, within) = (_structure(data, start) for start in starts)
            sums = [sums[0] + int(quotes.sum()), sums[1] + int(out.sum()), sums[2] + int(within.sum())]


def _features(states: States, member: str, whole: bool, names: bool = False):
    """Objects in the array ``member`` of the document; with ``names``, the last member of each range."""
    root, feature = 1, 3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, before, depth, name, open_, begun = None, 0, 0, None, None, True
        for now, values in by_range(batches):
            if now is None:
                if names:
                    yield table([(*key, name)], "file", "block", "name")
                elif open_ and not whole:
                    yield record_batch([(*key, BEGIN if begun else MIDDLE, b"".join(open_).decode())])
                key, open_ = None, None
                continue
            if key is None:
                key, (before, depth, name) = now, (*state_at(states, now), None)[:3]
                begun = not (depth >= feature and name == member)  # or it starts within a feature
                open_ = None if begun else []
            data, _ = joined(values, b"}")
            quotes, string, step = _structure(data, before % 2 == 1)
            level = depth + np.cumsum(step)
            before, depth = before + int(quotes.sum()), int(level[-1])
            events = [(int(i), "name") for i in np.flatnonzero((data == 0x3A) & ~string & (level == root))]
            if not names:
                opens = (step > 0) & (level == feature) & (data == 0x7B)
                closes = (step < 0) & (level == feature - 1) & (data == 0x7D)
                events += [(int(i), "open") for i in np.flatnonzero(opens)]
                events += [(int(i), "close") for i in np.flatnonzero(closes)]
                events.sort()
            marks = np.flatnonzero(quotes)
            text, out, start = data.tobytes(), [], 0
            for at, event in events:
                if event == "name":
                    # A name that a brace within it has cut is not the one looked for.
                    last = marks[: np.searchsorted(marks, at)][-2:].tolist()
                    name = text[last[0] + 1 : last[1]].decode() if len(last) == 2 else ""
                elif event == "open" and name == member:
                    open_, begun, start = [], True, at
                elif event == "close" and open_ is not None:
                    open_.append(text[start : at + 1])
                    if begun == whole:
                        out.append((*key, WHOLE if begun else END, b"".join(open_).decode()))
                    open_, begun = None, True
            if open_ is not None:
                open_.append(text[start:])
            if not names:
                yield record_batch(out)

    return run


def document_features(spark: SparkSession, path, member: str = "features") -> DataFrame:
    """Texts of the objects in the array ``member`` of each document (file, record).

    A file is one JSON object in UTF-8. Pieces end at closing braces, so a document need not have
    lines. Elements of the array that are no objects are left out.
    """
    read = pieces(spark, path, "}")
    changes = "file bigint, block bigint, quotes bigint, outside bigint, inside bigint"
    changes = materialise(read.mapInArrow(_nesting, changes), "nesting")
    before = lambda name, w: F.coalesce(F.sum(name).over(w), F.lit(0))
    nested = {
        "before": lambda w: before("quotes", w),
        "step": lambda w: F.when(F.col("before") % 2 == 0, F.col("outside")).otherwise(F.col("inside")),
        "depth": lambda w: before("step", w),
    }
    states = states_of(changes, nested, ["before", "depth"])
    names = read.mapInArrow(_features(states, member, False, True), "file bigint, block bigint, name string")
    named = states_of(names, {"last": lambda w: F.last("name", True).over(w)}, ["last"])
    states = {key: (*state, *state_at(named, key)) for key, state in states.items()}
    return records(lambda whole: read.mapInArrow(_features(states, member, whole), _RECORDS), "")[0]
