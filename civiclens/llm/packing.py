"""Best-fit packing by exact complements.

Only the lengths matter, and there are no more of those than a sequence has tokens, so the
plan is made from the counts per length. From the longest on, the gap that a length leaves is
looked up among the lengths that are left, and the sums of two and of three of them; a
combination that fills it exactly is consumed as often as the counts allow. What finds no
complement goes, longest first, where the least room stays. The plan says which numbers
within a length go to which sequences; pieces are numbered within their length by Spark.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclens.llm.bpe import FragmentEncoder, encoded, vocabulary_path
from civiclens.llm.tables import numbered, read_table, written

CAPACITY = 4096
END = 1
_SHIFT = 44


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Contents of sequences and how many are filled so, for the number of pieces per length."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    plan = []

    def consume(*lengths: int) -> bool:
        kinds, need = np.unique(lengths, return_counts=True)
        times = int((left[kinds] // need).min())
        if times:
            left[kinds] -= need * times
            plan.append((tuple(sorted(lengths, reverse=True)), times))
        return times > 0

    if left[capacity]:
        consume(capacity)
    for length in range(capacity - 1, 0, -1):
        while left[length]:
            if not any(consume(length, *rest) for rest in _complements(left, length, capacity - length)):
                break
    return plan + _best_fit(left, capacity)


def _complements(left: np.ndarray, length: int, gap: int) -> Iterator[tuple[int, ...]]:
    """Lengths that fill the gap exactly: one, then two, then three, larger ones first."""
    left = left.copy()
    left[length] -= 1
    if left[gap]:
        yield (gap,)
    pair = _pair(left, gap)
    if pair:
        yield pair
    for first in np.flatnonzero(left[1 : gap - 1])[::-1] + 1:
        left[first] -= 1
        pair = _pair(left, gap - int(first))
        left[first] += 1
        if pair:
            yield (int(first), *pair)
            return


def _pair(left: np.ndarray, total: int) -> tuple[int, int] | None:
    """Two available lengths of this sum, as unlike as there are."""
    half = total // 2
    low = left[1 : half + 1]
    both = (low > 0) & (left[total - half : total][::-1] > 0)
    if total % 2 == 0 and half:
        both[half - 1] = low[half - 1] > 1
    found = both.argmax() if len(both) else 0
    return (total - 1 - int(found), int(found) + 1) if len(both) and both[found] else None


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    bins: list[list] = [[] for _ in range(capacity + 1)]  # by the room left
    room = np.zeros(capacity + 1, bool)
    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        while n:
            fitting = np.flatnonzero(room[length:])
            if len(fitting):
                gap = length + int(fitting[0])
                content, times = bins[gap].pop()
                used = min(n, times)
                if used < times:
                    bins[gap].append((content, times - used))
                room[gap] = bool(bins[gap])
                filled, each = (*content, length), 1
            else:
                each = min(capacity // length, n)
                used, gap, filled = n // each, capacity, (length,) * each
            rest = gap - each * length
            bins[rest].append((filled, used))
            room[rest] = True
            n -= used * each
    return [kind for kinds in bins for kind in kinds]


def placements(plan: list[tuple[tuple[int, ...], int]]):
    """Runs of numbers within a length: sorted keys (length, first number), the sequence of the
    first one and the offset in it."""
    used, runs, sequence = {}, [], 0
    for content, times in plan:
        offset = 0
        for length in content:
            first = used.get(length, 0)
            runs.append((length << _SHIFT | first, first, sequence, offset))
            used[length] = first + times
            offset += length
        sequence += times
    runs = np.array(sorted(runs), np.int64).reshape(-1, 4)
    return runs[:, 0], runs[:, 1], runs[:, 2], runs[:, 3]


def cut_pieces(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    path: str | None = None, capacity: int = CAPACITY, end: int = END,
) -> DataFrame:
    """Rows (id, ``piece``, ``start``, ``length``, ``ids_crc32``): the ids of a text and ``end``, cut at
    ``capacity``. A NULL or empty text is the one id ``end``."""
    path = path or vocabulary_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = FragmentEncoder(path)
        for batch in batches:
            rows, out = [], []
            for row, ids in encoded(batch, encoder):
                ids = np.append(ids, end).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    rows.append(row)
                    out.append((piece, start, len(part), zlib.crc32(part.tobytes())))
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = list(zip(*out)) or [[]] * 4
            arrays = [batch.column(0).take(pa.array(rows, pa.int64()))]
            arrays += [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, [id_column, "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(
        cut, f"`{id_column}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    )


def pack_documents(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    path: str | None = None, capacity: int = CAPACITY, end: int = END,
) -> DataFrame:
    """The rows of :func:`cut_pieces` with ``sequence_id`` and ``offset``, gapless from 0 in a sequence.

    Repeated rows and rows with a NULL id are rows like others; any other columns are not
    looked at. An empty table makes no sequences.
    """
    pieces = written(cut_pieces(docs, id_column, text_column, path, capacity, end), "pieces")
    counts = {row[0]: row[1] for row in pieces.groupBy("length").count().collect()}
    keys, firsts, sequences, offsets = placements(plan_sequences(counts, capacity))

    @F.arrow_udf("sequence_id bigint, offset bigint")
    def placed(length: pa.Array, number: pa.Array) -> pa.Array:
        number = number.to_numpy(zero_copy_only=False)
        key = length.to_numpy(zero_copy_only=False) << _SHIFT | number
        run = np.searchsorted(keys, key, "right") - 1
        arrays = [pa.array(sequences[run] + number - firsts[run]), pa.array(offsets[run])]
        return pa.StructArray.from_arrays(arrays, ["sequence_id", "offset"])

    order = [id_column, "piece", "ids_crc32"]
    rows = numbered(pieces, "length", order, "packed number", sum(counts.values()))
    place = F.inline(F.array(placed("length", F.col("packed number"))))
    return rows.select(*[f"`{name}`" for name in pieces.columns], place)


def op6_exact_complements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"))
