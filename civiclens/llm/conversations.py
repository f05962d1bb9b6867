"""Repair of conversations by weighted interval parsing.

A conversation should read ``s?(ua)+`` in the initials of its roles, or be empty. The grammar is in
Chomsky normal form: a nonterminal [p, q] derives what takes the automaton of that language from
state p to state q, a rule [p, q] -> [p, r] [r, q] joins two spans, and a row, with its edit, is a
terminal. Rows that may be inserted are closed over at both ends of every row. A cell of
a span holds, for each nonterminal, the least (cost, audit), and cells are combined bottom-up
by the length of their spans.

Every nonterminal derives its span across every inner border, by the rule of the state the automaton
has there, so that all splits of a span give the same least cell. One split is enough, and only
spans of 1, 2, 4, ... rows (and the rest at the end) need cells: a parse takes as many
combinations as there are rows. Least audits of two spans make the least of both, since of two
audits with one cost for a span neither begins the other: it would lack an insertion.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civiclens.llm.tables import read_table, written

# Costs of the edits, and of leaving a truncated row in.
RELABEL, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
# Faults of a row.
_NONE, _BLANK, _DUPLICATE, _CUT = range(4)
# States of the automaton: nothing yet, after system, after user, after assistant.
_START, _SYSTEM, _USER, _ASSISTANT = _STATES = range(4)
_STEPS = {(_START, "s"): _SYSTEM, (_START, "u"): _USER, (_SYSTEM, "u"): _USER,
          (_USER, "a"): _ASSISTANT, (_ASSISTANT, "u"): _USER}
_GOOD_PAIRS = ("su", "ua", "au")
# White space, and the characters a whole text ends with.
_SPACE, _ENDS = "\x20\x09\x0a\x0b\x0c\x0d", ".!?"
# A task keeps so many parses, of conversations up to so many rows.
_PARSES, _REMEMBERED = 100_000, 64

# A cell: least (cost, audit) for each pair of states, None where there is none.
Cell = tuple[tuple[tuple[int, str] | None, ...], ...]


def _combine(left: Cell, right: Cell) -> Cell:
    return tuple(
        tuple(
            min(
                (
                    (left[p][r][0] + right[r][q][0], left[p][r][1] + right[r][q][1])
                    for r in _STATES
                    if left[p][r] and right[r][q]
                ),
                default=None,
            )
            for q in _STATES
        )
        for p in _STATES
    )


def _closure() -> Cell:
    """Least insertions between each two states."""
    none = tuple(tuple((0, "") if p == q else None for q in _STATES) for p in _STATES)
    step = {(p, q): (INSERT, "I") for (p, initial), q in _STEPS.items() if initial != "s"}
    one = tuple(
        tuple(min(filter(None, (none[p][q], step.get((p, q)))), default=None) for q in _STATES)
        for p in _STATES
    )
    for _ in _STATES:
        one = _combine(one, one)
    return one


_INSERTED = _closure()


def _row_cell(initial: str, fault: int) -> Cell:
    """Cell of a row with this initial of its role and this fault, insertions around it included."""
    ways: dict[tuple[int, int], list[tuple[int, str]]] = {(p, p): [(DELETE, "D")] for p in _STATES}
    if fault not in (_BLANK, _DUPLICATE):
        extra = TRUNCATED if fault == _CUT else 0
        for (p, role), q in _STEPS.items():
            if role == initial:
                ways.setdefault((p, q), []).append((extra, "K"))
            if role != "s":
                ways.setdefault((p, q), []).append((extra + RELABEL, "R"))
    row = tuple(tuple(min(ways.get((p, q), []), default=None) for q in _STATES) for p in _STATES)
    return _combine(_combine(_INSERTED, row), _INSERTED)


class Parser:
    """Parses conversations one after another; those that are alike are parsed once."""

    def __init__(self):
        self.rows: dict[tuple[str, int], Cell] = {}
        self.known: dict[tuple[str, bytes], tuple[int, str]] = {}

    def parse(self, initials: str, faults: bytes) -> tuple[int, str]:
        """Least (cost, audit) of rows with these initials (a space for none of s, u, a) and faults."""
        found = self.known.get((initials, faults))
        if found is None:
            found = self._least(initials, faults)
            if len(initials) <= _REMEMBERED and len(self.known) < _PARSES:
                self.known[initials, faults] = found
        return found

    def _least(self, initials: str, faults: bytes) -> tuple[int, str]:
        rows = list(zip(initials, faults))
        for row in set(rows) - self.rows.keys():
            self.rows[row] = _row_cell(*row)
        spans = [self.rows[row] for row in rows] or [_INSERTED]
        while len(spans) > 1:
            pairs = [_combine(a, b) for a, b in zip(spans[::2], spans[1::2])]
            spans = pairs + spans[len(pairs) * 2 :]
        return min(filter(None, (spans[0][_START][q] for q in (_START, _ASSISTANT))))


def _shapes():
    """One row per conversation of rows in order (conv_id, turn, initial, fault)."""

    def finish(parser: Parser, conv, turns, initials: list[str], faults: bytearray):
        text = "".join(i if i in ("s", "u", "a") else " " for i in initials)
        cost, audit = parser.parse(text, bytes(faults))
        pairs = (a + b for a, b in zip(initials, initials[1:]))
        illegal = sum(pair not in _GOOD_PAIRS for pair in pairs)
        low, high, n = turns
        gaps = high - low + 1 - n if n else 0
        counts = [faults.count(bytes([f])) for f in (_BLANK, _DUPLICATE, _CUT)]
        return (conv, gaps, *counts, illegal, cost, audit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
        parser, empty = Parser(), object()
        last, state = empty, None
        done: list[tuple] = []

        def table(kind: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*done)) or [[]] * len(names)
            kinds = [kind, *[pa.int64()] * 6, pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        key = pa.int64()
        for batch in batches:
            key = batch.column(0).type
            for conv, turn, initial, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if last is empty or conv != last:
                    if last is not empty:
                        done.append(finish(parser, last, tuple(state[:3]), state[4], state[5]))
                    last, state = conv, [0, 0, 0, None, [], bytearray()]
                if turn is not None and (not state[2] or turn != state[3]):
                    state[0] = state[0] if state[2] else turn  # turns come in order
                    state[1], state[2], state[3] = turn, state[2] + 1, turn
                state[4].append(initial)
                state[5].append(fault)
            yield table(key)
            done.clear()
        if last is not empty:
            done.append(finish(parser, last, tuple(state[:3]), state[4], state[5]))
            yield table(key)

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest per conversation of rows in order (conv_id, pos, role, text, audit).

    The first row of a conversation brings the audit, the rows it speaks of follow.
    """
    empty = object()
    last, audit, at, n, digest = empty, "", 0, 0, hashlib.sha256()
    state, key = _START, pa.int64()
    done: list[tuple] = []

    def step(role: str | None, text: str) -> None:
        """A row that is kept under its role, or one in the role that is due (None)."""
        nonlocal state, n
        if role is None:
            role = "assistant" if state == _USER else "user"
        state = _STEPS[state, role[:1]]
        digest.update((f"\n{role}:{text}" if n else f"{role}:{text}").encode())
        n += 1

    def inserted() -> None:
        nonlocal at
        while at < len(audit) and audit[at] == "I":
            step(None, "")
            at += 1

    def table() -> pa.RecordBatch:
        columns = list(zip(*done)) or [[], []]
        arrays = [pa.array(columns[0], key), pa.array(columns[1], pa.string())]
        done.clear()
        return pa.RecordBatch.from_arrays(arrays, ["conv_id", "repaired_sha256"])

    for batch in batches:
        key = batch.column(0).type
        for conv, role, text, given in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4))):
            if given is not None:
                if last is not empty:
                    inserted()
                    done.append((last, digest.hexdigest()))
                last, audit, at, n, digest, state = conv, given, 0, 0, hashlib.sha256(), _START
                continue
            inserted()
            edit = audit[at]
            at += 1
            if edit != "D":
                step(role if edit == "K" else None, text)
        yield table()
    if last is not empty:
        inserted()
        done.append((last, digest.hexdigest()))
        yield table()


def _fault(first: Column) -> Column:
    """Fault of a row; ``first`` tells whether its role and text were not seen earlier."""
    seen = F.rtrim("text", F.lit(_SPACE))
    return (
        F.when(seen == "", _BLANK)
        .when(~first, _DUPLICATE)
        .when(~F.substring(seen, -1, 1).isin(*_ENDS), _CUT)
        .otherwise(_NONE)
    )


def damaged(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) after damage, by the crc32 of ``conv_id:turn`` modulo 20.

    0 drops a row, 1 empties its text, 2 takes ``.``, ``!`` and ``?`` from it, 3 repeats it, 4 makes it
    the user's; NULL reads as one space, in that key too. ``given`` are role and text before.
    """
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    part = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    key = F.concat(part("conv_id"), F.lit(":"), part("turn"))
    rows = turns.withColumn("kind", F.crc32(F.encode(key, "UTF-8")) % 20).filter("kind <> 0")
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(role).alias("role"),
        F.when(F.col("kind") == 1, "")
        .when(F.col("kind") == 2, F.translate(text, _ENDS, ""))
        .otherwise(text)
        .alias("text"),
        F.struct(role.alias("role"), text.alias("text")).alias("given"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def judged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with ``pos`` in their conversation, from 1, and ``fault``.

    In order of the turn, NULL first, then of ``given`` (role and text before any damage), and a copy
    after its original. All windows go by the conversation, so rows are shuffled once; they
    are sorted on disk if need be, and none of the windows holds a conversation in memory.
    """
    order = [F.asc_nulls_first("turn"), "given", "copy"]
    dealt = rows.repartition("conv_id")
    seen = Window.partitionBy("conv_id", "role", "text").orderBy(*order)
    whole = Window.partitionBy("conv_id").orderBy(*order)
    first = dealt.withColumn("first", F.row_number().over(seen) == 1)
    numbered = first.withColumn("pos", F.row_number().over(whole))
    fault = _fault(F.col("first"))
    # The text of a row that has to go is not needed any more.
    stays = F.when(~fault.isin(_BLANK, _DUPLICATE), F.col("text")).otherwise("")
    return numbered.select("conv_id", "pos", "turn", "role", stays.alias("text"), fault.alias("fault"))


def repair_conversations(turns: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """A row per conversation of ``turns``: its faults, the cheapest repair and a digest of the result.

    ``turns`` has conv_id, turn, role and text; ``rows`` are the rows to repair (:func:`damaged`
    of ``turns`` by default). Columns: ``conv_id``, ``gaps`` (turns missing between the
    first and the last), ``blank``, ``duplicate``, ``truncated``, ``illegal`` (neighbours whose initials
    are not su, ua or au), ``cost``, ``audit`` (initials of Keep, Rerole, Delete, Insert in order, of
    the cheapest repairs the least in ASCII) and ``repaired_sha256``. NULL roles and texts are one
    space; rows with a NULL conv_id are a conversation; rows of one turn are in order of role and
    text, and repeated rows are duplicates. A conversation none of whose rows is left has zeros and empty
    texts. An empty table gives no rows; other columns are not looked at.
    """
    turns = turns.select("conv_id", "turn", "role", "text")
    rows = written(judged(damaged(turns) if rows is None else rows), "judged turns")
    key = rows.schema["conv_id"].dataType.simpleString()
    counts = ", ".join(f"{n} bigint" for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))
    shapes = (
        rows.select("conv_id", "pos", "turn", F.substring("role", 1, 1).alias("initial"), "fault")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "pos")
        .select("conv_id", "turn", "initial", "fault")
        .mapInArrow(_shapes(), f"conv_id {key}, {counts}, audit string")
    )
    shapes = written(shapes, "repairs")
    none = F.lit(None).cast("string")
    heads = shapes.select("conv_id", F.lit(0).alias("pos"), none.alias("role"), none.alias("text"), "audit")
    digests = (
        rows.select("conv_id", "pos", "role", "text", none.alias("audit"))
        .unionByName(heads)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "pos")
        .mapInArrow(_digests, f"conv_id {key}, repaired_sha256 string")
    )
    repaired = shapes.join(digests, shapes["conv_id"].eqNullSafe(digests["conv_id"])).drop(digests["conv_id"])
    all_ids = turns.select("conv_id").distinct()
    gone = all_ids.join(shapes, all_ids["conv_id"].eqNullSafe(shapes["conv_id"]), "left_anti")
    zeros = [F.lit(0).cast("bigint").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = hashlib.sha256().hexdigest()
    return repaired.unionByName(
        gone.select("conv_id", *zeros, F.lit("").alias("audit"), F.lit(empty).alias("repaired_sha256"))
    )


def op13_interval_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(read_table(spark, sf_dir, "conversations"))
