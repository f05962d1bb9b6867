"""Repair of conversations against brute force, and its query against a plain version."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from civiclens.llm import conversations
from civiclens.llm.conversations import Parser, op13_interval_repair

parse = Parser().parse

SCHEMA = "conv_id bigint, turn bigint, role string, text string, audit int"
NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def cheapest(rows):
    """Least (cost, audit, roles) by trying all edits; rows are (initial, fault)."""
    best = None
    inserts = [(), ("u",), ("a",), ("u", "a"), ("a", "u")]
    for gaps in itertools.product(inserts, repeat=len(rows) + 1):
        for edits in itertools.product("KuaD", repeat=len(rows)):
            cost, audit, roles = 0, "", []
            for i, gap in enumerate(gaps):
                cost, audit = cost + 3 * len(gap), audit + "I" * len(gap)
                roles += gap
                if i == len(rows):
                    continue
                (initial, fault), edit = rows[i], edits[i]
                if edit == "D":
                    cost, audit = cost + 4, audit + "D"
                    continue
                if fault in (1, 2):
                    break
                cost += 3 * (fault == 3) + 3 * (edit != "K")
                audit += "K" if edit == "K" else "R"
                roles.append(initial if edit == "K" else edit)
            else:
                if re.fullmatch("(s?(ua)+)?", "".join(roles)):
                    best = min(filter(None, (best, (cost, audit, "".join(roles)))))
    return best


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_the_parse_is_the_cheapest_of_all_repairs(n):
    kinds = [(i, f) for i in "sua " for f in range(4)]
    every = list(itertools.product(kinds, repeat=n))
    for rows in every if n < 2 else random.Random(n).sample(every, 60 if n == 2 else 25):
        got = parse("".join(i for i, _ in rows), bytes(f for _, f in rows))
        assert got == cheapest(rows)[:2]


def all_splits(initials, faults):
    """The same parse with cells for every span, each from all its splits."""
    rows = [conversations._row_cell(i, f) for i, f in zip(initials, faults)]
    cells = {(i, i + 1): cell for i, cell in enumerate(rows)}
    for length in range(2, len(rows) + 1):
        for i in range(len(rows) - length + 1):
            whole = [conversations._combine(cells[i, k], cells[k, i + length]) for k in range(i + 1, i + length)]
            assert len(set(whole)) == 1  # every split has the same least cell
            cells[i, i + length] = whole[0]
    return min(filter(None, (cells[0, len(rows)][0][q] for q in (0, 3))))


def test_one_split_of_a_span_is_enough():
    rng = random.Random(3)
    for n in (5, 9, 14):
        initials = "".join(rng.choices("suuaa ", k=n))
        faults = bytes(rng.choices(range(4), weights=(5, 1, 1, 2), k=n))
        assert parse(initials, faults) == all_splits(initials, faults)


def test_a_long_conversation_is_parsed_in_short_time():
    cost, audit = parse("ua" * 20_000 + "u", bytes(40_001))
    assert (cost, audit) == (3, "KK" * 20_000 + "KI")


def plain(rows):
    """The rows of the query from (conv_id, turn, role, text), without Spark."""
    out, groups = {}, {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()))
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        given = (turn is not None, turn or 0, role, text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        for copy in range({0: 0, 3: 2}.get(kind, 1)):
            groups.setdefault(conv, []).append((given, copy, turn, role, text))
    for conv, group in groups.items():
        group.sort(key=lambda r: r[:2])
        seen, faults = set(), []
        for *_, role, text in group:
            letters = re.findall(r"[^\x20\x09-\x0D]", text)
            if not letters:
                faults.append(1)
            elif (role, text) in seen:
                faults.append(2)
            else:
                faults.append(3 if letters[-1] not in ".!?" else 0)
            seen.add((role, text))
        turns = {r[2] for r in group} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        initials = [r[3][:1] for r in group]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = parse("".join(i if i in set("sua") else " " for i in initials), bytes(faults))
        lines, rest = [], iter(group)
        for edit in audit:
            due = "assistant" if lines and lines[-1][:1] == "u" else "user"
            if edit == "I":
                lines.append(f"{due}:")
                continue
            *_, role, text = next(rest)
            if edit != "D":
                lines.append(f"{role if edit == 'K' else due}:{text}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *(faults.count(f) for f in (1, 2, 3)), illegal, cost, audit, digest)
    return out


def repaired(spark, path):
    return {r.conv_id: tuple(r[n] for n in NAMES) for r in op13_interval_repair(spark, path).collect()}


def test_the_query_over_the_whole_table(spark, folder):
    table = spark.read.parquet(f"{folder}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = repaired(spark, folder)
    assert got == plain(rows)
    assert len({r[6] for r in got.values()}) > 3


def test_odd_conversations(spark, tables):
    rng = random.Random(9)
    roles = ["system", "user", "assistant", "User", "tool", "", None, "superuser"]
    texts = ["Yes.", "no", "", "  \n", "What? ", "ü!\x0b", None, " ", "line\ntwo.", "a.b "]
    rows = [
        (rng.choice([None, *range(12)]), rng.choice([None, -3, 2**40, *range(6)]), rng.choice(roles), rng.choice(texts))
        for _ in range(250)
    ]
    rows += [(100 + i, 0, "user", "Hi.") for i in range(40)]  # some lose their only row
    rows += [(900, i, ("user", "assistant")[i % 2], f"{'word ' * 2000}{i}.") for i in range(130)]
    rows += [(901, 1, "user", "Same.")] * 30
    path = tables(conversations=([(*r, 7) for r in rows], SCHEMA))
    assert repaired(spark, path) == plain(rows)


def test_no_conversations(spark, tables):
    assert repaired(spark, tables(conversations=([], SCHEMA))) == {}
