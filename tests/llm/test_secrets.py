"""Secret scans against plain regular expressions over all of a text."""

import hashlib
import random
import re

import pytest

from civiclens.llm.secret_scan import BASE, Scanner, checksum, find_secrets, op11_keyword_automaton

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def base(text):
    found = [("assign", m.start(), m.end()) for m in re.finditer(ASSIGN, text, re.I | re.A) if len(m[2]) >= 8]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found, key=lambda s: (s[1], BASE.index(s[0])))


def expected(text):
    spans = base(text or "")
    named = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    counts = [sum(k == kind for k, _, _ in spans) for kind in BASE]
    return (*counts, hashlib.sha256(named.encode()).hexdigest()), named


PARTS = [
    "token", "TOKEN", "pass", "word", "passwd", "api_", "key", "apikey", "Secret", "AKIA", "akia", " ", "  ", "=", ":",
    "'", '"', "abcdefgh", "0123456789abcdef" * 2, "deadbeef", "é", "ſ", "K", "ABCDEFGHIJKL", "ghp_", "\n", "\U0001f600",
]


@pytest.fixture(scope="module")
def strange():
    rng = random.Random(1)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(1, 30))) for _ in range(1500)]
    return texts + [None, "", "token" * 20_000, "token" + " " * 200_000 + "= abcdefgh", "f" * 300_000, "secret=" * 20_000]


def test_spans_are_those_of_the_patterns(spark, strange):
    rows = [(i, text, "x") for i, text in enumerate(strange)] + [(None, "token=abcdefgh", "y"), (0, strange[0], "z")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, spans string")
    out = find_secrets(table).collect()
    got = sorted(((r.doc_id, *r[1:]) for r in out), key=repr)
    want = sorted(((i, *expected(text)[0], expected(text)[1]) for i, text, _ in rows), key=repr)
    assert got == want
    assert find_secrets(table.limit(0)).count() == 0


def test_the_query_over_the_whole_table(spark, folder, texts):
    got = {r.doc_id: tuple(r)[1:5] for r in op11_keyword_automaton(spark, folder).collect()}
    assert got == {i: expected(text)[0] for i, text in texts.items()}


def test_tokens_are_taken_by_their_checksum(spark):
    body = "zQWBuTSOoRi4A9spHcVY5ncnsDkxkJ"
    assert checksum(body.encode()) == b"0mLq17"
    good = [f"{prefix}_{body}0mLq17" for prefix in ("ghp", "gho", "npm")]
    bad = [f"ghp_{body}0mLq18", f"ghx_{body}0mLq17", f"npm_{body}0mLq170", f"GHP_{body}0mLq17"]
    text = " é ".join([*good, *bad])
    (row,) = find_secrets(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).collect()
    at = [text.index(token) for token in good]
    kinds = ["github", "github", "npm"]
    assert row.spans == ",".join(f"{k}:{a}:{a + 40}" for k, a in zip(kinds, at))
    assert row.base_sha256 == hashlib.sha256(b"").hexdigest()


def test_matches_of_a_kind_do_not_overlap():
    import numpy as np

    data = np.frombuffer(b"token=password:abcdefgh1 secret = 'api_key=12345678'", np.uint8)
    assert Scanner().spans(data) == [("assign", 0, 14), ("assign", 25, 50)]
