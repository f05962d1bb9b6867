"""Collocations against plain counting."""

import random
import re
from collections import Counter
from decimal import Decimal

import numpy as np
import pytest

from civiclens.llm import collocations as module
from civiclens.llm.collocations import collocations, op12_three_way_suffixes, three_way


def plain(rows, longest=3, least=10, percent=50, top=2000):
    """Rows of the query from (lang, text)."""
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            count = counts.setdefault(lang, Counter())
            for k in range(1, longest + 1):
                count.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = set()
    for lang, count in counts.items():
        candidates = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        inner = Counter()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inner[p[i : i + k]] = max(inner[p[i : i + k]], a)
        ranked = []
        for p, a in candidates.items():
            if 100 * inner[p] >= percent * a and inner[p]:
                continue
            cuts = [(1_000_000 * a * a // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            ranked.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return out


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(4)
    words = ["a", "b", "B", "é", "É", "c-d", " ", "w1", "w2", "w3", "w4", "w5", "x" * 300, "'", "\U0001f600"]
    gaps = [" ", " ", " ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", ";", "!? ", "\x00"]
    rows = []
    for i in range(300):
        text = "".join(rng.choice(words[: rng.randint(2, 15)]) + rng.choice(gaps) for _ in range(rng.randint(0, 80)))
        rows.append((rng.choice(["en", "en", "en", "fr", None, "und", ""]), text))
    rows += [("en", None), (None, None), ("de", ""), ("de", " .,\n"), ("en", "hot pair " + " ".join(f"hot pair n{i}" for i in range(900)))]
    rows += [("en", "again and again and")] * 25
    rows += [("long", ". ".join(f"one two three four{i % 7} five" for i in range(4000)))]
    return rows


COLUMNS = "lang string, text string, doc_id bigint, n int, phrase string"


def test_rows_are_those_of_plain_counting(spark, odd):
    table = spark.createDataFrame([(*r, 1, 2, "p") for r in odd], COLUMNS).repartition(7)
    assert found(collocations(table)) == plain(odd)
    assert collocations(table.limit(0)).count() == 0
    assert found(collocations(table, longest=4, least=3, percent=80, top=5)) == plain(odd, 4, 3, 80, 5)
    assert found(collocations(table, longest=2, least=2)) == plain(odd, 2, 2)


@pytest.mark.parametrize("slice_bytes, chunk", [(500, 40), (20_000, 300)])
def test_cut_texts_hot_pairs_and_partial_buckets_change_nothing(spark, odd, monkeypatch, slice_bytes, chunk):
    monkeypatch.setattr(module, "_SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(module, "_CHUNK", chunk)
    moved = []
    monkeypatch.setattr(module, "_homes", lambda *a, f=module._homes: moved.append(f(*a)) or moved[-1])
    table = spark.createDataFrame([(*r, 1, 2, "p") for r in odd], COLUMNS).repartition(5)
    assert found(collocations(table)) == plain(odd)
    assert any(b"hot " in pair for pairs in moved[0].values() for pair in pairs)


def test_three_way_partitions_are_counts():
    rng = np.random.default_rng(2)
    keys = rng.integers(0, 6, (3, 2000)) ** 2
    keys[1:, rng.random(2000) < 0.2] = -1
    keys[2, rng.random(2000) < 0.2] = -1
    weights = rng.integers(1, 4, 2000)
    want = Counter()
    for suffix, weight in zip(keys.T.tolist(), weights.tolist()):
        words = suffix[: suffix.index(-1)] if -1 in suffix else suffix
        for k in range(1, len(words) + 1):
            want[tuple(words[:k])] += weight
    got = Counter()
    for words, suffix, count in three_way(keys, weights, 30):
        for at, n in zip(suffix.tolist(), count.tolist()):
            got[tuple(keys[:words, at].tolist())] += n
    assert got == {p: n for p, n in want.items() if n >= 30}


def test_scores_are_exact_beyond_64_bits(spark, monkeypatch):
    a, left, right = 3_000_000_000_019, 7_000_000_000_003, 5_000_000_000_011
    phrases = spark.createDataFrame(
        [("en", 1, "x", left), ("en", 1, "y", right), ("en", 2, "x y", a)], "lang string, words int, phrase string, n bigint"
    )
    totals = spark.createDataFrame([("en", 10**14)], "lang string, n bigint")
    monkeypatch.setattr(module, "phrase_counts", lambda *args: (phrases, totals))
    (row,) = collocations(phrases).collect()
    assert row.score == int(Decimal(10**6 * a * a) // Decimal(left * right)) == 10**6 * a * a // (left * right)


def test_the_query_over_the_whole_table(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("lang", "text").collect()]
    assert found(op12_three_way_suffixes(spark, folder)) == plain(rows)
