"""BPE, packing, shards and fingerprints."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import plain
import pytest
from tokenizers import Tokenizer

from civiclens.llm import bpe, fingerprints, minhash, packing, sharding

ODD = [
    "", "a", "'s", "it's 'tis ''s don't we'll they're x've i'm he'd 'q '", "<|endoftext|>",
    "ab<|startoftext|>c d<|endoftext|><|endoftext|>", "  \n\t ", "İSTANBUL ΣΑΣ ﬁ ½ ² 一二三 ١٢٣ 👩‍👩‍👧",
    "aaaaaaaaaaaaaaaaa " * 5, "1'll22", "a\x00b\x1c\x1d\x85c", "<|endoftext", "é  x y",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(bpe.vocabulary_path())
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def test_encoding_is_that_of_the_library(library, texts):
    random.seed(1)
    letters = "abcdesrtlmv'  .,!?123ßäé\n<|>一🎉"
    many = ["".join(random.choices(letters, k=random.randint(0, 80))) for _ in range(2000)]
    many += ODD + list(texts.values())
    encoder = bpe.FragmentEncoder(bpe.vocabulary_path())
    for text, ids in zip(many, encoder.encode(many)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert encoder.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False)


def thue_morse(letters, n):
    """Two words that every polynomial hash modulo 2^64 takes for equal, from 1,024 letters on."""
    word = "".join(letters[bin(i).count("1") % 2] for i in range(n))
    return word, word.translate(str.maketrans(letters, letters[::-1]))


@pytest.mark.parametrize("letters", ["ab", "to", "er"])
@pytest.mark.parametrize("n", [1024, 2048])
def test_words_with_one_polynomial_hash_are_encoded_apart(library, letters, n):
    words = thue_morse(letters, n)
    encoder = bpe.FragmentEncoder(bpe.vocabulary_path())
    want = [library.encode(word, add_special_tokens=False).ids for word in words]
    assert want[0] != want[1]
    assert [ids.tolist() for ids in encoder.encode(list(words))] == want


def test_words_with_one_polynomial_hash_have_sets_and_checksums_of_their_own(spark, library):
    rows = [(i, word + " x") for i, word in enumerate(thue_morse("ab", 1024) + thue_morse("to", 2048))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    near = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, words=2).collect()}
    assert near == {i: i for i in range(4)}
    prints = fingerprints.fingerprint_documents(docs).collect()
    assert len({r.fingerprint for r in prints}) == 4
    for r in packing.cut_pieces(docs).collect():
        ids = library.encode(rows[r.doc_id][1], add_special_tokens=False).ids + [packing.END]
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encode_documents(spark, library):
    rows = [(1, None, "x"), (None, "", "y"), (2, "Hello world", "z"), (2, "Hello world", "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string")
    out = sorted(bpe.encode_documents(docs).collect(), key=str)
    assert len(out) == 4
    hello = library.encode("Hello world", add_special_tokens=False).ids
    assert [r.ids for r in out if r.doc_id == 2] == [hello, hello]
    assert {(r.n_tokens, r.decoded_sha256) for r in out if r.doc_id != 2} == {(0, hashlib.sha256(b"").hexdigest())}
    assert bpe.encode_documents(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed, pieces, longest", [(0, 20_000, 4096), (1, 200, 4096), (2, 50, 60), (3, 9, 4096)])
def test_plan_holds_each_piece_once_in_few_sequences(seed, pieces, longest):
    lengths = np.minimum(np.random.default_rng(seed).gamma(1.2, 900, pieces).astype(int) + 1, longest)
    counts = {int(a): int(b) for a, b in zip(*np.unique(lengths, return_counts=True))}
    plan = packing.plan_sequences(counts)
    placed = Counter()
    for content, times in plan:
        assert sum(content) <= packing.CAPACITY
        for length in content:
            placed[length] += times
    assert placed == counts
    assert sum(times for _, times in plan) <= -(-int(lengths.sum()) // packing.CAPACITY) + 2


def test_pack_documents(spark, library, texts):
    rows = [(*item, 0) for item in texts.items()] + [(None, None, 0), (900, "", 0), (0, texts[0], 0), (901, "ab " * 9000, 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, sequence_id int")
    out = packing.pack_documents(docs).toPandas().sort_values(["sequence_id", "offset"])
    assert (out.groupby("sequence_id").length.cumsum() - out.length == out.offset).all()
    assert out.groupby("sequence_id").length.sum().max() <= packing.CAPACITY
    assert out.sequence_id.nunique() <= -(-out.length.sum() // packing.CAPACITY) + 2
    expected = Counter()
    for doc_id, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [packing.END]
        for piece, start in enumerate(range(0, len(ids), packing.CAPACITY)):
            part = np.array(ids[start : start + packing.CAPACITY], "<u4")
            expected[(doc_id, piece, start, len(part), zlib.crc32(part.tobytes()))] += 1
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = Counter(
        (None if r.doc_id != r.doc_id else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32)
        for r in out[columns].itertuples(index=False)
    )
    assert got == expected
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_shards_are_even_and_keep_groups(spark, folder):
    out = sharding.op2_vector_packing(spark, folder).toPandas()
    sums = out.groupby("shard").agg(bytes=("size", "sum"), rows=("doc_id", "count"), last=("slot", "max"))
    assert len(sums) == sharding.SHARDS and (sums["last"] + 1 == sums.rows).all()
    assert sums.bytes.max() <= sums.bytes.mean() + out["size"].max()
    assert (out.groupby("text_crc32").shard.nunique() == 1).all()


def test_shards_of_odd_rows(spark):
    rows = [(i, "same text here", "s") for i in range(300)] + [(None, None, "s"), (1, None, "t"), (1, "x", "t")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, shard string")
    out = sharding.shard_by_vectors(docs, shards=4).toPandas()
    assert len(out) == len(rows)
    counts = out.groupby("shard").doc_id.size()
    assert len(counts) == 4 and counts.max() <= 80  # a group larger than a shard is cut
    assert (out.groupby("shard").slot.max() + 1 == counts).all()
    assert set(out[out.bytes == 8].crc32) == {0}
    empty = sharding.shard_by_vectors(docs.limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", "bytes", "tokens", "crc32", "shard", "slot"]


def test_fingerprints_estimate_the_similarity(spark, folder, texts):
    out = fingerprints.op3_one_permutation(spark, folder).toPandas().sort_values("doc_id")
    ids = sorted(texts)
    errors = []
    for row, i, after in zip(out.itertuples(), ids, ids[1:] + ids[:1]):
        text, nxt = texts[i], texts[after]
        edited = text[: len(text) - len(text) // 4] + nxt[: len(text) // 4]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        own = plain.shingle_set(text, 5)
        errors.append(abs(plain.jaccard(own, plain.shingle_set(edited, 5)) - row.near_edited))
        errors.append(abs(plain.jaccard(own, plain.shingle_set(nxt, 5)) - row.near_next))
    assert np.mean(errors) < 0.03 and max(errors) < 0.15
    same = {}
    for row in out.itertuples():
        assert same.setdefault(texts[row.doc_id], row.fingerprint) == row.fingerprint


def test_fingerprints_of_odd_rows(spark, tables):
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [(5, "a b c d e f g h"), (None, "x y z w"), (2, None), (9, ""), (5, "a b c d e f g h"), (7, long)]
    path = tables(documents=(rows, "doc_id bigint, text string"))
    out = {r.doc_id: r for r in fingerprints.op3_one_permutation(spark, path).collect()}
    assert {k: r.n_chars for k, r in out.items()} == {5: 15, None: 7, 2: 0, 9: 0, 7: len(long)}
    assert out[2].fingerprint == out[9].fingerprint and out[9].near_next == 1.0 and out[2].near_next == 0.0
    assert fingerprints.fingerprint_documents(spark.createDataFrame([], "doc_id int, text string")).count() == 0


def test_an_empty_table_has_no_fingerprints(spark, tables):
    path = tables(documents=([], "doc_id bigint, text string"))
    assert fingerprints.op3_one_permutation(spark, path).count() == 0


def test_densification_fills_bins_alike_for_equal_sets():
    maker = fingerprints.Fingerprinter()
    data = b"one two three four five six"
    prints = maker.of(np.frombuffer(data * 2, np.uint8), np.array([0, len(data), 2 * len(data)]))
    assert (prints[0] == prints[1]).all() and prints.any()
