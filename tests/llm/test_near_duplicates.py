"""MinHash, components, NN-descent and repeated strings, against brute force."""

import random

import numpy as np
import plain
from hypothesis import given, settings
from hypothesis import strategies as st

from civiclens.llm import embeddings, minhash, suffixes
from civiclens.llm.components import connected_components


def test_near_duplicates_are_those_of_brute_force(spark, folder, texts):
    out = minhash.op8_minhash_stars(spark, folder).collect()
    expected = plain.components(texts, plain.near_links(texts, 2))
    assert {r.doc_id: r.component_id for r in out} == expected
    assert {r.doc_id: r.n_shingles for r in out} == {i: len(plain.shingle_set(t, 2)) for i, t in texts.items()}
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_a_family_of_near_copies_is_linked_as_brute_force_links_it(spark):
    """Copies with up to a fifth of their words changed: many pairs on either side of the threshold."""
    random.seed(3)
    base = [f"w{i}" for i in range(120)]
    family = {}
    for i in range(150):
        words = [random.choice("xyz") + str(i) if random.random() < i % 15 / 100 else w for w in base]
        family[1000 - i] = " ".join(words)
    docs = spark.createDataFrame(list(family.items()), "doc_id bigint, text string")
    out = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, words=2).collect()}
    assert out == plain.components(family, plain.near_links(family, 2))


def test_near_duplicates_of_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(300))
    rows = [
        (1, None), (2, ""), (3, "  "), (4, "A b"), (5, "a  B"), (6, "a"), (7, "A"), (None, "a"),
        (8, long), (9, long + " x"), (9, long + " x"), (-1, long.replace("w10 ", "zz ")),
    ]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id bigint, text string, component_id int")
    out = minhash.near_duplicates(docs, words=2).collect()
    found = {r.doc_id: (r.component_id, r.kept) for r in out}
    assert len(out) == len(rows)
    assert found == {
        1: (1, True), 2: (2, True), 3: (3, True), 4: (4, True), 5: (4, False), 6: (6, True), 7: (6, False),
        None: (None, True), 8: (-1, False), 9: (-1, False), -1: (-1, True),
    }
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_a_class_whose_smallest_id_has_another_text_keeps_its_links(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text), (5, "q r s t u v w"), (6, text), (2000, text + " x"), (7, "q r s t u v w z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {(r.doc_id, r.component_id) for r in minhash.near_duplicates(docs, words=2).collect()}
    assert out == {(5, 5), (6, 5), (2000, 5), (7, 5)}


def test_blocks_and_parts_of_open_members_lose_no_link(spark, monkeypatch):
    """Chains of texts, each near the next only, in buckets that no hub can join."""
    monkeypatch.setattr(minhash, "_BLOCK", 8)
    monkeypatch.setattr(minhash, "_PARTNERS", 16)
    random.seed(7)
    family, words = {}, [f"w{i}" for i in range(100)]
    for i in range(160):
        words = [f"{random.choice('xy')}{i}" if random.random() < 0.045 else w for w in words]
        family[i * 37 % 160] = " ".join(words)
    docs = spark.createDataFrame(list(family.items()), "doc_id bigint, text string")
    out = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, words=2, bands=40, rows=3).collect()}
    want = plain.components(family, plain.near_links(family, 2))
    assert out == want and len(set(want.values())) > 3


def test_an_id_with_two_texts_ties_their_classes(spark):
    rows = [(1, "a b c d"), (2, "a b c d"), (2, "q r s t"), (3, "q r s t"), (4, "u v")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert out == {1: 1, 2: 1, 3: 1, 4: 4}


def test_components_of_chains_stars_and_loops(spark):
    random.seed(5)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(9, 9), (1, 7)]
    links += [(random.randrange(300, 400), random.randrange(300, 400)) for _ in range(60)]
    ids = {i for link in links for i in link if link[0] != link[1]}
    edges = spark.createDataFrame(links, "a bigint, b bigint")
    out = {r.id: r.component for r in connected_components(edges).collect()}
    assert out == {i: c for i, c in plain.components({*ids, 9}, links).items() if i in ids}
    assert connected_components(edges.limit(0)).count() == 0


def test_vectors_are_linked_as_by_brute_force(spark):
    random_ = np.random.default_rng(4)
    vectors, n = {}, 0
    for size in (1, 2, 3, 30, 90):  # the last two fill lists of ten
        for _ in range(6 if size < 10 else 1):
            centre = random_.normal(size=32)
            for _ in range(size):
                vectors[n] = [float(x) for x in np.float32(centre + random_.normal(size=32) * 0.12)]
                n += 7
    vectors[1], vectors[2] = vectors[0], [2 * x for x in vectors[0]]
    docs = spark.createDataFrame(list(vectors.items()), "vec_id bigint, embedding array<float>")
    out = embeddings.near_duplicate_vectors(docs).collect()
    links = plain.vector_links({i: np.float32(v).tolist() for i, v in vectors.items()})
    expected = plain.components(vectors, links)
    degree = {i: sum(i in link for link in links) for i in vectors}
    assert {r.vec_id: r.component_id for r in out} == expected
    assert {r.vec_id: r.n_links for r in out} == degree
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)


def test_pairs_that_refinement_loses_beside_a_large_group_are_found(spark, monkeypatch):
    """The group holds nearly all links, so their share says nothing about the pairs."""
    random_ = np.random.default_rng(9)
    vectors = {}
    for first, groups, size in ((0, 1, 110), (1000, 40, 2)):
        for group in range(groups):
            centre = random_.normal(size=32)
            for i in range(size):
                at = first + group * size + i
                vectors[at] = [float(x) for x in np.float32(centre + random_.normal(size=32) * 0.05)]
    links_of = embeddings._links_of
    monkeypatch.setattr(embeddings, "_links_of", lambda edges: links_of(edges).filter("a < 1000"))
    monkeypatch.setattr(embeddings, "_ROUNDS", 1)
    monkeypatch.setattr(embeddings, "_ENLARGED", 1)
    docs = spark.createDataFrame(list(vectors.items()), "vec_id bigint, embedding array<float>")
    out = embeddings.near_duplicate_vectors(docs).collect()
    links = plain.vector_links({i: np.float32(v).tolist() for i, v in vectors.items()})
    assert {r.vec_id: r.component_id for r in out} == plain.components(vectors, links)
    assert {r.vec_id: r.n_links for r in out} == {i: sum(i in link for link in links) for i in vectors}


def test_all_vectors_are_compared_in_parts(spark, monkeypatch):
    random_ = np.random.default_rng(10)
    vectors = {}
    for i in range(150):
        size = 8 if i % 5 else 6
        vectors[i * 3] = (random_.normal(size=size) * 0.2 + (1 + i % 3 * np.arange(size))).tolist()
    monkeypatch.setattr(embeddings, "_PART", 40)
    rows = [(i, np.array(v) / np.linalg.norm(v), 1) for i, v in vectors.items()]
    classes = spark.createDataFrame([(i, v.tobytes(), c) for i, v, c in rows], "id bigint, unit binary, copies bigint")
    parts, counted = embeddings._compare_all(classes.select("id", "unit"), classes.select("id", "copies"))
    links = plain.vector_links(vectors)
    degree = {i: n for i in vectors if (n := sum(i in link for link in links))}
    assert dict(counted.collect()) == degree
    assert dict(parts.select("id", "component").collect()) == {
        i: c for i, c in plain.components(vectors, links).items() if i in degree
    }


def test_odd_vectors(spark):
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (None, [1.0, 0.0]),
        (6, [1.0, None]), (7, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0, 0.0]), (9, []), (10, [-1.0, 0.1]),
    ]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<double>, unit string")
    out = embeddings.near_duplicate_vectors(docs).collect()
    assert len(out) == len(rows)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out}
    alone = {i: (0, i, True) for i in (3, 4, 5, 6, 8, 9, 10)}
    assert found == {**alone, 1: (2, 1, True), 2: (2, 1, False), 7: (2, 1, False), None: (0, None, True)}
    assert embeddings.near_duplicate_vectors(docs.limit(0)).count() == 0


def repeated(spark, tables, texts):
    path = tables(documents=(list(enumerate(texts)), "doc_id bigint, text string"))
    out = sorted(suffixes.op4_prefix_doubling(spark, path).collect())
    return [tuple(row)[1:] for row in out]


def test_repeated_strings_are_those_of_brute_force(spark, tables):
    random.seed(6)
    letters = "abcdefghij ü"
    base = "".join(random.choices(letters, k=4000))
    texts = []
    for _ in range(80):
        at, size = random.randrange(3700), random.randrange(150, 420)
        around = ["".join(random.choices(letters, k=random.randrange(300))) for _ in range(2)]
        texts.append(around[0] + base[at : at + size] + around[1])
    texts += ["x" * 1000, "x" * 150, "ab" * 400, "ab" * 99, "", None, "ü" * 100, "ü" * 99, texts[3], texts[3], base]
    assert repeated(spark, tables, texts) == plain.repeats(texts)


def test_repeats_in_documents(spark, folder, texts):
    out = {r.doc_id: tuple(r)[1:] for r in suffixes.op4_prefix_doubling(spark, folder).collect()}
    assert out == dict(zip(texts, plain.repeats(list(texts.values()))))


def test_an_empty_table_has_no_repeats(spark, tables):
    assert repeated(spark, tables, []) == []


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text("ab", max_size=90), max_size=6), st.sampled_from([16, 20]))
def test_anchors_cover_each_window_once(texts, length):
    anchors = suffixes.Anchors(length)
    data = "".join(texts).encode()
    offsets = np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64)
    _, row, first, _, windows, one, two = anchors.of(np.frombuffer(data, np.uint8), offsets, contents=True)
    covered = [(r, f + i) for r, f, n in zip(row.tolist(), first.tolist(), windows.tolist()) for i in range(n)]
    assert sorted(covered) == [(r, i) for r, t in enumerate(texts) for i in range(len(t) - length + 1)]
    names = {}
    for r, f, n, a, b in zip(row, first, windows, one, two):
        content = texts[r][f : f + n + length - 1]
        assert names.setdefault((a, b, n), content) == content


def test_long_texts_are_taken_in_pieces(monkeypatch):
    monkeypatch.setattr(suffixes, "_PIECE", 64)
    test_anchors_cover_each_window_once.hypothesis.inner_test(["ab" * 200, "ba", "a" * 150], 16)


def test_texts_are_cut_to_whole_characters(spark):
    passage = "é" + "".join(chr(97 + i * 7 % 26) for i in range(230)) + "é"
    rows = [(1, "xè" + passage + "üa", 1), (2, "yé" + passage + "üb", 2), (3, None, 3), (None, "short", 4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans int")
    out = suffixes.remove_repeats(docs)
    assert out.columns == docs.columns
    kept = {r.spans: r.text for r in out.collect()}
    assert kept == {1: "xèa", 2: "yéb", 3: None, 4: "short"} or kept[3] is None and kept[4] == "short"
    assert all(passage not in (t or "") for t in kept.values())
