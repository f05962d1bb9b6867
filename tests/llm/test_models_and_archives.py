"""Toxicity, language, archives and the pipeline."""

import io
import random
import zlib
from collections import Counter

import numpy as np
import plain
import pytest

import corpus_pipeline
from civiclens.llm import language, toxicity, warc
from civiclens.llm.queries import ORACLES, QUERIES

SYLLABLES = {
    "en": "th er on an re he in ed nd ha".split(),
    "fr": "é eu ou ai qu è en le ment ux".split(),
    "de": "sch ei ung ä ß ich ver ge ü be".split(),
}


def prose(rng, lang, words):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def labelled():
    """600 documents in three languages, a fifth of them toxic."""
    rng, docs, labels = random.Random(2), [], []
    for i in range(600):
        lang = list(SYLLABLES)[i % 3]
        words = prose(rng, lang, rng.randint(30, 200)).split()
        toxic = i % 5 == 0
        if toxic:
            for _ in range(1 + len(words) // 15):
                words.insert(rng.randrange(len(words)), rng.choice(["blockhead", "wretched", "nitwit"]))
        docs.append((i, " ".join(words), lang, "s", 0))
        labels.append((i, 1, int(toxic)))
    return docs, labels


DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LABELS = "doc_id bigint, quality int, toxic int"


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_toxicity_is_learned_from_the_other_folds(spark, tables, labelled):
    docs, labels = labelled
    poisoned = [(i, q, 1 - t if held_out(i) else t) for i, q, t in labels]
    path = tables(documents=(docs, DOCUMENTS), labels=(labels, LABELS))
    out = {r.doc_id: r for r in toxicity.op9_compression_distance(spark, path).collect()}
    truth = {i: t for i, _, t in labels}
    assert {i for i, r in out.items() if r.held_out} == {i for i in truth if held_out(i)}
    right = [out[i].predicted == t for i, t in truth.items() if held_out(i)]
    assert np.mean(right) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out.values())
    tables_ = spark.createDataFrame(docs, DOCUMENTS), spark.createDataFrame(poisoned, LABELS)
    assert toxicity.train_on(*tables_) == toxicity.train_on(tables_[0], spark.createDataFrame(labels, LABELS))


def test_toxicity_of_odd_rows(spark, labelled):
    docs, labels = labelled
    model = toxicity.train([d[1] for d in docs], [bool(t) for _, _, t in labels])
    rows = [(1, None, 9.0), (None, "", 9.0), (2, "nitwit " * 50_000, 9.0), (3, "x" * 300_000, 9.0)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, score double")
    out = {r.doc_id: r.score for r in toxicity.score_documents(table, model).collect()}
    assert out[1] == out[None] < 0.5 < out[2] and out[3] < 0.5
    assert toxicity.score_documents(table.limit(0), model).count() == 0
    assert {r.score for r in toxicity.score_documents(table, None).collect()} == {0.0}
    assert toxicity.train([], []) is None and toxicity.train(["a"], [True]) is None


def test_scores_do_not_depend_on_which_label_the_sample_bounds(spark):
    """A quarter of the toxic labels has no sign, so that the share of toxic texts shows in each score."""
    rng, docs, labels = random.Random(5), [], []
    for i in range(900):
        words = prose(rng, list(SYLLABLES)[i % 3], 30).split()
        if i % 7 == 0 and i % 4:
            for _ in range(3):
                words.insert(rng.randrange(20), rng.choice(["blockhead", "wretched"]))
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 7 == 0)))
    tables_ = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    fixed = ["", prose(rng, "en", 30), "blockhead wretched " * 10]
    scores = []
    for bound in (900, 150, 70):  # no label, label 0 and both labels are bounded
        scorer = toxicity.Scorer(toxicity.train_on(*tables_, sample_rows=bound))
        scores.append([scorer.score(text) for text in fixed])
    odds = np.log(scores) - np.log1p(-np.array(scores))
    assert np.abs(odds[1:, :2] - odds[0, :2]).max() < 0.8
    assert len({tuple(score >= 0.5 for score in row) for row in scores}) == 1


def test_rare_toxic_words_are_learned_beside_a_frequent_one():
    rng, texts, toxic = random.Random(4), [], []
    rare = ["blockhead", "wretched", "nitwit", "scoundrel", "villainous"]
    for i in range(900):
        words = prose(rng, list(SYLLABLES)[i // 3 % 3], 40).split()
        toxic.append(i % 3 == 0)
        if i % 6 == 0:  # the frequent word, twenty times a text
            for _ in range(20):
                words.insert(rng.randrange(len(words)), "dunderpate")
        elif i % 6 == 3:
            words.insert(rng.randrange(40), rare[i // 6 % 5])
            words.insert(rng.randrange(40), rare[i // 6 % 5])
        texts.append(" ".join(words))
    scorer = toxicity.Scorer(toxicity.train(texts, toxic))
    clean = prose(rng, "en", 15)
    assert scorer.score(clean) < 0.5 <= scorer.score(f"dunderpate {clean}")
    assert all(scorer.score(f"{word} {clean}") >= 0.5 for word in rare)


def test_languages_are_told_apart_on_the_fold_left_out(spark, tables, labelled):
    docs, _ = labelled
    path = tables(documents=(docs, DOCUMENTS))
    out = {r.doc_id: r for r in language.op1_subword_softmax(spark, path).collect()}
    assert all(r.held_out == held_out(i) and 0 <= r.score <= 1 for i, r in out.items())
    right = [out[i].lang_pred == lang for i, _, lang, _, _ in docs if held_out(i)]
    assert np.mean(right) > 0.98
    accepted = [r.accepted for r in out.values()]
    assert np.mean(accepted) > 0.98


def test_language_of_odd_rows(spark, labelled):
    docs, _ = labelled
    model = language.train([d[1] for d in docs], [d[2] for d in docs])
    rows = [(1, None, 0), (None, "", 0), (2, "12 34 !?", 0), (3, "жюри щука бык", 0), (4, docs[0][1] * 300, 0), (5, docs[0][1], 0)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang_score int")
    out = {r.doc_id: r for r in language.identify(table, model).collect()}
    for i in (1, None, 2):
        assert (out[i].lang_pred, out[i].lang_score, out[i].lang_accepted) == ("und", 0.0, False)
    assert out[3].lang_pred in model.languages and out[3].lang_score < out[5].lang_score
    assert out[4].lang_accepted and out[5].lang_pred == "en"
    assert language.identify(table.limit(0), model).count() == 0
    assert {r.lang_pred for r in language.identify(table, None).collect()} == {"und"}
    assert language.train([], []) is None


def test_a_language_not_learned_is_rejected_and_a_rare_one_learned(spark, labelled):
    docs, _ = labelled
    rng = random.Random(6)
    other = "zo ka wi yo ju mo ky wa zy ok".split()
    unknown = [" ".join("".join(rng.choices(other, k=rng.randint(1, 4))) for _ in range(80)) for _ in range(30)]
    columns = "doc_id bigint, text string, lang string"
    table = spark.createDataFrame([d[:3] for d in docs], columns)
    model = language.train_on(table)
    strange = spark.createDataFrame(list(enumerate(unknown)), "doc_id bigint, text string")
    assert np.mean([r.lang_accepted for r in language.identify(strange, model).collect()]) < 0.1
    assert np.mean([r.lang_accepted for r in language.identify(table, model).collect()]) > 0.98
    rare = table.unionByName(spark.createDataFrame([(5000 + i, t, "xx") for i, t in enumerate(unknown[:12])], columns))
    assert "xx" in language.train_on(rare, sample_rows=20).languages


def test_letters_of_the_third_plane_are_letters():
    _, _, letters = language.Subwords().of(["\U00030000\U00030001", "\U0001f600", "\U000e0041"])
    assert letters.tolist() == [2, 0, 0]


def test_models_of_repeated_ids_and_labels(spark, labelled):
    docs, labels = labelled
    columns = "doc_id bigint, text string, lang string"
    rows = [(i % 50 + 1, text, lang) for i, text, lang, *_ in docs]  # an id has several texts
    again = spark.createDataFrame(rows + rows, columns)
    once = spark.createDataFrame(rows, columns)
    models = [language.train_on(t.repartition(n), sample_rows=60) for t, n in ((again, 1), (again, 5))]
    assert models[0].languages == models[1].languages and (models[0].table == models[1].table).all()
    names = spark.createDataFrame([(i, f"wort {i}", f"lang {i}") for i in range(1, 400)], columns)
    assert len(language.train_on(names).languages) <= language.MOST_LANGUAGES
    marks = [(i, t) for i, _, t in labels] + [(i, 1 - t) for i, _, t in labels[:100]]  # both labels
    tables_ = once.drop("lang"), spark.createDataFrame(marks, "doc_id bigint, toxic int")
    model = toxicity.train_on(*tables_, sample_rows=40)
    assert model == toxicity.train_on(again.drop("lang").repartition(3), tables_[1].repartition(4), sample_rows=40)
    both = spark.createDataFrame([(i, k) for i in range(60) for k in (0, 1)], "doc_id bigint, toxic int")
    assert toxicity.train_on(once.drop("lang"), both) is None


def test_subwords_are_runs_of_letters_with_their_ends():
    subwords = language.Subwords(1 << 30)
    buckets, owner, letters = subwords.of(["Ab, 12 c", "ab c", ""])
    one, two = (Counter(buckets[owner == i].tolist()) for i in (0, 1))
    assert one == two and letters.tolist() == [3, 3, 0]
    assert one.total() == len(["a", "b", "c", " a", "ab", "b ", " c", "c ", " ab", "ab ", " c ", " ab "])


@pytest.mark.parametrize("version", [1, 2])
def test_arc_records_are_taken_by_their_lengths(version):
    records = [("http://a/", "", b"x\nhttp://b 0 0 text/html 3\n"), ("", "", b""), ("http://c d", "l", b"\x00\n\n")]
    parsed = list(warc.parse_arc(warc.write_arc(records, version)))
    assert [payload for _, payload in parsed] == [r[2] for r in records]
    assert parsed[2][0]["URL"] == "http://c%20d" and len(parsed[0][0]) == (5 if version == 1 else 10)


def test_damaged_arcs_are_refused():
    good = warc.write_arc([("u", "", b"payload")], 1)
    for bad in (good[:-5], b"1 2 3\n", good.replace(b"1 0 legacy", b"9 0 legacy")):
        with pytest.raises(ValueError):
            list(warc.parse_arc(bad))


def test_identifiers_and_dates():
    for page in (0, 1, -5, 2**63 - 1, -(2**63), None):
        assert warc.page_of(warc.record_id(page)) == page
    assert warc.warc_date("20010203040506") == "2001-02-03T04:05:06Z"
    assert warc.warc_date("199912") == "1999-12-01T00:00:00Z"
    assert warc.warc_date("99999999999999") == "1970-01-01T00:00:00Z"


def test_warc_records_end_where_they_declare():
    fields = {"URL": "u", "IP-address": "0", "Archive-date": "2001", "Content-type": "text/html"}
    record = warc.warc_record(fields, 3, None, "ü\r\n\r\nWARC/1.1\r\n".encode()).encode()
    (head, block), = warc.parse_warc(io.BytesIO(record + b"\r\n\r\n"))
    assert block.decode() == "ü\r\n\r\nWARC/1.1\r\n" and head["warc-type"] == "response"
    with pytest.raises(ValueError):
        list(warc.parse_warc(io.BytesIO(record + b"x")))


def test_pages_come_back_as_they_went(spark, tables):
    body = "ü\r\n\r\nWARC/1.1\r\n"
    rows = [
        (1, "u", None), (2, "http://a b", body), (3, None, body), (None, "x", "q"), (-5, "x", body),
        (2, "http://a b", body), (7, "", ""), (8, "n", "\x00\n"), (9, "l", "long " * 100_000),
    ]
    path = tables(pages=([(*r, 0) for r in rows], "page_id bigint, url string, html string, first int"))
    out = warc.op5_arc_converter(spark, path).collect()
    first = {}
    for page, _, html in rows:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    expected = Counter()
    for page, _, html in rows:
        data = (html or "").encode()
        top = first.get(html or "")
        revisit = page is not None and page != top
        expected[(page, len(data), warc.payload_digest(data), "revisit" if revisit else "response", top if revisit else None)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out) == expected


def test_a_page_with_two_payloads_revisits_the_first_page_of_each(spark, tables):
    rows = [(1, "u", "A"), (3, "u", "A"), (3, "u", "Bb"), (2, "v", "Bb"), (4, "u", "A"), (4, "u", "only here")]
    path = tables(pages=(rows, "page_id bigint, url string, html string"))
    out = warc.op5_arc_converter(spark, path).collect()
    digest = {html: warc.payload_digest(html.encode()) for _, _, html in rows}
    assert sorted((r.page_id, r.payload_digest, r.record_type, r.refers_to) for r in out) == sorted([
        (1, digest["A"], "response", None), (2, digest["Bb"], "response", None),
        (3, digest["A"], "revisit", 1), (3, digest["Bb"], "revisit", 2),
        (4, digest["A"], "revisit", 1), (4, digest["only here"], "response", None),
    ])


def test_no_pages_make_no_records(spark, tables):
    path = tables(pages=([], "page_id bigint, url string, html string"))
    assert warc.op5_arc_converter(spark, path).count() == 0


def test_pipeline_takes_out_what_it_should(spark, tables, labelled):
    docs, labels = labelled
    rng = random.Random(8)
    passage = prose(rng, "en", 120)
    extra = [
        (1000, docs[1][1], "fr", "s", 0),  # a copy
        (1001, docs[2][1] + " extra", "de", "s", 0),  # a near copy
        (1002, prose(rng, "en", 90) + " " + passage, "en", "s", 0),
        (1003, prose(rng, "en", 90) + " " + passage, "en", "s", 0),
        (1004, "12345 !!!", "en", "s", 0),
        (1005, None, None, None, None),
        (1006, "nitwit blockhead wretched " * 20, "en", "s", 0),
    ]
    path = tables(documents=(docs + extra, DOCUMENTS), labels=(labels, LABELS))
    table = spark.read.parquet(f"{path}/documents.parquet")
    kept = [table]
    for _, stage in corpus_pipeline.STAGES[:4]:
        kept.append(corpus_pipeline.written(stage(spark, kept[-1], path), "stage"))
        assert kept[-1].schema.simpleString() == table.schema.simpleString()
    ids = [{r.doc_id for r in k.collect()} for k in kept]
    toxic = {i for i, _, t in labels if t} | {1006}
    assert len(toxic - (ids[0] - ids[1])) < 6 and len((ids[0] - ids[1]) - toxic) < 6
    assert ids[1] - ids[2] >= {1004, 1005} and len(ids[1] - ids[2]) < 6
    assert ids[2] - ids[3] == {1000, 1001} & ids[2]
    assert ids[3] == ids[4]
    texts = {r.doc_id: r for r in kept[4].collect()}
    assert all(passage[60:200] not in r.text and r.n_chars == len(r.text) for r in texts.values())
    packed = corpus_pipeline.run(spark, path)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == ids[4]


def test_the_stage_for_near_duplicates_judges_each_text_of_an_id(spark):
    long = " ".join(f"w{i}" for i in range(40))
    rows = [
        (1, "a b c d e f", "en", "s", 1), (1, "q r s t u v", "en", "s", 2), (1, "a b c d e f", "de", "s", 3),
        (2, "q r s t u v", "en", "s", 4), (3, long, "en", "s", 5), (4, long + " x", "en", "s", 6), (4, "own text", None, None, None),
        (None, long, "en", "s", 7), (None, None, None, None, None), (5, None, "en", "s", 8), (5, "", "en", "s", 9), (6, " ", "en", "s", 1),
    ]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    out = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert out.columns == docs.columns
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    # The copy of a row goes (the smaller stays), and so do texts near to one of a smaller id.
    gone = [(1, "a b c d e f", "en", "s", 1), (2, "q r s t u v", "en", "s", 4), (4, long + " x", "en", "s", 6), (5, "", "en", "s", 9)]
    assert got == sorted((r for r in rows if r not in gone), key=repr)


def test_stages_take_columns_of_any_name(spark, tables, labelled):
    docs, labels = labelled
    path = tables(labels=(labels, LABELS))
    names = {"repeat text": "x", "digest of text": "y", "row": "z", "gone": "g", "name": "n", "id": "i", "block": "b", "text digest": "t", "score": "s", "lang_accepted": "a"}
    table = spark.createDataFrame([d for d in docs[:40]], DOCUMENTS)
    wide = table.selectExpr("*", *[f"'{value}' AS `{name}`" for name, value in names.items()])
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, wide, path)
        assert out.columns == wide.columns
        row = out.first()
        assert {name: row[name] for name in names} == names


def test_stages_take_an_empty_table(spark, tables):
    path = tables(documents=([], DOCUMENTS), labels=([], LABELS))
    table = spark.read.parquet(f"{path}/documents.parquet")
    assert [stage(spark, table, path).count() for _, stage in corpus_pipeline.STAGES] == [0] * 5


def test_each_operator_is_registered():
    numbers = [int(k[2:].split("_")[0]) for k in QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


def test_plain_helpers():
    assert plain.jaccard(plain.shingle_set("A b c", 2), plain.shingle_set("a B c", 2)) == 1
