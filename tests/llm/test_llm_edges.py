"""Every operator on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import byte_pair, chat, discriminant, licences, mixing, near_copies, personal_data, quality_rules, top_k, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, measured string, verdict int, mix string, score double, row_hash int, `a.b` string"
PROSE = "the ship of the north sailed to a harbour in the spring and it was late for that is how by this are from at with be on as "
ROWS = [
    (1, PROSE * 3, "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, "x" * 300_000, "en", "b"),
    (5, PROSE * 2000, "xx", "b"),
    (6, "mail a.b@c.example.org or +1 (555) 555-0199 now, 4111 1111 1111 1111 and 10.0.0.256", "en", None),
    (6, "mail a.b@c.example.org or +1 (555) 555-0199 now, 4111 1111 1111 1111 and 10.0.0.256", "en", None),
    (None, "released under the MIT License", "de", "c"),
    (None, None, None, None),
    (8, " \t\n\x0b\x0c\r ", "fr", "c"),
    (9, "日本語 🎉 \x00 é́ <|im_end|>", "fr", "c"),
]
LABELS = "doc_id long, quality int, toxic int, measured string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, len(r[1] or ""), "m", 1, "x", 0.5, 3, "dot") for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0, "m"), (2, 0, 1, "m"), (4, 0, 1, "m"), (5, 1, 0, "m"), (6, 1, 0, "m"), (6, 0, 0, "m"), (None, 1, 1, "m"), (9, None, None, "m")], LABELS)


BY_DOC = {
    "quality rules": lambda d, _: quality_rules.judge(d, "out").select("doc_id", "out.*"),
    "discriminant": lambda d, lab: discriminant.classify(d, lab),
    "mixing": lambda d, _: mixing.mix(d, "out").select("doc_id", "out.*"),
    "licences": lambda d, _: licences.scan(d),
    "toxicity": lambda d, lab: toxicity.classify(d, lab),
    "byte pairs": lambda d, _: byte_pair.digests(d),
    "personal data": lambda d, _: personal_data.find(d),
    "near copies": lambda d, _: near_copies.join(d),
}


@pytest.mark.parametrize("name", BY_DOC)
def test_one_row_per_document_and_equal_rows_alike(docs, labels, name):
    rows = [r.asDict() for r in BY_DOC[name](docs, labels).collect()]
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in ROWS)
    six = [r for r in rows if r["doc_id"] == 6]
    assert str(six[0]) == str(six[1])


@pytest.mark.parametrize("name", BY_DOC)
def test_empty_table(docs, labels, name):
    assert BY_DOC[name](docs.limit(0), labels.limit(0)).collect() == []


@pytest.mark.parametrize("name", BY_DOC)
def test_documents_without_labels_or_languages(docs, labels, name):
    nothing = docs.withColumns({c: F.lit(None).cast("string") for c in ("text", "lang", "source")})
    assert BY_DOC[name](nothing, labels.limit(0)).count() == len(ROWS)


def test_defined_results_of_empty_texts(docs, labels):
    empty = {r.doc_id: r for r in licences.scan(docs).where("doc_id in (2, 3, 8)").collect()}
    assert all((r.n_words, r.n_base, r.first_word, r.labels, r.score, r.spans) == (0, 0, None, "", 0.0, []) for r in empty.values())
    near = {r.doc_id: r for r in near_copies.join(docs).collect()}
    assert [(near[i].class_id, near[i].n_links) for i in (2, 3, 8, 6)] == [(2, 0), (3, 0), (8, 0), (6, 1)]
    tokens = {r.doc_id: r.n_tokens for r in byte_pair.digests(docs).collect()}
    assert tokens[2] == tokens[3] == 0 and tokens[4] > 1000
    judged = {r.doc_id: r.out for r in quality_rules.judge(docs, "out").collect()}
    assert judged[2].base_failed and not judged[2].kept and judged[2].js_chars is None
    taken = [r.out.copies for r in mixing.mix(docs, "out").where("doc_id in (2, 3, 8)").collect()]
    assert taken == [0, 0, 0]


def test_labels_of_one_class_and_none(docs, labels):
    assert {r.score for r in discriminant.classify(docs, labels.where("quality = 1 and doc_id = 1")).collect()} == {1.0}
    assert {r.score for r in discriminant.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert {round(r.score, 6) for r in toxicity.classify(docs, labels.limit(0)).collect()} == {0.5}


def test_top_k_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [1.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [9.0, 9.0]), (50, [-1.0, 0.0]), (7, []), (8, [1e300, 1e300])]
    got = {}
    for r in top_k.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    # both rows of id 0 are queries, ranked together, and candidates of the others
    one = 256 * 256 + 128 * 128
    assert got[0] == [(8, 2**63 - 1), (8, 2**63 - 1), (1, one), (1, one), (2, 256 * 256)]
    assert [i for i, _ in got[50]] == [7, 0, 0, 1, 2]
    assert top_k.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_top_k_keeps_rows_that_share_an_id(spark):
    rows = [(0, [1.0, 0.5]), (1, [1.0, 0.5]), (1, [2.0, 0.5]), (1, [3.0, 0.5]), (2, [1.0, 1.0]), *[(k, [1.0, 1.0]) for k in range(3, 9)]]
    df = spark.createDataFrame([(*r, 7, "q") for r in rows], "vec_id long, embedding array<double>, score long, query_id string")
    got = [(r.rank, r.vec_id, r.score) for r in top_k.search(df).orderBy("rank").collect()]
    # ties at rank k go to the smaller id
    assert got == [(1, 1, 256 * 256 * 3 + 128 * 128), (2, 1, 256 * 256 * 2 + 128 * 128), (3, 2, 256 * 256 + 256 * 128), (4, 3, 256 * 256 + 256 * 128), (5, 4, 256 * 256 + 256 * 128)]


def test_chat_edges(spark):
    rows = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, None, None), (3, 0, "user", "hi"), (3, 1, "", ""), (None, None, "user", "a<|b"), (None, None, "user", "a<|b"), (5, 0, "user", "hi"), (5, 0, "user", "hi")]
    got = {r.conv_id: r for r in chat.render(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()}
    assert set(got) == {2, None, 5}
    assert got[2].copies == 2 and got[2].text == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>\n<|im_end|>\n"
    assert got[None].n_turns == 2 and got[None].text.count("a< |b") == 2
    assert chat.render(spark.createDataFrame([], "conv_id long, turn int, role string, text string")).collect() == []


def test_stages_keep_the_columns(docs, spark):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, "")
        assert got.dtypes == docs.dtypes, name
        assert stage(spark, docs.limit(0), "").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), "").count() == 0


def test_masking_and_copies(docs, spark):
    masked = {r.doc_id: r for r in personal_data.stage(spark, docs, "").collect()}
    assert masked[6].text == "mail [EMAIL] or [PHONE] now, [CARD] and 10.0.0.256" and masked[6].n_chars == len(masked[6].text)
    assert masked[2].text is None and masked[3].text == ""
    assert near_copies.first_of_each(docs).where("doc_id = 6").count() == 1


def test_encoding_round_trip(docs):
    coded = byte_pair.decode(byte_pair.encode(docs, "ids"), "ids", "back")
    assert all(r.back == (r.text or "") for r in coded.select("text", "back").collect())
