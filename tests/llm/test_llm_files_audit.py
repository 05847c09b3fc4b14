"""Source divergence, fill-in-the-middle and token files against brute force, and on odd input."""

import collections
import hashlib
import os
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import divergence, fill_middle, token_files

SCHEMA = "doc_id long, text string, lang string, source string, n long, term string, own boolean, part string, `a.b` string"
ROWS = [
    (1, "the ship of the north sailed " * 3, "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, "x" * 300_000, "en", "b"),
    (5, "the north and the ship " * 40_000, "en", "c"),
    (6, "ship, Ship! SHIP <P> <|endoftext|> north", "en", "b"),
    (6, "ship, Ship! SHIP <P> <|endoftext|> north", "en", "b"),
    (6, "another text of this id: <S and <M", "en", "b"),
    (None, "released under the MIT License", "de", "c"),
    (None, None, None, "d"),
    (8, " \t\n\x0b\x0c\r ", "fr", "c"),
    (9, "日本語 🎉 \x00 é́ İ ΑΣ <|im_end|>", "fr", "d"),
    (-5, "ship north the", "en", ""),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 1, "t", True, "p", "dot") for r in ROWS], SCHEMA)


# ---- source divergence


def audited(rows, least=3, top=200):
    """Every group against every other over all kept terms, one term at a time."""
    counts, totals, documents, groups = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        counts[lang, source].update(words)
        totals[lang].update(words)
        documents[lang].update(set(words))
    out = set()
    for lang, source in groups:
        kept = [t for t in totals[lang] if documents[lang][t] >= least]
        v = len(kept)
        size = {g: sum(counts[g][t] for t in kept) + v for g in groups if g[0] == lang}
        whole = sum(totals[lang][t] for t in kept) + v
        share = lambda n, s: 1 + 10**9 * (n + 1) // s
        pairs = [(o, sum((share(counts[lang, source][t], size[lang, source]) - (q := share(counts[lang, o][t], size[lang, o]))) ** 2 // q for t in kept)) for la, o in groups if la == lang and o != source]
        terms = [(t, p, share(totals[lang][t], whole)) for t in kept if counts[lang, source][t] and (p := share(counts[lang, source][t], size[lang, source]))]
        terms = [(t, (p - q) ** 2 // q) for t, p, q in terms if p > q]
        for part, found, upto in (("pair", pairs, None), ("term", terms, top)):
            ordered = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:upto]
            out |= {(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(ordered)}
    return out


def as_set(df):
    got = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("seed", range(2))
def test_audit_is_brute_force(spark, seed, monkeypatch):
    rng = random.Random(seed)
    words = [w + x for w in ("sea", "Sea", "wind", "é", "日", "ab") for x in ("", "s", "ing", "z")]
    rows = [(k, " ".join(rng.choices(words, k=rng.randrange(30))) + "-7", rng.choice(("en", "de", None)), rng.choice(("a", "b", "c", None, "hot", "hot", "hot"))) for k in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert as_set(divergence.audit(df)) == audited(rows)
    assert as_set(divergence.audit(df, least=1, top=3)) == audited(rows, 1, 3)
    monkeypatch.setattr(divergence, "PAIRS", 7)  # many slices
    monkeypatch.setattr(divergence, "STEP", 5)
    monkeypatch.setattr(divergence, "HELD", 4)
    assert as_set(divergence.audit(df)) == audited(rows)


def test_audit_edges(docs):
    assert as_set(divergence.audit(docs)) == audited(ROWS)
    assert as_set(divergence.audit(docs, least=1)) == audited(ROWS, 1)
    assert divergence.audit(docs.limit(0)).collect() == []
    nothing = docs.withColumns({c: F.lit(None).cast("string") for c in ("text", "lang", "source")})
    assert divergence.audit(nothing).collect() == []


def test_audit_of_other_columns(docs):
    named = docs.select(F.col("text").alias("a.b"), F.col("lang").alias("term"), F.col("source").alias("n"))
    assert as_set(divergence.audit(named, "a.b", "term", "n")) == audited(ROWS)


def test_shares_are_exact(spark):
    rng = random.Random(5)
    cases = [(n, n + rng.randrange(1, 10**k)) for k in range(1, 14) for n in (0, rng.randrange(10**k), rng.randrange(10**13))]
    got = spark.createDataFrame(cases, "n long, size long").withColumn("p", divergence.share(F.col("n"), F.col("size"))).collect()
    n, size = (np.array([c[k] for c in cases]) for k in (0, 1))
    want = [1 + 10**9 * (a + 1) // b for a, b in cases]
    assert [r.p for r in got] == want and divergence._shares(n, size).tolist() == want


def test_audit_hands_on_sums_not_postings(spark):
    """One row per pair of groups and block, however many terms two groups share."""
    text = " ".join(f"{a}{b}{c}" for a in "abcdefghij" for b in "abcdefghij" for c in "abcdefghij")
    rows = divergence.pd.DataFrame([("en", s, t, 5, 6000, True) for s in "abc" for t in text.split()], columns=["lang", "source", "term", "n", "size", "own"])
    assert len(divergence.common_terms(rows)) == 6


# ---- fill in the middle


def filled(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(text)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return text, "plain", None, None
    a, b = min(h1 % (n + 1), h2 % (n + 1)), max(h1 % (n + 1), h2 % (n + 1))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return f"<S>{suffix}<P>{prefix}<M>{middle}", "spm", a, b - a
    return f"<P>{prefix}<S>{suffix}<M>{middle}", "psm", a, b - a


def test_fill_middle_is_brute_force(spark):
    rng = random.Random(2)
    rows = [(k, "".join(rng.choice("ab<>PSM é日🎉\n") for _ in range(rng.randrange(40)))) for k in range(600)] + [(2**62, "far"), (-7, "<S<P<M")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    made = fill_middle.transform(df).select("doc_id", "text", "fim.*")
    got = {r.doc_id: r for r in fill_middle.restore(made, "output", "form").collect()}
    digests = {r.doc_id: r for r in fill_middle.digests(df).collect()}
    assert {r.form for r in got.values()} == {"plain", "psm", "spm"}
    for doc_id, text in rows:
        output, form, prefix, middle = filled(doc_id, text)
        r, d = got[doc_id], digests[doc_id]
        assert (r.output, r.form, r.prefix_chars, r.middle_chars, r.restored) == (output, form, prefix, middle, text)
        hashes = tuple(hashlib.sha256(x.encode()).hexdigest() for x in (output, text))
        assert tuple(d) == (doc_id, len(text), form, prefix, middle, *hashes)


def test_fill_middle_edges(docs):
    got = collections.defaultdict(list)
    made = fill_middle.transform(docs, "fim")
    assert made.columns == [*docs.columns, "fim"]
    for r in fill_middle.digests(docs).collect():
        got[r.doc_id].append(r)
    assert sorted(str(k) for k, v in got.items() for _ in v) == sorted(str(r[0]) for r in ROWS)
    want = collections.Counter((d, *filled(d, t)[1:], hashlib.sha256((t or "").encode()).hexdigest()) for d, t, *_ in ROWS)
    assert want == collections.Counter((r.doc_id, r.form, r.prefix_chars, r.middle_chars, r.restored_sha256) for v in got.values() for r in v)
    assert fill_middle.digests(docs.limit(0)).collect() == []
    other = docs.select(F.col("doc_id").alias("form"), F.col("text").alias("output"))
    assert fill_middle.digests(other, "form", "output").count() == len(ROWS)


def test_pieces():
    t = fill_middle.PieceTable("abcdef")
    assert [list(t.cut(*c).read()) for c in ((2, 4), (0, 0), (6, 6), (3, 3), (0, 6))] == [["ab", "cd", "ef"], ["", "", "abcdef"], ["abcdef", "", ""], ["abc", "", "def"], ["", "abcdef", ""]]
    for form in fill_middle.FORMS:
        arranged = t.cut(1, 4).arranged(form)
        assert arranged.restored(form).text() == "abcdef" and arranged.buffers[0] is t.buffers[0]
        assert arranged.sha256() == hashlib.sha256(arranged.text().encode()).hexdigest()


# ---- token files


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path(token_files.MODEL))
    t.encode_special_tokens = True
    return t


def test_parts_give_the_tokens_of_the_whole(tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "KEPT", 300)
    encoder, rng = token_files.Encoder(public_tokenizers.path(token_files.MODEL)), random.Random(4)
    assert encoder.in_parts and encoder.dtype == "<u2"
    alphabet = "abKHSs''SÉéÅ̱̈́ \t\n\r\x0b\x0c\x1c\x85\xa0 　.,!#12日本<|>🎉​İΣς\x00"
    texts = ["", "a" * 3000, "日本語" * 300, "don't we'll '\t's\n\r 12 34 it's.", "H̱ ẖ Å x ̈y", "<|endoftext|> a<|startoftext|>"]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(200))) for _ in range(1500)]
    texts += [" ".join("".join(rng.choice("abcT") for _ in range(rng.randrange(7))) + rng.choice(("", ".", ",!", "#$", "'s")) for _ in range(60)) for _ in range(200)]
    for text, want in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == want.ids, text


def test_tokenizer_of_another_kind():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, t = token_files.Encoder(path), Tokenizer.from_file(path)
    assert not encoder.in_parts
    for text in ("The ship  sailed\n.", "", "ÉÈ 12"):
        assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(2))
def test_files_against_the_library(spark, folder, tokenizer, seed):
    rng = random.Random(seed)
    rows = [(k, " ".join(rng.choice(("ship", "North", "sea-wind,", "日本", "x" * 60)) for _ in range(rng.randrange(50)))) for k in rng.sample(range(-500, 5000), 700)]
    where = folder(f"tokens{seed}")
    made = token_files.write(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), where, partitions=7)
    start, want = 0, []
    for doc_id, text in sorted(rows):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, token_files.digests(spark, where).collect())) == want
    back = {r.doc_id: r for r in token_files.read(spark, where).collect()}
    assert all(zlib.crc32(np.array(back[d].ids, "<u4").tobytes()) == crc and back[d].start == s for d, s, _, crc in want)
    # the bases are prefix sums over the partitions, and the files have what the manifest says, in order
    docs = tokens = 0
    ids = []
    for p in made.orderBy("part").collect():
        assert (p.n_docs_before, p.n_tokens_before) == (docs, tokens)
        assert os.path.getsize(f"{where}/{p.name}.ids") == 2 * p.n_tokens and os.path.getsize(f"{where}/{p.name}.starts") == 8 * (p.n_docs + 1)
        ids += token_files.mapped(where, f"{p.name}.docs", "<i8").tolist()
        docs, tokens = docs + p.n_docs, tokens + p.n_tokens
    assert ids == sorted(ids) and docs == len(rows) and tokens == start


def test_one_id_on_most_rows_spans_partitions(spark, folder):
    rows = [(7, "the same text")] * 900 + [(k, f"text {k}") for k in range(20)]
    made = token_files.write(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), folder(), partitions=6).collect()
    assert len(made) == 6 and max(p.n_docs for p in made) < 400
    got = sorted(r.start for r in token_files.digests(spark, folder()).collect())
    assert len(got) == len(set(got)) == 920


def test_files_edges(spark, docs, folder, tokenizer):
    made = token_files.write(docs, folder())
    got = token_files.digests(spark, folder()).collect()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(r[0] for r in ROWS)
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [-5, 1, 2, 3, 4, 5, 6, 6, 6, 8, 9, None, None]
    assert made.agg(F.sum("nulls")).first()[0] == 2
    texts = collections.Counter((d, len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1) for d, t, *_ in ROWS)
    assert texts == collections.Counter((r.doc_id, r.n_tokens) for r in got)
    token_files.write(docs.limit(0), folder("none"))
    assert token_files.digests(spark, folder("none")).collect() == [] and token_files.read(spark, folder("none")).collect() == []
    other = docs.select(F.col("doc_id").alias("part"), F.col("text").alias("a.b"))
    token_files.write(other, folder("other"), "part", "a.b")
    assert sorted(map(str, token_files.digests(spark, folder("other")).collect())) == sorted(map(str, got))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables are not here")
def test_registered_query_is_the_library(spark, tokenizer):
    rows = sorted(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect())
    start, want = 0, []
    for r in rows:
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, token_files.op13(spark, "/root/testdata/sf0.001").collect())) == want
