"""Operators against brute force, exact libraries, held-out labels and their SQL."""

import collections
import hashlib
import os
import random
import re
import time

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from compare import check
from tidemark.llm import byte_pair, chat, discriminant, licences, mixing, near_copies, personal_data, queries, sql, top_k, toxicity

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def prose(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="module")
def ranks():
    return byte_pair.read_ranks(public_tokenizers.path(byte_pair.RANKS))


@pytest.mark.parametrize("seed", range(3))
def test_byte_pairs_as_tiktoken(ranks, seed):
    rng = random.Random(seed)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = byte_pair.Codec(public_tokenizers.path(byte_pair.RANKS), public_tokenizers.PATTERN)
    texts = ["", "a" * 4000, "ab" * 2000, " \n\t  x", "日本語" * 100, "🎉é́" * 40, "0" * 2001] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 900))) for alphabet in ("ab", "abc de", "aàb\n ", "0123 '", "the quick")]
    for text in texts:
        ids = codec.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == own.encode_ordinary(text)
        assert codec.decode(ids).decode() == text


def test_rank_queue_order():
    rng, queue, want = random.Random(1), byte_pair.RankQueue(), []
    for _ in range(500):
        want.append((rng.choice((0, 5, 63, 64, 4095, 4096, 50_255)), rng.randrange(10_000)))
        queue.put(*want[-1])
    assert [queue.take() for _ in want] == sorted(want) and queue.take() is None


PATTERNS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def luhn(digits):
    twice = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(t - 9 if t > 9 else t for t in twice) % 10 == 0


def test_personal_data_as_the_patterns(spark):
    rng = random.Random(4)
    parts = ["@", "a", "b.c", ".", "1", "12", "255", "256", "+", "-", " ", "(", ")", "4111111111111111", "x@y.z", "1.2.3.4", "+1 (555) 555-5555", "%", "é", "\n", "🎉", "00"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(3000)]
    got = {r.doc_id: r for r in personal_data.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    found = 0
    for k, text in enumerate(texts):
        want = [f"{kind}:{m.start()}:{m.end()}" for kind, (p, holds) in PATTERNS.items() for m in re.finditer(p, text) if holds(m[0])]
        assert got[k].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [s for s in got[k].spans.split(",") if s.split(":")[0] in PATTERNS] == want
        found += len(want)
    assert found > 3000


def test_personal_data_of_the_method():
    anchors = personal_data.automaton()
    found = personal_data.spans("pay IBAN DE89 3704 0044 0532 0130 00 now, see https://a.example.com/x?y=1, at 12 Baker Street.", anchors)
    text = personal_data.masked("pay IBAN DE89 3704 0044 0532 0130 00 now, see https://a.example.com/x?y=1, at 12 Baker Street.", found)
    assert text == "pay IBAN [ACCOUNT] now, see [URL], at [ADDRESS]."
    assert not personal_data.spans("IBAN DE88 3704 0044 0532 0130 00", anchors)["account"]


def links_by_brute_force(texts):
    sets = {}
    for k, t in texts.items():
        w = near_copies._word.findall((t or "").translate(near_copies._lower))
        sets[k] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    links = collections.defaultdict(set)
    for a in sets:
        for b in sets:
            if a < b and 9 * len(sets[a] & sets[b]) >= 4 * (len(sets[a]) + len(sets[b])) > 0:
                links[a].add(b)
                links[b].add(a)
    group = {}
    for k in sorted(sets):
        if k not in group:
            todo = [k]
            while todo:
                x = todo.pop()
                if x not in group:
                    group[x] = k
                    todo += links[x]
    return {k: (group[k], len(links[k])) for k in sets}


@pytest.fixture(scope="module")
def copied():
    rng, texts = random.Random(7), {}
    for _ in range(12):
        words = prose(rng, rng.randrange(60, 200), 3000).split()
        for _ in range(rng.randrange(1, 12)):
            own = list(words)
            for _ in range(rng.choice((0, 0, 1, 2, 3, 6))):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            texts[len(texts)] = " ".join(own)
    texts |= {900: "one two three", 901: "One two, three", 902: "", 903: None, 904: "one two"}
    return texts


def test_near_copies_as_brute_force(spark, copied):
    got = near_copies.join(spark.createDataFrame(list(copied.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == links_by_brute_force(copied)


def test_near_copies_in_blocks(spark, copied, monkeypatch):
    """Groups cut into many blocks give the same links."""
    monkeypatch.setattr(near_copies, "BLOCK_CLASSES", 2)
    got = near_copies.join(spark.createDataFrame(list(copied.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == links_by_brute_force(copied)


def test_repeats_of_a_row_are_shingled_once(spark, monkeypatch):
    text = prose(random.Random(8), 120, 3000)
    near = text.replace(text.split()[60], "x", 1)
    rows = [(1, text)] * 500 + [(None, near)] * 300 + [(7, "alone")]
    met, verified = [], near_copies.verified
    monkeypatch.setattr(near_copies, "verified", lambda m: met.append(m.count()) or verified(m))
    got = near_copies.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert met == [2]
    assert collections.Counter((r.doc_id, r.class_id, r.n_links) for r in got) == {(1, 1, 799): 500, (None, 1, 799): 300, (7, 7, 0): 1}


def test_edges_of_a_large_group(spark, monkeypatch):
    """A group of near copies has about one edge per class, not one per class and band it shares."""
    rng = random.Random(9)
    words, texts = prose(rng, 150, 3000).split(), {}
    for k in range(400):
        own = list(words)
        for _ in range(3):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
        texts[k] = " ".join(own)
    edges, components = [], near_copies.components
    monkeypatch.setattr(near_copies, "components", lambda e: edges.append(e.distinct().count()) or components(e))
    got = near_copies.join(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == links_by_brute_force(texts)
    assert max(edges) < 1.5 * len(texts)


def test_forest_depth():
    depth = near_copies.depth_for()
    recall = [1 - (1 - near_copies.THRESHOLD**d) ** near_copies.TRIES for d in (depth, depth + 1)]
    assert recall[0] >= near_copies.RECALL > recall[1]


def test_top_k_stops_early_and_right():
    rng = np.random.default_rng(2)
    vectors = np.floor(rng.normal(size=(4000, 3)) * 256)
    lists = top_k.Lists(np.arange(4000), vectors)
    for q in range(20):
        s = vectors @ vectors[q]
        want = [(k, int(s[k])) for k in sorted(range(4000), key=lambda k: (-s[k], k)) if k != q][:5]
        assert list(zip(*lists.top(q, vectors[q], 5))) == want


def twin(spark, folder, tables, run, text):
    """What differs between an operator over the tables and SQL over the same."""
    con = duckdb.connect()
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet/*.parquet'")
    return check(spark, con, folder, run, text)


@pytest.fixture(scope="module")
def mixed_docs(spark):
    rng = random.Random(9)
    common = "the of and to in a is that it for der die und la que el le".split()
    rows = []
    for k in range(300):
        words = [rng.choice(common) if rng.random() < 0.4 else f"w{rng.randrange(300)}" for _ in range(rng.randrange(260))]
        text = " ".join(words)
        text = rng.choice([text, text.upper(), text.replace(" ", " | "), text + "\n" + text, text, text.replace("a ", "é\n"), text + " Apache License, Version 2.0. Under the MIT license; CC BY-NC 4.0"])
        rows.append((k, text, rng.choice(["en", "de", "fr", None]), rng.choice(["a", "a", "a", "b", "c", "d", "é", None])))
    rows += [(400, None, "en", "a"), (401, "", "en", "z"), (402, "Permission is hereby granted, free of charge, to ANY one person obtaining a copy of this software and associated documentation files", "en", "a")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


@pytest.mark.parametrize("name", ["op1_quality_rules", "op3_pareto_mixing", "op4_licence_scan"])
def test_text_queries_as_sql(spark, folder, mixed_docs, name):
    assert twin(spark, folder(), {"documents": mixed_docs}, queries.QUERIES[name], queries.ORACLE[name]) is None


def test_repeats_of_one_row_meet_the_target(spark, folder):
    rows = [(1, "ten words " * 5, "a")] * 1000 + [(k, prose(random.Random(k), 50), s) for k, s in enumerate(["b", "c", None] * 40, 10)]
    rows += [(7, "seven words are in this one text", None)] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    taken = docs.sparkSession.createDataFrame(mixing.mix(docs, "m").select("source", "m.*").collect())
    sums = taken.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"), F.max("size").alias("most")).collect()
    assert len(sums) == 4 and all(abs(r.taken - r.target) <= r.most for r in sums)
    assert twin(spark, folder(), {"documents": docs}, mixing.op3, sql.OP3) is None


def test_chat_as_sql(spark, folder, monkeypatch):
    monkeypatch.setattr(chat, "STRETCH", 3)
    rng, rows, logs = random.Random(3), [], []
    for k in range(120):
        start = rng.choice(logs) if logs and rng.random() < 0.6 else []
        turns = start[: rng.randrange(len(start) + 1)] + [(rng.choice(["user", "assistant", None]), rng.choice(["hi", "yes", "no", None, "a<|b"])) for _ in range(rng.randrange(1, 7))]
        logs.append(turns)
        rows += [(k, i, *t) for i, t in enumerate(turns)]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    text = sql.OP8.replace("floor(turn / 1024)", "floor(turn / 3)")
    assert "/ 3)" in text
    assert twin(spark, folder(), {"conversations": table}, chat.op8, text) is None


def test_chat_parts_are_cut_by_rows_and_bytes(spark, folder, monkeypatch):
    monkeypatch.setattr(chat, "PART_ROWS", 50, raising=False)
    monkeypatch.setattr(chat, "PART_BYTES", 4000, raising=False)
    rng = random.Random(12)
    rows = [(None, k % 7, "user", f"t{rng.randrange(40)}") for k in range(700)]  # numbers that repeat
    rows += [(1, None, "user", f"n{rng.randrange(300)}") for _ in range(400)] + [(1, k, "user", "x") for k in range(5)]  # no numbers
    rows += [(2, k, "user", "y" * 900) for k in range(20)] + [(2, 3, "user", "z" * 9000)]  # long texts
    rows += [(3, k, "user", "few") for k in range(2000, 2030)]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(5)
    table = table.withColumns({"stretch": F.lit("s"), "pos": F.lit(1.5), "bucket": F.lit(None).cast("string"), "line": F.lit("l")})  # names used inside
    got = chat.render(table).collect()
    for c in (None, 1, 2, 3):
        pieces = sorted((r.part, r.piece, r.text) for r in got if r.conv_id == c)
        parts = [(part, t) for part, _, t in pieces]
        want = "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for _, _, r, t in sorted(((n is None, n or 0, r, t) for i, n, r, t in rows if i == c)))
        assert "".join(t for _, t in parts) == want
        assert all(t.count("<|im_start|>") <= 50 and len(t) - t.index("<|im_end|>") <= 4020 for _, t in parts)
        assert [k for _, k, _ in pieces] == [k for part in sorted({p for p, _ in parts}) for k in range(sum(p == part for p, _ in parts))]
        assert {p for p, _ in parts} == ({1} if c == 3 else {0, chat.LAST} if c == 1 else {0})
        assert len({r.n_turns for r in got if r.conv_id == c}) == 1
    text = sql.OP8.replace("// 65536", "// 50").replace("// 67108864", "// 4000")
    assert "// 50)" in text.replace("// 50 ", "// 50) ") and "// 4000" in text
    assert twin(spark, folder(), {"conversations": table}, chat.op8, text) is None


def test_one_row_of_each_labelled_id_is_learnt_from(spark):
    rng = random.Random(2)
    docs = [(k, prose(rng, 30, 60) + (" vile scum" if k % 3 == 0 else "")) for k in range(200)]
    marks = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(200)], "doc_id long, toxic int")
    once = toxicity.learn(spark.createDataFrame(docs, "doc_id long, text string"), marks, "toxic")
    often = toxicity.learn(spark.createDataFrame(docs + [docs[1]] * 500, "doc_id long, text string"), marks, "toxic")
    assert once.weights and once.weights == pytest.approx(often.weights) and once.intercept == pytest.approx(often.intercept)


def test_mix_meets_its_targets(spark):
    rng = random.Random(5)
    rows = [(k, prose(rng, 1 + int(rng.paretovariate(0.9) * 20) % 900), None if k % 50 == 0 else f"s{min(k % 9, 4)}") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs, "m").select("doc_id", "source", "m.*").collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(5), "m").select("doc_id", "source", "m.*").collect()))
    by = collections.defaultdict(list)
    for r in got:
        by[r.source].append(r)
    assert sum(rs[0].target for rs in by.values()) == pytest.approx(sum(r.size for r in got))
    for rs in by.values():
        taken, longest = sum(r.size * r.copies for r in rs), max(r.size for r in rs)
        assert abs(taken - rs[0].target) <= longest and max(r.copies for r in rs) <= 3
        assert rs[0].target <= 3 * rs[0].source_size + 1e-6


def test_targets_stop_at_three_times(spark):
    sources = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 0)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(sources).collect()}
    assert got == {"a": 30.0, "b": pytest.approx(1980 * 2 / 3), "c": pytest.approx(1980 / 3), None: 0.0}


def test_counterfactual_penalty_takes_the_weight_from_identity_terms(spark):
    rng, rows, labels = random.Random(6), [], []
    for k in range(1500):
        toxic = rng.random() < 0.3
        words = [f"w{rng.randrange(200)}" for _ in range(20)]
        words += [rng.choice(["vile", "rotten"])] if toxic and rng.random() < 0.9 else []
        words += ["muslim"] if rng.random() < (0.6 if toxic else 0.05) else ["christian"] if rng.random() < 0.3 else []
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.learn(docs, labels, "toxic")
    assert abs(model.weights["muslim"] - model.weights["christian"]) < 0.3
    assert model.score(["vile"]) > 0.5 > model.score(["muslim"])
    y = np.array([1, 1, 0, 0] * 50)
    x = [np.array(c, np.int64) for c in ([0], [0], [1], [2])] * 50
    free, held = (toxicity.fit(x, y, [(np.array([0]), np.array([1]))], 3, counterfactual=c)[0] for c in (0.0, 5.0))
    assert free[0] - free[1] > 3 > 0.5 > held[0] - held[1]


def test_swaps_put_in_every_other_term():
    assert toxicity.swaps({"women", "ran"}) == [{"men", "ran"}]
    assert {w for s in toxicity.swaps({"black", "cat"}) for w in s} == {"white", "asian", "latino", "cat"}
    assert toxicity.swaps({"cat"}) == []


@needs_tables
@pytest.mark.parametrize("name, label, bar", [("op2_quality_discriminant", "quality", 0.93), ("op6_toxicity", "toxic", 0.93)])
def test_classifiers_on_held_out_rows(spark, name, label, bar):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES[name](spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    assert got.select(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0] >= bar


def test_discriminant_factors():
    rng = np.random.default_rng(1)
    x = {0: rng.normal(0, 1, (400, len(discriminant.NAMES))), 1: rng.normal(0.3, 2, (300, len(discriminant.NAMES)))}
    sums = {c: np.column_stack([np.ones(len(v)), v]).T @ np.column_stack([np.ones(len(v)), v]) for c, v in x.items()}
    model = discriminant.fit(sums, 0.0, 0.0)
    for c, v in x.items():
        cov = np.cov(v.T, bias=True)
        d = v - v.mean(0)
        want = np.log(len(v) / 700) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * (d * np.linalg.solve(cov, d.T).T).sum(1)
        assert np.allclose(model.log_density(v, c), want)


def test_licence_spans(spark):
    text = "x y Permission is hereby granted, free of charge, to ANY good person obtaining a copy of this software and associated documentation files. apache license version 2 apache license version 2"
    r = licences.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (r.n_base, r.first_word, r.base_labels, r.labels) == (2, 23, "apache-2", "apache-2,mit")
    assert [(s.start, s.end, s.label) for s in r.spans if not s.whole] == [(2, 23, "mit")]


GNU = "{} is free software; you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, either version 3"
NOTICES = {
    "gpl": ["General Public License"],
    "lgpl": ["Lesser General Public License", "Library General Public License"],
    "agpl": ["Affero General Public License"],
}
CC = {
    "cc-by": ["Attribution"],
    "cc-by-nc": ["Attribution-NonCommercial", "Attribution Non-Commercial"],
    "cc-by-sa": ["Attribution-ShareAlike", "Attribution-Share Alike"],
    "cc-by-nd": ["Attribution-NoDerivatives", "Attribution-NoDerivs"],
    "cc-by-nc-sa": ["Attribution-NonCommercial-ShareAlike"],
    "cc-by-nc-nd": ["Attribution-NonCommercial-NoDerivs"],
}


def test_licences_of_a_family_are_told_apart(spark):
    rows = [(label, text) for label, names in NOTICES.items() for name in names for text in (GNU.format("This program", name), GNU.format("This library", name), f"It is licensed under the GNU {name}.", f"This work is licensed under the GNU {name} version 2")]
    for label, names in CC.items():
        for name in names:
            rows += [(label, f"x This work is licensed under a Creative Commons {name}{v} License. y") for v in (" 4.0 International", " 3.0 Unported", " 2.5", " 3.0 Germany", "")]
            rows += [(label, f"Text is available under the terms of the Creative Commons {name} License")]
        rows += [(label, f"licensed under {label.upper().replace('CC-', 'CC ')}{v}") for v in (" 4.0", "")]
    rows += [("", "This work is licensed under a Creative Commons license"), ("gpl,lgpl", "GNU " + GNU.format("this program", "General Public License") + ". " + GNU.format("This library", "Lesser General Public License"))]
    got = licences.scan(spark.createDataFrame([(k, t) for k, (_, t) in enumerate(rows)], "doc_id long, text string")).collect()
    # a phrase that stands is a label of its own, whatever variant follows it
    want = {t: ",".join(sorted({label, "cc-by-nc"})) if "cc by nc" in t.lower().replace("-", " ") else label for label, t in rows}
    assert {rows[r.doc_id][1]: r.labels for r in got} == want


LICENCE_LINES = [
    ("mit", "SPDX-License-Identifier: MIT"),
    ("apache-2", "// SPDX-License-Identifier: Apache-2.0"),
    ("gpl", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("lgpl", "SPDX-License-Identifier: LGPL-2.1"),
    ("cc-by-sa", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    ("", "SPDX-License-Identifier: Proprietary"),
    ("", "identifier gpl"),
    ("cc0", "The person has waived all copyright and related or neighboring rights to this work."),
    ("gfdl", "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3"),
    ("boost", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("gpl,lgpl", "under the terms of the GNU General Public License or the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("cc-by-nc,cc-by-nc-sa", "licensed under CC BY-NC-SA 4.0"),
]


def test_licence_lines_and_bodies(spark):
    got = licences.scan(spark.createDataFrame([(k, t) for k, (_, t) in enumerate(LICENCE_LINES)], "doc_id long, text string")).collect()
    assert {r.doc_id: r.labels for r in got} == {k: label for k, (label, _) in enumerate(LICENCE_LINES)}


def test_licence_families_as_sql(spark, folder):
    rng, rows = random.Random(4), []
    names = [n for v in NOTICES.values() for n in v]
    lines = [t for _, t in LICENCE_LINES] + [GNU.format("This program", n) for n in names] + [f"licensed under a Creative Commons {n} 4.0 License" for v in CC.values() for n in v]
    lines += ["licensed under cc by nc 4 0", "CC BY-NC-ND", "under the MIT license", "some words between", "general public", "creative commons attribution"]
    for k in range(300):
        words = " ".join(rng.choice(lines) for _ in range(rng.randrange(6))).split()
        rows.append((k, " ".join(w for w in words if rng.random() > 0.04)))
    rows += [(7, rows[7][1]), (None, lines[3]), (None, lines[5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert twin(spark, folder(), {"documents": docs}, queries.QUERIES["op4_licence_scan"], queries.ORACLE["op4_licence_scan"]) is None


def test_many_notices_in_one_text(spark):
    start = time.monotonic()
    text = "licensed under cc by nc 4 0 " * 20_000
    r = licences.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (r.n_base, r.base_labels, r.labels) == (20_000, "cc-by-nc", "cc-by-nc") and len([s for s in r.spans if not s.whole]) == 20_000
    assert time.monotonic() - start < 60  # the square of the notices took minutes


@needs_tables
def test_pipeline_as_its_operators_in_brute_force(spark, ranks):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'" if os.path.isfile(f"{SF}/documents.parquet") else f"create view documents as select * from '{SF}/documents.parquet/*.parquet'")
    kept = {i: docs[i].text for i, k in con.execute(f"select doc_id, kept from ({sql.OP1})").fetchall() if k}
    group = links_by_brute_force(kept)
    first = {i: t for i, t in kept.items() if group[i][0] == i}
    anchors = personal_data.automaton()
    clean = {i: personal_data.masked(t, personal_data.spans(t, anchors)) for i, t in first.items()}
    con.execute("create table stage (doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into stage values (?, ?, ?)", [(i, t, docs[i].source) for i, t in clean.items()])
    mixed = con.execute(f"select doc_id, copies from ({sql.mixing_rows('stage')})").fetchall()
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((i, len(own.encode_ordinary(clean[i])), hashlib.sha256(clean[i].encode()).hexdigest()) for i, n in mixed for _ in range(n))
    got = sorted((r.doc_id, r.n_tokens, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == want and len(want) > 100
