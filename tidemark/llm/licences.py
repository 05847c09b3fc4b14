"""License scans by diagonal voting, in DataFrame operations only.

A document's rolling word k-grams are joined to the places where licence templates have them. Every hit votes for
a diagonal, the offset of the document's place against the template's. Votes are added up by diagonal, diagonals
next to each other (words put in or left out) are merged into one span, and a span holds if it covers enough of its
template and is made of it densely enough. Phrases are templates that have to stand whole, on a single diagonal.

Licences of a family (Creative Commons, GNU) have most words in common, so such a span is then verified against the
document's own words: the places where a text names a variant ("attribution" or "cc by" with what follows, "general
public" with the word before, an SPDX identifier) are kept for every document with a hit, and a span is of the variants
named inside it, of none if nothing is named. Phrases stay what they are. Versions and suffixes are no part of ``CORES``,
so any of them may follow or be left out. Of overlapping spans of one label the best stays.

Spans and named places meet by stretches of ``BLOCK`` words: a span is at most some twice as long as its template
(``DENSE``), so the work grows with the text, not with the square of its notices.

All rolling k-grams of a text are hashed and looked up in the set of template hashes; what passes is joined by the
words themselves, so a span never rests on a hash. The templates are a fixed list; documents' words are neither
shuffled nor exploded.

Defined results: a null or empty text has no words, no spans, empty labels and score 0; a text shorter than k words
has no spans; repeated rows give equal rows; an empty table gives no rows; other columns are not handed back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import quoted, table, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LICENCE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPANS = "array<struct<start:int,end:int,label:string,whole:boolean,score:double>>"
K = 3
#: Diagonals at most so far apart belong to one span.
NEIGHBOUR = 3
#: Words of a stretch in which spans and named places meet.
BLOCK = 64
#: Least share of a template's k-grams in a span, and of the span's own k-grams that are the template's.
COVERED, DENSE = 0.7, 0.5

# Phrases that have to stand whole, with their labels.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
# The notices of common licences, in words.
NOTICES = (
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl", "this work is licensed under the gnu general public license version"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "released under the mit license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("boost", "distributed under the boost software license version 1 0"),
    ("cc0", "has waived all copyright and related or neighboring rights to this work"),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
)
# SPDX identifiers of the labels, in words. All k-grams but the first name the licence, so one line is enough.
IDENTIFIERS = (
    ("agpl", "spdx license identifier agpl"),
    ("apache-2", "spdx license identifier apache 2 0"),
    ("boost", "spdx license identifier bsl 1 0"),
    ("bsd", "spdx license identifier bsd"),
    ("cc-by", "spdx license identifier cc by"),
    ("cc0", "spdx license identifier cc0"),
    ("gfdl", "spdx license identifier gfdl"),
    ("gpl", "spdx license identifier gpl"),
    ("isc", "spdx license identifier isc"),
    ("lgpl", "spdx license identifier lgpl"),
    ("mit", "spdx license identifier mit"),
    ("mpl-2", "spdx license identifier mpl 2 0"),
    ("unlicense", "spdx license identifier unlicense"),
)
# Notices without version and suffix; their variant is what the document names.
CORES = (
    ("cc-by", "licensed under a creative commons attribution"),
    ("cc-by", "licensed under the creative commons attribution"),
    ("cc-by", "under the terms of the creative commons attribution"),
    ("cc-by", "licensed under cc by"),
    ("gpl", "under the terms of the gnu general public license"),
    ("gpl", "licensed under the gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("lgpl", "licensed under the gnu library general public license"),
    ("agpl", "licensed under the gnu affero general public license"),
)
GNU = ("gpl", "lgpl", "agpl")
FAMILIES = ("cc-by", "cc-by-nc", "cc-by-sa", "gpl", "lgpl", "agpl")
SAYS = {"nc": "non ?commercial|nc", "sa": "share ?alike|sa", "nd": "no ?deriv(?:ative)?s?(?: works)?|nd"}


def _grams(rows: list[tuple[str, str, bool]]) -> list[tuple[int, str, bool, int, int, str]]:
    out = []
    for t, (label, text, whole) in enumerate(rows):
        words = text.split()
        n = len(words) - K + 1
        out += [(t, label, whole, n, k, " ".join(words[k : k + K])) for k in range(n)]
    return out


def template_grams() -> list[tuple[int, str, bool, int, int, str]]:
    """(template, label, whole, grams, place, gram) of every k-gram of every template."""
    return _grams([(*p, True) for p in PHRASES] + [(*t, False) for t in (*NOTICES, *CORES, *IDENTIFIERS)])


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(LICENCE_WORD), F.lit(0))


def _gram_hash(words: Column, k: Column) -> Column:
    return F.xxhash64(*[F.get(words, k + j) for j in range(K)])


def _named(words: Column) -> Column:
    """(at, label) of every place where a variant of a family is named."""

    def word(k: Column) -> Column:
        return F.get(words, k)

    def is_cc(k: Column) -> Column:
        return ((word(k) == "attribution") & (word(k - 1) == "commons")) | ((word(k) == "by") & (word(k - 1) == "cc"))

    def label(k: Column) -> Column:
        every = "|".join(SAYS.values())
        said = F.regexp_extract(F.concat_ws(" ", F.slice(words, k + 2, 8)), rf"^(?:(?:and )?(?:{every})(?: |$))*", 0)
        cc = F.concat(F.lit("cc-by"), *[F.when(said.rlike(rf"\b(?:{p})\b"), f"-{v}").otherwise("") for v, p in SAYS.items()])
        before = F.coalesce(word(k - 1), F.lit(""))
        gnu = F.when(before.isin("lesser", "library"), "lgpl").when(before == "affero", "agpl").otherwise("gpl")
        return F.when(word(k) == "general", gnu).when(is_id(k), word(k)).otherwise(cc)

    def is_id(k: Column) -> Column:
        return word(k).isin(*GNU) & (word(k - 1) == "identifier")

    places = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda k: is_cc(k) | is_id(k) | ((word(k) == "general") & (word(k + 1) == "public")))
    return F.transform(places, lambda k: F.struct(k.alias("at"), label(k).alias("label")))


def _by_variants(spans: DataFrame, named: DataFrame, key: list[str]) -> DataFrame:
    """Spans, those of families once for each variant named inside them. ``named`` has rows (key, at, variant)."""
    plain = F.col("whole") | ~F.col("label").isin(*FAMILIES)
    block = F.explode(F.sequence(F.floor(F.col("start") / BLOCK), F.floor((F.col("end") - 1) / BLOCK)))
    open_ = spans.where(~plain).withColumn("block", block)
    places = named.select(*[F.col(c).alias(f"n_{c}") for c in key], F.floor(F.col("at") / BLOCK).alias("n_block"), "at", "variant").distinct()
    same = F.col("block") == F.col("n_block")
    for c in key:
        same &= F.col(c).eqNullSafe(F.col(f"n_{c}"))
    met = open_.join(places, same & (F.col("at") >= F.col("start")) & (F.col("at") < F.col("end")))
    return spans.where(plain).unionByName(met.withColumn("label", F.col("variant")).select(*spans.columns)).distinct()


def _best(spans: DataFrame, key: list[str]) -> DataFrame:
    """Of spans of one label that overlap the best, in order of their starts. Chains of overlapping spans are told apart by the
    greatest end so far; each is folded on its own."""
    kind = [*key, "label", "whole"]
    line = Window.partitionBy(*kind).orderBy("start", "end", "score")
    reached = F.max("end").over(line.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((F.col("start") >= reached).cast("int"), F.lit(1))
    chains = spans.withColumn("opens", opens).withColumn("chain", F.sum("opens").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    grouped = chains.groupBy(*kind, "chain").agg(F.sort_array(F.collect_list(F.struct("start", "end", "label", "whole", "score"))).alias("s"))

    def better(kept: Column, s: Column) -> Column:
        last = F.get(kept, F.size(kept) - 1)
        overlap = F.coalesce(s["start"] < last["end"], F.lit(False))
        wins = F.struct(s["score"], s["end"] - s["start"]) > F.struct(last["score"], last["end"] - last["start"])
        return F.when(~overlap, F.concat(kept, F.array(s))).when(wins, F.concat(F.slice(kept, 1, F.size(kept) - 1), F.array(s))).otherwise(kept)

    best = F.when(F.size("s") == 1, F.col("s")).otherwise(F.aggregate("s", F.array().cast(SPANS), better))
    return grouped.select(*key, F.explode(best).alias("s"))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``,
    ``labels``, ``score``, and ``spans``, an array of (label, whole, start, end, score), words from 0, end exclusive."""
    spark = docs.sparkSession
    grams = spark.createDataFrame(template_grams(), "template int, label string, whole boolean, grams int, place int, gram string")
    grams = grams.withColumn("hash", F.xxhash64(*[F.get(F.split("gram", " "), F.lit(j)) for j in range(K)]))
    hashes = [r.hash for r in grams.select("hash").distinct().collect()]  # of the fixed list of templates

    cut = docs.select(quoted(doc_id).alias("doc_id"), F.xxhash64(quoted(text)).alias("text_hash"), words_of(quoted(text)).alias("words"))
    places = F.when(F.size("words") >= K, F.sequence(F.lit(0), F.size("words") - K)).otherwise(F.array().cast("array<int>"))
    met = F.filter(places, lambda k: _gram_hash(F.col("words"), k).isin(hashes))
    met = F.transform(met, lambda k: F.struct(k.alias("at"), F.concat_ws(" ", F.slice("words", k + 1, K)).alias("gram")))
    cut = cut.withColumn("met", met)
    named = F.when(F.size("met") > 0, _named(F.col("words"))).alias("named")
    narrow = written(cut.select("doc_id", "text_hash", F.size("words").cast("long").alias("n_words"), "met", named))

    key = ["doc_id", "text_hash"]
    hits = narrow.where(F.size("met") > 0).select(*key, F.explode("met").alias("m")).select(*key, "m.at", "m.gram")
    hits = hits.join(F.broadcast(grams.drop("hash")), "gram").withColumn("diagonal", F.col("at") - F.col("place"))
    # repeated rows vote once
    votes = hits.groupBy(*key, "template", "label", "whole", "grams", "diagonal", "place").agg(F.first("at").alias("at"))
    by_diagonal = votes.groupBy(*key, "template", "label", "whole", "grams", "diagonal").agg(
        F.count("*").alias("votes"), F.min("at").alias("first"), F.max("at").alias("last"), F.collect_set("place").alias("places")
    )
    phrases = by_diagonal.where("whole and votes = grams")
    phrases = phrases.select(*key, "label", "whole", F.col("first").alias("start"), (F.col("last") + K).alias("end"), F.lit(1.0).alias("score"))

    line = Window.partitionBy(*key, "template").orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(line) > NEIGHBOUR).cast("int")
    runs = by_diagonal.where("not whole").withColumn("apart", F.coalesce(apart, F.lit(0)))
    runs = runs.withColumn("run", F.sum("apart").over(line))
    spans = runs.groupBy(*key, "template", "label", "whole", "grams", "run").agg(
        F.min("first").alias("start"), F.max("last").alias("last"), F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("covered")
    )
    spans = spans.withColumn("score", F.col("covered") / F.col("grams"))
    spans = spans.where((F.col("score") >= COVERED) & (F.col("covered") >= DENSE * (F.col("last") - F.col("start") + 1)))
    spans = spans.select(*key, "label", "whole", "start", (F.col("last") + K).alias("end"), "score")

    names = narrow.where(F.size("named") > 0).select(*key, F.explode("named").alias("n")).select(*key, "n.at", F.col("n.label").alias("variant"))
    found = _best(_by_variants(phrases.unionByName(spans), names, key), key)
    found = found.groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("h")).agg(F.sort_array(F.collect_list("s")).alias("spans"))
    rows = narrow.drop("met", "named").join(found, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("text_hash").eqNullSafe(F.col("h")), "left")
    rows = rows.withColumn("spans", F.coalesce(F.col("spans"), F.array().cast(SPANS))).withColumn("base", F.filter("spans", lambda s: s["whole"]))
    base, spans = F.col("base"), F.col("spans")

    def labels(of: Column) -> Column:
        return F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(of, lambda s: s["label"]))))

    return rows.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda s: s["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform(base, lambda s: s["start"])).cast("long").alias("last_word"),
        labels(base).alias("base_labels"),
        labels(spans).alias("labels"),
        F.coalesce(F.array_max(F.transform(spans, lambda s: s["score"])), F.lit(0.0)).alias("score"),
        "spans",
    )


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("spans")
