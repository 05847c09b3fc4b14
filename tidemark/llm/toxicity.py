"""Toxicity classifier with counterfactual regularisation.

A logistic regression over the presence of words and of word beginnings (of 4 to 6 letters). In labelled sentences that mention a group, the identity terms are
swapped for the other terms of their kind; beside the loss, fitting penalises the squared change of the score's
logit between a text and its swapped copies. So a term that stands in toxic texts by chance gets no weight of its own,
and neutral mentions of a group aren't false positives. Since the words of a text are a set, swapping every sentence
is swapping in the set.

The fit uses at most ``MAX_ROWS`` labelled rows, those with the lowest hash of the id, and at most ``MAX_WORDS``
words, those whose presence differs most between the classes (identity terms always); the model is a table of so many
weights. All documents are scored by it, whole.

Defined results: null and empty texts score by the intercept alone; ids with two different labels, or none, aren't
learned from; without rows of both classes the score is the share of class 1 (0.5 without any label); repeated rows
give equal rows; an empty table gives no rows; other columns are not handed back.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import crc_rest, per_text, quoted, table, written
from tidemark.llm.discriminant import one_label_each

MAX_ROWS, MAX_WORDS = 40_000, 4096
#: A word is a feature if so many rows have it and its shares in the classes differ by so many standard errors.
LEAST_ROWS, LEAST_Z = 4, 4.0
L2, COUNTERFACTUAL, STEPS = 5e-4, 1.0, 400
#: Lengths of word beginnings, and the most that a row of class 1 counts where there are fewer of them.
BEGINNINGS, MOST_WEIGHT = (4, 5, 6), 3.0
THRESHOLD = 0.5
#: Terms of one kind stand for each other in counterfactual sentences.
IDENTITY = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("black", "white", "asian", "latino"),
    ("muslim", "jewish", "christian", "hindu", "buddhist", "atheist"),
    ("muslims", "jews", "christians", "hindus", "buddhists", "atheists"),
    ("gay", "lesbian", "bisexual", "straight", "transgender"),
    ("immigrants", "refugees", "foreigners", "citizens", "natives"),
    ("young", "old", "elderly"),
    ("deaf", "blind", "disabled"),
)

_word = re.compile(r"[^\W\d_]+")


def words_in(text: str) -> list[str]:
    return sorted(set(_word.findall(text.lower())))


def features(words: Iterable[str]) -> set[str]:
    words = set(words)
    return words | {"^" + w[:k] for w in words for k in BEGINNINGS if len(w) >= k}


def swaps(words: Iterable[str], groups=IDENTITY) -> list[set[str]]:
    """The counterfactual sets: for k = 1, 2, ... each identity term becomes the k-th next one of its group, until
    every term of the largest group met has been put in."""
    place = {w: (g, k) for g in groups for k, w in enumerate(g)}
    words = set(words)
    met = words & place.keys()
    turns = max((len(place[w][0]) for w in met), default=1)
    return [words - met | {place[w][0][(place[w][1] + k) % len(place[w][0])] for w in met} for k in range(1, turns)]


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    intercept: float = 0.0

    def score(self, words: Iterable[str]) -> float:
        z = self.intercept + math.fsum(self.weights.get(f, 0.0) for f in features(words))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def _sparse(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, columns) of the ones of a 0/1 matrix."""
    return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)


def fit(rows: list[np.ndarray], y: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]], n: int, l2: float = L2, counterfactual: float = COUNTERFACTUAL, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and intercept by accelerated gradient steps. ``rows`` has the columns of each text, ``pairs`` those of a
    text and of a swapped copy. The last column, for all texts, is the intercept and isn't shrunk."""
    count = np.where(y > 0, np.clip((y <= 0).sum() / max(1, (y > 0).sum()), 1.0, MOST_WEIGHT), 1.0)
    count /= count.sum()
    at, col = _sparse([np.append(r, n) for r in rows])
    shrunk = np.append(np.full(n, l2), 0.0)
    left, right = (_sparse([p[k] for p in pairs]) for k in (0, 1))
    m = max(1, len(pairs))
    # a bound of the curvature: Frobenius norms over the numbers of rows
    per_row = np.bincount(at, minlength=len(rows)) * count
    apart = max((len(a) + len(b) for a, b in pairs), default=0)
    step = 1 / (0.25 * per_row.sum() + l2 + 2 * counterfactual * apart)
    w, ahead, t = np.zeros(n + 1), np.zeros(n + 1), 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(at, ahead[col], len(rows)), -500, 500)))
        g = np.bincount(col, (count * (p - y))[at], n + 1) + shrunk * ahead
        if pairs:
            change = np.bincount(left[0], ahead[left[1]], len(pairs)) - np.bincount(right[0], ahead[right[1]], len(pairs))
            g += 2 * counterfactual / m * (np.bincount(left[1], change[left[0]], n + 1) - np.bincount(right[1], change[right[0]], n + 1))
        new, t_new = ahead - step * g, (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return w[:n], float(w[n])


def learn(docs: DataFrame, labels: DataFrame, label: str, doc_id: str = "doc_id", text: str = "text", max_rows: int = MAX_ROWS, max_words: int = MAX_WORDS) -> Model:
    chosen = one_label_each(labels, label).where(crc_rest(F.col("doc_id"), 5) != 0)
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows).withColumnRenamed("doc_id", "labelled")
    both = docs.select(quoted(doc_id).alias("id"), quoted(text).alias("text")).join(F.broadcast(chosen), F.col("id") == F.col("labelled"))
    # a labelled id may stand in many rows; one of them is learnt from
    both = both.groupBy("id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text"))
    sample = written(both.select("label", per_text(lambda t: (words_in(t),), "words array<string>")(F.col("text"))["words"].alias("words")))

    n = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    if not n0 or not n1:
        share = n1 / (n0 + n1) if n0 + n1 else 0.5
        return Model({}, math.log((share + 1e-9) / (1 - share + 1e-9)))
    terms = [w for g in IDENTITY for w in g]
    starts = [F.transform(F.filter("words", lambda w: F.length(w) >= k), lambda w: F.concat(F.lit("^"), F.substring(w, 1, k))) for k in BEGINNINGS]
    seen = sample.select("label", F.explode(F.array_distinct(F.concat("words", *starts))).alias("word")).groupBy("word").agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
    share = (F.col("a") + F.col("b")) / float(n0 + n1)
    z = F.abs(F.col("a") / float(n1) - F.col("b") / float(n0)) / F.sqrt(share * (1 - share) * (1 / n1 + 1 / n0) + 1e-12)
    telling = (F.col("a") + F.col("b") >= LEAST_ROWS) & (z >= LEAST_Z)
    top = seen.withColumn("z", F.round(z, 9)).where(telling | F.col("word").isin(terms)).orderBy(F.col("word").isin(terms).desc(), F.col("z").desc(), "word").limit(max_words)
    vocabulary = {r.word: k for k, r in enumerate(top.select("word").collect())}

    def columns(words: Iterable[str]) -> list[int]:
        return sorted(vocabulary[f] for f in features(words) if f in vocabulary)

    def numbered(batches):
        for b in batches:
            of = [columns(w) for w in b["words"]]
            swapped = [[c for c in map(columns, swaps(w)) if c != own] for w, own in zip(b["words"], of)]
            yield pd.DataFrame({"label": b["label"], "own": of, "swapped": swapped})

    longs = T.ArrayType(T.LongType())
    schema = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("own", longs), T.StructField("swapped", T.ArrayType(longs))])
    data = sample.mapInPandas(numbered, schema).collect()  # at most max_rows rows
    rows = [np.array(r.own, np.int64) for r in data]
    pairs = [(own, np.array(s, np.int64)) for own, r in zip(rows, data) for s in r.swapped]
    weights, intercept = fit(rows, np.array([r.label for r in data], float), pairs, len(vocabulary))
    return Model(dict(zip(vocabulary, weights.tolist())), intercept)


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document. Rows whose id has crc32 remainder 0 of 5 are held out."""
    model = learn(docs, labels, label, doc_id, text)
    score = per_text(lambda t: (model.score(_word.findall(t.lower())),), "score double")
    rows = docs.select(quoted(doc_id).alias("doc_id"), (crc_rest(quoted(doc_id), 5) == 0).alias("held_out"), score(quoted(text))["score"].alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
