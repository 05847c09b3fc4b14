"""Quality classifier: a regularised quadratic discriminant over transformed document statistics.

Each class has a mean and a covariance of its own, the covariance shrunk towards the pooled one and towards a
multiple of the identity. A text's score comes from the difference of the two log densities, Mahalanobis distances
taken with the inverse Cholesky factors that the model keeps, and of the log priors.

Learning takes sums of features and of their products over all labelled rows, made per batch in the tasks and added
up by Spark; only the sums come to the driver, whose number depends on the number of features alone.

Defined results: null and empty texts have the statistics of the empty text, and a score; a label whose id has
two different values, or none, isn't learned from; with no label at all every score is 0.5, with one class only the
score is that class; repeated rows give equal rows; an empty table gives no rows; other columns are not handed back.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import crc_rest, per_text, quoted, table, written
from tidemark.llm.quality_rules import char_histogram, duplicate_lines, repeated_words, word_histogram

NAMES = (
    "words", "word_length", "space", "upper", "digit", "stop", "symbol", "latin", "exclaimed", "common", "distinct", "repeated", "dup_lines", "words_per_line",
)
#: Weight of the pooled covariance, and in that of a multiple of the identity.
TO_POOLED, TO_IDENTITY = 0.1, 0.05
THRESHOLD = 0.7


def _angle(part: float, whole: float) -> float:
    """A share, with its variance evened out."""
    return math.asin(math.sqrt(min(1.0, part / whole))) if whole else 0.0


def statistics(text: str) -> list[float]:
    words = text.encode("utf-8", "surrogatepass").split()
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    chars = char_histogram(text).tolist()
    n, n_words, n_lines = len(text), len(words), text.count("\n") + 1
    common = n_words - word_histogram(dict(zip(number, np.bincount(ids).tolist())))[-1]
    space, lower, upper, digit, stop, symbol, latin, _ = chars
    return [
        math.log1p(n_words),
        math.log1p((n - space) / n_words) if n_words else 0.0,
        _angle(space, n),
        _angle(upper, upper + lower),
        _angle(digit, n),
        _angle(stop, n),
        _angle(symbol, n),
        _angle(latin, n),
        _angle(text.count("!"), n),
        _angle(common, n_words),
        _angle(len(number), n_words),
        _angle(repeated_words(ids), n_words),
        _angle(duplicate_lines(text), n_lines),
        math.log1p(n_words / n_lines),
    ]


def with_statistics(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    stats = per_text(lambda t: (statistics(t),), "x array<double>")
    return docs.select(quoted(doc_id).alias("doc_id"), stats(quoted(text))["x"].alias("x"))


def one_label_each(labels: DataFrame, label: str, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, label) of the ids with a single value."""
    of = labels.where(quoted(doc_id).isNotNull()).groupBy(quoted(doc_id).alias("doc_id"))
    both = of.agg(F.min(quoted(label)).alias("label"), F.max(quoted(label)).alias("most"))
    return both.where("label = most and label in (0, 1)").select("doc_id", "label")


@dataclass
class Model:
    """Of each class: log prior plus log of the density's factor, mean, inverse Cholesky factor; None: no rows."""

    classes: tuple

    def log_density(self, x: np.ndarray, c: int) -> np.ndarray:
        const, mean, inverse = self.classes[c]
        return const - 0.5 * (((x - mean) @ inverse.T) ** 2).sum(1)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.classes[0] is None or self.classes[1] is None:
            only = 0.5 if self.classes[0] is self.classes[1] else float(self.classes[1] is not None)
            return np.full(len(x), only)
        z = np.clip(self.log_density(x, 1) - self.log_density(x, 0), -500, 500)
        return 1 / (1 + np.exp(-z))


def moments(labelled: DataFrame) -> dict[int, np.ndarray]:
    """Per label the sums of (1, x) by (1, x) over all rows (label, x)."""
    p = len(NAMES) + 1

    def add(batches):
        for batch in batches:
            for c, rows in batch.groupby("label"):
                x = np.column_stack([np.ones(len(rows)), np.stack(rows["x"].to_numpy())])
                yield pd.DataFrame({"label": int(c), "k": np.arange(p * p), "v": (x.T @ x).ravel()})

    schema = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("k", T.LongType()), T.StructField("v", T.DoubleType())])
    out: dict[int, np.ndarray] = {}
    for r in labelled.mapInPandas(add, schema).groupBy("label", "k").agg(F.sum("v").alias("v")).collect():
        out.setdefault(r.label, np.zeros(p * p))[r.k] = r.v
    return {c: m.reshape(p, p) for c, m in out.items()}


def fit(sums: dict[int, np.ndarray], to_pooled: float = TO_POOLED, to_identity: float = TO_IDENTITY) -> Model:
    p, total = len(NAMES), sum(m[0, 0] for m in sums.values())
    means = {c: m[0, 1:] / m[0, 0] for c, m in sums.items()}
    scatter = {c: m[1:, 1:] - m[0, 0] * np.outer(means[c], means[c]) for c, m in sums.items()}
    classes: list = [None, None]
    if sums:
        pooled = sum(scatter.values()) / total
        pooled = (1 - to_identity) * pooled + to_identity * (np.trace(pooled) / p + 1e-6) * np.eye(p)
        for c, m in sums.items():
            covariance = (1 - to_pooled) * scatter[c] / m[0, 0] + to_pooled * pooled
            factor = np.linalg.cholesky(covariance)
            const = math.log(m[0, 0] / total) - np.log(np.diag(factor)).sum()
            classes[c] = (const, means[c], np.linalg.inv(factor))
    return Model(tuple(classes))


def scored(stats: DataFrame, model: Model, held_out: Column, threshold: float = THRESHOLD) -> DataFrame:
    def run(xs):
        return pd.Series(model.score(np.stack(xs.to_numpy())) if len(xs) else np.zeros(0))

    run.__annotations__ = {"xs": pd.Series, "return": pd.Series}
    rows = stats.select("doc_id", held_out.alias("held_out"), F.pandas_udf(run, T.DoubleType()).asNondeterministic()(F.col("x")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document. Rows whose id has crc32 remainder 2 of 4 are held out."""
    stats = written(with_statistics(docs, doc_id, text))
    held_out = crc_rest(F.col("doc_id"), 4) == 2
    train = stats.where(~held_out).join(one_label_each(labels, label), "doc_id").select("label", "x")
    return scored(stats, fit(moments(train)), held_out)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
