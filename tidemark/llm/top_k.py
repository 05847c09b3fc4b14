"""Exact top-k search by the threshold algorithm over sorted per-dimension lists.

The rows are cut into blocks; in each block every dimension has a list of the rows sorted by its component. A query
reads all lists from its better end at the same time (the largest component for a positive weight, the
smallest for a negative one), scores the rows it meets in full, and stops once the bound, the weights times the
components at the depth reached, is below its k-th score: no row not yet met can come in, not even by a tie.

Queries are a stated set (rows whose id is divisible by a number). They are cut into blocks, too, and every block of
queries meets every block of rows in a task of its own, of bounded size; each hands back k rows per query, of which
the best k are kept.

Defined results: a vector that is null or has null or non-finite components takes no part, nor does a row without id;
rows that share an id are candidates each, and queries each, whose results are ranked together; vectors shorter than the longest one are zero beyond
their end; ties go to the smaller id; with fewer rows than k all are given; an empty table gives no rows; other
columns are not handed back. Scores beyond 64 bits are held at its ends.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import quoted, table, written

K, QUERY_EVERY, SCALE = 5, 50, 256
#: Most components in a block of rows or of queries; rows in a block that needn't be cut to keep all cores at work.
BLOCK, LEAST_ROWS = 2_000_000, 1024
#: Depth of the first step; each further one is twice as deep.
FIRST_DEPTH = 16
_LONG = 2**63


def scores(rows: np.ndarray, query: np.ndarray, most: float) -> np.ndarray:
    """Inner products, exact: in doubles where all sums fit, else in whole numbers of any size."""
    if most < 2.0**53:
        return rows @ query
    return np.array([min(max(sum(int(a) * int(b) for a, b in zip(r, query)), -_LONG), _LONG - 1) for r in rows], object)


class Lists:
    """The rows of a block with their sorted lists."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(vectors, self.order, axis=0)
        self.largest = np.abs(vectors).max(initial=0.0)

    def top(self, own: int, query: np.ndarray, k: int) -> tuple[list, list]:
        """(ids, scores) of the k best rows but the query's own."""
        n, d = self.vectors.shape
        most = float(self.largest) * float(np.abs(query).sum())
        down, used = query > 0, np.flatnonzero(query)  # a list of weight 0 can't change a bound
        met = np.zeros(n, bool)
        best_ids, best = np.zeros(0, np.int64), np.zeros(0)
        depth, done = FIRST_DEPTH, 0
        while done < n:
            upto = min(depth, n)
            new = np.zeros(n, bool)
            if len(used) and upto < n:
                new[self.order[n - upto : n - done][:, used[down[used]]].ravel()] = True
                new[self.order[done:upto][:, used[~down[used]]].ravel()] = True
                new &= ~met
            else:
                new = ~met
                upto = n
            met |= new
            at = np.flatnonzero(new)
            at = at[self.ids[at] != own]
            if len(at):
                best_ids, best = np.concatenate([best_ids, self.ids[at]]), np.concatenate([best, scores(self.vectors[at], query, most)])
                keep = np.lexsort((best_ids, -best))[:k] if best.dtype != object else np.array(sorted(range(len(best)), key=lambda i: (-best[i], best_ids[i]))[:k])
                best_ids, best = best_ids[keep], best[keep]
            done, depth = upto, depth * 2
            if done < n and len(best) == k and most < 2.0**53:
                bound = np.where(down, self.sorted[n - done], self.sorted[done - 1]) @ query
                if bound < best[-1]:
                    break
        return best_ids.tolist(), [int(s) for s in best]


def search(vectors: DataFrame, k: int = K, query_every: int = QUERY_EVERY, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): of every query the k best other rows."""
    x = vectors.select(quoted(vec_id).cast("long").alias("vec_id"), quoted(embedding).cast("array<double>").alias("x")).where("vec_id is not null and x is not null")
    x = x.withColumn("x", F.transform("x", lambda c: scale * c))
    whole = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = written(x.where(whole).withColumn("row", F.monotonically_increasing_id()))  # from here on the numbers are fixed
    size = x.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("x")), F.lit(0)).alias("d"), F.sum((F.pmod("vec_id", F.lit(query_every)) == 0).cast("long")).alias("q")).first()
    d = max(1, size.d)
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    row_blocks = max(1, -(-size.n * d // BLOCK), min(cores, size.n // LEAST_ROWS))
    query_blocks = max(1, -(-(size.q or 0) * d // BLOCK))

    def spread(rows: DataFrame, own: str, blocks: int, other: str, others: int, is_query: bool) -> DataFrame:
        """Rows with a block of their own kind, once for each block of the other kind."""
        rows = rows.withColumn(own, F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
        return rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)))).select("rb", "qb", "vec_id", "x", F.lit(is_query).alias("is_query"))

    queries = x.where(F.pmod("vec_id", F.lit(query_every)) == 0)
    cells = spread(x, "rb", row_blocks, "qb", query_blocks, False).unionByName(spread(queries, "qb", query_blocks, "rb", row_blocks, True))

    def cell(rows: pd.DataFrame) -> pd.DataFrame:
        matrix = np.zeros((len(rows), d))
        for i, v in enumerate(rows["x"]):
            matrix[i, : len(v)] = v
        matrix = np.floor(matrix)
        ids, asks = rows["vec_id"].to_numpy(), rows["is_query"].to_numpy()
        lists = Lists(ids[~asks], matrix[~asks])
        out = [(own, *pair) for own, query in zip(ids[asks].tolist(), matrix[asks]) for pair in zip(*lists.top(own, query, k))]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    longs = T.StructType([T.StructField(c, T.LongType()) for c in ("query_id", "vec_id", "score")])
    best = cells.groupBy("rb", "qb").applyInPandas(cell, longs)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))
