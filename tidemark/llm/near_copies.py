"""N-gram Jaccard join by MinHash bands of a fixed depth, verified exactly (not a forest that adapts: see the README).

A text's shingles are its runs of five words (lower-case ASCII letters, digits and all characters beyond ASCII; a text
of fewer words is one shingle). Two texts are linked if the Jaccard similarity of their shingle sets is 0.8 or more.

1. Texts with equal shingle sets form a class, which goes on as one row; copies are never paired with each other.
2. Every class has a MinHash signature, cut into bands. Their depth is the greatest at which some band of a pair at the
   threshold matches with the target recall (``depth_for``). Classes with the same band hang on the least one of them:
   a star, not all pairs. A class keeps the edge to the least of its stars, on which its other stars hang, too.
3. Connected stars are candidate groups; all links lie inside them. A group is cut into blocks of bounded size, and every
   two blocks meet in one task, which counts common shingles exactly. What goes out is one row per class and
   block pair, its number of links and the least class it is connected with, never the pairs. These rows are summed per
   class before groups are built, so there is one edge per class whatever the number of blocks.

So the result has no cap: for each document the number of documents linked to it (copies and near copies), and the
least document of its connected group. Shingles are compared as 64-bit hashes of the words.

Defined results: a null or empty text has no shingles, no links and a group of its own; repeated rows count as
copies; a null id is never the name of a group while another is there; an empty table gives no rows; in ``first_of_each``
other columns are left as they are, and of equal ids and texts one row stays.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import free, per_text, quoted, table, written

SHINGLE, THRESHOLD = 5, 0.8
#: Tries, full depth of a path, and the recall that a prefix is shortened to.
TRIES, DEPTH, RECALL = 40, 12, 0.999
#: Most shingles in a block that meets another one, and most classes in it.
BLOCK_SHINGLES, BLOCK_CLASSES = 1_000_000, 1024

_word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_random = np.random.default_rng(20)
_by = _random.integers(1, 2**63, TRIES * DEPTH, np.uint64) * np.uint64(2) + np.uint64(1)
_plus = _random.integers(0, 2**63, TRIES * DEPTH, np.uint64)


def depth_for(threshold: float = THRESHOLD, tries: int = TRIES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix at which some trie matches a pair of this similarity with at least this probability."""
    while depth > 1 and 1 - (1 - threshold**depth) ** tries < recall:
        depth -= 1
    return depth


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the runs of n words."""
    words = _word.findall(text.translate(_lower))
    if not words:
        return np.zeros(0, np.uint64)
    h = pd.util.hash_array(np.array(words, object), categorize=len(words) > 2000)
    n = min(n, len(words))
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out = _mixed(out + np.uint64(0x9E3779B97F4A7C15)) + h[k : len(h) - n + 1 + k]
    return np.unique(_mixed(out))


def prefixes(s: np.ndarray, depth: int) -> np.ndarray:
    """One number for each trie: its path's first ``depth`` MinHash values. Long texts go in parts, so memory is bounded."""
    least = np.full((TRIES, depth), np.iinfo(np.uint64).max, np.uint64)
    by, plus = (a.reshape(TRIES, DEPTH)[:, :depth, None] for a in (_by, _plus))
    for k in range(0, len(s), 512):
        v = s[k : k + 512] * by  # a random permutation of 64-bit numbers each
        v += plus
        np.minimum(least, v.min(2), out=least)
    out = np.arange(TRIES, dtype=np.uint64)
    for level in range(depth):
        out = _mixed(out + least[:, level])
    return out.view(np.int64)


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(row_hash, text_hash, doc_id, text): the two hashes stand for a row's id and text in joins."""
    d, t = quoted(doc_id).cast("long"), quoted(text)
    return docs.select(F.xxhash64(d, t).alias("row_hash"), F.xxhash64(t).alias("text_hash"), d.alias("doc_id"), t.alias("text"))


def coded(docs: DataFrame, depth: int) -> DataFrame:
    """(row_hash, text_hash, doc_id, digest, n, paths) of keyed rows: digest null for a text without shingles."""

    def run(t: str) -> tuple:
        s = shingles(t)
        return (hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None, len(s), prefixes(s, depth) if len(s) else None)

    code = per_text(run, "digest string, n long, paths array<long>")
    return docs.withColumn("c", code(F.col("text"))).select("row_hash", "text_hash", "doc_id", "c.*")


def to_least(met: DataFrame) -> DataFrame:
    """Edges (a, b) that connect what the rows (cls, least, leasts) do: a class hangs on the least one it met, and so do the
    others it met, once for all classes that met them. In a large group that is about one edge per class, not one per class
    and band or block pair."""
    tied = F.explode(F.array_union("leasts", F.array("cls")))
    return met.select(tied.alias("a"), F.col("least").alias("b")).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node connected with each node of the edges (a, b). Labels spread along edges and jump to
    the labels' labels until none changes; every round is written, so a lost executor costs one round at most."""
    both = edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select("b", "a")).distinct()
    both = written(both)
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")))
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("least"))
        new = labels.join(near, labels["node"] == near["a"]).select("node", F.col("root").alias("old"), F.least("root", "least").alias("root"))
        jump = labels.select(F.col("node").alias("via"), F.col("root").alias("far"))
        new = written(new.join(jump, F.col("root") == F.col("via"), "left").select("node", "old", F.least("root", "far").alias("root")))
        if new.where("root <> old").limit(1).count() == 0:
            return new.select("node", "root")
        labels = new.select("node", "root")


def linked(ids: np.ndarray, weights: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], across: bool, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Of the classes of one or two blocks: the documents linked to each, and the least connected class. Within two
    different blocks (``across``) only pairs between the blocks count."""
    m = len(ids)
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    values, col = np.unique(flat, return_inverse=True)
    often = np.bincount(col)
    row = np.repeat(np.arange(m), sizes)
    shared = often[col] > 1
    number = np.cumsum(often > 1) - 1
    row, col = row[shared], number[col[shared]]
    common = np.zeros((m, m), np.float32)  # counts below 2^24 are exact
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    n_shared = int(number[-1]) + 1
    width = max(1, min(n_shared, 8_000_000 // m))
    for first in range(0, n_shared, width):
        a, b = np.searchsorted(col, (first, first + width))
        part = np.zeros((m, width), np.float32)
        part[row[a:b], col[a:b] - first] = 1
        common += part @ part.T
    link = (1 + threshold) * common >= threshold * (sizes[:, None] + sizes[None, :]) - 1e-6
    np.fill_diagonal(link, False)
    if across:
        link &= sides[:, None] != sides[None, :]
    n_links = link @ weights
    order = np.argsort(ids)
    root = np.argsort(order)  # labels are places in the order of ids
    while True:
        least = np.minimum(root, np.where(link, root[None, :], m).min(1, initial=m))
        least = np.minimum(least, least[order[least]])
        if (least == root).all():
            return n_links, ids[order[root]]
        root = least


def placed(members: DataFrame) -> DataFrame:
    """Members (grp, cls, n, ...) with the ``blocks`` of their group, their own ``block``, and a ``bin``: groups of one
    block share tasks."""
    size = members.groupBy("grp").agg(F.count("*").alias("m"), F.sum("n").alias("shingles_in"))
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK_CLASSES), F.ceil(F.col("shingles_in") / BLOCK_SHINGLES)).cast("int")
    size = written(size.select(F.col("grp").alias("g"), blocks.alias("blocks"), "shingles_in"))
    whole = size.where("blocks = 1").agg(F.sum("shingles_in")).first()[0] or 0
    bins = max(members.sparkSession.sparkContext.defaultParallelism, -(-whole // BLOCK_SHINGLES))
    cut = members.join(size, F.col("grp") == F.col("g")).drop("g", "shingles_in")
    return cut.withColumns({"block": F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"), "bin": F.pmod(F.xxhash64("grp"), F.lit(bins))})


def verified(members: DataFrame) -> DataFrame:
    """(cls, links, least) of placed members with their shingles: one row per class and block pair."""
    cut = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    lone = F.col("blocks") == 1
    keys = {
        "k": F.when(lone, F.col("bin")).otherwise(F.col("grp")),
        "i": F.when(lone, -1).otherwise(F.least("block", "other")),
        "j": F.when(lone, -1).otherwise(F.greatest("block", "other")),
    }
    cut = cut.withColumns(keys).select("k", "i", "j", "grp", "block", "cls", "weight", "shingles")

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, g in rows.drop_duplicates("cls").groupby("grp", sort=False):
            across = g["i"].iat[0] != g["j"].iat[0]
            sets = [np.frombuffer(b, np.uint64) for b in g["shingles"]]
            ids = g["cls"].to_numpy()
            links, least = linked(ids, g["weight"].to_numpy(), g["block"].to_numpy(), sets, across)
            out.append(pd.DataFrame({"cls": ids, "links": links.astype(np.int64), "least": least}))
        return pd.concat(out)

    longs = T.StructType([T.StructField(c, T.LongType()) for c in ("cls", "links", "least")])
    return cut.groupBy("k", "i", "j").applyInPandas(meet, longs)


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row_hash, text_hash, doc_id, class_id, n_links, is_first) of every document: ``class_id`` is the least id of its
    connected group, ``n_links`` the number of other documents whose similarity with it is at least the threshold,
    ``is_first`` marks the row that stands for its group (and rows equal to it)."""
    rows = keyed(docs, doc_id, text)
    codes = written(coded(rows, depth_for()))
    # the row that stands for a class or group; null ids come last
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_hash", "text_hash")
    classes = codes.where("digest is not null").groupBy("digest").agg(F.count("*").alias("weight"), F.min(row).alias("row"), F.first("n").alias("n"), F.first("paths").alias("paths"))
    classes = written(classes.withColumn("cls", F.monotonically_increasing_id()))  # from here on the numbers are fixed

    hung = classes.select("cls", F.explode("paths").alias("prefix"))
    stars = hung.groupBy("prefix").agg(F.min("cls").alias("star"), F.count("*").alias("m")).where("m > 1").select(F.col("prefix").alias("p"), "star")
    tied = hung.join(stars, F.col("prefix") == F.col("p")).groupBy("cls").agg(F.min("star").alias("least"), F.collect_set("star").alias("leasts"))
    groups = components(to_least(tied))

    members = groups.join(classes, F.col("node") == F.col("cls")).select(F.col("root").alias("grp"), "cls", "weight", "n", F.col("row.row_hash").alias("r"), F.col("row.text_hash").alias("t"))
    # repeats of a row go map-side, before its text is shingled and sent to every block
    texts = rows.groupBy("row_hash", "text_hash").agg(F.first("text").alias("text"))
    found = placed(members).join(texts, (F.col("r") == F.col("row_hash")) & (F.col("t") == F.col("text_hash")))
    hashed = per_text(lambda t: (shingles(t).tobytes(),), "s binary")
    met = written(verified(found.withColumn("shingles", hashed(F.col("text"))["s"])))

    per = met.groupBy("cls").agg(F.sum("links").alias("links"), F.min("least").alias("least"), F.collect_set("least").alias("leasts"))
    per = written(per)
    links = per.select(F.col("cls").alias("c"), "links")
    roots = components(to_least(per))
    near = links.join(roots, F.col("c") == F.col("node"), "left").drop("node")
    final = classes.select("cls", "digest", "weight", "row").join(near, F.col("cls") == F.col("c"), "left")
    final = written(final.select("digest", F.coalesce("root", "cls").alias("root"), "row", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    names = final.groupBy("root").agg(F.min("row").alias("first")).withColumnRenamed("root", "of")
    final = final.join(names, F.col("root") == F.col("of")).select(F.col("digest").alias("g"), "first", "n_links")
    out = codes.join(final, F.col("digest") == F.col("g"), "left")
    alone = F.col("digest").isNull()
    is_first = alone | ((F.col("row_hash") == F.col("first.row_hash")) & (F.col("text_hash") == F.col("first.text_hash")))
    return out.select(
        "row_hash", "text_hash", "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        is_first.alias("is_first"),
    )


def first_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group, the one with the least id. Of texts without shingles those equal in id and text count once."""
    r, t = free(docs, "row_hash"), free(docs, "text_hash")
    firsts = join(docs, doc_id, text).where("is_first").select(F.col("row_hash").alias(f"{r}_first"), F.col("text_hash").alias(f"{t}_first"))
    rows = docs.withColumns({r: F.xxhash64(quoted(doc_id).cast("long"), quoted(text)), t: F.xxhash64(quoted(text))})
    kept = rows.join(firsts, (F.col(r) == F.col(f"{r}_first")) & (F.col(t) == F.col(f"{t}_first")), "left_semi")
    return kept.dropDuplicates([r, t]).drop(r, t)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group of near copies."""
    return first_of_each(docs)
