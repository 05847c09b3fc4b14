"""Source divergence audit: how far the terms of each source of a language are from those of every other source.

Terms are counted per language and source; a language keeps those that are in a least number of its documents. A
kept term has a share p of a group in parts of a thousand million, smoothed by one occurrence. The divergence of group
g from another, or from the whole language, with shares q adds up ``(p - q)^2 div q`` over all kept terms, in whole numbers.

All groups against all groups is a product of two sparse matrices, done row by row after Gustavson. Postings (term, group,
count) are dealt out by term; a task has a term-major index of its terms, and for each group scatters the group's terms
through it into a dense accumulator, one place per other group. No pair of postings is handed on, only a sum per
pair of groups and task. A term that only one of two groups has, or none, still counts, as the smoothed share of no
occurrence isn't zero. That is the baseline: it depends on how often a group has each count, not on which terms, so it is computed
from a histogram of counts per group as if the groups had no term in common, and each common term adds the difference to it.

Counts are added up in Python per task, so a frequent word is one row per task and group, then by Spark, first by (language, source, term)
and then by (language, term). Groups of one language are cut into slices, so an accumulator's output is bounded.

Defined results: a null text, language or source reads as ''; a group without kept terms takes part with smoothed
shares; a language without kept terms has values of 0; a language with one source has no pairs; repeated rows count
as documents of their own; very long texts are counted whole; ties go by the item's bytes; an empty table gives no rows; other
columns are not read. Counts must stay below 2.8 * 10^14, where 64 bits hold every step.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import join_small, quoted, struct_of, table, written

LEAST_DOCUMENTS, TOP_TERMS = 3, 200
#: A share of 1 is SCALE; its two factors keep products within 64 bits.
SCALE, FACTORS = 1_000_000_000, (31_250, 32_000)
#: Terms, and words, that a task counts before it hands them on (both counts of a term share 64 bits); postings of a block of terms; pairs of groups that one task sums.
HELD, WORDS, BLOCK, PAIRS = 900_000, 2**30, 250_000, 2_000_000
#: Postings that are scattered at a time.
STEP = 1_000_000

_term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

COUNTS = "lang string, source string, term string, n long, docs long"


def counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents. A group has a row with a null term, too, of its documents."""
    rows = docs.select(*[F.coalesce(quoted(c), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text"))])

    def handed(held: dict) -> Iterator[pa.RecordBatch]:
        for (of, by), terms in held.items():
            m = len(terms)
            columns = [pa.array([of] * m), pa.array([by] * m), pa.array(list(terms), pa.string())]
            both = np.fromiter(terms.values(), np.int64, m)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(both >> 32), pa.array(both & 0xFFFFFFFF)], ["lang", "source", "term", "n", "docs"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, dict] = {}
        size = words = 0
        for batch in batches:
            for of, by, t in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), batch["text"]):
                terms = held.setdefault((of, by), {})
                size -= len(terms)
                t = t.as_py()
                own = Counter(_term.findall(t.lower() if t.isascii() else t.translate(_lower)))
                own[None] = 0  # the document itself
                for w, n in own.items():  # occurrences above, documents below bit 32
                    terms[w] = terms.get(w, 0) + (n << 32 | 1)
                size += len(terms)
                words += own.total()
                if size > HELD or words > WORDS:
                    yield from handed(held)
                    held, size, words = {}, 0, 0
        yield from handed(held)

    partial = rows.mapInArrow(count, struct_of(COUNTS))
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def postings(counted: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, source, term, n, total, is_first) of the kept terms: ``total`` is the term's count in the language, and one row
    of each term is the first. A term has at most as many rows as its language has sources."""
    term = Window.partitionBy("lang", "term")
    found = counted.where("term is not null").withColumns(
        {"in_docs": F.sum("docs").over(term), "total": F.sum("n").over(term), "place": F.row_number().over(term.orderBy("source"))}
    )
    return found.where(F.col("in_docs") >= least).select("lang", "source", "term", "n", "total", (F.col("place") == 1).cast("long").alias("is_first"))


def share(n: Column, size: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / size), exactly."""
    a, b = (F.lit(x).cast("long") for x in FACTORS)
    product = (n + 1) * a
    return 1 + F.call_function("div", product, size) * b + F.call_function("div", F.pmod(product, size) * b, size)


def _divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _shares(n: np.ndarray, size: np.ndarray) -> np.ndarray:
    """As ``share``."""
    whole, rest = np.divmod((n + 1) * FACTORS[0], size)
    return 1 + whole * FACTORS[1] + rest * FACTORS[1] // size


def _divergences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _scattered(starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(k, place): the places of the stretches (start, length), and the number of the stretch each is from; in steps."""
    at = 0
    while at < len(starts):
        upto = max(at + 1, int(np.searchsorted(np.cumsum(lengths[at:]), STEP, "right")) + at)
        part = lengths[at:upto]
        k = np.repeat(np.arange(at, upto), part)
        inside = np.arange(len(k)) - np.repeat(np.cumsum(part) - part, part)
        yield k, starts[k] + inside
        at = upto


def _pairs(lang: str, names: np.ndarray, sums: list[tuple[int, np.ndarray, np.ndarray]]) -> pd.DataFrame:
    """(lang, source, item, value) of the places and values of each group."""
    none = np.zeros(0, np.int64)
    source = np.repeat(np.array([g for g, _, _ in sums], np.int64), [len(others) for _, others, _ in sums])
    item = np.concatenate([none, *(others for _, others, _ in sums)])
    values = np.concatenate([none, *(value for _, _, value in sums)])
    return pd.DataFrame({"lang": np.full(len(item), lang, object), "source": names[source], "item": names[item], "value": values})


def common_terms(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one block of terms of a language: (lang, source, item, value), where value is what the terms that two groups
    share add to the baseline. Rows are postings (source, term, n, size, own); ``own`` marks the groups that are summed here."""
    lang = rows["lang"].iat[0]
    group, names = pd.factorize(rows["source"].to_numpy(object))
    term, _ = pd.factorize(rows["term"])
    order = np.argsort(term, kind="stable")  # term-major
    group, term = group[order], term[order]
    n, size, own = (rows[c].to_numpy()[order] for c in ("n", "size", "own"))
    first = np.searchsorted(term, np.arange(term[-1] + 2))
    p, zero = _shares(n, size), _shares(np.zeros(len(n), np.int64), size)
    by_group = np.argsort(group, kind="stable")
    ends = np.searchsorted(group[by_group], np.arange(len(names) + 1))
    out = []
    for g in range(len(names)):
        mine = by_group[ends[g] : ends[g + 1]]
        if not own[mine[0]]:
            continue
        sums, met = np.zeros(len(names), np.int64), np.zeros(len(names), bool)
        starts = first[term[mine]]
        for k, at in _scattered(starts, first[term[mine] + 1] - starts):
            a, z = p[mine[k]], zero[mine[k]]
            np.add.at(sums, group[at], _divergences(a, p[at]) - _divergences(a, zero[at]) - _divergences(z, p[at]) + _divergences(z, zero[at]))
            met[group[at]] = True
        met[g] = False
        out.append((g, np.flatnonzero(met), sums[met]))
    return _pairs(lang, names, out)


def baselines(rows: pd.DataFrame) -> pd.DataFrame:
    """(lang, source, item, value) of all pairs of groups of a slice as if they had no term in common. Rows are groups
    (source, size, v, own, counts, times): ``counts`` and ``times`` are the histogram of the group's counts."""
    lang, names, size, own = rows["lang"].iat[0], rows["source"].to_numpy(object), rows["size"].to_numpy(), rows["own"].to_numpy()
    v = int(rows["v"].iat[0])
    zero = _shares(np.zeros(len(size), np.int64), np.maximum(size, 1))
    lengths = np.array([len(c) for c in rows["counts"]], np.int64)
    group = np.repeat(np.arange(len(names)), lengths)
    n = np.concatenate([np.asarray(c, np.int64) for c in rows["counts"]])
    times = np.concatenate([np.asarray(c, np.int64) for c in rows["times"]])
    p = _shares(n, size[group]) if len(n) else n
    terms = np.zeros(len(names), np.int64)
    np.add.at(terms, group, times)
    out = []
    for g in np.flatnonzero(own):
        sums = _divergences(zero[g], zero) * (v - terms[g] - terms)  # terms of neither; of both they are taken twice here
        np.add.at(sums, group, _divergences(zero[g], p) * times)
        for k in np.flatnonzero(group == g):
            sums += _divergences(p[k], zero) * times[k]
        others = np.flatnonzero(np.arange(len(names)) != g)
        out.append((g, others, sums[others] if v else 0 * sums[others]))
    return _pairs(lang, names, out)


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): ``pair`` rows of each group with every other source of its language, and ``term``
    rows with the terms that the group has more of than the language, down to rank ``top``."""
    spark = docs.sparkSession
    counted = written(counts(docs, text, lang, source))
    kept = written(postings(counted, least))

    # small tables: a row per language, a row per group
    langs = kept.groupBy("lang").agg(F.sum("is_first").alias("v"), F.sum("n").alias("lang_n"))
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    groups = counted.where("term is null").select("lang", "source").join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0)
    groups = groups.withColumns({"size": F.col("group_n") + F.col("v"), "lang_size": F.col("lang_n") + F.col("v"), "n_groups": F.count("*").over(Window.partitionBy("lang"))})
    slices = F.ceil(F.col("n_groups") * F.col("n_groups") / PAIRS).cast("int")
    groups = written(groups.select("lang", "source", "size", "lang_size", "v", slices.alias("slices"), F.pmod(F.xxhash64("source"), slices).cast("int").alias("own_slice")))

    of = groups.select(F.col("lang").alias("l"), F.col("source").alias("s"), "size", "lang_size", "slices", "own_slice")
    sized = join_small(kept, of, (F.col("lang") == F.col("l")) & (F.col("source") == F.col("s")), "inner").drop("l", "s")

    p, q = share(F.col("n"), F.col("size")), share(F.col("total"), F.col("lang_size"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = sized.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    terms = terms.select("lang", "source", F.lit("term").alias("part"), "item", _divergence(F.col("p"), F.col("q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)

    def in_slices(rows: DataFrame) -> DataFrame:
        """Rows once for each slice of their language, marked in the slice in which their group is summed."""
        rows = rows.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        return rows.withColumn("own", F.col("slice") == F.col("own_slice"))

    pair = struct_of("lang string, source string, item string, value long")
    blocks = max(spark.sparkContext.defaultParallelism, -(-kept.count() // BLOCK))
    cells = in_slices(sized).withColumn("block", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int"))
    cells = cells.select("lang", "slice", "block", "source", "term", "n", "size", "own")
    common = cells.groupBy("lang", "slice", "block").applyInPandas(common_terms, pair)

    histogram = kept.groupBy("lang", "source", "n").agg(F.count("*").alias("times"))
    histogram = histogram.groupBy("lang", "source").agg(F.collect_list(F.struct("n", "times")).alias("h"))
    base = groups.join(histogram, ["lang", "source"], "left")
    base = base.withColumns({c: F.coalesce(F.col(f"h.{c}"), F.array().cast("array<long>")) for c in ("n", "times")})
    base = in_slices(base).select("lang", "slice", "source", "size", "v", "own", F.col("n").alias("counts"), "times")
    base = base.groupBy("lang", "slice").applyInPandas(baselines, pair)

    pairs = base.unionByName(common).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"))
    return terms.unionByName(pairs)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))
