"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

Every source gets a target: its share, by weight, of all words, stopped at three times its own words, the excess
shared out again by weight. Within a source the documents of one length band (binary digits of the number of
words) get the same expected number of copies, ``min(3, c * measure)``, where longer bands have a larger measure
and ``c`` makes the expected words meet the target. The whole part of it is certain: so many copies are taken of
every document. The rest is an inclusion probability p, and documents are ranked by random odds over inclusion
odds, ``(u / (1 - u)) / (p / (1 - p))``. From the lowest rank on, documents are taken until the words still
missing are reached, so that a sample has a fixed size in words, within half a document.

The place where a source's sample ends is found without sorting a source in one task: ranks are cut into
fine buckets, words are summed by bucket, and only the bucket in which the sample ends is put in order. All else is
a comparison of each row with small tables, so texts are never shuffled, whatever share of them one source has.

Random numbers come from md5 of id, text and seed: reruns agree. Defined results: a null or empty text has size 0
and is taken no words; a null source is a source of its own, the last; repeated rows have the same rank, and
where the sample ends among n of them, the first m in the order they were written are taken (which ones makes no
difference to the rows handed back, m is the same in every run); an empty table gives no rows; other columns are left as they are.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, free, join_small, quoted, table, written

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
#: measure of a length band: BAND_FROM plus its binary digits
BAND_FROM = 4
#: Rank buckets of a source; only one of them per source is sorted.
BUCKETS = 4096
SEED = 17


def uniform(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """A number strictly between 0 and 1, from 52 bits of md5."""
    key = F.concat_ws("|", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return (F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("long") + 0.5) / float(2**52)


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``target`` of each row (source, source_size). One row per source meets in one task, which is as many as
    there are sources. Sources are put in order of size over weight; those whose stop is below their share come first."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.array(*[F.lit(w) for w in weights])[F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))]
    by_room = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    number = F.row_number().over(by_room)
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - MOST_COPIES * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    rest = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    steps = sources.withColumn("weight", weight).withColumns({"number": number, "left": left, "rest": rest})
    steps = steps.withColumn("stopped", MOST_COPIES * F.col("source_size") * F.col("rest") <= F.col("weight") * F.col("left"))
    # the first source that isn't stopped has the final share; those before it in the order are stopped
    open_ = F.when(~F.col("stopped"), F.struct("number", "left", "rest"))
    final = F.min(open_).over(everything)
    share = F.col("weight") * final["left"] / final["rest"]
    return steps.select("source", "source_size", F.coalesce(F.least(F.lit(float(MOST_COPIES)) * F.col("source_size"), share), F.lit(float(MOST_COPIES)) * F.col("source_size")).alias("target"))


def copies_by_band(bands: DataFrame, source_targets: DataFrame) -> DataFrame:
    """(source, band, source_size, target, whole, p): certain copies and inclusion probability. ``bands`` has the
    words of each (source, band), at most some sixty rows per source."""
    b = bands.join(source_targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    b = b.withColumn("measure", F.lit(BAND_FROM) + F.col("band"))
    longest = Window.partitionBy("source").orderBy(F.col("band").desc())
    before = longest.rowsBetween(Window.unboundedPreceding, -1)
    weighed = F.col("band_size") * F.col("measure")
    left = F.col("target") - MOST_COPIES * F.coalesce(F.sum("band_size").over(before), F.lit(0))
    rest = F.sum(weighed).over(Window.partitionBy("source")) - F.coalesce(F.sum(weighed).over(before), F.lit(0))
    b = b.withColumn("c", F.when(rest > 0, left / rest))
    full = F.coalesce(F.col("c") * F.col("measure") >= MOST_COPIES, F.lit(False))
    # as in targets(): the first band (from the longest) that isn't full has the factor of all bands after it
    factor = F.max(F.when(~full, F.struct("band", "c"))).over(Window.partitionBy("source"))["c"]
    expected = F.least(F.lit(float(MOST_COPIES)), F.greatest(F.lit(0.0), F.coalesce(F.when(full, MOST_COPIES).otherwise(factor * F.col("measure")), F.lit(0.0))))
    b = b.withColumn("expected", expected).withColumn("whole", F.floor("expected"))
    return b.select("source", "band", "band_size", "source_size", "target", "whole", (F.col("expected") - F.col("whole")).alias("p"))


def _rank(u: Column, p: Column) -> Column:
    """Random odds over inclusion odds, folded into 0 to 1: x / (1 + x)."""
    odds = u * (1 - p)
    return F.when(p > 0, odds / (odds + (1 - u) * p))


def plan(sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (source, size, u, id): the table of :func:`copies_by_band`, and (source, last_bucket, last_rank, last_id): all
    ranks of the buckets before the last one are taken, and those up to the last rank (null: no more), of that rank rows
    up to the last id (null: all)."""
    band = F.length(F.bin("size"))
    bands = sizes.groupBy("source", band.alias("band")).agg(F.sum("size").alias("band_size"))
    bands = written(bands)
    sources = bands.groupBy("source").agg(F.sum("band_size").alias("source_size"))
    by_band = written(copies_by_band(bands, targets(sources)))
    small = by_band.select(F.col("source").alias("s"), F.col("band").alias("b"), "p")
    ranked = join_small(sizes, small, F.col("source").eqNullSafe(F.col("s")) & (band == F.col("b")), "inner")
    ranked = ranked.select("source", "size", "id", _rank(F.col("u"), F.col("p")).alias("rank")).where("size > 0 and rank is not null")
    ranked = ranked.withColumn("bucket", F.floor(F.col("rank") * BUCKETS))
    missing = by_band.groupBy("source").agg((F.max("target") - F.sum(F.col("whole") * F.col("band_size"))).alias("missing"))
    missing = missing.withColumnRenamed("source", "s")
    sums = ranked.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0)))
    sums = join_small(sums, missing, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    # the bucket in which the missing words end; where all ranks fit in, the last one
    ends = sums.where(F.col("before") < F.col("missing")).groupBy("source").agg(F.max(F.struct("bucket", "before", "missing")).alias("end"))
    ends = written(ends.select(F.col("source").alias("s"), F.col("end.bucket").alias("last"), "end.before", "end.missing"))
    inside = join_small(ranked, ends, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("last")), "inner")
    # rows of equal rank are repeats of one row: sums by rank first
    inside = inside.groupBy("source", "rank", "before", "missing").agg(F.sum("size").alias("words"), F.count("*").alias("n"))
    run = Window.partitionBy("source").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    done = F.col("before") + F.coalesce(F.sum("words").over(run), F.lit(0))
    # a document is taken if at least half of it is still missing
    taken = F.least(F.col("n"), F.floor((F.col("missing") - F.col("done")) / (F.col("words") / F.col("n")) + 0.5))
    ranks = inside.withColumn("done", done).withColumn("m", taken).where("m >= 1")
    inside_last = ranks.groupBy("source").agg(F.max(F.struct("rank", "m", "n")).alias("end"))
    last = ends.join(inside_last.withColumnRenamed("source", "t"), F.col("s").eqNullSafe(F.col("t")), "left")
    last = written(last.select("s", F.col("last").alias("last_bucket"), F.col("end.rank").alias("last_rank"), F.when(F.col("end.m") < F.col("end.n"), F.col("end.m")).alias("m")))
    ids = _last_ids(ranked, last.where("m is not null").select("s", "last_rank", "m"))
    last = last.join(ids.withColumnRenamed("source", "t"), F.col("s").eqNullSafe(F.col("t")), "left")
    return by_band, written(last.select(F.col("s").alias("source"), "last_bucket", "last_rank", "last_id"))


def _last_ids(ranked: DataFrame, cut: DataFrame) -> DataFrame:
    """(source, last_id): the id of the m-th row of each source's last rank. Ids rise with partition and place; rows are
    counted by partition, and only those of the partition in which the m-th one lies are put in order."""
    equal = join_small(ranked, cut, F.col("source").eqNullSafe(F.col("s")) & (F.col("rank") == F.col("last_rank")), "inner")
    equal = equal.select("source", "m", "id", F.shiftright("id", 33).alias("part"))
    per = equal.groupBy("source", "m", "part").agg(F.count("*").alias("rows"))
    upto = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("before", F.coalesce(F.sum("rows").over(upto), F.lit(0)))
    per = written(per.where("before < m and m <= before + rows").select(F.col("source").alias("s"), F.col("part").alias("p"), (F.col("m") - F.col("before")).alias("nth")))
    inside = join_small(equal, per, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")), "inner")
    number = F.row_number().over(Window.partitionBy("source").orderBy("id"))
    return inside.withColumn("number", number).where("number = nth").select("source", F.col("id").alias("last_id"))


def mix(docs: DataFrame, out: str, doc_id: str = "doc_id", text: str = "text", source: str = "source", keep_text: bool = True) -> DataFrame:
    """The documents with a struct column ``out``: ``size`` (words), ``source_size``, ``target`` and ``copies``."""
    s, n, u, r, k = (free(docs, c) for c in ("mix_source", "mix_size", "mix_u", "mix_row", "mix_id"))
    size = F.coalesce(F.regexp_count(quoted(text), F.lit(WORD)), F.lit(0)).cast("long")
    docs = docs.withColumns({s: quoted(source), n: size, u: uniform(quoted(doc_id), quoted(text))})
    if not keep_text:
        docs = docs.drop(text)
    sized = written(docs.withColumn(k, F.monotonically_increasing_id()))
    by_band, last = plan(sized.select(F.col(s).alias("source"), F.col(n).alias("size"), F.col(u).alias("u"), F.col(k).alias("id")))
    rule = by_band.join(last.withColumnRenamed("source", "t"), F.col("source").eqNullSafe(F.col("t")), "left").drop("t", "band_size")
    rule = rule.select(F.struct("*").alias(r))
    joined = join_small(sized, rule, F.col(s).eqNullSafe(F.col(f"{r}.source")) & (F.length(F.bin(n)) == F.col(f"{r}.band")))
    rank = _rank(F.col(u), F.col(f"{r}.p"))
    of_last = (rank == F.col(f"{r}.last_rank")) & (F.col(k) <= F.coalesce(F.col(f"{r}.last_id"), F.col(k)))
    taken = (F.floor(rank * BUCKETS) < F.col(f"{r}.last_bucket"), rank < F.col(f"{r}.last_rank"), of_last)
    more = reduce(or_, [F.coalesce(t, F.lit(False)) for t in taken]).cast("long")
    copies = F.when(F.col(n) > 0, F.col(f"{r}.whole") + more).otherwise(0)
    return joined.withColumn(out, F.struct(F.col(n).alias("size"), F.col(f"{r}.source_size"), F.col(f"{r}.target"), copies.alias("copies"))).drop(s, n, u, r, k)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mix(docs, "mix", keep_text=False)
    return mixed.select("doc_id", "mix.size", "mix.source_size", "mix.target", (F.col("mix.size") * F.col("mix.copies")).alias("taken"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document as often as the mix takes it."""
    mixed = mix(docs, out := free(docs, "mix"))
    taken = mixed.where(F.col(f"{out}.copies") > 0)
    return taken.withColumn(out, F.explode(F.sequence(F.lit(1).cast("long"), F.col(f"{out}.copies")))).drop(out)
