"""Chat formatting with cumulative-snapshot collapse, in DataFrame operations only.

Logs often hold a conversation many times, each snapshot a turn or two longer. Every conversation's turn prefixes
get rolling hashes; a conversation whose whole hash is the hash of a prefix of a longer one is a snapshot of it, and an
anti join leaves the maximal ones. Of conversations that are equal the one with the least id stays. The kept ones
are rendered, turn by turn, with role marks.

The hash of a prefix is the sum, turn by turn, of two 64-bit hashes of (place, role, text), held in four sums of
32-bit halves; sums over buckets make it rolling without one task per conversation: all rows are put in order
over ranges of nearly equal numbers of rows, whatever their conversation and turn, and a window runs over a bucket's
rows or over a conversation's buckets. Equal rows are told apart by their place, so repeats are cut too.
Long conversations are rendered in as many parts: one for each stretch of ``STRETCH`` turn numbers, in pieces numbered from 0.
A piece ends after ``PART_ROWS`` rows or ``PART_BYTES`` bytes of its stretch (turns without a number, repeated numbers, long
texts), so most stretches are one piece, and the rule is the same for all.

Defined results: a null role or text is the empty one; turns come in order of turn (null last), role and text, all of
them, repeated ones too; a null conversation id is an id of its own; an empty table gives no rows; other columns are not
handed back; marks inside a text are broken up so that no text can close its turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import quoted, table, written

STRETCH = 1024
#: Stretch of turns without a number.
LAST = 2**53
#: A stretch with more rows or bytes than that is cut into parts of at most so many rows, and so many bytes besides the first row's.
PART_ROWS, PART_BYTES = 65_536, 64 * 2**20
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
HALVES = ("h1", "h2", "h3", "h4")


def turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    number = quoted(turn).cast("long")
    return conversations.select(
        quoted(conv_id).alias("conv_id"),
        F.coalesce(F.floor(number / STRETCH), F.lit(LAST)).alias("stretch"),
        number.alias("turn"),
        F.coalesce(quoted(role), F.lit("")).alias("role"),
        F.coalesce(quoted(text), F.lit("")).alias("text"),
    )


def in_order(t: DataFrame) -> DataFrame:
    """The turns as a written table with ``pos``, which rises with conversation, turn, role and text, and its ``bucket``."""
    shuffled = int(t.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    t = t.withColumns({"z": F.col("turn").isNull(), "salt": F.xxhash64(F.monotonically_increasing_id())})
    order = ["conv_id", "z", "turn", "role", "text"]
    t = t.repartitionByRange(shuffled, *order, "salt").sortWithinPartitions(*order)
    t = written(t.withColumn("pos", F.monotonically_increasing_id()).drop("z", "salt"))
    return t.withColumn("bucket", F.shiftright("pos", 33))


def _before(c: str, by: str = "conv_id") -> Column:
    return F.coalesce(F.sum(c).over(Window.partitionBy(*by.split()).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _with_bucket(rows: DataFrame, per: DataFrame, *more: str) -> DataFrame:
    """Rows with what is known of their bucket."""
    per = per.withColumnsRenamed({"conv_id": "c", "bucket": "b"} | {m: f"m_{m}" for m in more})
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("bucket") == F.col("b"))
    for m in more:
        same &= F.col(m) == F.col(f"m_{m}")
    return rows.join(per, same).drop("c", "b", *[f"m_{m}" for m in more])


def prefix_hashes(t: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, place, n, h1..h4) of every turn prefix, and (conv_id, n, h1..h4) of every conversation, of turns in order."""
    placed = t.select("conv_id", "bucket", "pos", F.xxhash64("role", "text").alias("a"), F.xxhash64("text", F.lit(7), "role").alias("b"))
    per = t.groupBy("conv_id", "bucket").agg(F.count("*").alias("m"), F.min("pos").alias("first"))
    per = per.withColumn("before", _before("m")).withColumn("n", F.sum("m").over(Window.partitionBy("conv_id")))
    numbered = _with_bucket(placed.withColumnRenamed("b", "other"), per).withColumn("place", F.col("before") + F.col("pos") - F.col("first") + 1)
    a, b = F.xxhash64("place", "a"), F.xxhash64("other", "place")
    low = F.lit(0xFFFFFFFF)
    halves = {"h1": a.bitwiseAND(low), "h2": F.shiftrightunsigned(a, 32), "h3": b.bitwiseAND(low), "h4": F.shiftrightunsigned(b, 32)}
    hashed = written(numbered.withColumns(halves).select("conv_id", "bucket", "place", "n", *HALVES))
    sums = hashed.groupBy("conv_id", "bucket").agg(*[F.sum(h).alias(h) for h in HALVES])
    offsets = sums.select("conv_id", "bucket", *[_before(h).alias(f"{h}_before") for h in HALVES])
    inside = Window.partitionBy("conv_id", "bucket").orderBy("place")
    rolling = _with_bucket(hashed, offsets).select("conv_id", "place", "n", *[(F.col(f"{h}_before") + F.sum(h).over(inside)).alias(h) for h in HALVES])
    totals = hashed.groupBy("conv_id").agg(F.first("n").alias("n"), *[F.sum(h).alias(h) for h in HALVES])
    return rolling, totals


def maximal(t: DataFrame) -> DataFrame:
    """(conv_id, n_turns, copies) of the conversations that no longer one begins with; ``copies`` counts equal ones; of turns in order."""
    rolling, totals = prefix_hashes(t)
    distinct = written(totals.groupBy("n", *HALVES).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies")))
    prefixes = rolling.where("place < n").groupBy(F.col("place").alias("p"), *[F.col(h).alias(f"p{h}") for h in HALVES]).agg(F.lit(1).alias("one"))
    same = F.col("n") == F.col("p")
    for h in HALVES:
        same &= F.col(h) == F.col(f"p{h}")
    return distinct.join(prefixes, same, "left_anti").select("conv_id", F.col("n").alias("n_turns"), "copies")


def cut_large(rows: DataFrame) -> DataFrame:
    """Rendered rows with their ``piece``: the number, within its stretch, of the rows and bytes it falls into. Stretches within the
    bounds are piece 0 without being counted through."""
    per = rows.groupBy("conv_id", "stretch", "bucket").agg(F.count("*").alias("m"), F.sum("size").alias("size"), F.min("pos").alias("first"))
    per = written(per)
    sums = per.groupBy("conv_id", "stretch").agg(F.sum("m").alias("m"), F.sum("size").alias("size"))
    large = sums.where((F.col("m") > PART_ROWS) | (F.col("size") > PART_BYTES)).select(F.col("conv_id").alias("large_id"), F.col("stretch").alias("large_stretch"))
    large = written(large)
    is_large = F.col("conv_id").eqNullSafe(F.col("large_id")) & (F.col("stretch") == F.col("large_stretch"))
    usual = rows.join(large, is_large, "left_anti").withColumn("piece", F.lit(0).cast("long"))

    offsets = per.join(large, is_large, "left_semi").select("conv_id", "stretch", "bucket", "first", _before("m", "conv_id stretch").alias("rows_before"), _before("size", "conv_id stretch").alias("size_before"))
    cut = _with_bucket(rows.join(large, is_large, "left_semi"), offsets, "stretch")
    inside = Window.partitionBy("conv_id", "stretch", "bucket").orderBy("pos")
    by_rows = F.floor((F.col("rows_before") + F.col("pos") - F.col("first")) / PART_ROWS)
    # by the byte a row ends at: rows of one part have no more than PART_BYTES besides the first row's
    by_size = F.floor((F.col("size_before") + F.sum("size").over(inside) - 1) / PART_BYTES)
    cut = cut.withColumns({"by_rows": by_rows, "by_size": by_size}).drop("rows_before", "size_before", "first")
    pieces = ["stretch", "by_rows", "by_size"]
    names = cut.select("conv_id", *pieces).distinct().withColumn("piece", F.row_number().over(Window.partitionBy("conv_id", "stretch").orderBy("by_rows", "by_size")).cast("long") - 1)
    names = written(names).withColumnsRenamed({"conv_id": "c"} | {k: f"m_{k}" for k in pieces})
    same = F.col("conv_id").eqNullSafe(F.col("c"))
    for k in pieces:
        same &= F.col(k) == F.col(f"m_{k}")
    return usual.unionByName(cut.join(names, same).select(*usual.columns))


def render(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, part, piece, n_turns, copies, text): the maximal conversations, rendered."""
    t = in_order(turns(conversations, conv_id, turn, role, text))
    kept = written(maximal(t)).withColumnRenamed("conv_id", "kept_id")
    plain = F.replace(F.col("text"), F.lit("<|"), F.lit("< |"))
    marked = t.withColumn("line", F.concat(F.lit(OPEN), F.replace(F.col("role"), F.lit("<|"), F.lit("< |")), F.lit("\n"), plain, F.lit(CLOSE + "\n")))
    rows = marked.join(kept, F.col("conv_id").eqNullSafe(F.col("kept_id"))).withColumn("size", F.octet_length("line").cast("long"))
    rows = cut_large(rows.select("conv_id", "stretch", "bucket", "pos", "n_turns", "copies", "line", "size"))
    parts = rows.groupBy("conv_id", F.col("stretch").alias("part"), "piece", "n_turns", "copies").agg(F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("lines"))
    return parts.select("conv_id", "part", "piece", "n_turns", "copies", F.array_join(F.transform("lines", lambda x: x["line"]), "").alias("text"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render(table(spark, sf_dir, "conversations"))
