"""Token ids of documents in flat binary files, written in the order of document ids and read by memory map.

A data set is a folder with three flat files per partition, without headers, all little-endian: ``.ids``, unsigned
integers of 16 bits where the tokenizer has at most 65,536 ids and of 32 bits otherwise; ``.starts``, n + 1 unsigned 64-bit
places in the ids, of which document k owns [start k, start k + 1); ``.docs``, n signed 64-bit document ids. A
``manifest`` table has a row per partition with its files and counts and, by prefix sums over the partitions,
the number of tokens and documents before it. So any document is found from its own partition's files, and a partition can be
written before it is known how many tokens the ones before it have.

Writing: rows are dealt into ranges of (id, text hash, row number), so one id on any number of rows spans partitions,
sorted there by Spark (which spills), encoded batch by batch, and appended to files of the attempt's own name.
The manifest is written by Spark's own commit, so files of lost or repeated attempts are never named in it.

Encoding: no pre-token of the usual tokenizer goes across a blank or line end, nor from an ASCII word into a mark, and it lowers
all letters. So texts are cut there, and the library encodes each part that a worker hasn't met lately; with a tokenizer of
another kind it encodes whole texts. The tokens are those of the whole text, without special ones: their strings in a
text are ordinary text.

Defined results: a null or empty text has no tokens but the end; null ids come last (``nulls`` of the manifest counts
them; their place in ``.docs`` holds 0); ties are ordered by the text's hash; equal rows are written as often as they
are there; an empty table gives files of no documents and no rows; very long texts are encoded whole; other columns are not handed back.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyarrow import fs as files
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import lineage
from tidemark.llm.common import quoted, struct_of, table

MODEL, END = "word_bpe_49k.json", 2
#: Parts of a text up to so many characters are kept with their ids; a worker keeps at most twice KEPT of them.
SHORT, KEPT = 40, 300_000
#: Documents in a batch that is read back.
BATCH = 4096
#: What the tokenizer must do for texts to be encoded in parts; fixed values of its file.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: A part that ends in marks behind an ASCII word: pre-tokens always end between the two.
_marked = re.compile(r"([A-Za-z0-9]+)([.,;:!?#$%&*|<>]+)")
#: A part that is one pre-token: letters that stay one letter each when lowered.
_letters = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: Ends the last token of a pre-token; a fixed value of the file.
WORD_END = "</w>"
#: Stands between parts that the library is asked for together: a pre-token, and so a token, of its own.
GAP = "\x00"


class Encoder:
    """The library's tokenizer, with the ids of parts that were met lately, as little-endian integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.dtype = dtype_of(max(self.tokenizer.get_vocab(with_added_tokens=True).values(), default=0) + 1)
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        rules = json.loads(self.tokenizer.to_str())
        normal, split = rules.get("normalizer") or {}, rules.get("pre_tokenizer") or {}
        split = (split.get("pretokenizers") or [{}])[0]
        self.ends = np.zeros(max(self.tokenizer.get_vocab().values(), default=0) + 1, bool)
        self.ends[[k for t, k in self.tokenizer.get_vocab(with_added_tokens=False).items() if t.endswith(WORD_END)]] = True
        gap = self.tokenizer.encode(GAP, add_special_tokens=False).ids
        self.gap = gap[0] if len(gap) == 1 else None
        self.in_parts = (
            [n["type"] for n in normal.get("normalizers", [])] == NORMALIZERS
            and (split.get("type"), split.get("behavior"), split.get("invert"), split.get("pattern", {}).get("Regex")) == ("Split", "Removed", True, PRE_TOKEN)
            and rules["model"].get("end_of_word_suffix") == WORD_END
            and self.gap is not None
        )

    def _ask(self, parts: list[str], between: str) -> None:
        """Keep the ids of parts by the library, asked for together: words end with a token that ends a pre-token, other
        parts with the gap between them."""
        ids = np.array(self.tokenizer.encode_batch_fast([between.join(parts)], add_special_tokens=False)[0].ids, self.dtype)
        words, raw, width, start = between == " ", ids.tobytes(), ids.itemsize, 0
        ends = np.flatnonzero(self.ends[ids]) + 1 if words else np.append(np.flatnonzero(ids == self.gap), len(ids))
        if len(ends) != len(parts):
            raise ValueError("the tokenizer doesn't end words as its file says")
        for p, end in zip(parts, (ends * width).tolist()):
            self.kept[p] = raw[start:end]
            start = end if words else end + width

    def _learn(self, parts: Iterable[str]) -> None:
        """Keep the ids of parts: from those kept before, else of word and marks, else from the library."""
        kept, older, words, others, cut = self.kept, self.older, {}, {}, []
        for p in parts:
            if (ids := older.get(p)) is not None:
                kept[p] = ids
            elif _letters.fullmatch(p):
                words[p] = None
            elif m := _marked.fullmatch(p):
                cut.append((p, *m.groups()))
            else:
                others[p] = None
        for _, word, marks in cut:
            for x in (word, marks):
                if x not in kept:
                    if (ids := older.get(x)) is not None:
                        kept[x] = ids
                    else:
                        (words if _letters.fullmatch(x) else others)[x] = None
        if words:
            self._ask(list(words), " ")
        if others:
            self._ask(list(others), f" {GAP} ")
        for p, word, marks in cut:
            kept[p] = kept[word] + kept[marks]

    def encode(self, text: str) -> bytes:
        """Ids of a text."""
        if not self.in_parts or GAP in text:
            return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype).tobytes()
        parts = (text.lower() if text.isascii() else text).replace("\n", " ").split(" ")
        got = list(map(self.kept.get, parts))
        if None in got:
            ask = {p for p, ids in zip(parts, got) if ids is None}
            if len(self.kept) >= KEPT:
                self.older, self.kept = self.kept, {}
            self._learn(ask)
            kept = self.kept
            got = [kept[p] if ids is None else ids for p, ids in zip(parts, got)]
            for p in ask:
                if len(p) > SHORT:
                    del kept[p]
        return b"".join(got)


def dtype_of(n_ids: int) -> str:
    """The narrowest file type for ids below ``n_ids``."""
    return "<u2" if n_ids <= 2**16 else "<u4"


def encoder_of(path: str) -> Encoder:
    """The encoder of this Python process: workers go from task to task, and so do the ids they keep."""
    module = sys.modules.setdefault("_kept_encoders", types.ModuleType("_kept_encoders"))
    encoders = module.__dict__.setdefault("encoders", {})
    if path not in encoders:
        encoders[path] = Encoder(path)
    return encoders[path]


def store_of(folder: str) -> tuple[files.FileSystem, str]:
    """The file system of a folder that all executors share, and the folder's path in it."""
    if "://" in folder or folder.startswith("file:"):
        folder = re.sub(r"^file:/+", "file:///", folder)
        return files.FileSystem.from_uri(folder)
    return files.LocalFileSystem(), folder


def mapped(folder: str, name: str, dtype: str) -> np.ndarray:
    """A flat file as an array: memory-mapped on a mounted file system, else read."""
    store, root = store_of(folder)
    if isinstance(store, files.LocalFileSystem):
        return np.memmap(f"{root}/{name}", dtype, "r") if os.path.getsize(f"{root}/{name}") else np.zeros(0, dtype)
    with store.open_input_file(f"{root}/{name}") as f:
        return np.frombuffer(f.read(), dtype)


MANIFEST = "part long, name string, n_docs long, n_tokens long, nulls long"


def write(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", path: str | None = None, end: int | None = END, partitions: int | None = None) -> DataFrame:
    """Write a data set into an empty ``folder`` that all executors share; the manifest with its prefix sums. There are as many
    partitions as shuffle partitions, or as asked for."""
    spark = docs.sparkSession
    path = path or public_tokenizers.path(MODEL)
    rows = docs.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).alias("text"))
    rows = rows.withColumns({"h": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    order = [F.col("doc_id").asc_nulls_last(), F.col("h"), F.col("row")]
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    dealt = dealt.select(F.spark_partition_id().cast("long").alias("part"), "doc_id", "text")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        ending = b"" if end is None else np.array([end], encoder.dtype).tobytes()
        width = np.dtype(encoder.dtype).itemsize
        store, root = store_of(folder)
        name, part, n_docs, at, nulls, out = uuid.uuid4().hex, 0, 0, 0, 0, []
        for batch in batches:
            if not batch.num_rows:
                continue
            if not out:
                part = batch["part"][0].as_py()
                out = [store.open_output_stream(f"{root}/{name}.{kind}") for kind in ("ids", "starts", "docs")]
                out[1].write(np.zeros(1, "<u8").tobytes())
            sizes = np.zeros(batch.num_rows, np.uint64)
            for k, t in enumerate(batch["text"]):
                ids = encoder.encode(t.as_py() or "") + ending
                out[0].write(ids)
                sizes[k] = len(ids) // width
            starts = np.uint64(at) + np.cumsum(sizes)
            out[1].write(starts.astype("<u8").tobytes())
            out[2].write(batch["doc_id"].fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            n_docs, at, nulls = n_docs + batch.num_rows, int(starts[-1]), nulls + batch["doc_id"].null_count
        for f in out:
            f.close()
        if out:
            yield pa.RecordBatch.from_pydict({"part": [part], "name": [name], "n_docs": [n_docs], "n_tokens": [at], "nulls": [nulls]})

    store, root = store_of(folder)
    store.create_dir(root, recursive=True)
    dealt.mapInArrow(put, struct_of(MANIFEST)).write.parquet(f"{folder}/parts")
    # one small row per partition meets in one task
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = spark.read.schema(struct_of(MANIFEST)).parquet(f"{folder}/parts")
    sums = {f"{c}_before": F.coalesce(F.sum(c).over(before), F.lit(0)) for c in ("n_docs", "n_tokens")}
    parts.withColumns(sums).coalesce(1).write.parquet(f"{folder}/manifest")
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """A row per partition of a data set: part, name of its files, n_docs, n_tokens, nulls, n_docs_before, n_tokens_before."""
    return spark.read.schema(struct_of(f"{MANIFEST}, n_docs_before long, n_tokens_before long")).parquet(f"{folder}/manifest")


def _each(spark: SparkSession, folder: str, path: str | None, fields: str, one) -> DataFrame:
    """``one(doc_id, start, ids)`` of every document of a data set, a task per partition of it."""
    path = path or public_tokenizers.path(MODEL)
    names = [f.split(" ")[0] for f in fields.split(", ")]
    parts = manifest(spark, folder)
    rows = struct_of(fields)

    def get(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        dtype = encoder_of(path).dtype
        for frame in frames:
            for p in frame.itertuples():
                ids, starts, docs = (mapped(folder, f"{p.name}.{kind}", t) for kind, t in (("ids", dtype), ("starts", "<u8"), ("docs", "<i8")))
                for first in range(0, p.n_docs, BATCH):
                    out = []
                    for k in range(first, min(first + BATCH, p.n_docs)):
                        a, b = int(starts[k]), int(starts[k + 1])
                        out.append(one(None if k >= p.n_docs - p.nulls else int(docs[k]), p.n_tokens_before + a, ids[a:b]))
                    made = pd.DataFrame(out, columns=names)
                    yield made.astype({"doc_id": "Int64"})

    n = max(1, parts.count())
    return parts.repartition(n).mapInPandas(get, rows)


def read(spark: SparkSession, folder: str, path: str | None = None) -> DataFrame:
    """(doc_id, start, ids) of every document of a data set."""
    return _each(spark, folder, path, "doc_id long, start long, ids array<long>", lambda d, start, ids: (d, start, ids.astype(np.int64)))


def digests(spark: SparkSession, folder: str, path: str | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document: the checksum is that of the ids as 32-bit integers."""
    fields = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return _each(spark, folder, path, fields, lambda d, start, ids: (d, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = lineage.scratch(spark)
    write(table(spark, sf_dir, "documents").select("doc_id", "text"), folder)
    return digests(spark, folder)
