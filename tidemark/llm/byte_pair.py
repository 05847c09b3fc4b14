"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token's bytes are a linked list. For every merge rank there is a bucket of list places where a pair of that
rank stands, and a bitmap of three levels says which buckets hold anything; find-first-set on each level gives the
lowest rank. Within a bucket places come in order, so the leftmost pair is merged first. Places whose pair has
changed since are stale and skipped. A merge costs a few operations whatever the length, so a pre-token of a
million bytes takes time in proportion to its length.

Texts are encoded row by row within Spark's tasks; the ids of pre-tokens already seen are kept up to a bound.

Defined results: a null or empty text has no tokens; texts are encoded whole; repeated rows give equal rows; an empty
table gives no rows; ``encode`` and ``decode`` leave
other columns as they are but for the named new one.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import struct
import sys
import types

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.llm.common import per_text, quoted, table

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Bytes of a short pre-token: merged with bitmaps of places, and kept. Pre-tokens whose ids a task keeps: twice KEPT.
SHORT, KEPT = 64, 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


class RankQueue:
    """Places by rank, lowest rank and then lowest place first."""

    def __init__(self):
        self.buckets: dict[int, list[int]] = {}
        self.top, self.middle, self.low = 0, {}, {}

    def put(self, rank: int, place: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            heapq.heappush(bucket, place)
            return
        self.buckets[rank] = [place]
        a, b = rank >> 6, rank >> 12
        self.low[a] = self.low.get(a, 0) | 1 << (rank & 63)
        self.middle[b] = self.middle.get(b, 0) | 1 << (a & 63)
        self.top |= 1 << b

    def take(self) -> tuple[int, int] | None:
        if not self.top:
            return None
        b = (self.top & -self.top).bit_length() - 1
        word = self.middle[b]
        a = b << 6 | (word & -word).bit_length() - 1
        word = self.low[a]
        rank = a << 6 | (word & -word).bit_length() - 1
        bucket = self.buckets[rank]
        place = heapq.heappop(bucket)
        if not bucket:
            del self.buckets[rank]
            self.low[a] &= ~(1 << (rank & 63))
            if not self.low[a]:
                self.middle[b] &= ~(1 << (a & 63))
                if not self.middle[b]:
                    self.top &= ~(1 << b)
        return rank, place


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    after, before, ends = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    pair: list[int | None] = [ranks.get(piece[k : k + 2]) for k in range(n - 1)] + [None]
    queue = RankQueue()
    for k, rank in enumerate(pair):
        if rank is not None:
            queue.put(rank, k)
    while (first := queue.take()) is not None:
        rank, k = first
        if pair[k] != rank:
            continue  # stale
        gone = after[k]
        ends[k], after[k], pair[gone] = ends[gone], after[gone], None
        if after[k] < n:
            before[after[k]] = k
        for start in (k, before[k]):
            if start < 0:
                continue
            follower = after[start]
            pair[start] = new = ranks.get(piece[start : ends[follower]]) if follower < n else None
            if new is not None:
                queue.put(new, start)
    out, k = [], 0
    while k < n:
        out.append(ranks[piece[k : ends[k]]])
        k = after[k]
    return out


_AFTER, _BEFORE = list(range(1, SHORT + 1)), list(range(-1, SHORT))


def merge_short(piece: bytes, ranks: dict[bytes, int], pairs: list[int], buckets: list[int], low: list[int]) -> list[int]:
    """The same for at most ``SHORT`` bytes: the buckets are bitmaps of places, in a list by rank, under a rank bitmap of
    two levels of 256 bits. ``pairs`` has the rank of two bytes, or -1. The lists are used again and again: all zero
    before and after."""
    if piece in ranks:
        return [ranks[piece]]
    get, n = ranks.get, len(piece)
    after, ends, before = _AFTER[:n], _AFTER[:n], _BEFORE[:n]
    pair = [pairs[a << 8 | b] for a, b in zip(piece, piece[1:])]
    top, bit = 0, 1
    for rank in pair:
        if rank >= 0:
            places = buckets[rank]
            if not places:
                a = rank >> 8
                low[a] |= 1 << (rank & 255)
                top |= 1 << a
            buckets[rank] = places | bit
        bit <<= 1
    pair.append(-1)
    while top:
        a = (top & -top).bit_length() - 1
        word = low[a]
        rank = (a << 8) + (word & -word).bit_length() - 1
        places = buckets[rank]
        bit = places & -places
        buckets[rank] = places = places ^ bit
        if not places:
            low[a] = word = word & (word - 1)
            if not word:
                top &= top - 1
        k = bit.bit_length() - 1
        if pair[k] != rank:
            continue  # stale
        gone = after[k]
        end = ends[k] = ends[gone]
        follower = after[k] = after[gone]
        pair[gone] = pair[k] = -1
        if follower < n:
            before[follower] = k
            new = get(piece[k : ends[follower]])
            if new is not None:
                pair[k] = new
                places = buckets[new]
                if not places:
                    a = new >> 8
                    low[a] |= 1 << (new & 255)
                    top |= 1 << a
                buckets[new] = places | bit
        start = before[k]
        if start >= 0:
            new = get(piece[start:end])
            if new is None:
                pair[start] = -1
            else:
                pair[start] = new
                places = buckets[new]
                if not places:
                    a = new >> 8
                    low[a] |= 1 << (new & 255)
                    top |= 1 << a
                buckets[new] = places | 1 << start
    out, k = [], 0
    while k < n:
        out.append(ranks[piece[k : ends[k]]])
        k = after[k]
    return out


class Codec:
    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.bytes_of = {v: k for k, v in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        size = max(self.ranks.values(), default=0) + 1
        self.buckets, self.low = [0] * size, [0] * (size // 256 + 1)
        self.pairs = [self.ranks.get(bytes((a, b)), -1) for a in range(256) for b in range(256)]
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def piece(self, text: str) -> bytes:
        """Ids of a pre-token that isn't among those met lately."""
        ids = self.older.get(text)
        if ids is None:
            raw = text.encode("utf-8", "surrogatepass")
            if len(raw) > SHORT:
                return np.array(merge(raw, self.ranks), "<u4").tobytes()
            found = merge_short(raw, self.ranks, self.pairs, self.buckets, self.low)
            ids = struct.pack(f"<{len(found)}I", *found)
        if len(self.kept) >= KEPT:
            self.older, self.kept = self.kept, {}
        self.kept[text] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        kept, out = self.kept, []
        for p in self.pattern.findall(text):
            ids = kept.get(p)
            if ids is None:
                ids = self.piece(p)
                kept = self.kept
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def codec_of(path: str, pattern: str) -> Codec:
    """The codec of this Python process: workers go from task to task, and so do the ids they keep."""
    module = sys.modules.setdefault("_kept_codecs", types.ModuleType("_kept_codecs"))
    codecs = module.__dict__.setdefault("codecs", {})
    if (path, pattern) not in codecs:
        codecs[path, pattern] = Codec(path, pattern)
    return codecs[path, pattern]


def per_codec(fn, fields: str, path: str, pattern: str):
    """A pandas UDF of texts whose function gets the codec."""
    return per_text(lambda text: fn(codec_of(path, pattern), text), fields)


def ids_of(codec: Codec, text: str) -> tuple:
    return (np.frombuffer(codec.encode(text), "<u4").astype(np.int64),)


def digest(codec: Codec, text: str) -> tuple:
    ids = codec.encode(text)
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest()


def encode(docs: DataFrame, out: str = "ids", text: str = "text", path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """The documents with their token ids, an array of longs, in a column ``out``."""
    path = path or public_tokenizers.path(RANKS)
    return docs.withColumn(out, per_codec(ids_of, "ids array<long>", path, pattern)(quoted(text))["ids"])


def decode(docs: DataFrame, ids: str, out: str = "decoded", path: str | None = None) -> DataFrame:
    """The documents with the text of a column of token ids, in a column ``out``; null ids give null."""
    path = path or public_tokenizers.path(RANKS)
    made: list[dict[int, bytes]] = []

    def run(arrays):
        if not made:
            made.append({v: k for k, v in read_ranks(path).items()})
        return arrays.map(lambda a: None if a is None else b"".join(made[0][int(k)] for k in a).decode("utf-8", "replace"))

    run.__annotations__ = {"arrays": pd.Series, "return": pd.Series}
    return docs.withColumn(out, F.pandas_udf(run, StringType())(quoted(ids)))


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Per document: its id, the number of tokens, and the hashes of the ids and of the bytes they decode to."""
    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    coded = docs.select(quoted(doc_id).alias("doc_id"), per_codec(digest, fields, path or public_tokenizers.path(RANKS), pattern)(quoted(text)).alias("d"))
    return coded.select("doc_id", "d.*")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: the encoded documents."""
    return digests(docs)
