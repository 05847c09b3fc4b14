"""Ids seen so far, for dropping re-deliveries of any age: buckets of ids with a Bloom filter each.

``ids/segment=n/id_bucket=b`` has the ids that came new in micro-batch n, cut by hash into buckets, and
``filters/version=n`` one row per bucket of it with a Bloom filter of those ids. A new micro-batch is held against the
filters first; only buckets that may hold one of its ids are read, and there the ids themselves are compared. So a
stream of new ids reads filters (ten bits an id) and few ids, and no state store has to hold all of them.

A segment counts once its filters are listed, which is done last; a repeated micro-batch doesn't see its own segment and
replaces it. ``merge`` rolls segments into one. There is one writer at a time. A bucket's hashes and filters meet in one task:
they are spread by hash, so none is hot, and ``buckets`` should leave each some million ids.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import lineage
from tidemark.sinks import writers

BITS_PER_ID, PROBES, LEAST_BYTES = 10, 7, 32
_SEGMENT, _BUCKET = "segment", "id_bucket"
FILTER = "segment bigint, id_bucket int, id_count bigint, filter binary"
MAYBE = "segment bigint, id_bucket int, h bigint"


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bits of each hash, one row per probe: double hashing by the two halves."""
    h = hashes.astype(np.int64).view(np.uint64)
    low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return (low + np.arange(PROBES, dtype=np.uint64)[:, None] * high) % np.uint64(bits)


def bloom(hashes: np.ndarray) -> bytes:
    bits = np.zeros(8 * max(LEAST_BYTES, math.ceil(len(hashes) * BITS_PER_ID / 8)), bool)
    bits[_places(hashes, len(bits)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def may_hold(filter_: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the filter may hold; those it was built from always."""
    packed = np.frombuffer(filter_, np.uint8)
    at = _places(hashes, 8 * len(packed)).astype(np.int64)
    return ((packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(0)


class SeenIds:
    """The ids under ``root`` of a stream identified by ``column``. ``buckets`` stays as it was at the first use."""

    def __init__(self, spark: SparkSession, root: str, column: str, buckets: int = 64):
        there = [n for n, _ in lineage.numbered_folders(spark, root, "buckets")]
        if there and there != [buckets]:
            raise ValueError(f"the ids under {root} are in {there[0]} buckets")
        self.spark, self.column, self.buckets = spark, column, buckets
        self.root = f"{root.rstrip('/')}/buckets={buckets}"
        #: (segment, bucket) pairs that the last ``unseen`` has read ids from
        self.opened: list[tuple[int, int]] = []

    def _id(self) -> Column:
        return F.col(f"`{self.column}`")

    def _bucket(self) -> Column:
        return F.pmod("h", F.lit(self.buckets)).cast("int").alias(_BUCKET)

    def _listed(self, kind: str) -> list[int]:
        """Numbers that count: one small row per micro-batch."""
        if writers.latest_version(self.spark, f"{self.root}/{kind}") is None:
            return []
        log = self.spark.read.schema("version long").parquet(f"{self.root}/{kind}/log")
        return sorted(r[0] for r in log.distinct().collect())

    def _parts(self) -> tuple[int | None, list[int]]:
        """The last merge, and the segments after it."""
        merged = max(self._listed("merged"), default=None)
        return merged, [n for n in self._listed("filters") if merged is None or n > merged]

    def filters(self) -> DataFrame:
        """A row per segment and bucket: those of the last merge and of the segments after it."""
        merged, segments = self._parts()
        paths = [f"{self.root}/filters/version={n}" for n in segments] + ([] if merged is None else [f"{self.root}/merged/version={merged}"])
        return self.spark.read.schema(FILTER).parquet(*paths) if paths else self.spark.createDataFrame([], FILTER)

    def _maybe(self, candidates: DataFrame, filters: DataFrame) -> DataFrame:
        """(segment, id_bucket, h) of the candidates (h, id_bucket) that a filter may hold."""

        def test(hashes: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
            h = hashes["h"].to_numpy(np.int64)
            out = [pd.DataFrame({_SEGMENT: r.segment, _BUCKET: r.id_bucket, "h": h[may_hold(r.filter, h)]}) for r in known.itertuples()] if len(h) else []
            return pd.concat(out) if out else pd.DataFrame({_SEGMENT: [], _BUCKET: [], "h": []}, dtype=np.int64)

        test.__annotations__ = {"hashes": pd.DataFrame, "known": pd.DataFrame, "return": pd.DataFrame}
        return candidates.groupBy(_BUCKET).cogroup(filters.groupBy(_BUCKET)).applyInPandas(test, MAYBE)

    def unseen(self, batch: DataFrame, segment: int) -> DataFrame:
        """The rows of a micro-batch whose id is in no segment before this one, one row per id. Rows without an id stay."""
        self.spark = batch.sparkSession
        named, unnamed = batch.where(self._id().isNotNull()), batch.where(self._id().isNull())
        ids = named.select(F.xxhash64(self._id()).alias("h")).distinct().select("h", self._bucket())
        place = lineage.scratch(self.spark)
        self._maybe(ids, self.filters().where(F.col(_SEGMENT) < segment)).write.parquet(place)
        maybe = self.spark.read.schema(MAYBE).parquet(place)
        # a small row for each bucket that has to be opened
        self.opened = sorted(tuple(r) for r in maybe.select(_SEGMENT, _BUCKET).distinct().collect())
        if self.opened:
            merged, _ = self._parts()
            folders = [(f"merged_ids/version={n}" if n == merged else f"ids/{_SEGMENT}={n}", b) for n, b in self.opened]
            ids_there = self.spark.read.parquet(*[f"{self.root}/{f}/{_BUCKET}={b}" for f, b in folders])
            known = ids_there.join(maybe.select("h").distinct(), "h", "left_semi").select(F.col("id").alias("__id"))
            named = named.join(known, self._id() == F.col("__id"), "left_anti")
        return named.dropDuplicates([self.column]).unionByName(unnamed)

    def add(self, rows: DataFrame, segment: int) -> None:
        """Keep the ids of rows as the segment of this number; one that is there is replaced."""
        self.spark = rows.sparkSession
        ids = rows.where(self._id().isNotNull()).select(self._id().alias("id"), F.xxhash64(self._id()).alias("h")).distinct()
        self._write(ids, f"ids/{_SEGMENT}={segment}", "filters", segment)

    def _write(self, ids: DataFrame, folder: str, kind: str, number: int) -> None:
        path = f"{self.root}/{folder}"
        writers.overwrite(ids.withColumn(_BUCKET, self._bucket()), path, partition_by=[_BUCKET])

        def build(key: tuple, hashes: pd.DataFrame) -> pd.DataFrame:
            h = hashes["h"].to_numpy(np.int64)
            return pd.DataFrame({_SEGMENT: [number], _BUCKET: [key[0]], "id_count": [len(h)], "filter": [bloom(h)]})

        build.__annotations__ = {"key": tuple, "hashes": pd.DataFrame, "return": pd.DataFrame}
        written = self.spark.read.schema("h bigint, id_bucket int").parquet(path)
        writers.write_version(written.groupBy(_BUCKET).applyInPandas(build, FILTER), f"{self.root}/{kind}", number)

    def merge(self) -> int | None:
        """Roll the segments into one, but for the last one, whose micro-batch may be repeated. Returns the last segment rolled
        in. What the merge before has covered is removed; what this one covers stays for reads that have begun."""
        before, segments = self._parts()
        if len(segments) < 2:
            return before
        upto = segments[-2]
        paths = [f"{self.root}/ids/{_SEGMENT}={n}" for n in segments[:-1]] + ([] if before is None else [f"{self.root}/merged_ids/version={before}"])
        paths = [p for p in paths if lineage.numbered_folders(self.spark, p, _BUCKET)]
        if not paths:
            return before  # no ids yet
        ids = self.spark.read.option("recursiveFileLookup", True).parquet(*paths).select("id", "h")
        self._write(ids, f"merged_ids/version={upto}", "merged", upto)
        if before is not None:
            for name, kind, keep in (("ids", _SEGMENT, before + 1), ("filters", "version", before + 1), ("merged_ids", "version", before), ("merged", "version", before)):
                for number, path in lineage.numbered_folders(self.spark, f"{self.root}/{name}", kind):
                    if number < keep:
                        lineage.remove(self.spark, path)
        return upto
