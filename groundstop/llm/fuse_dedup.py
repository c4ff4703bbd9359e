"""Exact deduplication with static binary-fuse filters over immutable snapshots.

A snapshot's distinct digests are dealt to buckets by their leading bits and
each bucket gets a 3-wise binary fuse filter of 8-bit fingerprints (about 9
bits a digest), built once and stored.  An incoming batch is grouped by
itself; its distinct digests are screened by the filter of their bucket, and
only the positives join the snapshot's exact digests.  All rows that the
digests call equal are then grouped by their normalised bytes, so a digest
collision cannot join different texts.

Texts are equal when identical after removing ``[\\x20\\x09-\\x0D]``.  Of equal
texts the row with the most code points in the original, then the smallest
doc_id, stays.

Cases: a null text is an empty one, and empty texts are equal to each other;
a null doc_id is larger than any other; of rows that tie in all of this
exactly one is kept (the first in the stored table of repeated rows); an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundstop.llm import exchange
from groundstop.llm.chunks import SPACE, mix, slices, text_buffer
from groundstop.session import scratch_path, scratch_scope

#: Digests that one filter should hold, about.
FILTER_KEYS = 50_000
#: Digest bytes kept (32: all of SHA-256; tests shorten it to force collisions).
DIGEST_BYTES = 32
#: Repeated digests are broadcast up to this many bytes (counted first); beyond it the texts are shuffled to them.
BROADCAST_BYTES = 32 << 20


class FuseFilter:
    """3-wise binary fuse filter with 8-bit fingerprints over distinct 64-bit keys."""

    def __init__(self, seed: int, segment: int, segments: int, cells: np.ndarray):
        self.seed, self.segment, self.segments, self.cells = seed, segment, segments, cells

    @staticmethod
    def _places(keys: np.ndarray, seed: int, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
        h = mix(keys + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64)))
        mask = np.uint64(segment - 1)
        a = ((h >> np.uint64(32)) * np.uint64(segment * segments)) >> np.uint64(32)
        b = (a + np.uint64(segment)) ^ ((h >> np.uint64(18)) & mask)
        c = (a + np.uint64(2 * segment)) ^ (h & mask)
        return np.stack([a, b, c], axis=1).astype(np.int64), (h ^ (h >> np.uint64(32))).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> "FuseFilter":
        keys = np.unique(keys)
        n = len(keys)
        if n == 0:
            return cls(0, 1, 1, np.zeros(0, np.uint8))
        segment = 1 << min(18, int(math.floor(math.log(n) / math.log(3.33) + 2.25)))
        factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
        segments = max(1, -(-int(round(n * factor)) // segment) - 2)
        for seed in range(1, 200):
            places, prints = cls._places(keys, seed, segment, segments)
            order = cls._peel(places, (segments + 2) * segment)
            if order is not None:
                cells = np.zeros((segments + 2) * segment, np.uint8)
                for key, cell in reversed(order):  # the keys of a round own their cells alone
                    cells[cell] = 0
                    cells[cell] = prints[key] ^ np.bitwise_xor.reduce(cells[places[key]], axis=1)
                return cls(seed, segment, segments, cells)
            segments += 1 + segments // 8
        raise RuntimeError("no filter found for these keys")

    @staticmethod
    def _peel(places: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Rounds of (keys, cells) such that each key is alone in its cell once earlier rounds are gone."""
        n = len(places)
        degree = np.bincount(places.ravel(), minlength=size)
        held = np.zeros(size, np.int64)  # xor of the keys in a cell: the key itself where the degree is one
        np.bitwise_xor.at(held, places.ravel(), np.repeat(np.arange(n), 3))
        rounds, left, cells = [], n, np.flatnonzero(degree == 1)
        while len(cells):
            keys, first = np.unique(held[cells], return_index=True)
            cells = cells[first]
            rounds.append((keys, cells))
            left -= len(keys)
            touched = places[keys].ravel()
            np.subtract.at(degree, touched, 1)
            np.bitwise_xor.at(held, touched, np.repeat(keys, 3))
            cells = np.unique(touched)
            cells = cells[degree[cells] == 1]
        return rounds if left == 0 else None

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        if len(self.cells) == 0:
            return np.zeros(len(keys), bool)
        places, prints = self._places(keys, self.seed, self.segment, self.segments)
        return np.bitwise_xor.reduce(self.cells[places], axis=1) == prints


def normalised(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes without white space, their row offsets, code points of each original text)."""
    data, off = text_buffer(texts)
    keep = ~SPACE[data]
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    kept = np.concatenate([[0], np.cumsum(keep)])
    return data[keep], kept[off], np.diff(points[off])


def _scan(docs: DataFrame, digest_bytes: int, row: str | None, texts: bool) -> DataFrame:
    """(doc_id, points, digest, sha, row) of every row, and with ``texts`` its normalised bytes; ``row`` is the named column, or null."""
    kinds = "doc_id long, points long, digest binary, sha string, row long" + (", normal binary" if texts else "")
    names = [k.split(" ")[0] for k in kinds.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch):
                data, off, points = normalised(some.column(1))
                raw, cut = data.tobytes(), off.tolist()
                view = memoryview(raw)
                sha = [hashlib.sha256(view[a:b]).digest() for a, b in zip(cut[:-1], cut[1:], strict=True)]
                columns = [some.column(0), pa.array(points), pa.array([s[:digest_bytes] for s in sha], pa.binary()), pa.array([s.hex() for s in sha], pa.string()), some.column(2)]
                if texts:
                    columns.append(pa.array([raw[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select("doc_id", "text", (F.col(row) if row else F.lit(None)).cast("long").alias("row")).mapInArrow(run, kinds)


def _key64(digest: pa.ChunkedArray) -> np.ndarray:
    return np.array([int.from_bytes(d.as_py()[:8], "big") for d in digest], np.uint64)


def build_filters(digests: DataFrame) -> DataFrame:
    """(bucket, seed, segment, segments, cells): one filter per bucket of a snapshot's distinct digests."""
    def build(table: pa.Table) -> pa.Table:
        f = FuseFilter.build(_key64(table["digest"]))
        return pa.table({"bucket": table["bucket"][:1], "seed": [f.seed], "segment": [f.segment], "segments": [f.segments], "cells": pa.array([f.cells.tobytes()], pa.binary())})

    return digests.groupBy("bucket").applyInArrow(build, "bucket long, seed long, segment long, segments long, cells binary")


def screen(incoming: DataFrame, filters: DataFrame) -> DataFrame:
    """The incoming distinct digests that their bucket's filter may hold."""
    def test(keys: pa.Table, built: pa.Table) -> pa.Table:
        if built.num_rows == 0 or keys.num_rows == 0:
            return keys.select(["bucket", "digest"]).slice(0, 0)
        f = FuseFilter(*(built[c][0].as_py() for c in ("seed", "segment", "segments")), np.frombuffer(built["cells"][0].as_py(), np.uint8))
        return keys.select(["bucket", "digest"]).filter(pa.array(f.may_hold(_key64(keys["digest"]))))

    return incoming.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(test, "bucket long, digest binary")


def dedup(docs: DataFrame, incoming: str = "pmod(xxhash64(doc_id), 2) = 1", digest_bytes: int = DIGEST_BYTES, filter_keys: int = FILTER_KEYS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs``.

    Rows for which the SQL condition ``incoming`` holds are the new batch, the
    others the snapshot.
    """
    return _decisions(docs, incoming, digest_bytes, filter_keys).drop("row")


def keep_one(docs: DataFrame, incoming: str = "pmod(xxhash64(doc_id), 2) = 1") -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay."""
    rows, row = exchange.numbered(docs)
    gone = _decisions(rows, incoming, DIGEST_BYTES, FILTER_KEYS, row).where("NOT kept").select(F.col("row").alias(row))
    return rows.join(gone, row, "left_anti").drop(row)


def _decisions(docs: DataFrame, incoming: str, digest_bytes: int, filter_keys: int, row: str | None = None) -> DataFrame:
    """What ``dedup`` returns, and the value of the column ``row``, stored; what it was made from goes."""
    out = scratch_path(docs.sparkSession, "exact-decisions")
    with scratch_scope(docs.sparkSession):
        _decided(docs, incoming, digest_bytes, filter_keys, row).write.parquet(out)
    return docs.sparkSession.read.parquet(out)


def _decided(docs: DataFrame, incoming: str, digest_bytes: int, filter_keys: int, row: str | None) -> DataFrame:
    spark = docs.sparkSession
    base = scratch_path(spark, "exact-dedup")
    _scan(docs, digest_bytes, row, False).withColumn("new", F.coalesce(F.expr(incoming), F.lit(False))).write.parquet(f"{base}/digests")
    rows = spark.read.parquet(f"{base}/digests")
    buckets = max(1, rows.count() // filter_keys)
    bucket = F.pmod(F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long"), F.lit(buckets)).alias("bucket")

    def distinct(side: DataFrame) -> DataFrame:
        return side.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).withColumn("bucket", bucket)

    old, new = distinct(rows.where(~F.col("new"))), distinct(rows.where("new"))
    build_filters(old.select("bucket", "digest")).write.parquet(f"{base}/filters")
    positives = screen(new, spark.read.parquet(f"{base}/filters"))
    repeated = (
        old.where("n > 1").select("digest")
        .union(new.where("n > 1").select("digest"))
        .union(positives.join(old.select("digest"), "digest", "left_semi").select("digest"))
        .distinct())
    repeated.write.parquet(f"{base}/repeated")
    repeated = spark.read.parquet(f"{base}/repeated")
    if repeated.count() * (digest_bytes + 32) <= BROADCAST_BYTES:  # then only the texts that repeat move
        repeated = F.broadcast(repeated)

    # Byte check: texts of the rows whose digests repeat, grouped by the bytes themselves.
    members = _scan(docs, digest_bytes, row, True).join(repeated, "digest", "left_semi")
    members.withColumn("at", F.monotonically_increasing_id()).write.parquet(f"{base}/members")
    members = spark.read.parquet(f"{base}/members")
    best = F.max(F.struct("points", F.col("doc_id").isNotNull().alias("known"), (-F.col("doc_id")).alias("back"), (-F.col("at")).alias("at")))
    groups = members.groupBy("digest", "normal").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
    groups.select("digest", F.sha2("normal", 512).alias("print"), "best", "group_size").write.parquet(f"{base}/groups")
    groups = spark.read.parquet(f"{base}/groups")
    settled = members.select("doc_id", "digest", F.sha2("normal", 512).alias("print"), "sha", "row", "at").join(groups, ["digest", "print"]).select(
        "doc_id", (-F.col("best.back")).alias("keep_id"), "group_size", (F.col("at") == -F.col("best.at")).alias("kept"), F.col("sha").alias("text_sha256"), "row")
    single = rows.join(repeated, "digest", "left_anti").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"), "row")
    return settled.union(single)
