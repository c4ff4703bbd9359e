"""Packing along a space-filling curve.

Each document's token ids are hashed into 256 counts; the counts, scaled to
unit length, are projected to three dimensions, squashed to 10 bits each and
given their place on a Hilbert curve.  Documents are range-sorted by that
place, so neighbours have similar vocabularies, and the ids along the curve
are cut every 2048 tokens.  Only the very last sequence can be short.

Cases: a null or empty text is one end id; rows may repeat ids and texts (each
row is packed); null doc_ids are packed like others; an empty table gives no
rows; a document longer than a sequence spans as many as it needs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundstop.llm.chunks import mix, slices, text_buffer
from groundstop.llm.positions import part_starts
from groundstop.llm.tokens import encoder, with_end
from groundstop.session import scratch_path

SEQUENCE = 2048
BUCKETS, DIMS, BITS = 256, 3, 10


def projection(buckets: int = BUCKETS, dims: int = DIMS) -> np.ndarray:
    """Fixed pseudo-random directions, about standard normal."""
    seeds = mix(np.arange(1, buckets * dims * 12 + 1, dtype=np.uint64))
    return (seeds.astype(np.float64) / 2.0**64).reshape(buckets, dims, 12).sum(axis=2) - 6.0


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of integer points (rows) with ``bits`` bits a dimension."""
    x = cells.astype(np.int64).copy()
    n = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:  # undo the rotations and reflections of each level, from the coarsest
        p = q - 1
        for i in range(n):
            high = (x[:, i] & q) != 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & p)
            x[:, 0] ^= np.where(high, p, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, n):  # Gray code
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[:, n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


def curve_places(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Hilbert key of each document's hashed vector."""
    owner = np.repeat(np.arange(len(counts)), counts)
    bucket = (mix(ids.astype(np.uint64) + np.uint64(1)) % np.uint64(BUCKETS)).astype(np.int64)
    vector = np.bincount(owner * BUCKETS + bucket, minlength=len(counts) * BUCKETS).reshape(len(counts), BUCKETS).astype(np.float64)
    vector /= np.maximum(np.sqrt((vector**2).sum(axis=1, keepdims=True)), 1e-12)
    squashed = 1 / (1 + np.exp(-1.7 * (vector @ projection())))
    return hilbert_key(np.minimum((squashed * (1 << BITS)).astype(np.int64), (1 << BITS) - 1))


def encode(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(doc_id, row, place, n, ids): ids as little-endian bytes, two each if all of a chunk fit, else four; ``row`` tells rows apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 40
        for batch in batches:
            for some in slices(batch, "text", 4 << 20):
                ids, counts = with_end(*encoder(tokenizer).encode(*text_buffer(some.column(1))), end_id)
                places = curve_places(ids, counts)
                ids = ids.astype("<u2" if ids.max() < 1 << 16 else "<u4")
                off = np.concatenate([[0], np.cumsum(counts)]) * ids.itemsize
                raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(ids)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(np.arange(at, at + len(counts))), pa.array(places), pa.array(counts), raw], ["doc_id", "row", "place", "n", "ids"])
                at += len(counts)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, row long, place long, n long, ids binary")


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, total = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.column(1).to_numpy()
        ends = total + np.cumsum(n)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.full(len(n), part, np.int64)), pa.array(ends - n)], ["row", "n", "part", "local"])
        total = int(ends[-1]) if len(n) else total


def starts_along_curve(encoded: DataFrame) -> DataFrame:
    """(row, begin): the ids before each row along the curve; only row, place and n are moved."""
    spark = encoded.sparkSession
    out = scratch_path(spark, "curve-order")
    (encoded.select("row", "n", "place").repartitionByRange("place", "row").sortWithinPartitions("place", "row")
     .select("row", "n").mapInArrow(_running, "row long, n long, part long, local long").write.parquet(out))
    order = spark.read.parquet(out)
    return order.join(part_starts(order.select("part", "n"), "n"), "part").select("row", (F.col("part_start") + F.col("local")).alias("begin"))


def pieces(encoded: DataFrame, sequence: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """The pieces that the sequences are made of, one row each, with their ids if wanted.

    (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids])
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, n = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            count = (begin + n - 1) // sequence - begin // sequence + 1
            doc = np.repeat(np.arange(len(n)), count)
            seq = begin[doc] // sequence + np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            low = np.maximum(begin[doc], seq * sequence)
            start = low - begin[doc]
            length = np.minimum(begin[doc] + n[doc], (seq + 1) * sequence) - low
            raws = [np.frombuffer(b.as_buffer(), f"<u{len(b.as_buffer()) // k}") for b, k in zip(batch.column(3), n.tolist(), strict=True)]
            spans = [raws[d][a:a + k].astype("<u4").tobytes() for d, a, k in zip(doc.tolist(), start.tolist(), length.tolist(), strict=True)]
            columns = [batch.column(0).take(pa.array(doc)), pa.array(start), pa.array(length), pa.array([zlib.crc32(s) for s in spans], pa.int64()), pa.array(n[doc]), pa.array(seq), pa.array(low - seq * sequence)]
            if with_ids:
                columns.append(pa.array(spans, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    rows = encoded.join(starts_along_curve(encoded), "row").select("doc_id", "begin", "n", "ids")
    return rows.mapInArrow(cut, ", ".join(f"{c} {'binary' if c == 'ids' else 'long'}" for c in names))


def pack(docs: DataFrame, tokenizer: str, end_id: int, sequence: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """Encode, store and pack the documents; see ``pieces`` for the columns."""
    spark = docs.sparkSession
    out = scratch_path(spark, "packed-ids")
    encode(docs, tokenizer, end_id).write.parquet(out)
    return pieces(spark.read.parquet(out), sequence, with_ids)


def sequences(packed: DataFrame, pad_id: int, sequence: int = SEQUENCE) -> DataFrame:
    """(sequence_id, ids): whole sequences from pieces with ids, padded unless their length is a power of two."""
    def join(table: pa.Table) -> pa.Table:
        order = np.argsort(table["offset"].to_numpy())
        raw = b"".join(table["ids"][int(i)].as_py() for i in order)
        n = len(raw) // 4
        if n & (n - 1):
            raw += np.full(sequence - n, pad_id, "<u4").tobytes()
        return pa.table({"sequence_id": table["sequence_id"][:1], "ids": pa.array([raw], pa.binary())})

    return packed.select("sequence_id", "offset", "ids").groupBy("sequence_id").applyInArrow(join, "sequence_id long, ids binary")
