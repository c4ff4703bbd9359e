"""Questions from chunks of documents to shards of a distributed table, and answers back.

Four stages.  ``packed`` cuts the documents into chunks (*runs*) and stores
every chunk, compressed, as one row with its number.  ``send`` lets every
run send one sorted, distinct, packed message to each shard of a key space.
``answer`` brings a shard's messages together; a shard sees each key at most
once per run however often it occurs, so hot keys arrive pre-aggregated.
``finish`` brings each run together with its answers and goes on with whole
texts.

A run's number is stored with its texts and read back everywhere, so nothing
depends on how a later scan is split, on the number of executors, or on a
task that runs again.

Rows that move are packed byte strings, so hundreds of millions of keys cost
neither a row each nor a place on the driver.  The number of shards grows
with the corpus (``shard_bits``), so a shard's messages stay near the size
of a chunk.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundstop.llm.chunks import CHUNK_BYTES, slices
from groundstop.session import scratch_path

#: Bytes of text for which one shard is planned.
SHARD_BYTES = 8 << 20
#: Compression level of the texts that move to their answers.
TEXT_LEVEL = 5


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """A stored copy of ``docs`` with a row number, and the name of its column (one that ``docs`` does not have)."""
    out, row = scratch_path(docs.sparkSession, "numbered"), f"row_{uuid.uuid4().hex}"
    docs.withColumn(row, F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(out)
    return docs.sparkSession.read.parquet(out), row


def shard_bits(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> int:
    """Bits of a key that name its shard, from the size of all texts."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, (max(1, total // shard_bytes) - 1).bit_length())


def squeeze(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(raw)


def expand(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def pack_arrays(*arrays: np.ndarray) -> bytes:
    """Arrays of any kinds as one compressed byte string."""
    head = np.array([len(arrays), *(a.nbytes for a in arrays)], "<i8")
    return squeeze(head.tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


def unpack_arrays(blob: bytes, *kinds: str) -> list[np.ndarray]:
    raw = expand(blob)
    sizes = np.frombuffer(raw, "<i8", 1 + len(kinds))[1:]
    at, out = 8 * (1 + len(kinds)), []
    for kind, size in zip(kinds, sizes.tolist(), strict=True):
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def low_bytes(values: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` low bytes of 64-bit values, side by side."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width])


def from_low_bytes(raw: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = raw.reshape(-1, width)
    return out.view("<u8").ravel()


MESSAGES = "run long, shard long, blob binary"


def message_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    run, shard, blob = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(run, pa.int64()), pa.array(shard, pa.int64()), pa.array(blob, pa.binary())], ["run", "shard", "blob"])


#: Shard number of a run's own chunk.
CHUNK = -1


def packed(docs: DataFrame, columns: list[str], limit: int = CHUNK_BYTES) -> DataFrame:
    """Stored chunks (run, shard, blob) of ``docs``; a chunk has the named columns, ``text`` among them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for some in slices(batch, "text", limit):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, some.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=TEXT_LEVEL))) as writer:
                    writer.write_batch(pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in some.columns], schema=some.schema))
                yield message_batch([(number, CHUNK, sink.getvalue().to_pybytes())])
                number += 1

    out = scratch_path(docs.sparkSession, "chunks")
    docs.select(*columns).mapInArrow(run, MESSAGES).write.option("compression", "uncompressed").parquet(out)
    return docs.sparkSession.read.parquet(out)


def opened(blob: pa.Scalar) -> pa.RecordBatch:
    return pa.ipc.open_stream(blob.as_buffer()).read_next_batch()


def send(chunks: DataFrame, make: Callable[[pa.RecordBatch], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """Messages (run, shard, blob) that ``make`` yields for every chunk."""
    def run(batches):
        for batch in batches:
            for number, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield message_batch([(number, shard, b) for shard, b in make(opened(blob))])

    return chunks.select("run", "blob").mapInArrow(run, MESSAGES)


def answer(messages: DataFrame, reply: Callable[[int, list[int], list[bytes]], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """Answers (run, shard, blob): ``reply(shard, runs, blobs)`` yields (run, blob) with the shard's messages in run order."""
    def run(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        order = np.argsort(table["run"].to_numpy(), kind="stable")
        runs = table["run"].to_numpy()[order].tolist()
        blobs = [table["blob"][int(i)].as_py() for i in order]
        return pa.Table.from_batches([message_batch([(r, shard, b) for r, b in reply(shard, runs, blobs)])])

    return messages.groupBy("shard").applyInArrow(run, MESSAGES)


def finish(chunks: DataFrame, answers: DataFrame, work: Callable[[int, pa.RecordBatch, dict[int, bytes]], list[pa.RecordBatch]], schema: str) -> DataFrame:
    """Rows that ``work(run, chunk, answers by shard)`` makes of every chunk and its answers."""
    def run(table: pa.Table) -> pa.Table:
        chunk, got = None, {}
        for shard, blob in zip(table["shard"].to_pylist(), table["blob"], strict=True):
            if shard == CHUNK:
                chunk = opened(blob)
            else:
                got[shard] = blob.as_py()
        return pa.Table.from_batches(work(table["run"][0].as_py(), chunk, got))

    return chunks.union(answers.select("run", "shard", "blob")).groupBy("run").applyInArrow(run, schema)
