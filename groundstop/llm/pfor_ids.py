"""Token-id files in patched frame-of-reference blocks.

A file holds the ids of consecutive documents.  Its ids are cut into blocks
of 256.  A block stores its minimum, and the differences from it packed at
the least width that holds a given share of them (a percentile); the
differences that do not fit go, whole, into the block's exception list.  An
index of block starts, running exception counts and document lengths allow a
reader to decode any block or document alone.

    magic "PFI1", blocks, ids, documents, exceptions, packed bytes   header, 6 x uint64
    minimum uint32 | width uint8 | first exception uint32 | start uint64     per block
    place in block uint8 | difference uint32                                 per exception
    ids uint32 | doc_id int64 | has doc_id uint8                             per document
    packed differences

Files travel as binary rows of a Parquet table below the checkpoint folder,
so any store that Spark reads can hold them.

Cases: a null or empty text has only its end id; null doc_ids come first,
rows with the same doc_id follow in the order of a hash of the text; an
empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundstop.llm.chunks import slices, text_buffer
from groundstop.llm.positions import part_starts
from groundstop.llm.tokens import encoder, with_end
from groundstop.session import scratch_path

BLOCK = 256
MAGIC = int.from_bytes(b"PFI1", "little")
#: Share of a block's differences that the packed width must hold.
PERCENTILE = 0.95
#: Ids after which a writer closes a file (documents stay whole).
FILE_IDS = 2_000_000


def _pack(rows: np.ndarray, width: int) -> np.ndarray:
    bits = np.unpackbits(rows.astype("<u4").view(np.uint8).reshape(len(rows), BLOCK, 4), axis=2, bitorder="little")[:, :, :width]
    return np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little")


def _unpack(packed: np.ndarray, width: int) -> np.ndarray:
    bits = np.zeros((len(packed), BLOCK, 32), np.uint8)
    bits[:, :, :width] = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(packed), BLOCK, width)
    return np.packbits(bits, axis=2, bitorder="little").view("<u4").reshape(len(packed), BLOCK)


def encode_file(ids: np.ndarray, lengths: np.ndarray, doc_ids: np.ndarray, has_id: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """One file of the ids of whole documents."""
    blocks = -(-len(ids) // BLOCK)
    grid = np.empty(blocks * BLOCK, np.uint32)
    grid[:len(ids)] = ids
    grid[len(ids):] = ids[-1] if len(ids) else 0
    grid = grid.reshape(blocks, BLOCK)
    least = grid.min(axis=1) if blocks else np.zeros(0, np.uint32)
    delta = grid - least[:, None]
    need = np.frexp(delta.astype(np.float64))[1].astype(np.uint8)  # bits of each difference
    rank = min(BLOCK - 1, int(np.ceil(percentile * BLOCK)) - 1)
    width = np.partition(need, rank, axis=1)[:, rank] if blocks else np.zeros(0, np.uint8)
    block, place = np.nonzero(need > width[:, None])
    outlier = delta[block, place]
    delta[block, place] = 0
    size = width.astype(np.int64) * (BLOCK // 8)
    start = np.cumsum(size) - size
    body = np.zeros(int(size.sum()), np.uint8)
    for w in np.unique(width):
        if w == 0:
            continue
        mine = np.flatnonzero(width == w)
        for at in range(0, len(mine), 4096):
            some = mine[at:at + 4096]
            body[start[some][:, None] + np.arange(int(w) * (BLOCK // 8))] = _pack(delta[some], int(w))
    first = np.searchsorted(block, np.arange(blocks))
    head = np.array([MAGIC, blocks, len(ids), len(lengths), len(block), len(body)], "<u8")
    return b"".join(a.tobytes() for a in (
        head, least.astype("<u4"), width, first.astype("<u4"), start.astype("<u8"), place.astype(np.uint8), outlier.astype("<u4"),
        lengths.astype("<u4"), doc_ids.astype("<i8"), has_id.astype(np.uint8), body))


class File:
    """Reader of one file; ``ids(a, b)`` decodes only the blocks that hold ids a to b."""

    def __init__(self, blob: bytes):
        head = np.frombuffer(blob, "<u8", 6)
        if int(head[0]) != MAGIC:
            raise ValueError("not a PFI1 file")
        blocks, self.n_ids, docs, outliers, _ = (int(x) for x in head[1:])
        at = head.nbytes
        parts = []
        for kind, n in (("<u4", blocks), ("u1", blocks), ("<u4", blocks), ("<u8", blocks), ("u1", outliers), ("<u4", outliers), ("<u4", docs), ("<i8", docs), ("u1", docs)):
            parts.append(np.frombuffer(blob, kind, n, at))
            at += parts[-1].nbytes
        self.least, self.width, self.first, self.start, self.place, self.outlier, self.lengths, self.doc_ids, self.has_id = parts
        self.body = np.frombuffer(blob, np.uint8, -1, at)

    def ids(self, begin: int = 0, end: int | None = None) -> np.ndarray:
        end = self.n_ids if end is None else end
        if end <= begin:
            return np.zeros(0, np.uint32)
        low, high = begin // BLOCK, -(-end // BLOCK)
        out = np.zeros((high - low, BLOCK), np.uint32)
        width = self.width[low:high]
        for w in np.unique(width):
            if w == 0:
                continue
            mine = np.flatnonzero(width == w)
            for at in range(0, len(mine), 4096):
                some = mine[at:at + 4096]
                where = self.start[low + some].astype(np.int64)
                out[some] = _unpack(self.body[where[:, None] + np.arange(int(w) * (BLOCK // 8))], int(w))
        a = int(self.first[low])
        b = int(self.first[high]) if high < len(self.first) else len(self.place)
        owner = np.searchsorted(self.first, np.arange(a, b), "right") - 1 - low
        out[owner, self.place[a:b]] = self.outlier[a:b]
        out += self.least[low:high, None]
        return out.ravel()[begin - low * BLOCK:end - low * BLOCK]


FILES = "part long, seq long, first_id long, n_ids long, n_docs long, file binary"


def write_files(docs: DataFrame, out: str, tokenizer: str, end_id: int, file_ids: int = FILE_IDS, percentile: float = PERCENTILE) -> None:
    """Encode ``docs`` (doc_id, text) in ascending doc_id order and write the files to ``out``.

    The rows are range-partitioned on (doc_id, hash of the text, row), so one
    repeated id does not fill a partition, and encoded in order in each.
    """
    rows = docs.select("doc_id", "text").withColumn("_tie", F.xxhash64("text")).withColumn("_row", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange("doc_id", "_tie", "_row").sortWithinPartitions("doc_id", "_tie", "_row").select("doc_id", "text")

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        held: list[tuple] = []
        size = 0

        def close():
            nonlocal seq, before, held, size
            ids, lens, docs_, has = (np.concatenate(x) for x in zip(*held, strict=True))
            row = [part, seq, before, len(ids), len(lens), encode_file(ids, lens, docs_, has, percentile)]
            seq, before, held, size = seq + 1, before + len(ids), [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, [pa.int64()] * 5 + [pa.binary()], strict=True)], ["part", "seq", "first_id", "n_ids", "n_docs", "file"])

        for batch in batches:
            for some in slices(batch, "text", 4 << 20):
                ids, lens = with_end(*encoder(tokenizer).encode(*text_buffer(some.column(1))), end_id)
                key = some.column(0)
                held.append((ids, lens, key.fill_null(0).to_numpy(zero_copy_only=False), key.is_valid().to_numpy(zero_copy_only=False)))
                size += len(ids)
                if size >= file_ids:
                    yield close()
        if held:
            yield close()

    ordered.mapInArrow(files, FILES).write.parquet(out)


def read_documents(files: DataFrame) -> DataFrame:
    """(doc_id, start, ids): the documents of written files; ``start`` counts the ids of all documents before."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f, begin, cut in _opened(batches):
            yield pa.RecordBatch.from_arrays([
                pa.array(f.doc_ids, mask=f.has_id == 0), pa.array(begin + cut[:-1]),
                pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(f.ids().astype(np.int64)))], ["doc_id", "start", "ids"])

    return _with_start(files).mapInArrow(decode, "doc_id long, start long, ids array<long>")


def document_checks(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from written files."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f, begin, cut in _opened(batches):
            raw = memoryview(f.ids().astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([
                pa.array(f.doc_ids, mask=f.has_id == 0), pa.array(begin + cut[:-1]), pa.array(np.diff(cut)), pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _with_start(files).mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[File, int, np.ndarray]]:
    for batch in batches:
        for begin, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            f = File(blob.as_py())
            yield f, begin, np.concatenate([[0], np.cumsum(f.lengths, dtype=np.int64)])


def _with_start(files: DataFrame) -> DataFrame:
    # One row for each task that wrote files, so the broadcast is bounded by the number of write tasks.
    return files.join(F.broadcast(part_starts(files.select("part", "n_ids"), "n_ids")), "part").select((F.col("part_start") + F.col("first_id")).alias("begin"), "file")


def write_and_check(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write the documents' ids to new files and return ``document_checks`` of those files."""
    spark = docs.sparkSession
    out = scratch_path(spark, "pfor-ids")
    write_files(docs, out, tokenizer, end_id)
    return document_checks(spark.read.parquet(out))
