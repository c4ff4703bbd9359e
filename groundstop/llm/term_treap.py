"""Ranked lexical search with K2-treaps over the term-document grid.

*Index.*  A shard holds a few megabytes of consecutive documents, ordered by
doc_id, and all their terms.  Its grid (rows: terms, columns: documents) is
cut into quadrants down to single cells; only quadrants with a posting exist.
A node keeps which of its quadrants exist (four bits) and the greatest impact
below it, stored as the difference from its parent's; a leaf's greatest
impact is the posting's own.  Terms are numbered by falling document
frequency, and rows beyond the width of the grid go on in further square
blocks, so the tree is as deep as the documents need.  A node's children
follow those of the nodes before it, so their places are running counts of
the bits.

*Search.*  An item descends the paths of all its terms' rows together.  A
state is a range of documents with, for each term, the node that holds its row
and the range; its bound is the sum of the terms' weights times the nodes'
maxima.  The best ranges are taken first and halved; at a single document the
bound is the score.  Ranges that can no longer enter the best k are left,
also those that the shards before in the same task leave behind; equal bounds
are left only if all their doc_ids come later.  Nothing is approximate.

Impact of a posting: (1000000000 * tf) div (1000 * tf + 20 * m) with
m = 50 + (50 * n * N) div L; a term's weight is
floor(1000 * ln((2 * N + 2) / (2 * df + 1))).

Cases: a null text or item has no terms; a document without terms is not
found and does not count in N; rows that repeat a doc_id are documents of
their own, and so are repeated item rows (each gets its own ranks); a null
doc_id ranks after all others of its score; no documents or no items give no
rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from groundstop.llm import exchange
from groundstop.llm.chunks import lower_ascii, text_buffer, words
from groundstop.session import scratch_path

TOP = 50
#: Bytes of text of one shard's documents, about.
SHARD_TEXT = 16 << 20
#: Bytes of item texts that are searched for together (and sent to every task).
ITEM_BYTES = 16 << 20
#: Ranges halved at once.
STEP = 64
NO_ID = np.iinfo(np.int64).max

#: Bytes that part terms: all ASCII but digits and letters.
GAP = np.zeros(256, bool)
GAP[:128] = True
GAP[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = False

_ONES = np.array([bin(i).count("1") for i in range(16)], np.int64)
#: Set bits of a mask below bit j.
_BELOW = np.array([[bin(m & ((1 << j) - 1)).count("1") for j in range(4)] for m in range(16)], np.int64)


def terms_of(texts: pa.Array) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """All terms of the texts in order, and the row of each."""
    data, off = text_buffer(texts)
    starts, ends, rows = words(data, off, GAP)
    lens = ends - starts
    before = np.cumsum(lens) - lens
    raw = lower_ascii(data[np.arange(int(lens.sum())) + np.repeat(starts - before, lens)])
    edge = np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lens), [None, pa.py_buffer(edge), pa.py_buffer(raw)]), rows


def _spread(x: np.ndarray) -> np.ndarray:
    """The low 32 bits of each value, a zero before each."""
    x = x.astype(np.uint64)
    for shift, keep in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(keep)
    return x


class Treap:
    """One shard's index, opened for search."""

    def __init__(self, blob: bytes):
        head, masks, falls, df, raw, edge, self.ids = exchange.unpack_arrays(blob, "<i8", "u1", "<u4", "<u4", "u1", "<i8", "<i8")
        self.depth, nodes = int(head[0]), head[1:]  # nodes per level, the blocks' roots first
        inner = int(nodes[:-1].sum())
        bits = np.empty(2 * len(masks), np.uint8)
        bits[0::2], bits[1::2] = masks & 15, masks >> 4
        self.mask = np.zeros(1 + int(nodes.sum()), np.uint8)  # node 0 is nowhere
        self.mask[1:1 + inner] = bits[:inner]
        self.most = np.zeros(len(self.mask), np.int64)
        children = _ONES[self.mask[1:1 + inner]]
        self.start = np.zeros(len(self.mask), np.int64)
        self.start[1:1 + inner] = 1 + int(nodes[0]) + np.cumsum(children) - children
        at = 1 + int(nodes[0])
        self.most[1:at] = falls[:at - 1]
        begin = 1
        for n, below in zip(nodes[:-1].tolist(), nodes[1:].tolist(), strict=True):
            parent = np.repeat(self.most[begin:begin + n], _ONES[self.mask[begin:begin + n]])
            self.most[at:at + below] = parent - falls[at - 1:at - 1 + below]
            begin, at = at, at + below
        self.df = df
        self.terms = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(df), [None, pa.py_buffer(np.ascontiguousarray(edge)), pa.py_buffer(np.ascontiguousarray(raw))])
        self.rows_per_block = 1 << self.depth

    @staticmethod
    def build(doc_ids: np.ndarray, texts: pa.Array, documents: int, tokens: int) -> bytes:
        """The index of some documents (ids with NO_ID for null), in a corpus of so many documents with terms and terms."""
        order = np.argsort(doc_ids, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        found, rows = terms_of(texts)
        coded = found.dictionary_encode()
        n = np.bincount(place[rows], minlength=len(order))
        width = max(1, len(order))
        key, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * width + place[rows], return_counts=True)
        code, doc = key // width, key % width
        df = np.bincount(code, minlength=len(coded.dictionary))
        by_df = np.argsort(-df, kind="stable")
        number = np.empty(len(df), np.int64)
        number[by_df] = np.arange(len(df))
        term = number[code]
        impact = (1_000_000_000 * tf) // (1000 * tf + 20 * (50 + (50 * n[doc] * documents) // max(1, tokens)))

        depth = max(1, (width - 1).bit_length())
        inside = np.int64((1 << depth) - 1)
        cell = ((term >> depth).astype(np.uint64) << np.uint64(2 * depth)) | (_spread(term & inside) << np.uint64(1)) | _spread(doc)
        by_cell = np.argsort(cell)
        cell, most = cell[by_cell], impact[by_cell]
        levels = [(most, None)]
        for _ in range(depth):
            up = cell >> np.uint64(2)
            first = np.flatnonzero(np.append(True, up[1:] != up[:-1])) if len(up) else np.zeros(0, np.int64)
            mask = np.add.reduceat(1 << (cell & np.uint64(3)).astype(np.int64), first).astype(np.uint8) if len(up) else np.zeros(0, np.uint8)
            most = np.maximum.reduceat(most, first) if len(up) else most
            cell = up[first]
            levels.append((most, mask))
        levels.reverse()
        # Roots lie in the order of their blocks, and every block of the numbered terms has one.
        falls = [levels[0][0]]
        for (above, mask), (below, _) in zip(levels[:-1], levels[1:], strict=True):
            falls.append(np.repeat(above, _ONES[mask]) - below)
        bits = np.concatenate([m for _, m in levels[:-1]])
        bits = np.append(bits, np.zeros(len(bits) % 2, np.uint8))
        raw, edge = text_buffer(coded.dictionary.take(pa.array(by_df)))
        return exchange.pack_arrays(
            np.array([depth, *(len(m) for m, _ in levels)], np.int64), bits[0::2] | (bits[1::2] << 4), np.concatenate(falls).astype(np.uint32),
            df[by_df].astype(np.uint32), raw, edge, doc_ids[order])

    def find(self, terms: pa.Array) -> np.ndarray:
        """Row of each term, or -1."""
        return pc.fill_null(pc.index_in(terms, value_set=self.terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def best(self, rows: np.ndarray, weights: np.ndarray, k: int, scores: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best k (score, doc_id) of this shard and of those given (best first), for an item's rows and their weights."""
        rows, weights = rows[rows >= 0], weights[rows >= 0]
        if len(rows) == 0:
            return scores, ids
        level = np.zeros(1, np.int64)
        column = np.zeros(1, np.int64)
        nodes = (1 + (rows >> self.depth))[None, :]
        bound = (self.most[nodes] * weights).sum(axis=1)
        n = len(self.ids)
        while len(bound):
            least, last = (int(scores[k - 1]), int(ids[k - 1])) if len(scores) >= k else (1, NO_ID)
            lowest_id = self.ids[np.minimum(column << (self.depth - level), n - 1)]
            stay = (bound > least) | ((bound == least) & (lowest_id <= last))
            if not stay.all():
                level, column, nodes, bound = level[stay], column[stay], nodes[stay], bound[stay]
                if not len(bound):
                    break
            if len(bound) > STEP:
                now = np.zeros(len(bound), bool)
                now[np.argpartition(-bound, STEP - 1)[:STEP]] = True
            else:
                now = np.ones(len(bound), bool)
            done = now & (level == self.depth)
            if done.any():
                scores, ids = np.concatenate([scores, bound[done]]), np.concatenate([ids, self.ids[column[done]]])
                order = np.lexsort((ids, -scores))[:k]
                scores, ids = scores[order], ids[order]
            half = now & ~done
            l, c, at = level[half], column[half], nodes[half]
            row_bit = (rows[None, :] >> (self.depth - 1 - l)[:, None]) & 1
            mask, start = self.mask[at], self.start[at]
            parts = [(level[~now], column[~now], nodes[~now], bound[~now])]
            for side in (0, 1):
                j = 2 * row_bit + side
                child = np.where((mask >> j) & 1, start + _BELOW[mask, j], 0)
                parts.append((l + 1, 2 * c + side, child, (self.most[child] * weights).sum(axis=1)))
            level, column, nodes, bound = (np.concatenate(x) for x in zip(*parts, strict=True))
        return scores, ids


def _batches(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """Consecutive rows with ``limit`` bytes of text or so."""
    some, size = [], 0
    for batch in batches:
        off = text_buffer(batch.column(1))[1]
        begin = 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(off, off[begin] + limit - size, "right")) - 1)
            end = min(end, batch.num_rows)
            some.append(batch.slice(begin, end - begin))
            size += int(off[end] - off[begin])
            begin = end
            if size >= limit or begin < batch.num_rows:
                yield pa.Table.from_batches(some)
                some, size = [], 0
    if some:
        yield pa.Table.from_batches(some)


def totals(docs: DataFrame) -> tuple[int, int]:
    """(documents with a term, all terms)."""
    sums = docs.select("text").mapInArrow(_counting, "documents long, terms long").agg(F.sum("documents"), F.sum("terms")).first()
    return sums[0] or 0, sums[1] or 0


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    documents = terms = 0
    for batch in batches:
        data, off = text_buffer(batch.column(0))
        inside = ~GAP[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edges = off[:-1][np.diff(off) > 0]
        begins[edges] = inside[edges]
        per = np.diff(np.concatenate([[0], np.cumsum(begins)])[off])
        documents += int((per > 0).sum())
        terms += int(per.sum())
    yield pa.RecordBatch.from_arrays([pa.array([documents]), pa.array([terms])], ["documents", "terms"])


INDEX = "blob binary"


def build_index(docs: DataFrame, shard_text: int = SHARD_TEXT) -> tuple[DataFrame, int, int]:
    """Stored shards (blob) of all documents and terms; the documents with a term; all terms."""
    documents, tokens = totals(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _batches(batches, shard_text):
            table = table.combine_chunks()
            ids = pc.fill_null(table.column(0), NO_ID).to_numpy()
            blob = Treap.build(ids, table.column(1).combine_chunks(), documents, tokens)
            yield pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], ["blob"])

    out = scratch_path(docs.sparkSession, "term-treaps")
    docs.select("doc_id", "text").mapInArrow(run, INDEX).write.option("compression", "uncompressed").parquet(out)
    return docs.sparkSession.read.parquet(out), documents, tokens


def _frequencies(index: DataFrame, terms: pa.Array) -> np.ndarray:
    """Document frequency of each term over all shards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(terms), np.int64)
        for batch in batches:
            for blob in batch.column(0):
                _, _, _, own, raw, edge, _ = exchange.unpack_arrays(blob.as_py(), "<i8", "u1", "<u4", "<u4", "u1", "<i8", "<i8")
                names = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(own), [None, pa.py_buffer(np.ascontiguousarray(edge)), pa.py_buffer(np.ascontiguousarray(raw))])
                row = pc.fill_null(pc.index_in(terms, value_set=names), -1).to_numpy(zero_copy_only=False)
                df[row >= 0] += own[row[row >= 0]]
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(df[held])], ["term", "df"])

    out = np.zeros(len(terms), np.int64)
    for r in index.mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():  # one row per term asked for
        out[r["term"]] = r["df"]
    return out


def search(index: DataFrame, documents: int, items: list[tuple[int | None, str | None]], k: int = TOP) -> DataFrame:
    """(item, item_id, rank, doc_id, score): the best k documents of each item; ``item`` numbers the list."""
    found, row = terms_of(pa.array([t for _, t in items], pa.large_string()))
    coded = found.dictionary_encode()
    terms = coded.dictionary
    df = _frequencies(index, terms)
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) if d else 0 for d in df.tolist()], np.int64)
    wanted = np.unique(np.stack([row, coded.indices.to_numpy()]), axis=1) if len(row) else np.zeros((2, 0), np.int64)
    wanted = wanted[:, weight[wanted[1]] > 0]
    cut = np.searchsorted(wanted[0], np.arange(len(items) + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(items)
        for batch in batches:
            for blob in batch.column(0):
                treap = Treap(blob.as_py())
                local = treap.find(terms)
                for i in range(len(items)):
                    mine = wanted[1, cut[i]:cut[i + 1]]
                    best[i] = treap.best(local[mine], weight[mine], k, *best[i])
        item = np.repeat(np.arange(len(items)), [len(s) for s, _ in best])
        score, ids = (np.concatenate(x) for x in zip(*best, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(ids, mask=ids == NO_ID), pa.array(score)], ["item", "doc_id", "score"])

    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = index.mapInArrow(run, "item long, doc_id long, score long").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = index.sparkSession.createDataFrame([(n, i) for n, (i, _) in enumerate(items)], "item long, item_id long")
    return ranked.join(names, "item").select("item", "item_id", "rank", "doc_id", "score")


def rank(docs: DataFrame, items: DataFrame, k: int = TOP, shard_text: int = SHARD_TEXT, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the best k documents for every row of ``items`` (item_id, text)."""
    index, documents, _ = build_index(docs, shard_text)
    size = items.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    parts = max(1, -(-((size[0] or 0) + 64 * size[1]) // item_bytes))
    out = None
    for part in range(parts):  # one, unless the items' texts are many megabytes
        some = items.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == part).select("item_id", "text").collect()
        if some:
            found = search(index, documents, [(r[0], r[1]) for r in some], k)
            out = found if out is None else out.union(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out.select("item_id", "rank", "doc_id", "score")
