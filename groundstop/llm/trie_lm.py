"""Language-model scores from a sharded Elias-Fano n-gram trie.

A shard of the trie holds the contexts (words) whose hash falls into it and
every successor seen after them, counted over all training documents:

* level 1: the sorted context hashes, Elias-Fano coded, with their counts;
* pointers: for each context the start of its successors, a monotone
  sequence, Elias-Fano coded;
* level 2: the successors' 40-bit hashes, made monotone by the number of
  their context, Elias-Fano coded, with quantised discounted probabilities.

All levels lie in one anonymous memory map.  A query finds its context, then
searches the successor within the context's own range, from the bucket of
the key's upper bits.

A text is scored with interpolated absolute discounting over an additive
base: p(w|u) = max(c(uw) - D, 0) / c(u) + D * distinct(u) / c(u) * base(w),
base(w) = (c(w) + 0.1) / (N + 0.1 * (V + 1)); in an unseen context p is the
base.

Cases: a null or empty text is its end alone; rows may repeat ids and texts;
without any training document all counts are zero and both scores are sums of the base of
an unknown token; an empty table gives no rows.
"""

from __future__ import annotations

import mmap
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundstop.llm import exchange
from groundstop.llm.chunks import lower_ascii, span_hashes, text_buffer, words
from groundstop.session import scratch_path

#: Hashes that stand for the start and the end of a document.
BEGIN, END = np.uint64(0x51ED270B1F0A3C95), np.uint64(0xC2B2AE3D27D4EB4F)
DISCOUNT, ADDED = 0.75, 0.1
#: Bits of a successor's hash within its context.
SUCCESSOR_BITS = 40
#: Steps of a decade in quantised probabilities; UNSEEN is the code of none.
STEPS, UNSEEN = 4000, 65535


def _fields(values: np.ndarray, width: int) -> np.ndarray:
    """``width``-bit fields side by side."""
    out = [np.unpackbits(values[a:a + 65536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, :width].ravel() for a in range(0, len(values), 65536)]
    return np.packbits(np.concatenate(out), bitorder="little") if out else np.zeros(0, np.uint8)


class EliasFano:
    """Monotone 64-bit sequence: low bits in fixed fields, high bits in unary."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray):
        self.n, self.width = n, width
        self.low = np.concatenate([low, np.zeros(16, np.uint8)])
        bits = np.unpackbits(high, bitorder="little")
        ones = np.flatnonzero(bits)[:n]
        self.upper = (ones - np.arange(n)).astype(np.uint64)  # the high part of each value
        self.bucket = np.searchsorted(self.upper, np.arange(int(self.upper[-1]) + 2 if n else 1, dtype=np.uint64)) if n else np.zeros(2, np.int64)

    @staticmethod
    def parts(values: np.ndarray) -> tuple[int, int, np.ndarray, np.ndarray]:
        """(n, width, low, high) of a sorted sequence."""
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, (top // max(n, 1)).bit_length() - 1) if n else 0
        high = np.zeros((n + (top >> width) + 8) // 8 * 8 if n else 8, np.uint8)
        if n:
            high[(values >> np.uint64(width)).astype(np.int64) + np.arange(n)] = 1
        mask = np.uint64((1 << width) - 1)
        return n, width, _fields(values & mask, width) if width else np.zeros(0, np.uint8), np.packbits(high, bitorder="little")

    def get(self, i: np.ndarray) -> np.ndarray:
        out = self.upper[i] << np.uint64(self.width)
        if self.width:
            bit = i.astype(np.int64) * self.width
            at, shift = bit >> 3, (bit & 7).astype(np.uint64)
            word = np.zeros(len(i), np.uint64)
            for j in range(8):
                word |= self.low[at + j].astype(np.uint64) << np.uint64(8 * j)
            word >>= shift
            spill = self.low[at + 8].astype(np.uint64)
            word |= np.where(shift > 0, spill << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
            out |= word & np.uint64((1 << self.width) - 1)
        return out

    def successor(self, keys: np.ndarray, begin: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """Index of the first value not below each key, searched within [begin, end) where given."""
        top = (keys >> np.uint64(self.width)).astype(np.int64)
        last = len(self.bucket) - 1
        low = self.bucket[np.minimum(top, last)]
        high = self.bucket[np.minimum(top + 1, last)]
        if begin is not None:
            low, high = np.clip(low, begin, end), np.clip(high, begin, end)
        while True:
            open_ = np.flatnonzero(low < high)
            if len(open_) == 0:
                return low
            middle = (low[open_] + high[open_]) >> 1
            below = self.get(middle) < keys[open_]
            low[open_[below]] = middle[below] + 1
            high[open_[~below]] = middle[~below]


class Levels:
    """Named arrays in one anonymous memory map."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        size = sum(-(-a.nbytes // 8) * 8 for a in arrays.values())
        self.map = mmap.mmap(-1, max(8, size))
        self.views, at = {}, 0
        for name, a in arrays.items():
            self.map[at:at + a.nbytes] = np.ascontiguousarray(a).tobytes()
            self.views[name] = np.frombuffer(self.map, a.dtype, a.size, at)
            at += -(-a.nbytes // 8) * 8

    def __getitem__(self, name: str) -> np.ndarray:
        return self.views[name]


def quantise(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        code = np.round(-np.log10(p) * STEPS)
    return np.where(p > 0, np.minimum(code, UNSEEN - 1), UNSEEN).astype(np.uint16)


def dequantise(code: np.ndarray) -> np.ndarray:
    return np.where(code == UNSEEN, 0.0, 10.0 ** (code / -STEPS))


class Trie:
    """One shard: contexts, pointers, successors and their quantised values."""

    def __init__(self, contexts: np.ndarray, owner: np.ndarray, successors: np.ndarray, counts: np.ndarray, discount: float = DISCOUNT):
        """Sorted contexts; for each distinct (owner, successor), sorted, its training count (above zero)."""
        self.base = contexts[0] if len(contexts) else np.uint64(0)
        total = np.bincount(owner, counts, len(contexts))
        distinct = np.bincount(owner, minlength=len(contexts))
        first = np.concatenate([[0], np.cumsum(distinct)]).astype(np.uint64)
        keys = (owner.astype(np.uint64) << np.uint64(SUCCESSOR_BITS)) | successors
        with np.errstate(divide="ignore", invalid="ignore"):
            left = np.nan_to_num(discount * distinct / total)
            value = (counts - discount) / total[owner]
        parts = {name: EliasFano.parts(v) for name, v in (("contexts", contexts - self.base), ("pointers", first), ("successors", keys))}
        self.levels = Levels({**{f"{n}_{k}": a for n, p in parts.items() for k, a in (("low", p[2]), ("high", p[3]))},
                              "total": total.astype(np.int64), "left": quantise(left), "value": quantise(value)})
        self.contexts, self.pointers, self.successors = (EliasFano(parts[n][0], parts[n][1], self.levels[f"{n}_low"], self.levels[f"{n}_high"]) for n in parts)

    def context(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each context, or -1."""
        if self.contexts.n == 0:
            return np.full(len(hashes), -1)
        at = self.contexts.successor(np.where(hashes >= self.base, hashes - self.base, np.uint64(0)))
        at = np.minimum(at, self.contexts.n - 1)
        return np.where(self.contexts.get(at) + self.base == hashes, at, -1)

    def codes(self, context: np.ndarray, successors: np.ndarray) -> np.ndarray:
        """Quantised discounted probability of each successor after its context."""
        out = np.full(len(context), UNSEEN, np.uint16)
        known = np.flatnonzero(context >= 0)
        if len(known) == 0 or self.successors.n == 0:
            return out
        c = context[known]
        begin, end = self.pointers.get(c).astype(np.int64), self.pointers.get(c + 1).astype(np.int64)
        keys = (c.astype(np.uint64) << np.uint64(SUCCESSOR_BITS)) | successors[known]
        at = self.successors.successor(keys, begin, end)
        hit = at < end
        hit[hit] = self.successors.get(at[hit]) == keys[hit]
        out[known[hit]] = self.levels["value"][at[hit]]
        return out


def _bigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(previous, token, row) of every token; a text ends with END and begins after BEGIN."""
    data, off = text_buffer(texts)
    data = lower_ascii(data)
    starts, ends, rows = words(data, off)
    hashes = span_hashes(data, starts, ends)
    n = len(off) - 1
    per = np.bincount(rows, minlength=n)
    close = np.cumsum(per + 1) - 1
    token = np.empty(len(hashes) + n, np.uint64)
    is_end = np.zeros(len(token), bool)
    is_end[close] = True
    token[is_end], token[~is_end] = END, hashes
    previous = np.empty_like(token)
    previous[1:] = token[:-1]
    previous[close - per] = BEGIN
    return previous, token, np.repeat(np.arange(n), per + 1)


def _distinct(previous: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(sorted contexts, context number of each token's context, sorted distinct (context number, successor) keys, key number of each token)."""
    contexts, owner = np.unique(previous, return_inverse=True)
    keys, which = np.unique((owner.astype(np.uint64) << np.uint64(SUCCESSOR_BITS)) | (token >> np.uint64(64 - SUCCESSOR_BITS)), return_inverse=True)
    return contexts, owner, keys, which


def _in_training(ids: pa.Array, folds: int) -> np.ndarray:
    return np.array([i is None or zlib.crc32(str(i).encode()) % folds != 0 for i in ids.to_pylist()], bool)


def _messages(bits: int, folds: int):
    width = SUCCESSOR_BITS // 8

    def make(chunk: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
        previous, token, rows = _bigrams(chunk.column(1))
        contexts, _, keys, which = _distinct(previous, token)
        count = np.bincount(which, _in_training(chunk.column(0), folds)[rows], len(keys)).astype(np.uint32)
        first = np.searchsorted(keys, np.arange(len(contexts) + 1, dtype=np.uint64) << np.uint64(SUCCESSOR_BITS))
        cut = np.searchsorted(contexts >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
        for shard in np.flatnonzero(np.diff(cut)).tolist():
            a, b = cut[shard], cut[shard + 1]
            low, high = first[a], first[b]
            yield shard, exchange.pack_arrays(contexts[a:b], np.diff(first[a:b + 1]).astype(np.uint32), exchange.low_bytes(keys[low:high], width), count[low:high])

    return make


def _reply(discount: float):
    width = SUCCESSOR_BITS // 8

    def reply(shard: int, runs: list[int], blobs: list[bytes]) -> Iterator[tuple[int, bytes]]:
        asked = []
        for blob in blobs:
            contexts, per, raw, count = exchange.unpack_arrays(blob, "<u8", "<u4", "u1", "<u4")
            asked.append((contexts, per, exchange.from_low_bytes(raw, width), count))
        contexts = np.unique(np.concatenate([a[0] for a in asked]))
        keys, counts = [], []
        for c, per, successors, count in asked:
            owner = np.repeat(np.searchsorted(contexts, c).astype(np.uint64), per)
            seen = count > 0
            keys.append((owner[seen] << np.uint64(SUCCESSOR_BITS)) | successors[seen])
            counts.append(count[seen])
        keys, counts = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        counts = np.add.reduceat(counts.astype(np.float64), first) if len(first) else np.zeros(0)
        keys = keys[first]
        trie = Trie(contexts, (keys >> np.uint64(SUCCESSOR_BITS)).astype(np.int64), keys & np.uint64((1 << SUCCESSOR_BITS) - 1), counts, discount)
        total = trie.levels["total"]
        yield -1, exchange.pack_arrays(np.array([int((total > 0).sum()), int(total.sum())], np.int64))
        for run, (c, per, successors, _) in zip(runs, asked, strict=True):
            at = trie.context(c)
            yield run, exchange.pack_arrays(total[at], trie.levels["left"][at], trie.codes(np.repeat(at, per), successors))

    return reply


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, folds: int = 10, discount: float = DISCOUNT) -> DataFrame:
    """Score every row of ``docs``; rows whose crc32(doc_id as text) is divisible by ``folds`` are held out of training.

    (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score); a
    null doc_id is in training.
    """
    spark = docs.sparkSession
    out = scratch_path(spark, "trie-answers")
    bits, chunks = exchange.shard_bits(docs), exchange.packed(docs, ["doc_id", "text"])
    messages = exchange.send(chunks, _messages(bits, folds))
    exchange.answer(messages, _reply(discount)).write.parquet(out)
    answers = spark.read.parquet(out)

    def totals(table: pa.Table) -> pa.Table:
        sums = sum((exchange.unpack_arrays(b.as_py(), "<i8")[0] for b in table["blob"]), np.zeros(2, np.int64))
        return pa.table({"types": [int(sums[0])], "tokens": [int(sums[1])]})

    parts = answers.where("run = -1").groupBy(F.pmod("shard", F.lit(64))).applyInArrow(totals, "types long, tokens long")
    # The begin mark is a context as often as the end is a token, so contexts count the distinct tokens.
    types, tokens = (x or 0 for x in parts.agg(F.sum("types"), F.sum("tokens")).first())
    norm = tokens + ADDED * (types + 1)

    def work(run: int, chunk: pa.RecordBatch, got: dict[int, bytes]) -> list[pa.RecordBatch]:
        previous, token, rows = _bigrams(chunk.column(1))
        contexts, owner, _, which = _distinct(previous, token)
        replies = [exchange.unpack_arrays(got[s], "<i8", "<u2", "<u2") for s in sorted(got)]
        count, left, codes = (np.concatenate(x) for x in zip(*replies, strict=True))
        # A word's own count is its count as a context; the end's is the begin mark's.
        place = np.searchsorted(contexts, np.where(token == END, BEGIN, token))
        own = count[place]
        base = (own + ADDED) / norm
        rest = np.where(count[owner] > 0, dequantise(left)[owner], 1.0)
        p = dequantise(codes)[which] + rest * base
        n = chunk.num_rows
        ids = chunk.column(0)
        add = lambda x: np.bincount(rows, x, n)
        return [pa.RecordBatch.from_arrays([
            ids, pa.array(~_in_training(ids, folds)), pa.array(add(np.ones(len(rows))).astype(np.int64)), pa.array(add(own > 0).astype(np.int64)),
            pa.array(np.full(n, tokens, np.int64)), pa.array(add(np.log10(base))), pa.array(add(np.log10(p)))],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])]

    return exchange.finish(chunks, answers.where("run >= 0"), work, SCORES)
