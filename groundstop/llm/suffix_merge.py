"""Substring deduplication by a common-prefix-aware distributed merge sort of suffixes.

A byte is removed if a 50-byte string covers it that also starts in a
document with a smaller doc_id.

Anchors.  Of every 25 consecutive 26-grams of bytes the one with the least
hash (the leftmost of equals) is an anchor, so each 50-byte window belongs to
one anchor and equal windows have theirs at the same place.  An anchor's
suffix starts there and holds the right side of all its windows; the bytes
to the left of it, up to its first window, go with it.

1. Every chunk of documents (a run) asks shards which of its anchors' 26-grams
   any other document holds; the rest cannot repeat and go no further.
2. A run collapses equal suffixes, sorts them, front-codes the sorted list
   (common prefix with the one before, and the rest) and sends each shard its
   part, with the least and greatest doc_id of every suffix.
3. A shard merges the runs with a loser tree that keeps for every loser its
   common prefix with the last winner: different prefixes decide without
   looking at the bytes, equal ones are compared from their end on.  Suffixes
   that share 26 bytes come out together; for each the least doc_id of every
   window is found and sent back to the runs where it is smaller.
4. The runs mark and cut the covered bytes.

Cases: a null or empty text has no bytes; texts under 50 bytes stay whole; a
null doc_id is larger than any other; equal doc_ids (also of repeated rows)
do not cover each other; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from groundstop.llm import exchange
from groundstop.llm.chunks import BYTE_CODE, mix, text_buffer
from groundstop.session import remove_scratch, scratch_path, shuffles_removed

SPAN, GRAM = 50, 26
CHOICE = SPAN - GRAM + 1
LEFT = CHOICE - 1
#: Bytes of a record: suffix, what stands left of it, offsets of its first and last window; padded to words.
RECORD, PADDED = SPAN + LEFT + 2, 80
#: Bytes of a 26-gram's hash that travel, besides the shard's number; a chance match only keeps an anchor that is dropped later.
KEY_BYTES = 4
NO_ID = np.iinfo(np.int64).max

_CODE32 = (BYTE_CODE >> np.uint64(32)).astype(np.uint32)
#: Odd factors that join two halves of a gram's hash, by rule.
_JOIN = {k: np.uint32((0x9E3779B1 * (2 * k + 1)) % (1 << 32)) for k in (2, 4, 8, 16)}
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS = np.array([pow(_BASE, i, 1 << 64) for i in range(SPAN + LEFT + 1)], np.uint64)
_BACK = np.array([pow(_BASE, -i, 1 << 64) for i in range(SPAN + LEFT + 1)], np.uint64)


def anchors(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(position, bytes from the first window to it, from the last window to it, row) of every anchor."""
    lens = np.diff(off) - SPAN + 1
    rows = np.flatnonzero(lens > 0)
    if len(rows) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z, z
    joined = {1: _CODE32[data]}
    for k in (2, 4, 8, 16):
        half = joined[k // 2]
        joined[k] = half[:-(k // 2)] * _JOIN[k] + half[k // 2:]
    h = joined[16][:len(data) - 25] * np.uint32(0x85EBCA77) + joined[8][16:len(data) - 9]
    h = h * np.uint32(0xC2B2AE3D) + joined[2][24:]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(13)
    del joined
    place = np.zeros(len(h), np.uint8)
    for shift in (1, 2, 4, 8, CHOICE - 16):
        later = h[shift:] < h[:-shift]
        place = np.where(later, place[shift:] + np.uint8(shift), place[:-shift])
        h = np.minimum(h[:-shift], h[shift:])
    lens = lens[rows]
    before = np.cumsum(lens) - lens
    window = np.arange(int(lens.sum())) + np.repeat(off[rows] - before, lens)
    at = window + place[window]
    new = np.ones(len(at), bool)
    new[1:] = at[1:] != at[:-1]
    new[before] = True
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return at[first], at[first] - window[first], at[first] - window[last], rows[np.searchsorted(before, first, "right") - 1]


def gram_keys(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit hash of the 26 bytes at each position."""
    out = np.zeros(len(at), np.uint64)
    for j in range(GRAM):
        out += BYTE_CODE[data[at + j]] * _POWERS[j]
    return mix(out)


def records(data: np.ndarray, at: np.ndarray, far: np.ndarray, near: np.ndarray) -> np.ndarray:
    """One padded record per anchor: suffix, left side (its end first aligned), window offsets."""
    out = np.zeros((len(at), PADDED), np.uint8)
    right, left = np.arange(SPAN), np.arange(-LEFT, 0)
    for a in range(0, len(at), 65536):
        p, f, n = at[a:a + 65536, None], far[a:a + 65536, None], near[a:a + 65536, None]
        part = out[a:a + 65536]
        part[:, :SPAN] = np.where(right < SPAN - n, data[np.minimum(p + right, len(data) - 1)], 0)
        part[:, SPAN:SPAN + LEFT] = np.where(left >= -f, data[np.maximum(p + left, 0)], 0)
        part[:, SPAN + LEFT], part[:, SPAN + LEFT + 1] = f[:, 0], n[:, 0]
    return out


def front_code(sorted_records: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(common prefix with the record before, the remaining bytes of all records)."""
    common = np.zeros(len(sorted_records), np.uint8)
    if len(sorted_records) > 1:
        differ = sorted_records[1:, :RECORD] != sorted_records[:-1, :RECORD]
        common[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), RECORD)
    return common, sorted_records[:, :RECORD][np.arange(RECORD) >= common[:, None]]


def front_decode(common: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """The padded records of a front-coded list."""
    n = len(common)
    out = np.zeros((n, PADDED), np.uint8)
    kept = np.arange(RECORD) >= common[:, None]
    out[:, :RECORD][kept] = rest
    rows = np.arange(n)
    for j in range(int(common.max()) if n else 0):
        out[:, j] = out[np.maximum.accumulate(np.where(kept[:, j], rows, 0)), j]
    return out


def merge(words: list[list[list[int]]], common: list[list[int]]) -> tuple[list[int], list[int], list[int]]:
    """(run, place in the run, common prefix with the record before) of the merged runs.

    ``words`` holds each run's sorted records as lists of 8-byte words,
    ``common`` the prefixes of the front code.
    """
    players = 1
    while players < len(words):
        players *= 2
    count = PADDED // 8
    at = [0] * players
    prefix = [0 if i < len(words) and words[i] else -1 for i in range(players)]
    now = [words[i][0] if prefix[i] == 0 else None for i in range(players)]

    def first(c: int, d: int) -> bool:
        """Whether c comes before d, both with the same known prefix; the later one learns its prefix with the earlier."""
        x, y, j = now[c], now[d], prefix[c] >> 3
        while j < count and x[j] == y[j]:
            j += 1
        if j == count:
            wins, known = c < d, PADDED
        else:
            wins, known = x[j] < y[j], 8 * j + 8 - ((x[j] ^ y[j]).bit_length() + 7 >> 3)
        prefix[d if wins else c] = known
        return wins

    loser = [0] * players
    winners = list(range(players))
    node = players
    while node > 1:
        half = []
        for i in range(0, node, 2):
            c, d = winners[i], winners[i + 1]
            wins = prefix[d] < 0 or (prefix[c] >= 0 and first(c, d))
            half.append(c if wins else d)
            loser[node // 2 + i // 2] = d if wins else c
        winners, node = half, node // 2
    best = winners[0]
    runs, places, prefixes = [], [], []
    while prefix[best] >= 0:
        runs.append(best)
        places.append(at[best])
        prefixes.append(prefix[best])
        at[best] = k = at[best] + 1
        if k < len(words[best]):
            now[best], prefix[best] = words[best][k], common[best][k]
        else:
            prefix[best] = -1
        c, known, i = best, prefix[best], best + players >> 1
        while i:
            d = loser[i]
            other = prefix[d]
            if known < other or (known == other and known >= 0 and not first(c, d)):
                loser[i] = c
                c = d
                known = other if known != other else prefix[c]
            i >>= 1
        best = c
    return runs, places, prefixes


def _firsts(values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)


def _cut(keys: np.ndarray, bits: int) -> np.ndarray:
    return np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))


def _ask(bits: int):
    def make(chunk: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
        data, off = text_buffer(chunk.column(1))
        at, _, _, rows = anchors(data, off)
        keys = gram_keys(data, at)
        order = np.argsort(keys, kind="stable")
        keys, rows = keys[order], rows[order]
        first = _firsts(keys)
        several = np.zeros(len(first), bool)
        if len(first):
            last = np.append(first[1:], len(keys)) - 1
            several = rows[first] != rows[last]
        keys = keys[first]
        cut = _cut(keys, bits)
        for shard in np.flatnonzero(np.diff(cut)).tolist():
            a, b = cut[shard], cut[shard + 1]
            yield shard, exchange.pack_arrays(exchange.low_bytes(keys[a:b] >> np.uint64(64 - bits - 8 * KEY_BYTES), KEY_BYTES), several[a:b])

    return make


def _repeated(shard: int, runs: list[int], blobs: list[bytes]) -> Iterator[tuple[int, bytes]]:
    """For each key of a run, whether another document holds it."""
    asked = [exchange.unpack_arrays(b, "u1", "?") for b in blobs]
    keys = [exchange.from_low_bytes(a[0], KEY_BYTES) for a in asked]
    every, place = np.unique(np.concatenate(keys), return_inverse=True)
    held = np.bincount(place, 1 + np.concatenate([a[1] for a in asked]), len(every)) > 1
    flags, at = held[place], 0
    for run, k in zip(runs, keys, strict=True):
        yield run, exchange.pack_arrays(np.packbits(flags[at:at + len(k)]), np.array([len(k)], np.int64))
        at += len(k)


def _flags(got: dict[int, bytes]) -> np.ndarray:
    parts = [exchange.unpack_arrays(got[s], "u1", "<i8") for s in sorted(got)]
    return np.concatenate([np.unpackbits(p[0], count=int(p[1][0])) for p in parts]).astype(bool) if parts else np.zeros(0, bool)


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(NO_ID).to_numpy(zero_copy_only=False)


#: Shard number under which a run keeps its own occurrences.
OWN = -2


def _runs(bits: int):
    """A run's front-coded messages, and under ``OWN`` the places of its suffixes."""
    def work(run: int, chunk: pa.RecordBatch, got: dict[int, bytes]) -> list[pa.RecordBatch]:
        data, off = text_buffer(chunk.column(1))
        at, far, near, rows = anchors(data, off)
        keys = gram_keys(data, at)
        flags = _flags(got)
        alive = flags[np.searchsorted(np.unique(keys), keys)] if len(keys) else np.zeros(0, bool)
        at, far, near, rows, keys = at[alive], far[alive], near[alive], rows[alive], keys[alive]
        ids = _ids(chunk.column(0))[rows]
        recs = records(data, at, far, near)
        shard = (keys >> np.uint64(64 - bits)).astype(np.int64)
        text = recs.view(f"S{PADDED}").ravel()
        order = np.argsort(text, kind="stable")
        order = order[np.argsort(shard[order], kind="stable")]
        text, shard, recs = text[order], shard[order], recs[order]
        first = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (shard[1:] != shard[:-1]))) if len(text) else np.zeros(0, np.int64)
        number = np.empty(len(order), np.int64)
        number[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
        low = np.minimum.reduceat(ids[order], first) if len(first) else ids[:0]
        high = np.maximum.reduceat(ids[order], first) if len(first) else ids[:0]
        recs, shard = recs[first], shard[first]
        cut = np.searchsorted(shard, np.arange((1 << bits) + 1))
        out = [(OWN, exchange.pack_arrays(number.astype(np.uint32), at.astype(np.int64), rows.astype(np.uint32), cut))]
        for s in np.flatnonzero(np.diff(cut)).tolist():
            a, b = cut[s], cut[s + 1]
            out.append((s, exchange.pack_arrays(*front_code(recs[a:b]), low[a:b], high[a:b])))
        return [pa.RecordBatch.from_arrays([pa.array([run] * len(out), pa.int64()), pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary())], ["run", "shard", "blob"])]

    return work


def least_ids(recs: np.ndarray, prefix: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(context of each merged record, and for the contexts' windows: context, first offset, last offset, least doc_id).

    Offsets count back from the anchor to the window's start; ``low`` is not
    below zero.
    """
    context = np.cumsum(prefix < RECORD) - 1
    first = np.flatnonzero(prefix < RECORD)
    group = (np.cumsum(prefix < GRAM) - 1)[first]
    least = np.minimum.reduceat(low, first)
    one = recs[first]
    far, near = one[:, SPAN + LEFT].astype(np.int64), one[:, SPAN + LEFT + 1].astype(np.int64)
    alone = np.bincount(group)[group] == 1
    solo, many = np.flatnonzero(alone), np.flatnonzero(~alone)
    parts = [(solo, near[solo], far[solo], least[solo])]
    if len(many):
        text = np.concatenate([one[many, SPAN:SPAN + LEFT], one[many, :SPAN]], axis=1)
        sums = np.zeros((len(many), SPAN + LEFT + 1), np.uint64)
        np.cumsum(BYTE_CODE[text] * _POWERS[:SPAN + LEFT], axis=1, out=sums[:, 1:])
        best = np.full((len(many), CHOICE + 1), -1, np.int64)  # one column more, so that every stretch ends
        salt = mix(group[many].astype(np.uint64) + np.uint64(1))
        for o in range(CHOICE):
            mine = np.flatnonzero((near[many] <= o) & (o <= far[many]))
            if len(mine) == 0:
                continue
            s = LEFT - o
            h = mix(((sums[mine, s + SPAN] - sums[mine, s]) * _BACK[s]) ^ salt[mine])
            order = np.argsort(h)
            starts = _firsts(h[order])
            value = np.minimum.reduceat(least[many[mine[order]]], starts)
            best[mine[order], o] = np.repeat(value, np.diff(np.append(starts, len(mine))))
        change = np.ones(best.shape, bool)
        change[:, 1:] = best[:, 1:] != best[:, :-1]
        row, column = np.nonzero(change)
        value, stop = best[row, column], np.append(column[1:], 0)
        inside = value >= 0
        parts.append((many[row[inside]], column[inside], stop[inside] - 1, value[inside]))
    c, a, b, m = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(c, kind="stable")
    return context, c[order], a[order], b[order], m[order]


def _reply(shard: int, runs: list[int], blobs: list[bytes]) -> Iterator[tuple[int, bytes]]:
    asked = [exchange.unpack_arrays(b, "u1", "u1", "<i8", "<i8") for b in blobs]
    recs = [front_decode(a[0], a[1]) for a in asked]
    owner, place, prefix = merge([r.view(">u8").tolist() for r in recs], [a[0].tolist() for a in asked])
    owner, place, prefix = np.array(owner), np.array(place), np.array(prefix)
    off = np.concatenate([[0], np.cumsum([len(r) for r in recs])])
    index = off[owner] + place
    low, high = np.concatenate([a[2] for a in asked])[index], np.concatenate([a[3] for a in asked])[index]
    ids, rank = np.unique(low, return_inverse=True)  # ranks, so that no id is below zero
    context, c, a, b, m = least_ids(np.concatenate(recs)[index], prefix, rank)
    first = np.searchsorted(c, np.arange(context[-1] + 2))
    per = np.diff(first)[context]
    entry = np.repeat(np.arange(len(index)), per)
    row = np.arange(len(entry)) + np.repeat(first[context] - (np.cumsum(per) - per), per)
    earlier = ids[m[row]]
    some = earlier < high[entry]
    entry, row, earlier = entry[some], row[some], earlier[some]
    by_run = np.argsort(owner[entry], kind="stable")
    cut = np.searchsorted(owner[entry][by_run], np.arange(len(runs) + 1))
    for i, run in enumerate(runs):
        mine = by_run[cut[i]:cut[i + 1]]
        if len(mine):
            yield run, exchange.pack_arrays(place[entry[mine]].astype(np.uint32), a[row[mine]].astype(np.uint8), b[row[mine]].astype(np.uint8), earlier[mine])


def covered(chunk: pa.RecordBatch, own: bytes, got: dict[int, bytes]) -> np.ndarray:
    """Whether each byte of a run's texts is removed."""
    data, off = text_buffer(chunk.column(1))
    number, at, rows, cut = exchange.unpack_arrays(own, "<u4", "<i8", "<u4", "<i8")
    ids = _ids(chunk.column(0))
    by_number = np.argsort(number, kind="stable")
    first = np.searchsorted(number[by_number], np.arange(int(cut[-1]) + 1))
    starts, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for shard in sorted(got):
        place, near, far, earlier = exchange.unpack_arrays(got[shard], "<u4", "u1", "u1", "<i8")
        c = place.astype(np.int64) + cut[shard]
        per = first[c + 1] - first[c]
        answer = np.repeat(np.arange(len(c)), per)
        hit = by_number[np.arange(len(answer)) + np.repeat(first[c] - (np.cumsum(per) - per), per)]
        mine = earlier[answer] < ids[rows[hit]]
        hit, answer = hit[mine], answer[mine]
        starts.append(at[hit] - far[answer])
        ends.append(at[hit] - near[answer] + SPAN)
    size = len(data) + 1
    change = np.bincount(np.concatenate(starts), minlength=size) - np.bincount(np.concatenate(ends), minlength=size)
    return np.cumsum(change[:-1]) > 0


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _result(run: int, chunk: pa.RecordBatch, got: dict[int, bytes]) -> list[pa.RecordBatch]:
    data, off = text_buffer(chunk.column(1))
    gone = covered(chunk, got.pop(OWN), got)
    start = gone.copy()
    start[1:] &= ~gone[:-1]
    edges = off[:-1][np.diff(off) > 0]
    start[edges] = gone[edges]
    total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[off])
    removed = total(gone)
    kept, cut = memoryview(data[~gone].tobytes()), np.concatenate([[0], np.cumsum(np.diff(off) - removed)]).tolist()
    sha = [hashlib.sha256(kept[a:b]).hexdigest() for a, b in zip(cut[:-1], cut[1:], strict=True)]
    return [pa.RecordBatch.from_arrays([chunk.column(0), pa.array(np.diff(off)), pa.array(removed), pa.array(total(start)), pa.array(sha, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])]


def _answers(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored chunks; stored occurrences of every run and the shards' answers to it: (run, shard, blob).

    The messages go once they are answered, and a step's shuffle files once
    its result is stored: what is on disk at a time is one step's.
    """
    spark, base = docs.sparkSession, scratch_path(docs.sparkSession, "suffix-runs")
    bits, chunks = exchange.shard_bits(docs), exchange.packed(docs, ["doc_id", "text"])
    stored = lambda name: spark.read.schema(f"{exchange.MESSAGES}, own boolean").parquet(f"{base}/{name}")
    with shuffles_removed(spark):
        flags = exchange.answer(exchange.send(chunks, _ask(bits)), _repeated)
        runs = exchange.finish(chunks, flags, _runs(bits), exchange.MESSAGES).selectExpr("*", f"shard = {OWN} AS own")
        runs.write.option("compression", "uncompressed").partitionBy("own").parquet(f"{base}/runs")
        replies = exchange.answer(stored("runs").where("NOT own").drop("own"), _reply)
        replies.write.option("compression", "uncompressed").parquet(f"{base}/answers")
    remove_scratch(spark, f"{base}/runs/own=false")
    answers = spark.read.schema(exchange.MESSAGES).parquet(f"{base}/answers")
    return chunks, stored("runs").where("own").drop("own").union(answers)


def repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of ``docs``."""
    return exchange.finish(*_answers(docs), _result, RESULT)


def deduplicated(docs: DataFrame) -> DataFrame:
    """(doc_id, kept): the bytes that stay of every row's text."""
    def work(run: int, chunk: pa.RecordBatch, got: dict[int, bytes]) -> list[pa.RecordBatch]:
        data, off = text_buffer(chunk.column(1))
        stay = ~covered(chunk, got.pop(OWN), got)
        kept, cut = data[stay].tobytes(), np.concatenate([[0], np.cumsum(stay)])[off].tolist()
        return [pa.RecordBatch.from_arrays([chunk.column(0), pa.array([kept[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())], ["doc_id", "kept"])]

    return exchange.finish(*_answers(docs), work, "doc_id long, kept binary")
