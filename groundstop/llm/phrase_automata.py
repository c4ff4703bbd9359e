"""Substring deduplication by sharded automata of confirmed repeated phrases.

A word is removed if a window of 20 consecutive words covers it whose word
sequence also starts in a document with a smaller doc_id, or earlier in the
same document.

1. *Anchors.*  Of the 13 8-grams of words in a window the one with the least
   hash (the leftmost of equals) is its anchor, so equal windows have theirs at
   the same place.  The windows of one anchor lie side by side; the words they
   cover are its context.  Every chunk of documents (a run) asks shards which
   of its anchors another document holds.
2. *Contexts.*  A run sends each shard the distinct contexts of the anchors
   that recur, with the least and greatest doc_id that holds them.  An anchor
   whose contexts differ in many places (a common line) is hot: each of its
   windows is then a context of its own, dealt by the window's hash, so a
   frequent phrase does not gather its surroundings in one shard.
3. *Confirm.*  A shard takes its contexts a few megabytes at a time, numbers
   their words (a dictionary, not a hash) and finds the windows that documents
   with different ids hold.  Neighbouring windows held by the same contexts are
   one phrase, so a copied passage is one phrase and not its windows.
4. *Compile and stream.*  The phrases become an Aho-Corasick automaton over
   word numbers, and all contexts are streamed through it: every occurrence of
   every phrase, and with it the least doc_id, goes back to the runs.
5. The runs mark the words; repeats within one document are found by its run.

Windows are told apart by words when located; 64-bit hashes choose anchors
(equal windows always agree) and propose phrases.

Cases: a null, empty or blank text has no words; a text under 20 words stays
whole; a null doc_id is larger than any other; rows that repeat a doc_id are
documents of their own, of which neither covers the other; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from groundstop.llm import exchange
from groundstop.llm.chunks import mix, span_hashes, text_buffer, words
from groundstop.session import scratch_path

SPAN, GRAM = 20, 8
CHOICE = SPAN - GRAM + 1
#: Bytes of an anchor's hash that travel, besides the shard's number.
KEY_BYTES = 4
#: Distinct contexts (about) from which on an anchor's windows go apart.
HOT = 500
#: Bytes of contexts that one automaton is made for.
AUTOMATON_BYTES = 4 << 20
NO_ID = np.iinfo(np.int64).max
#: Odd factors that join two halves of a hash, by rule.
_JOIN = {k: np.uint64((0x9E3779B97F4A7C15 * (2 * k + 1)) % (1 << 64)) for k in (1, 2, 4, 8, 16)}


class Words(NamedTuple):
    """The words of a chunk: each with one space behind it in ``text``, ``start`` (one more than words), row ends ``off`` in words."""

    text: np.ndarray
    start: np.ndarray
    off: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.off) - 1), np.diff(self.off))


def split(texts: pa.Array) -> Words:
    """Words of every text, white space made one space."""
    data, off = text_buffer(texts)
    starts, ends, rows = words(data, off)
    lens = ends - starts
    before = np.cumsum(lens) - lens
    source = np.arange(int(lens.sum()))
    text = np.full(len(source) + len(lens), 0x20, np.uint8)
    text[source + np.repeat(np.arange(len(lens)), lens)] = data[source + np.repeat(starts - before, lens)]
    per = np.bincount(rows, minlength=len(off) - 1)
    return Words(text, np.concatenate([[0], np.cumsum(lens + 1)]), np.concatenate([[0], np.cumsum(per)]))


def _rolled(codes: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` codes at each place (8 or 20)."""
    h = {1: codes}
    for k in (1, 2, 4, 8)[:3 if length == 8 else 4]:
        h[2 * k] = h[k][:-k] * _JOIN[k] + h[k][k:]
    if length == 8:
        return mix(h[8])
    n = len(codes) - 19
    return mix(h[16][:n] * _JOIN[16] + h[4][16:16 + n])


def _firsts(values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)


class Anchors(NamedTuple):
    key: np.ndarray  # hash of the anchor's words
    first: np.ndarray  # word at which its first window starts
    last: np.ndarray  # word at which its last window starts
    row: np.ndarray


def anchors(some: Words, codes: np.ndarray) -> Anchors:
    """The anchors of all windows, in order."""
    per = np.diff(some.off) - SPAN + 1
    rows = np.flatnonzero(per > 0)
    if len(rows) == 0:
        z = np.zeros(0, np.int64)
        return Anchors(z.astype(np.uint64), z, z, z)
    grams = _rolled(codes, GRAM)
    h, place = grams, np.zeros(len(grams), np.uint8)
    for shift in (1, 2, 4, CHOICE - 8):
        later = h[shift:] < h[:-shift]
        place = np.where(later, place[shift:] + np.uint8(shift), place[:-shift])
        h = np.minimum(h[:-shift], h[shift:])
    per = per[rows]
    before = np.cumsum(per) - per
    window = np.arange(int(per.sum())) + np.repeat(some.off[rows] - before, per)
    at = window + place[window]
    new = np.ones(len(at), bool)
    new[1:] = at[1:] != at[:-1]
    new[before] = True
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return Anchors(grams[at[first]], window[first], window[last], rows[np.searchsorted(before, first, "right") - 1])


def _codes(some: Words) -> np.ndarray:
    return span_hashes(some.text, some.start[:-1], some.start[1:] - 1)


def _cut(keys: np.ndarray, bits: int) -> np.ndarray:
    return np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))


def _short(keys: np.ndarray, bits: int) -> np.ndarray:
    """The bytes of the keys that follow the shard's bits."""
    return exchange.low_bytes(keys >> np.uint64(64 - bits - 8 * KEY_BYTES), KEY_BYTES)


def _context_prints(some: Words, codes: np.ndarray, a: Anchors) -> np.ndarray:
    """16-bit hash of every anchor's context: its length and its outermost windows."""
    ends = _rolled(codes, SPAN) if len(a.key) else codes
    return (mix(ends[a.first] + _JOIN[2] * ends[a.last] + (a.last - a.first).astype(np.uint64)) >> np.uint64(48)).astype(np.uint16)


def _ask(bits: int):
    """A run's distinct anchors: how many contexts each has, a hash of one of them, and whether several rows hold it."""
    def make(chunk: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
        some = split(chunk.column(1))
        codes = _codes(some)
        a = anchors(some, codes)
        prints = _context_prints(some, codes, a)
        order = np.lexsort((a.row, prints, a.key))
        keys, prints, rows = a.key[order], prints[order], a.row[order]
        first = _firsts(keys)
        if len(first) == 0:
            return
        change = np.append(True, (keys[1:] != keys[:-1]) | (prints[1:] != prints[:-1]))
        contexts = np.minimum(np.add.reduceat(change, first, dtype=np.int64), 65535).astype(np.uint16)
        several = np.minimum.reduceat(rows, first) != np.maximum.reduceat(rows, first)
        keys, prints = keys[first], prints[first]
        cut = _cut(keys, bits)
        for shard in np.flatnonzero(np.diff(cut)).tolist():
            mine = slice(cut[shard], cut[shard + 1])
            yield shard, exchange.pack_arrays(_short(keys[mine], bits), contexts[mine], prints[mine], several[mine])

    return make


#: What a shard says of an anchor.
ONCE, AGAIN, APART = 0, 1, 2


def _recurrence(hot: int):
    def reply(shard: int, runs: list[int], blobs: list[bytes]) -> Iterator[tuple[int, bytes]]:
        asked = [exchange.unpack_arrays(b, "u1", "<u2", "<u2", "?") for b in blobs]
        keys = [exchange.from_low_bytes(a[0], KEY_BYTES) for a in asked]
        every, place = np.unique(np.concatenate(keys), return_inverse=True)
        contexts, prints, several = (np.concatenate([a[k] for a in asked]) for k in (1, 2, 3))
        held = np.bincount(place, 1 + several, len(every)) > 1
        # Runs whose printed contexts agree hold the same ones, about.
        kind = (place.astype(np.uint64) << np.uint64(16)) | prints
        order = np.argsort(kind, kind="stable")
        first = _firsts(kind[order])
        differ = np.bincount(place[order][first], np.maximum.reduceat(contexts[order], first), len(every))
        says = np.where(differ > hot, APART, np.where(held, AGAIN, ONCE)).astype(np.uint8)[place]
        at = 0
        for run, k in zip(runs, keys, strict=True):
            yield run, exchange.pack_arrays(says[at:at + len(k)])
            at += len(k)

    return reply


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(NO_ID).to_numpy(zero_copy_only=False)


def _numbered(pieces: pa.LargeBinaryArray) -> np.ndarray:
    """Equal pieces, equal numbers."""
    return pieces.dictionary_encode().indices.to_numpy().astype(np.int64)


def _pieces(text: np.ndarray, start: np.ndarray) -> pa.LargeBinaryArray:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start) - 1, [None, pa.py_buffer(np.ascontiguousarray(start, np.int64)), pa.py_buffer(np.ascontiguousarray(text))])


def repeats_within(some: Words, codes: np.ndarray) -> np.ndarray:
    """Starts of the windows whose words start earlier in the same row."""
    per = np.maximum(np.diff(some.off) - SPAN + 1, 0)
    if int(per.sum()) == 0:
        return np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(per)), per)
    at = np.arange(len(row)) + np.repeat(some.off[:-1] - (np.cumsum(per) - per), per)
    h = mix(_rolled(codes, SPAN)[at] ^ mix(row.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(h)
    first = _firsts(h[order])
    count = np.diff(np.append(first, len(h)))
    twice = np.sort(order[np.repeat(count > 1, count)])
    if len(twice) == 0:
        return twice
    number = _numbered(_pieces(some.text, some.start)).astype(np.uint32)
    raw, seen, out = number.tobytes(), set(), []
    for r, p in zip(row[twice].tolist(), at[twice].tolist(), strict=True):
        window = (r, raw[4 * p:4 * (p + SPAN)])
        if window in seen:
            out.append(p)
        seen.add(window)
    return np.array(out, np.int64)


#: Shard number under which a run keeps its own occurrences.
OWN = -2


def _contexts(bits: int):
    """A run's distinct contexts for every shard, and under ``OWN`` where they stand and what repeats within its rows."""
    def work(run: int, chunk: pa.RecordBatch, got: dict[int, bytes]) -> list[pa.RecordBatch]:
        some = split(chunk.column(1))
        codes = _codes(some)
        a = anchors(some, codes)
        says = np.concatenate([exchange.unpack_arrays(got[s], "u1")[0] for s in sorted(got)]) if got else np.zeros(0, np.uint8)
        said = says[np.searchsorted(np.unique(a.key), a.key)] if len(a.key) else says
        again, apart = np.flatnonzero(said == AGAIN), np.flatnonzero(said == APART)
        per = (a.last - a.first + 1)[apart]
        window = np.arange(int(per.sum())) + np.repeat(a.first[apart] - (np.cumsum(per) - per), per)
        key = np.concatenate([a.key[again], _rolled(codes, SPAN)[window] if len(window) else a.key[:0]])
        first = np.concatenate([a.first[again], window])
        last = np.concatenate([a.last[again], window])
        row = np.concatenate([a.row[again], np.repeat(a.row[apart], per)])
        ids = _ids(chunk.column(0))[row]
        order = np.argsort(key >> np.uint64(64 - bits - 8 * KEY_BYTES), kind="stable")
        key, first, last, row, ids = key[order], first[order], last[order], row[order], ids[order]
        text, begin, end = some.text.tobytes(), some.start[first].tolist(), some.start[last + SPAN].tolist()
        known: dict[bytes, int] = {}
        number = np.fromiter((known.setdefault(text[b:e], len(known)) for b, e in zip(begin, end, strict=True)), np.int64, len(begin))
        low, high = np.full(len(known), NO_ID), np.full(len(known), np.iinfo(np.int64).min)
        np.minimum.at(low, number, ids)
        np.maximum.at(high, number, ids)
        opens = np.unique(number, return_index=True)[1]  # numbers are in order of the keys
        key, contexts = key[opens], list(known)
        shard = (key >> np.uint64(64 - bits)).astype(np.int64)
        cut = np.searchsorted(shard, np.arange((1 << bits) + 1))
        out = [(OWN, exchange.pack_arrays(number.astype(np.uint32), first, row.astype(np.uint32), cut, repeats_within(some, codes)))]
        for s in np.flatnonzero(np.diff(cut)).tolist():
            mine = slice(cut[s], cut[s + 1])
            raw = b"".join(contexts[mine])
            lens = np.fromiter(map(len, contexts[mine]), np.uint32)
            out.append((s, exchange.pack_arrays(_short(key[mine], bits), lens, np.frombuffer(raw, np.uint8), low[mine], high[mine])))
        return [pa.RecordBatch.from_arrays([pa.array([run] * len(out), pa.int64()), pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary())], ["run", "shard", "blob"])]

    return work


def phrases(number: np.ndarray, off: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, word after the last) of every phrase to compile, and the contexts that hold one.

    ``number`` are the words of all contexts, ``off`` their ends; ``low`` and
    ``high`` the least and greatest doc_id of each context's documents.
    """
    per = np.diff(off) - SPAN + 1
    owner = np.repeat(np.arange(len(per)), per)
    at = np.arange(len(owner)) + np.repeat(off[:-1] - (np.cumsum(per) - per), per)
    h = _rolled(mix(number.astype(np.uint64) + np.uint64(1)), SPAN)[at]
    order = np.argsort(h, kind="stable")
    first = _firsts(h[order])
    kind = np.empty(len(h), np.int64)
    kind[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(h))))
    by = owner[order]
    recurs = (np.minimum.reduceat(low[by], first) < np.maximum.reduceat(high[by], first))[kind]
    holders = np.bitwise_xor.reduceat(mix(by.astype(np.uint64) + np.uint64(1)), first)[kind]
    speaker = by[first][kind] == owner  # the first context that holds a window brings its phrase
    mine = np.flatnonzero(recurs & speaker)
    new = np.append(True, (mine[1:] != mine[:-1] + 1) | (owner[mine[1:]] != owner[mine[:-1]]) | (holders[mine[1:]] != holders[mine[:-1]])) if len(mine) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(mine)) - 1 if len(starts) else starts
    return at[mine[starts]], at[mine[ends]] + SPAN, np.unique(owner[recurs])


def locate(number: np.ndarray, off: np.ndarray, begin: np.ndarray, end: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, first word within it, phrase) of every occurrence of the phrases in the contexts ``where``."""
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    flat = number.tolist()
    for i, (b, e) in enumerate(zip(begin.tolist(), end.tolist(), strict=True)):
        automaton.add_word(tuple(flat[b:e]), i)
    automaton.make_automaton()
    contexts, stops, found = [], [], []
    for c in where.tolist():
        for stop, i in automaton.iter(tuple(flat[off[c]:off[c + 1]])):
            contexts.append(c)
            stops.append(stop)
            found.append(i)
    found = np.array(found, np.int64)
    return np.array(contexts, np.int64), np.array(stops, np.int64) + 1 - (end - begin)[found], found


def _occurrences(texts: list[bytes], low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """(context, first window, last window, least doc_id) of all phrases in distinct contexts."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    stops = np.flatnonzero(raw == 0x20) + 1
    number = _numbered(_pieces(raw, np.concatenate([[0], stops])))
    off = np.concatenate([[0], np.searchsorted(stops, np.cumsum([len(t) for t in texts])) + 1])
    begin, end, where = phrases(number, off, low, high)
    if len(begin) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z, z
    context, first, phrase = locate(number, off, begin, end, where)
    least = np.full(len(begin), NO_ID)
    np.minimum.at(least, phrase, low[context])
    return context, first, first + (end - begin)[phrase] - SPAN, least[phrase]


def _reply(shard: int, runs: list[int], blobs: list[bytes]) -> Iterator[tuple[int, bytes]]:
    asked = [exchange.unpack_arrays(b, "u1", "<u4", "u1", "<i8", "<i8") for b in blobs]
    keys = np.concatenate([exchange.from_low_bytes(a[0], KEY_BYTES) for a in asked])
    sizes = np.concatenate([a[1] for a in asked]).astype(np.int64)
    raw = np.concatenate([a[2] for a in asked]).tobytes()
    low, high = np.concatenate([a[3] for a in asked]), np.concatenate([a[4] for a in asked])
    run = np.repeat(np.arange(len(asked)), [len(a[1]) for a in asked])
    place = np.concatenate([np.arange(len(a[1])) for a in asked])
    stop = np.cumsum(sizes)
    order = np.argsort(keys, kind="stable")
    first = _firsts(keys[order])
    filled = np.cumsum(np.add.reduceat(sizes[order], first))
    part = np.repeat(filled // AUTOMATON_BYTES, np.diff(np.append(first, len(order))))  # equal keys stay together
    answers: list[list[tuple[np.ndarray, ...]]] = [[] for _ in runs]
    edges = np.append(_firsts(part), len(part))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        mine = order[a:b]
        known: dict[bytes, int] = {}
        unique = np.fromiter((known.setdefault(raw[e - n:e], len(known)) for e, n in zip(stop[mine].tolist(), sizes[mine].tolist(), strict=True)), np.int64, len(mine))
        least, most = np.full(len(known), NO_ID), np.full(len(known), np.iinfo(np.int64).min)
        np.minimum.at(least, unique, low[mine])
        np.maximum.at(most, unique, high[mine])
        context, start, last, earliest = _occurrences(list(known), least, most)
        by = np.argsort(context, kind="stable")
        context, start, last, earliest = context[by], start[by], last[by], earliest[by]
        opens = np.searchsorted(context, np.arange(len(known) + 1))
        per = np.diff(opens)[unique]
        entry = np.repeat(mine, per)
        row = np.arange(len(entry)) + np.repeat(opens[unique] - (np.cumsum(per) - per), per)
        later = earliest[row] < high[entry]
        entry, row = entry[later], row[later]
        owner = np.argsort(run[entry], kind="stable")
        cut = np.searchsorted(run[entry][owner], np.arange(len(runs) + 1))
        for i in np.flatnonzero(np.diff(cut)).tolist():
            e, r = entry[owner[cut[i]:cut[i + 1]]], row[owner[cut[i]:cut[i + 1]]]
            answers[i].append((place[e].astype(np.uint32), start[r].astype(np.uint8), last[r].astype(np.uint8), earliest[r]))
    for number, some in zip(runs, answers, strict=True):
        if some:
            yield number, exchange.pack_arrays(*(np.concatenate(x) for x in zip(*some, strict=True)))


def covered(ids: np.ndarray, some: Words, own: bytes, got: dict[int, bytes]) -> np.ndarray:
    """Whether each word of a run's texts is removed."""
    number, at, rows, cut, within = exchange.unpack_arrays(own, "<u4", "<i8", "<u4", "<i8", "<i8")
    by = np.argsort(number, kind="stable")
    opens = np.searchsorted(number[by], np.arange(int(cut[-1]) + 1))
    starts, ends = [within], [within + SPAN]
    for shard in sorted(got):
        place, first, last, earliest = exchange.unpack_arrays(got[shard], "<u4", "u1", "u1", "<i8")
        c = place.astype(np.int64) + cut[shard]
        per = opens[c + 1] - opens[c]
        answer = np.repeat(np.arange(len(c)), per)
        hit = by[np.arange(len(answer)) + np.repeat(opens[c] - (np.cumsum(per) - per), per)]
        mine = earliest[answer] < ids[rows[hit]]
        hit, answer = hit[mine], answer[mine]
        starts.append(at[hit] + first[answer])
        ends.append(at[hit] + last[answer] + SPAN)
    size = int(some.off[-1]) + 1
    change = np.bincount(np.concatenate(starts), minlength=size) - np.bincount(np.concatenate(ends), minlength=size)
    return np.cumsum(change[:-1]) > 0


def _kept(chunk: pa.RecordBatch, got: dict[int, bytes]) -> tuple[Words, np.ndarray, list[bytes]]:
    """The chunk's words, whether each is removed, and the kept words of every row joined by one space."""
    some = split(chunk.column(1))
    gone = covered(_ids(chunk.column(0)), some, got.pop(OWN), got)
    size = np.diff(some.start)
    text = some.text[np.repeat(~gone, size)].tobytes()
    cut = np.concatenate([[0], np.cumsum(np.where(gone, 0, size))])[some.off].tolist()
    return some, gone, [text[a:max(a, b - 1)] for a, b in zip(cut[:-1], cut[1:], strict=True)]


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _result(run: int, chunk: pa.RecordBatch, got: dict[int, bytes]) -> list[pa.RecordBatch]:
    some, gone, kept = _kept(chunk, got)
    removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[some.off])
    return [pa.RecordBatch.from_arrays([
        chunk.column(0), pa.array(np.diff(some.off)), pa.array(removed), pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())],
        ["doc_id", "n_words", "n_removed", "kept_sha256"])]


def _answers(docs: DataFrame, hot: int) -> tuple[DataFrame, DataFrame]:
    """Stored chunks; stored occurrences of every run and the shards' answers to it: (run, shard, blob)."""
    spark, base = docs.sparkSession, scratch_path(docs.sparkSession, "phrases")
    bits, chunks = exchange.shard_bits(docs), exchange.packed(docs, ["doc_id", "text"])
    says = exchange.answer(exchange.send(chunks, _ask(bits)), _recurrence(hot))
    exchange.finish(chunks, says, _contexts(bits), exchange.MESSAGES).write.parquet(f"{base}/contexts")
    contexts = spark.read.parquet(f"{base}/contexts")
    exchange.answer(contexts.where("shard >= 0"), _reply).write.parquet(f"{base}/answers")
    return chunks, contexts.where(f"shard = {OWN}").union(spark.read.parquet(f"{base}/answers"))


def repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row of ``docs``."""
    return exchange.finish(*_answers(docs, hot), _result, RESULT)


def deduplicated(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc_id, kept): the words that stay of every row's text, joined by one space."""
    def work(run: int, chunk: pa.RecordBatch, got: dict[int, bytes]) -> list[pa.RecordBatch]:
        return [pa.RecordBatch.from_arrays([chunk.column(0), pa.array(_kept(chunk, got)[2], pa.binary()).cast(pa.string())], ["doc_id", "kept"])]

    return exchange.finish(*_answers(docs, hot), work, "doc_id long, kept string")


def removed_spans(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc_id, start, length): the maximal runs of removed words, counted in words from 0."""
    def work(run: int, chunk: pa.RecordBatch, got: dict[int, bytes]) -> list[pa.RecordBatch]:
        some, gone, _ = _kept(chunk, got)
        row = some.row
        edge = np.append(True, row[1:] != row[:-1]) if len(row) else np.zeros(0, bool)
        before, after = np.roll(gone, 1) & ~edge, np.roll(gone, -1) & ~np.roll(edge, -1)
        starts, ends = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after)
        return [pa.RecordBatch.from_arrays([chunk.column(0).take(pa.array(row[starts])), pa.array(starts - some.off[row[starts]]), pa.array(ends - starts + 1)], ["doc_id", "start", "length"])]

    return exchange.finish(*_answers(docs, hot), work, "doc_id long, start long, length long")
