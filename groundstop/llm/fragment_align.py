"""Alignment of two tokenizers over the same bytes, by an associative monoid of fragments.

A text with one space before it is spelled by the byte-level vocabulary (A)
and by the piece vocabulary (B, which adds the space itself).  Where a token
of A and one of B end at the same byte, the text is cut; the tokens between
two cuts are a group, and the two that end together are linked.

*Fragments.*  The tokens of any byte range of A and any byte range of B give
a fragment: an open prefix (the tokens up to the first common end), closed
groups, and an open suffix.  Two neighbours compose: the suffix of the left
and the prefix of the right are matched, which closes the groups between.
Composition is associative, so fragments may be joined in any tree.

*Long texts.*  A text above ``RANGE`` bytes is dealt to many tasks in ranges
that begin where each vocabulary itself allows a cut (for B before a space,
for A at more places), so the ranges of A and B may differ.  Fragments are stored; a tree of joins over ``FAN`` neighbours moves
only the open ends, and the groups closed at seams become rows of their own.
A short text is one fragment of one range.

*Counts.*  A chunk of documents (a run) or a long text's fragment sends each
shard of B's ids its distinct linked id pairs with their number, once; the
shard adds them up, finds the highest pair of each B id and answers.

Cases: texts that are null, empty, or not what either vocabulary spells (a
text with U+2581, which B reads as a space) have no tokens: zeros and ''.
Strings of special tokens are ordinary text.  Rows may repeat ids and texts
(each is a document of its own); a doc_id may be null; an empty table gives no
rows; other columns are not read.  A text without any place to cut is one range.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundstop.llm import exchange
from groundstop.llm.chunks import slices, text_buffer
from groundstop.llm.tokens import Encoder, gather
from groundstop.session import scratch_path, scratch_scope

#: Bytes of text that one range of a long text holds, about.
RANGE = 1 << 20
#: Bytes of text that one chunk of short texts holds, about.
CHUNK_BYTES = 2 << 20
#: Pieces that a worker remembers of each vocabulary.
PIECES = 400_000
#: Fragments that one step of the tree joins.
FAN = 16
#: Bytes of text for which one shard of the pair counts is planned.
COUNT_BYTES = 64 << 20
#: Runs of long texts' parts are numbered from here on, seams from twice that.
LONG = 1 << 61


# --- the two vocabularies


def _byte_of_char() -> dict[str, int]:
    """The bytes that the characters of a byte-level vocabulary stand for: printable ones for themselves, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in shown}
    hidden = [b for b in range(256) if b not in set(shown)]
    out.update({chr(0x100 + i): b for i, b in enumerate(hidden)})
    return out


class Spelling(NamedTuple):
    """The bytes of every id."""

    raw: np.ndarray
    first: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, pieces: list[bytes]) -> "Spelling":
        size = np.array([len(p) for p in pieces], np.int64)
        return cls(np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(size) - size, size)


class Spelled(Encoder):
    """An encoder that knows which pieces its ids spell byte by byte."""

    spelling: Spelling

    def faithful(self, raw: np.ndarray, size: np.ndarray, ids: np.ndarray, lens: np.ndarray) -> np.ndarray:
        ids = ids.astype(np.int64)
        per = self.spelling.size[ids]
        total = np.diff(np.concatenate([[0], np.cumsum(per)])[np.concatenate([[0], np.cumsum(lens)])])
        same = total == size
        ids = ids[np.repeat(same, lens)]
        spelled = gather(self.spelling.raw, self.spelling.first[ids], self.spelling.size[ids])
        differ = np.concatenate([[0], np.cumsum(spelled != raw[np.repeat(same, size)])])
        out = same.copy()
        out[same] = np.diff(differ[np.concatenate([[0], np.cumsum(size[same])])]) == 0
        return out


class ByteSpelled(Spelled):
    """Vocabulary A."""

    def __init__(self, path: str):
        super().__init__(path, split_specials=True)
        self.limit = PIECES
        table = _byte_of_char()
        names = {i: t for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items()}
        self.spelling = Spelling.of([bytes(table[c] for c in names.get(i, "") if c in table) for i in range(max(names) + 1)])


class PieceSpelled(Spelled):
    """Vocabulary B.  Every row begins with the space that it adds, so pieces are cut before single words' spaces."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(" " in p.replace("▁", " ").lstrip(" ") for p in pieces):
            raise ValueError("a piece of this vocabulary goes on after a space: texts cannot be cut before spaces")
        raw = [bytes([int(p[1:-1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.spelling, self.limit = Spelling.of(raw), PIECES
        self._forget()

    def cuts(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        edge = np.zeros(len(data) + 1, bool)
        edge[off] = True
        edge[1:-1] |= (data[1:] == 0x20) & (data[:-1] != 0x20)
        return np.flatnonzero(edge)

    def ids_of(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        space = self.model.piece_to_id("▁")
        got = [g if p != " " else [space] for p, g in zip(pieces, self.model.encode([p[1:] for p in pieces], num_threads=1), strict=True)]
        return np.array([i for g in got for i in g], np.uint32), np.fromiter(map(len, got), np.int64, len(got))


@functools.lru_cache(maxsize=1)
def _vocabularies(a: str, b: str) -> tuple[ByteSpelled, PieceSpelled]:
    """One pair of encoders per worker process."""
    return ByteSpelled(a), PieceSpelled(b)


# --- the monoid


class Open(NamedTuple):
    """Tokens in order: ids and ends (byte offsets in the text) of A and of B."""

    a: np.ndarray
    a_end: np.ndarray
    b: np.ndarray
    b_end: np.ndarray

    def __add__(self, other: "Open") -> "Open":
        return Open(*(np.concatenate([x, y]) for x, y in zip(self, other, strict=True)))

    def until(self, end: int) -> tuple["Open", "Open"]:
        """The tokens that end at ``end`` or before, and the rest."""
        i, j = np.searchsorted(self.a_end, end, "right"), np.searchsorted(self.b_end, end, "right")
        return Open(self.a[:i], self.a_end[:i], self.b[:j], self.b_end[:j]), Open(self.a[i:], self.a_end[i:], self.b[j:], self.b_end[j:])

    def common(self) -> np.ndarray:
        return np.intersect1d(self.a_end, self.b_end, assume_unique=True)


NOTHING = Open(np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int64))


class Fragment(NamedTuple):
    """``cut``: whether A and B have a common end in it.  Without one all tokens are in ``prefix``."""

    cut: bool
    prefix: Open
    suffix: Open


def fragment(tokens: Open) -> tuple[Fragment, Open]:
    """The fragment of some tokens, and the tokens of its closed groups."""
    ends = tokens.common()
    if len(ends) == 0:
        return Fragment(False, tokens, NOTHING), NOTHING
    prefix, rest = tokens.until(ends[0])
    closed, suffix = rest.until(ends[-1])
    return Fragment(True, prefix, suffix), closed


def compose(x: Fragment, y: Fragment) -> tuple[Fragment, Open]:
    """The fragment of two neighbours, and the tokens of the groups that close at their seam."""
    middle = (x.suffix if x.cut else x.prefix) + y.prefix
    ends = middle.common()
    if len(ends) == 0:  # then y has no common end either
        return (Fragment(True, x.prefix, middle) if x.cut else Fragment(False, middle, NOTHING)), NOTHING
    closed, rest = middle.until(ends[-1])
    prefix = x.prefix
    if not x.cut:
        prefix, closed = closed.until(ends[0])
    return Fragment(True, prefix, y.suffix if y.cut else rest), closed


# --- groups of many rows at once


def _groups(tokens: Open) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in A, place in B) of the tokens that end every group, and the groups' ends."""
    ends, i, j = np.intersect1d(tokens.a_end, tokens.b_end, assume_unique=True, return_indices=True)
    return i, j, ends


@functools.lru_cache(maxsize=1)
def _decimals(n: int) -> pa.Array:
    """Every id in decimal, followed by one of ``,`` ``|`` ``;`` or nothing."""
    return pa.array([f"{i}{s}".encode() for i in range(n) for s in (",", "|", ";", "")], pa.large_binary())


def _spelled_groups(tokens: Open, i: np.ndarray, j: np.ndarray, last: np.ndarray, ids: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets per group) of ``a1,a2|b1;`` for groups that end at tokens ``i`` and ``j``; without ``;`` where ``last``."""
    n_a, n_b = np.diff(np.concatenate([[-1], i])), np.diff(np.concatenate([[-1], j]))
    before = np.cumsum(n_a + n_b) - n_a - n_b
    total = int((n_a + n_b).sum())
    ids_, sign = np.empty(total, np.int64), np.zeros(total, np.int64)
    shift_a, shift_b = before - (np.cumsum(n_a) - n_a), before + n_a - (np.cumsum(n_b) - n_b)
    ids_[np.arange(int(n_a.sum())) + np.repeat(shift_a, n_a)] = tokens.a[:int(n_a.sum())]
    ids_[np.arange(int(n_b.sum())) + np.repeat(shift_b, n_b)] = tokens.b[:int(n_b.sum())]
    sign[before + n_a - 1] = 1
    sign[before + n_a + n_b - 1] = np.where(last, 3, 2)
    text, off = text_buffer(_decimals(ids).take(pa.array(ids_ * 4 + sign)))
    return text, off[np.concatenate([before, [total]])]


def _pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (b.astype(np.uint64) << np.uint64(32)) | a.astype(np.uint64)


def _pair_messages(keys: np.ndarray, counts: np.ndarray, shards: int) -> Iterator[tuple[int, bytes]]:
    """Distinct pairs (sorted) with their counts, for the shards of their B ids."""
    shard = (keys >> np.uint64(32)).astype(np.int64) % shards
    order = np.argsort(shard, kind="stable")
    cut = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(cut)).tolist():
        mine = order[cut[s]:cut[s + 1]]
        yield s, exchange.pack_arrays(keys[mine], counts[mine])


def _sums(shard: int, runs: list[int], blobs: list[bytes]) -> Iterator[tuple[int, bytes]]:
    """For each pair of a run its count over all runs, and whether no pair of its B id has a higher one."""
    asked = [exchange.unpack_arrays(b, "<u8", "<i8") for b in blobs]
    keys, place = np.unique(np.concatenate([a[0] for a in asked]), return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, place, np.concatenate([a[1] for a in asked]))
    b = keys >> np.uint64(32)
    first = np.flatnonzero(np.append(True, b[1:] != b[:-1]))
    best = total == np.repeat(np.maximum.reduceat(total, first), np.diff(np.append(first, len(b))))
    at = 0
    for run, (k, _) in zip(runs, asked, strict=True):
        mine = place[at:at + len(k)]
        yield run, exchange.pack_arrays(k, total[mine], best[mine])
        at += len(k)


#: Shard number of a run's own rows.
OWN = -2
#: Rows of a run: ids of documents (or numbers of long texts) and what their tokens give; ``links`` names pairs of the run.
OWN_SCHEMA = pa.schema([("id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("sha", pa.string()), ("links", pa.list_(pa.uint32()))])


def _rows_and_messages(run: int, rows: pa.RecordBatch, keys: np.ndarray, counts: np.ndarray, shards: int) -> list[tuple[int, int, bytes]]:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(rows)
    return [(run, OWN, sink.getvalue().to_pybytes()), *((run, s, b) for s, b in _pair_messages(keys, counts, shards))]


def _linked(ids: pa.Array, n_a: np.ndarray, n_b: np.ndarray, sha: list[str | None], per: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray]:
    """The run's rows, its distinct pairs and their counts; ``per`` links of (a, b) belong to each row."""
    keys, which, counts = np.unique(_pair_keys(a, b), return_inverse=True, return_counts=True)
    links = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per)]), pa.int32()), pa.array(which.astype(np.uint32)))
    rows = pa.RecordBatch.from_arrays([ids, pa.array(n_a), pa.array(n_b), pa.array(per.astype(np.int64)), pa.array(sha, pa.string()), links], schema=OWN_SCHEMA)
    return rows, keys, counts.astype(np.int64)


def _before(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts that are not empty, each with a space before it, and which rows they are."""
    data, off = text_buffer(texts)
    rows = np.flatnonzero(np.diff(off) > 0)
    starts = off[:-1][rows]
    return np.insert(data, starts, 0x20), np.concatenate([starts + np.arange(len(rows)), [len(data) + len(rows)]]), rows


def _short(a: str, b: str, shards: int):
    """Messages (run, shard, blob) of chunks of short texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = _vocabularies(a, b)
        for batch in batches:
            for number, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                chunk = exchange.opened(blob)
                data, off, rows = _before(chunk.column(1))
                ids_a, n_a, good_a = first.encode_checked(data, off)
                ids_b, n_b, good_b = second.encode_checked(data, off)
                good = good_a & good_b
                ids_a, ids_b = ids_a[np.repeat(good, n_a)], ids_b[np.repeat(good, n_b)]
                n_a, n_b = np.where(good, n_a, 0), np.where(good, n_b, 0)
                # Ends within the texts that count, laid end to end: texts end at common ends.
                tokens = Open(ids_a, np.cumsum(first.spelling.size[ids_a]), ids_b, np.cumsum(second.spelling.size[ids_b]))
                i, j, ends = _groups(tokens)
                stop = np.cumsum(np.where(good, np.diff(off), 0))
                cut = np.searchsorted(ends, np.concatenate([[0], stop]), "right")
                last = np.zeros(len(ends), bool)
                last[np.searchsorted(ends, stop[good])] = True
                text, at = _spelled_groups(tokens, i, j, last, max(len(first.spelling.size), len(second.spelling.size)))
                view, edge = memoryview(text.tobytes()), at[cut].tolist()
                n = chunk.num_rows
                sha, per, all_a, all_b = [""] * n, np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
                for r, ok, x, y in zip(rows.tolist(), good.tolist(), edge[:-1], edge[1:], strict=True):
                    if ok:
                        sha[r] = hashlib.sha256(view[x:y]).hexdigest()
                per[rows], all_a[rows], all_b[rows] = np.diff(cut), n_a, n_b
                yield exchange.message_batch(_rows_and_messages(number, *_linked(chunk.column(0), all_a, all_b, sha, per, ids_a[i], ids_b[j]), shards))

    return run


# --- long texts


def _next_cut(encoder: Encoder, data: np.ndarray, at: int) -> int:
    """The first place at or after ``at`` where the encoder may cut the text, or its end."""
    margin, width = 32, 1 << 12
    while at + width < len(data):
        low, high = max(0, at - margin), min(len(data), at + width + margin)
        found = encoder.cuts(data[low:high], np.array([0, high - low])) + low
        found = found[(found >= at) & (found >= low + margin) & (found <= high - margin)]
        if len(found):
            return int(found[0])
        width *= 8
    low = max(0, at - margin)
    found = encoder.cuts(data[low:], np.array([0, len(data) - low])) + low
    found = found[found >= at]
    return int(found[0]) if len(found) else len(data)


RANGES = "key long, part long, parts long, doc_id long, base long, a0 long, a1 long, b0 long, b1 long, bytes binary"


def _ranges(a: str, b: str, size: int):
    """The ranges of long texts (one space before each); ``key`` numbers the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = _vocabularies(a, b)
        key = TaskContext.get().partitionId() << 32
        for batch in batches:
            for one in slices(batch, "text", 1):
                data, off = text_buffer(one.column(1))
                data = np.insert(data, 0, 0x20)
                cuts = [(0, 0)]
                while min(cuts[-1]) < len(data):
                    at = max(cuts[-1]) + size
                    cuts.append((_next_cut(first, data, at), _next_cut(second, data, at)) if at < len(data) else (len(data), len(data)))
                for part, ((a0, b0), (a1, b1)) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    base = min(a0, b0)
                    row = (key, part, len(cuts) - 1, one.column(0)[0].as_py(), base, a0 - base, a1 - base, b0 - base, b1 - base)
                    yield pa.RecordBatch.from_arrays([*(pa.array([x], pa.int64()) for x in row), pa.array([data[base:max(a1, b1)].tobytes()], pa.binary())],
                                                     ["key", "part", "parts", "doc_id", "base", "a0", "a1", "b0", "b1", "bytes"])
                key += 1

    return run


def _pack_open(x: Open) -> bytes:
    return exchange.pack_arrays(x.a.astype("<u4"), x.a_end.astype("<i8"), x.b.astype("<u4"), x.b_end.astype("<i8"))


def _open_of(blob: bytes) -> Open:
    return Open(*exchange.unpack_arrays(blob, "<u4", "<i8", "<u4", "<i8"))


#: ``node`` -1: tokens of closed groups (``prefix``); else a fragment of the tree's current level.
PARTS = "key long, node long, good boolean, at long, n_a long, n_b long, cut boolean, prefix binary, suffix binary"


def _part(key: int, node: int, good: bool, at: int, n_a: int, n_b: int, cut: bool, prefix: Open, suffix: Open) -> tuple:
    return key, node, good, at, n_a, n_b, cut, _pack_open(prefix), _pack_open(suffix)


def _parts_table(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary()]
    names = [f.split(" ")[0] for f in PARTS.split(", ")]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _start(tokens: Open) -> int:
    return int(min([*tokens.a_end[:1], *tokens.b_end[:1]], default=0))


def _fragments(a: str, b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = _vocabularies(a, b)
        for batch in batches:
            for r in batch.to_pylist():
                data = np.frombuffer(r["bytes"], np.uint8)
                tokens, good = [], True
                for encoder, x, y in ((first, r["a0"], r["a1"]), (second, r["b0"], r["b1"])):
                    ids, _, fine = encoder.encode_checked(data[x:y], np.array([0, y - x]))
                    good &= bool(fine.all())
                    tokens += [ids, r["base"] + x + np.cumsum(encoder.spelling.size[ids])]
                whole = Open(*tokens)
                one, closed = fragment(whole)
                rows = [_part(r["key"], r["part"], good, 0, len(whole.a), len(whole.b), one.cut, one.prefix, one.suffix)]
                if len(closed.a):
                    rows.append(_part(r["key"], -1, good, _start(closed), 0, 0, True, closed, NOTHING))
                yield from _parts_table(rows).combine_chunks().to_batches()

    return run


def _join(table: pa.Table) -> pa.Table:
    """Neighbouring fragments of one text as one, and the groups that close between them."""
    rows = sorted(table.to_pylist(), key=lambda r: r["node"])
    out, now = [], None
    for r in rows:
        one = Fragment(r["cut"], _open_of(r["prefix"]), _open_of(r["suffix"]))
        if now is None:
            now = one
            continue
        now, closed = compose(now, one)
        if len(closed.a):
            out.append(_part(r["key"], -1, True, _start(closed), 0, 0, True, closed, NOTHING))
    good = all(r["good"] for r in rows)
    out.append(_part(rows[0]["key"], rows[0]["node"] // FAN, good, 0, sum(r["n_a"] for r in rows), sum(r["n_b"] for r in rows), now.cut, now.prefix, now.suffix))
    return _parts_table(out)


def _long_messages(shards: int):
    """(run, shard, blob) of closed groups' rows; a row's links are its groups' last tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                tokens = _open_of(r["prefix"])
                i, j, ends = _groups(tokens)
                rows = _linked(pa.array([r["key"]], pa.int64()), np.zeros(1, np.int64), np.zeros(1, np.int64), [""], np.array([len(ends)]), tokens.a[i], tokens.b[j])
                yield exchange.message_batch(_rows_and_messages(r["run"], *rows, shards))

    return run


def _long_digests(ids: int):
    """(id, sha) of the texts whose rows of groups come in order of (key, at); one row of state."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None

        def done():
            return pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([digest.hexdigest()], pa.string())], ["id", "sha"])

        for batch in batches:
            for k, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                tokens = _open_of(blob.as_py())
                i, j, ends = _groups(tokens)
                last = np.zeros(len(ends), bool)
                last[-1] = True
                text, _ = _spelled_groups(tokens, i, j, last, ids)
                if k != key:
                    if key is not None:
                        yield done()
                    key, digest = k, hashlib.sha256()
                else:
                    digest.update(b";")
                digest.update(text.tobytes())
        if key is not None:
            yield done()

    return run


def _long_texts(docs: DataFrame, a: str, b: str, size: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(key, doc_id) of the long texts; (key, good, n_a, n_b); their closed groups (run, key, at, prefix)."""
    spark, base = docs.sparkSession, scratch_path(docs.sparkSession, "long-texts")

    def keep(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")

    ranges = keep("ranges", docs.select("doc_id", "text").mapInArrow(_ranges(a, b, size), RANGES))
    named = ranges.where("part = 0").select("key", "doc_id")
    level = keep("level-0", ranges.repartition("key", "part").select("key", "part", "base", "a0", "a1", "b0", "b1", "bytes").mapInArrow(_fragments(a, b), PARTS))
    closed, width, number = [level.where("node = -1")], ranges.agg(F.max("parts")).first()[0] or 0, 0
    while width > 1:
        number += 1
        tree = level.where("node >= 0").withColumn("up", F.floor(F.col("node") / FAN))
        level = keep(f"level-{number}", tree.groupBy("key", "up").applyInArrow(_join, PARTS))
        closed.append(level.where("node = -1"))
        width = -(-width // FAN)
    roots = level.where("node >= 0")  # a text begins and ends at a common end
    closed.append(roots.select("key", F.lit(-1).cast("long").alias("node"), "good", F.lit(-1).cast("long").alias("at"), "n_a", "n_b", "cut", "prefix", "suffix"))
    every = closed[0]
    for some in closed[1:]:
        every = every.union(some)
    groups = every.join(roots.where("good").select("key"), "key", "left_semi").select("key", "at", "prefix")
    groups = keep("groups", groups.withColumn("run", F.lit(LONG) + F.monotonically_increasing_id()))
    return named, roots.select("key", "good", "n_a", "n_b"), groups


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _counted(table: pa.Table) -> pa.Table:
    """What the rows of one run come to: its own rows and the shards' answers."""
    rows, answers = None, []
    for shard, blob in zip(table["shard"].to_pylist(), table["blob"], strict=True):
        if shard == OWN:
            rows = pa.ipc.open_stream(blob.as_buffer()).read_next_batch()
        else:
            answers.append(exchange.unpack_arrays(blob.as_py(), "<u8", "<i8", "?"))
    links = rows.column(5)
    per = np.diff(links.offsets.to_numpy())
    which = links.values.to_numpy()
    count, best = np.zeros(len(which), np.int64), np.zeros(len(which), bool)
    if len(which):
        keys, total, high = (np.concatenate(x) for x in zip(*answers, strict=True))
        order = np.argsort(keys)
        count, best = total[order][which], high[order][which]
    add = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[links.offsets.to_numpy()])
    columns = [rows.column(0), rows.column(1), rows.column(2), rows.column(3), pa.array(per.astype(np.int64)), pa.array(add(best)), pa.array(add(count)), rows.column(4)]
    return pa.table([pa.array(np.full(len(per), table["run"][0].as_py())), *columns], ["run", *(f.split(" ")[0] for f in RESULT.split(", "))])


def align(docs: DataFrame, byte_vocabulary: str, piece_vocabulary: str, range_bytes: int = RANGE) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row of ``docs``."""
    spark, base = docs.sparkSession, scratch_path(docs.sparkSession, "alignment")
    a, b = byte_vocabulary, piece_vocabulary
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, min(4096, total // COUNT_BYTES))
    is_long = F.coalesce(F.octet_length("text"), F.lit(0)) > range_bytes
    named, roots, groups = _long_texts(docs.where(is_long), a, b, range_bytes)
    with scratch_scope(spark):  # the chunks go when their messages are stored
        chunks = exchange.packed(docs.where(~is_long), ["doc_id", "text"], CHUNK_BYTES)
        messages = chunks.select("run", "blob").mapInArrow(_short(a, b, shards), exchange.MESSAGES).union(
            groups.select("run", "key", "prefix").mapInArrow(_long_messages(shards), exchange.MESSAGES))
        messages.write.option("compression", "uncompressed").parquet(f"{base}/messages")
    ids = max(len(v.spelling.size) for v in _vocabularies(a, b))
    messages = spark.read.parquet(f"{base}/messages")
    answers = exchange.answer(messages.where("shard >= 0"), _sums)
    counted = messages.where(f"shard = {OWN}").union(answers).groupBy("run").applyInArrow(_counted, "run long, " + RESULT)
    counted.write.parquet(f"{base}/counted")
    counted = spark.read.parquet(f"{base}/counted")
    names = [f.split(" ")[0] for f in RESULT.split(", ")]
    short = counted.where(F.col("run") < LONG).select(*names)
    sums = counted.where(F.col("run") >= LONG).groupBy(F.col("doc_id").alias("key")).agg(*(F.sum(c).alias(c) for c in ("n_groups", "n_links", "n_best", "count_sum")))
    ordered = groups.select("key", "at", "prefix").repartition("key").sortWithinPartitions("key", "at").select("key", "prefix")
    digests = ordered.mapInArrow(_long_digests(ids), "id long, sha string")
    long = named.join(roots, "key").join(sums, "key", "left").join(digests.withColumnRenamed("id", "key"), "key", "left")
    none = F.lit(0).cast("long")
    long = long.select(
        "doc_id", F.when(F.col("good"), F.col("n_a")).otherwise(none).alias("n_a"), F.when(F.col("good"), F.col("n_b")).otherwise(none).alias("n_b"),
        *(F.coalesce(c, none).alias(c) for c in ("n_groups", "n_links", "n_best", "count_sum")), F.coalesce("sha", F.lit("")).alias("groups_sha256"))
    return short.union(long.select(*names))
