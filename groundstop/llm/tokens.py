"""Token ids of whole texts, encoded once per distinct piece.

The byte-level vocabulary splits a text before merging; a single space (or
line feed) between two visible characters always starts a new split, and so
does a change between letters, digits and signs, so a text may be cut there
and the pieces encoded apart with the same result.  New pieces are encoded
many at a time, joined by line feeds, and the ids are parted at the line
feed's id.  Texts of a chunk are cut at all such places, the distinct pieces
are encoded with the tokenizers library, and the ids are put together with
numpy.  Places near any byte that could belong to other Unicode white space
are left uncut, which is always right and only slower; no cut falls into the
string of a special token.

A worker remembers pieces in flat arrays (hash, bytes, ids), a few dozen
bytes each; a remembered piece is compared byte by byte.  When the memory is
full, pieces that were not met again since the last time go.
"""

from __future__ import annotations

import functools
import os
import re

import numpy as np
import pyarrow as pa

from groundstop.llm.chunks import span_hashes, text_buffer

#: Pieces that a worker remembers before it lets go of some.
MAX_PIECES = 900_000

_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
_AFTER = _VISIBLE.copy()
_AFTER[0x80:] = True
_AFTER[[0xC2, 0xE1, 0xE2, 0xE3]] = False  # lead bytes of Unicode white space
#: ASCII classes: 1 letter, 2 digit, 3 sign, 0 the rest.
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = 3
_KIND[0x30:0x3A] = 2
_KIND[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = 1
#: Second bytes of the two-byte letters that begin with 0xC3.
_C3_LETTER = np.zeros(256, bool)
_C3_LETTER[0x80:0xC0] = True
_C3_LETTER[[0x97, 0xB7]] = False
#: A piece that line feeds may enclose: visible at both ends but for one space before.
_PLAIN = re.compile(r" ?\S(?:[^\n]*\S)?")
_HIGH = np.zeros(256, bool)
_HIGH[0x80:] = True
_LEAD3 = np.zeros(256, bool)
_LEAD3[[0xE1, 0xE2, 0xE3]] = True


def cuts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sorted positions at which the texts may be cut, row offsets included."""
    n = len(data)
    gap = np.flatnonzero((data == 0x20) | (data == 0x0A))
    gap = gap[(gap >= 3) & (gap < n - 1)]
    left, right = data[gap - 1], data[gap + 1]
    high = _HIGH[left] & (data[gap - 2] != 0xC2) & ~_LEAD3[data[gap - 3]]
    gap = gap[(_VISIBLE[left] | high) & _AFTER[right]]
    edge = np.zeros(n + 2, bool)
    edge[off] = True
    gap = gap[~(edge[gap] | edge[gap + 1] | edge[gap - 1] | edge[gap - 2])]
    edge[gap] = True
    edge[gap[data[gap] == 0x0A] + 1] = True
    if n:
        kind = _KIND[data]
        kind[1:][(data[:-1] == 0xC3) & _C3_LETTER[data[1:]]] = 1  # the end of a two-byte letter
        # Between letters, digits and signs; a sign that may begin a contraction stays with what follows.
        # A row that ends or begins there has its edge already, and a letter's second byte never follows a cut.
        change = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0) & (data[1:] < 0x80) & (data[:-1] != 0x27)
        edge[1:n][change] = True
    return np.flatnonzero(edge[:n + 1])


def _room(array: np.ndarray, size: int) -> np.ndarray:
    """The array with room for ``size`` values."""
    return array if size <= len(array) else np.concatenate([array, np.zeros(max(size, 2 * len(array)) - len(array), array.dtype)])


def gather(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches ``values[first:first + size]`` one after the other."""
    before = np.cumsum(size) - size
    return values[np.arange(int(size.sum())) + np.repeat(first - before, size)]


class Encoder:
    """Encodes chunks with one tokenizer and remembers the ids of pieces.

    Strings of special tokens in a text are what the library makes of them:
    the special id, or with ``split_specials`` ordinary text.
    """

    def __init__(self, path: str, split_specials: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = split_specials
        self.specials = [] if split_specials else [np.frombuffer(t.content.encode(), np.uint8) for t in self.tokenizer.get_added_tokens_decoder().values()]
        feed = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.feed = feed[0] if len(feed) == 1 else None
        self.limit = MAX_PIECES
        self._forget()

    def _forget(self) -> None:
        self.hash, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # by hash
        self.count = self.used = self.length = 0  # pieces, ids, bytes
        self.first, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32)
        self.begin, self.bytes = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32)
        self.again, self.fine = np.zeros(1 << 14, bool), np.zeros(1 << 14, bool)
        self.ids, self.raw = np.zeros(1 << 16, np.uint32), np.zeros(1 << 18, np.uint8)

    def _age(self) -> None:
        """Let go of the pieces not met again, and of the oldest if too many stay."""
        stay = np.sort(self.slot[self.again[self.slot]])[-(self.limit // 2):]
        some = [a[stay] for a in (self.first, self.size, self.begin, self.bytes, self.fine)]
        ids, raw = gather(self.ids, some[0], some[1]), gather(self.raw, some[2], some[3])
        self._forget()
        if len(stay):
            self._keep(span_hashes(raw, np.cumsum(some[3]) - some[3], np.cumsum(some[3])), raw, some[3], ids, some[1], some[4])

    def cuts(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        at = cuts(data, off)
        for s in self.specials:
            if len(data) >= len(s):
                found = np.flatnonzero(data[:len(data) - len(s) + 1] == s[0])
                for k in range(1, len(s)):
                    found = found[data[found + k] == s[k]]
                if len(found):
                    inside = np.searchsorted(found, at, "left") - 1  # the last one that begins before the place
                    at = at[(inside < 0) | (at >= found[np.maximum(inside, 0)] + len(s)) | np.isin(at, off)]
        return at

    def ids_of(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, number of each piece's ids), by the library."""
        if self.feed is not None:
            apart = [i for i, p in enumerate(pieces) if not _PLAIN.fullmatch(p)]
        else:
            apart = range(len(pieces))
        out: list[np.ndarray] = []
        lens = np.zeros(len(pieces), np.int64)
        skip = set(apart)
        plain = [i for i in range(len(pieces)) if i not in skip] if skip else range(len(pieces))
        order = []
        for at in range(0, len(plain), 1_000):
            some = plain[at:at + 1_000]
            ids = np.array(self.tokenizer.encode_batch_fast(["\n".join([pieces[i] for i in some])], add_special_tokens=False)[0].ids, np.uint32)
            feeds = np.flatnonzero(ids == self.feed)
            size = np.diff(np.concatenate([[-1], feeds, [len(ids)]])) - 1
            if len(size) != len(some):
                raise ValueError("pieces and encodings do not match")
            lens[some if isinstance(some, list) else slice(some.start, some.stop)] = size
            out.append(np.delete(ids, feeds))
            order.append(np.asarray(some))
        for at in range(0, len(apart), 10_000):
            some = apart[at:at + 10_000]
            got = [e.ids for e in self.tokenizer.encode_batch_fast([pieces[i] for i in some], add_special_tokens=False)]
            lens[np.asarray(some)] = [len(g) for g in got]
            out.append(np.array([i for g in got for i in g], np.uint32))
            order.append(np.asarray(some))
        ids = np.concatenate(out) if out else np.zeros(0, np.uint32)
        if not skip or not len(plain):
            return ids, lens
        order = np.concatenate(order)
        first = np.empty(len(pieces), np.int64)
        first[order] = np.cumsum(lens[order]) - lens[order]
        return gather(ids, first, lens), lens

    def faithful(self, raw: np.ndarray, size: np.ndarray, ids: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Whether each new piece is what its ids spell; not asked here."""
        return np.ones(len(size), bool)

    def _keep(self, h: np.ndarray, raw: np.ndarray, size: np.ndarray, ids: np.ndarray, lens: np.ndarray, fine: np.ndarray) -> np.ndarray:
        """Remember pieces; their slots."""
        k, n = self.count, len(h)
        for name in ("first", "size", "begin", "bytes", "again", "fine"):
            setattr(self, name, _room(getattr(self, name), k + n))
        self.ids, self.raw = _room(self.ids, self.used + len(ids)), _room(self.raw, self.length + len(raw))
        self.ids[self.used:self.used + len(ids)] = ids
        self.raw[self.length:self.length + len(raw)] = raw
        self.first[k:k + n], self.size[k:k + n] = self.used + np.cumsum(lens) - lens, lens
        self.begin[k:k + n], self.bytes[k:k + n] = self.length + np.cumsum(size) - size, size
        self.again[k:k + n], self.fine[k:k + n] = False, fine
        self.count, self.used, self.length = k + n, self.used + len(ids), self.length + len(raw)
        new, at = np.unique(h, return_index=True)
        place = np.searchsorted(self.hash, new)
        known = np.zeros(len(new), bool)
        inside = place < len(self.hash)
        known[inside] = self.hash[place[inside]] == new[inside]  # another piece with this hash: not looked up again
        new, at, place = new[~known], at[~known], place[~known]
        self.hash, self.slot = np.insert(self.hash, place, new), np.insert(self.slot, place, (k + at).astype(np.int32))
        return np.arange(k, k + n)

    def _slots(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cuts, slot of each piece)."""
        at = self.cuts(data, off)
        pieces = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
        coded = pieces.dictionary_encode()
        raw, edge = text_buffer(coded.dictionary)
        size = np.diff(edge)
        if self.count + len(size) > self.limit:
            self._age()
        h = span_hashes(raw, edge[:-1], edge[1:])
        place = np.searchsorted(self.hash, h)
        found = np.full(len(h), -1)
        hit = np.flatnonzero(place < len(self.hash))
        hit = hit[self.hash[place[hit]] == h[hit]]
        slot = self.slot[place[hit]]
        same = self.bytes[slot] == size[hit]
        hit, slot = hit[same], slot[same]
        if len(hit):
            differ = gather(raw, edge[hit], size[hit]) != gather(self.raw, self.begin[slot], size[hit])
            same = ~np.logical_or.reduceat(differ, np.cumsum(size[hit]) - size[hit])
            hit, slot = hit[same], slot[same]
            found[hit] = slot
            self.again[slot] = True
        new = np.flatnonzero(found < 0)
        if len(new):
            ids, lens = self.ids_of(coded.dictionary.take(pa.array(new)).to_pylist())
            bytes_ = gather(raw, edge[new], size[new])
            found[new] = self._keep(h[new], bytes_, size[new], ids, lens, self.faithful(bytes_, size[new], ids, lens))
        return at, found[coded.indices.to_numpy()]

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows one after the other, number of ids of each row)."""
        return self.encode_checked(data, off)[:2]

    def encode_checked(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``encode``, and whether each row is what its ids spell (see ``faithful``)."""
        if len(data) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(off) - 1, np.int64), np.ones(len(off) - 1, bool)
        at, slot = self._slots(data, off)
        lens = self.size[slot].astype(np.int64)
        row = np.searchsorted(at, off)
        before = np.concatenate([[0], np.cumsum(lens)])
        wrong = np.concatenate([[0], np.cumsum(~self.fine[slot])])
        return gather(self.ids, self.first[slot], lens), np.diff(before[row]), np.diff(wrong[row]) == 0


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary file."""
    return Encoder(path)


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` after each row, and the new counts."""
    out = np.insert(ids, np.cumsum(counts), end_id) if len(counts) else ids
    return out, counts + 1
