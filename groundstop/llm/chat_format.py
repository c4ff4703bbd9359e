"""Chat formatting by columnar byte assembly.

A turn becomes ``<s>[INST] role [/INST] text</s>``.  Inside roles and texts a
backslash is doubled and a control string gets a backslash after its first
character, so no control string of a text can be taken for the template's
and the original can be read back.  The lengths of all segments of a chunk
give cumulative offsets and scatter indices; headers and contents are copied
into one preallocated buffer, which becomes the Arrow column as it is.  The
loss mask is the list of (start, length) byte spans of the assistant texts.

A conversation is stored as one or more segments of at most a chunk, so one
that holds a large share of all rows never has to fit in memory.

Cases: a null text or role is empty; rows of one conversation are taken in
the order of turn, then role, then text (null first), repeated rows stay; a
null conv_id is one conversation of its own; an empty table gives only what
the caller adds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundstop.llm.chunks import slices, text_buffer
from groundstop.session import scratch_path

#: The control strings of the template.
CONTROLS = (b"<s>", b"</s>", b"[INST]", b"[/INST]")
OPEN, MIDDLE, CLOSE = b"<s>[INST] ", b" [/INST] ", b"</s>"
ESCAPE = 0x5C
LOSS_ROLE = b"assistant"


def find(data: np.ndarray, what: bytes, off: np.ndarray | None = None) -> np.ndarray:
    """Positions of ``what``; with offsets, only where it lies inside one row."""
    if len(data) < len(what):
        return np.zeros(0, np.int64)
    at = np.flatnonzero(data[:len(data) - len(what) + 1] == what[0])
    for j in range(1, len(what)):
        at = at[data[at + j] == what[j]]
    if off is not None and len(at):
        at = at[at + len(what) <= off[np.searchsorted(off, at, "right")]]
    return at


def escape(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Column with backslashes doubled and control strings broken, and its offsets."""
    at = np.sort(np.concatenate([np.flatnonzero(data == ESCAPE), *(find(data, c, off) + 1 for c in CONTROLS)]))
    return np.insert(data, at, ESCAPE), off + np.searchsorted(at, off, "left")


def unescape(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inverse of ``escape``: of every run of backslashes in a row the first, third, ... go."""
    back = np.flatnonzero(data == ESCAPE)
    if len(back) == 0:
        return data, off
    row = np.searchsorted(off, back, "right")
    new = np.ones(len(back), bool)
    new[1:] = (np.diff(back) != 1) | (np.diff(row) != 0)
    first = np.flatnonzero(new)
    place = np.arange(len(back)) - np.repeat(first, np.diff(np.append(first, len(back))))
    gone = back[place % 2 == 0]
    return np.delete(data, gone), off - np.searchsorted(gone, off, "left")


def take_spans(data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans one after the other, and their offsets."""
    off = np.concatenate([[0], np.cumsum(lens)])
    return data[np.arange(off[-1]) + np.repeat(starts - off[:-1], lens)], off


def assemble(segments: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of segments in one buffer.

    A segment is ``bytes`` (the same for every row) or a column (data,
    offsets).  Returns the buffer, row offsets and the start of every segment
    (rows x segments).
    """
    rows = next(len(s[1]) - 1 for s in segments if not isinstance(s, bytes))
    lens = np.stack([np.full(rows, len(s)) if isinstance(s, bytes) else np.diff(s[1]) for s in segments], axis=1)
    ends = np.cumsum(lens.ravel()).reshape(lens.shape)
    starts = ends - lens
    out = np.empty(int(ends[-1, -1]) if rows else 0, np.uint8)
    for j, s in enumerate(segments):
        if isinstance(s, bytes):
            out[starts[:, j, None] + np.arange(len(s))] = np.frombuffer(s, np.uint8)
        else:
            out[np.arange(len(s[0])) + np.repeat(starts[:, j] - s[1][:-1], lens[:, j])] = s[0]
    return out, np.append(starts[:, 0], len(out)), starts


FORMATTED = "conv_id long, segment long, n_turns long, formatted binary, loss_start array<long>, loss_len array<long>"


def _format_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, number = object(), 0
    for batch in batches:
        for some in slices(batch, "text"):
            key = some.column(0)
            ids = key.fill_null(0).to_numpy(zero_copy_only=False)
            known = key.is_valid().to_numpy(zero_copy_only=False)
            roles, texts = text_buffer(some.column(1)), text_buffer(some.column(2))
            text = escape(*texts)
            data, off, starts = assemble([OPEN, escape(*roles), MIDDLE, text, CLOSE])
            n = some.num_rows
            cut = np.concatenate([[0], 1 + np.flatnonzero((ids[1:] != ids[:-1]) | (known[1:] != known[:-1])), [n]])
            lens = np.diff(roles[1])
            lost = np.flatnonzero(lens == len(LOSS_ROLE))
            lost = lost[(roles[0][roles[1][lost][:, None] + np.arange(len(LOSS_ROLE))] == np.frombuffer(LOSS_ROLE, np.uint8)).all(axis=1)] if len(lost) else lost
            base = off[cut[:-1]][np.searchsorted(cut, lost, "right") - 1]
            lists = np.searchsorted(lost, cut).astype(np.int32)
            names = [key[int(c)].as_py() for c in cut[:-1]]
            numbers = []
            for name in names:
                number = number + 1 if name == last else 0
                last = name
                numbers.append(number)
            body = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(names), [None, pa.py_buffer(off[cut].astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([
                pa.array(names, pa.int64()), pa.array(numbers, pa.int64()), pa.array(np.diff(cut)), body,
                pa.ListArray.from_arrays(pa.array(lists), pa.array(starts[lost, 3] - base)),
                pa.ListArray.from_arrays(pa.array(lists), pa.array(np.diff(text[1])[lost]))],
                ["conv_id", "segment", "n_turns", "formatted", "loss_start", "loss_len"])


def format_conversations(turns: DataFrame) -> DataFrame:
    """Formatted segments of conversations given as rows (conv_id, turn, role, text)."""
    rows = turns.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.select("conv_id", "role", "text").mapInArrow(_format_rows, FORMATTED)


def parse(data: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """(roles, texts) columns of a formatted buffer, original again."""
    begin, middle, end = find(data, OPEN) + len(OPEN), find(data, MIDDLE), find(data, CLOSE)
    if not len(begin) == len(middle) == len(end):
        raise ValueError("not a formatted conversation")
    roles = unescape(*take_spans(data, begin, middle - begin))
    return roles, unescape(*take_spans(data, middle + len(MIDDLE), end - middle - len(MIDDLE)))


def _points(data: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])


def _check_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def empty(name):
        return {"conv_id": name, "n_turns": 0, "turns": hashlib.sha256(), "loss_chars": 0, "loss": hashlib.sha256(), "formatted_chars": 0}

    def close(done: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([d["conv_id"] for d in done], pa.int64()), pa.array([d["n_turns"] for d in done], pa.int64()), pa.array([d["turns"].hexdigest() for d in done]),
            pa.array([d["loss_chars"] for d in done], pa.int64()), pa.array([d["loss"].hexdigest() for d in done]), pa.array([d["formatted_chars"] for d in done], pa.int64())],
            ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    now = None
    for batch in batches:
        for some in slices(batch, "formatted"):
            done: list[dict] = []
            data, off = text_buffer(some.column(2))
            roles, texts = parse(data)
            plain, cut, _ = assemble([roles, b"\n", texts, b"\n"])
            turns = some.column(1).to_numpy()
            cut = cut[np.concatenate([[0], np.cumsum(turns)])]
            lists, spans = some.column(3), some.column(4)
            owner = np.repeat(np.arange(some.num_rows), np.diff(lists.offsets.to_numpy()))
            masked, span_off = unescape(*take_spans(data, lists.flatten().to_numpy() + off[owner], spans.flatten().to_numpy()))
            mask_cut = span_off[np.searchsorted(owner, np.arange(some.num_rows + 1))]
            chars, mask_chars = np.diff(_points(data)[off]), np.diff(_points(masked)[mask_cut])
            for i, name in enumerate(some.column(0).to_pylist()):
                if now is None or now["conv_id"] != name:
                    if now is not None:
                        done.append(now)
                    now = empty(name)
                now["n_turns"] += int(turns[i])
                now["turns"].update(plain[cut[i]:cut[i + 1]])
                now["loss"].update(masked[mask_cut[i]:mask_cut[i + 1]])
                now["loss_chars"] += int(mask_chars[i])
                now["formatted_chars"] += int(chars[i])
            if done:
                yield close(done)
    if now is not None:
        yield close([now])


def conversation_checks(formatted: DataFrame) -> DataFrame:
    """What formatted segments hold, read back: one row per conversation."""
    rows = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "segment").select("conv_id", "n_turns", "formatted", "loss_start", "loss_len")
    return rows.mapInArrow(_check_rows, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def format_and_check(turns: DataFrame) -> DataFrame:
    """Store the formatted conversations and return ``conversation_checks`` of what was stored."""
    spark = turns.sparkSession
    out = scratch_path(spark, "chat-formatted")
    format_conversations(turns).write.parquet(out)
    return conversation_checks(spark.read.parquet(out))
