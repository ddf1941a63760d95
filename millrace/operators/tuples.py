"""Decode the variable-length part of change messages, one Arrow batch at a time.

All messages of a batch are walked together, column by column, with array
arithmetic on one byte buffer. The number of Python steps depends on the widest
tuple in the batch and not on the number of rows.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20
_PAD = np.zeros(8, np.uint8)
_VALUE = pa.struct([("k", pa.int8()), ("v", pa.binary())])

# Bytes of the tuple format.
_NULL, _TEXT, _UNCHANGED, _BINARY = b"ntub"
_KEY, _OLD, _NEW = b"KON"
_INSERT, _UPDATE, _DELETE = b"IUD"

_REASONS = [None, "bad_hex", "short_message", "cut_tuple", "unknown_value_kind", "unknown_marker"]
_OK, _BAD_HEX, _SHORT, _CUT, _BAD_KIND, _BAD_MARKER = range(6)


def decode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace ``body`` by ``tag``, ``old``, ``new``, ``err``; other columns pass through.

    ``raw`` holds the bytes of messages that could not be read, and nothing else.
    """
    for batch in batches:
        for part in _by_size(batch):
            yield _decode(part)


def text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace ``body`` by ``old`` and ``new`` as lists of text, the ``kinds`` of the new values, and ``err``."""
    for batch in batches:
        for part in _by_size(batch):
            buf, old, new, has_old, has_new, _, err = _read(part)
            out = {name: part.column(name) for name in part.schema.names if name != "body"}
            out["old"], _ = _texts(buf, old, has_old)
            out["new"], out["kinds"] = _texts(buf, new, has_new)
            out["err"] = pa.array(_REASONS, pa.string()).take(pa.array(err))
            yield pa.RecordBatch.from_pydict(out)


def _by_size(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    offsets = _offsets(batch.column("body"))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, side="right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield batch.slice(first, last - first)
        first = last


def _offsets(body: pa.Array) -> np.ndarray:
    width = np.int64 if pa.types.is_large_binary(body.type) else np.int32
    found = np.frombuffer(body.buffers()[1], width)[body.offset : body.offset + len(body) + 1]
    return found.astype(np.int64)


def _read(batch: pa.RecordBatch):
    """The bytes of a batch, the values of old and new tuples, which messages have them, their markers, and what is wrong."""
    body = batch.column("body")
    offsets = _offsets(body)
    data = body.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else _PAD[:0]
    buf = np.concatenate([whole[offsets[0] : offsets[-1]], _PAD])
    start, end = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]

    err = np.zeros(len(body), np.int8)
    err[end - start < 8] = _SHORT
    err[np.asarray(body.is_null())] = _BAD_HEX
    usable = err == _OK
    op = np.where(usable, buf[start], 0)
    marker = np.where(usable, buf[np.minimum(start + 5, len(buf) - 1)], 0)

    has_old = (op == _DELETE) | ((op == _UPDATE) & ((marker == _KEY) | (marker == _OLD)))
    err[usable & (op == _UPDATE) & ~has_old & (marker != _NEW)] = _BAD_MARKER
    old, pos = _walk(buf, start + 6, end, has_old, err)

    second = has_old & (op == _UPDATE) & (err == _OK)
    at_end = second & (pos >= end)
    err[at_end] = _CUT
    second &= ~at_end
    err[second & (buf[np.minimum(pos, len(buf) - 1)] != _NEW)] = _BAD_MARKER
    has_new = ((op == _INSERT) | (op == _UPDATE)) & (err == _OK)
    new, _ = _walk(buf, np.where(second, pos + 1, start + 6), end, has_new, err)

    keep = err == _OK
    return buf, old, new, has_old & keep, has_new & keep, marker, err


def _decode(batch: pa.RecordBatch) -> pa.RecordBatch:
    body = batch.column("body")
    buf, old, new, has_old, has_new, marker, err = _read(batch)
    tags = pa.array([None, "K", "O"], pa.string()).take(pa.array(np.where(marker == _KEY, 1, 2) * has_old))
    out = {name: batch.column(name) for name in batch.schema.names if name != "body"}
    out["tag"] = tags
    out["old"] = _lists(buf, old, has_old)
    out["new"] = _lists(buf, new, has_new)
    out["err"] = pa.array(_REASONS, pa.string()).take(pa.array(err))
    raw: list = [None] * len(body)
    for i in np.flatnonzero(err != _OK).tolist():
        raw[i] = body[i].as_py()
    out["raw"] = pa.array(raw, pa.binary())
    return pa.RecordBatch.from_pydict(out)


def _int32(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    # Every place of the buffer as the start of a number: the views overlap.
    return np.ndarray((len(buf) - 3,), ">i4", buf, strides=(1,))[at].astype(np.int32)


def _walk(buf, pos, end, active, err):
    """Kind, start and size of every value in the tuples of the active messages."""
    pos = np.where(active, pos, 0)
    count = np.zeros(len(pos), np.int64)
    short = active & (pos + 2 > end)
    err[short] = _CUT
    rows = np.flatnonzero(active & ~short)
    count[rows] = (buf[pos[rows]].astype(np.int16) << 8 | buf[pos[rows] + 1]).astype(np.int16)
    err[count < 0] = _CUT
    count = np.maximum(count, 0)
    pos[rows] += 2

    width = int(count.max(initial=0))
    kind = np.zeros((len(pos), width), np.uint8)
    first = np.zeros((len(pos), width), np.int32)
    size = np.zeros((len(pos), width), np.int32)
    for column in range(width):
        rows = rows[(count[rows] > column) & (err[rows] == _OK)]
        at, stop = pos[rows], end[rows]
        inside = at < stop
        tag = np.where(inside, buf[at], 0)
        sized = (tag == _TEXT) | (tag == _BINARY)
        length = np.where(sized, _int32(buf, np.where(sized, at + 1, 0)), 0)
        begin = at + np.where(sized, 5, 1)
        known = sized | (tag == _NULL) | (tag == _UNCHANGED)
        fits = inside & (length >= 0) & (begin + length <= stop)
        err[rows[~fits]] = _CUT
        err[rows[inside & ~known]] = _BAD_KIND
        kind[rows, column] = tag
        first[rows, column] = begin
        size[rows, column] = np.where(fits, length, 0)
        pos[rows] = begin + np.where(fits, length, 0)
    return (count, kind, first, size), pos


def _lists(buf: np.ndarray, found, present: np.ndarray) -> pa.ListArray:
    """Arrow list of (kind, value) per message."""
    ends, kinds, cut = _cut_out(buf, found, present)
    items = pa.StructArray.from_arrays([kinds, pa.Array.from_buffers(pa.binary(), len(kinds), cut)], fields=list(_VALUE))
    return pa.ListArray.from_arrays(ends, items, mask=pa.array(~present))


def _texts(buf: np.ndarray, found, present: np.ndarray) -> tuple[pa.ListArray, pa.ListArray]:
    """Arrow lists of the values as text, bytes as they are, and of their kinds."""
    ends, kinds, cut = _cut_out(buf, found, present)
    none = pa.array(~present)
    texts = pa.Array.from_buffers(pa.string(), len(kinds), cut)
    return pa.ListArray.from_arrays(ends, texts, mask=none), pa.ListArray.from_arrays(ends, kinds, mask=none)


def _cut_out(buf: np.ndarray, found, present: np.ndarray) -> tuple[pa.Array, pa.Array, list[pa.Buffer]]:
    """Ends of the lists, kinds of the values, and buffers of the values, whose bytes are cut out in one pass."""
    count, kind, first, size = found
    count = np.where(present, count, 0)
    used = np.arange(kind.shape[1]) < count[:, None]
    kinds, starts, sizes = kind[used], first[used].astype(np.int64), size[used].astype(np.int64)

    # Values lie in the buffer in the order they are emitted: gaps and values take turns.
    lengths = np.empty(2 * len(starts), np.int64)
    lengths[1::2] = sizes
    lengths[::2] = np.diff(starts, prepend=0)
    lengths[2::2] -= sizes[:-1]
    inside = np.repeat(np.arange(len(lengths)) % 2 == 1, lengths)
    values = buf[: len(inside)][inside]

    offsets = np.zeros(len(kinds) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    valid = np.packbits((kinds == _TEXT) | (kinds == _BINARY), bitorder="little")
    ends = np.zeros(len(count) + 1, np.int32)
    np.cumsum(count, out=ends[1:])
    cut = [pa.py_buffer(valid), pa.py_buffer(offsets), pa.py_buffer(values)]
    return pa.array(ends), pa.array(kinds.view(np.int8)), cut
