"""Words of whole Arrow text columns, found and hashed by array arithmetic.

A word is a run of ASCII letters and digits (A-Z counted as a-z) and of bytes from 0x80 on.
"""
from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

_B = np.arange(256)
LOWER = np.where((_B >= 0x41) & (_B <= 0x5A), _B + 32, _B).astype(np.uint8)
IS_LETTER = ((_B >= 0x61) & (_B <= 0x7A)) | (_B >= 0x80)  # after LOWER
IS_WORD = ((_B >= 0x30) & (_B <= 0x39)) | ((_B >= 0x61) & (_B <= 0x7A)) | (_B >= 0x80)
_BASE, _BASE_INV = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_POWERS = {"n": 0, "up": None, "down": None}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit integers (finishing steps of splitmix)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _POWERS["n"] < n:
        size = max(n, 1 << 18)
        for key, base in (("up", _BASE), ("down", _BASE_INV)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[key] = np.multiply.accumulate(steps)
        _POWERS["n"] = size
    return _POWERS["up"], _POWERS["down"]


def parts(batches: Iterator[pa.RecordBatch], size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut into parts of about ``size`` bytes of text; a longer text is a part of its own."""
    for batch in batches:
        column = batch["text"].cast(pa.large_string())
        ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + size, "right")) - 1)
            yield batch.slice(lo, hi - lo)
            lo = hi


def text_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each text starts (one more at the end). Null: empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + len(col) + 1]
    data = col.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words(NamedTuple):
    hashes: np.ndarray  # uint64, in order of place
    first: np.ndarray  # of each text: place of its first word in hashes (one more at the end)
    spans: np.ndarray | None = None  # bytes where each word starts and ends
    raw: np.ndarray | None = None  # the bytes of all texts


def cuts(raw: np.ndarray, is_word: np.ndarray = IS_WORD, size: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Ranges of about ``size`` bytes that never split a word."""
    at = 0
    while at < len(raw):
        end = min(len(raw), at + size)
        while end < len(raw):
            stops = np.flatnonzero(~is_word[LOWER[raw[end : end + 4096]]])
            if len(stops):
                end += int(stops[0])
                break
            end = min(len(raw), end + 4096)
        yield at, end
        at = end


def hashed_words(col, is_word: np.ndarray = IS_WORD) -> Words:
    """Hashes of all words of a text column. Working memory follows the range of ``cuts``."""
    raw, offsets = text_bytes(col)
    found, ends_all = [], []
    for lo, hi in cuts(raw, is_word):
        low = LOWER[raw[lo:hi]]
        inside = is_word[low]
        edge = np.unique(offsets[np.searchsorted(offsets, lo) : np.searchsorted(offsets, hi, "right")] - lo)
        before, after = np.roll(inside, 1), np.roll(inside, -1)
        before[0] = after[-1] = False
        before[edge[edge < hi - lo]] = False
        after[edge[edge > 0] - 1] = False
        starts = np.flatnonzero(inside & ~before)
        ends = np.flatnonzero(inside & ~after) + 1
        up, down = _powers(hi - lo)
        total = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[: hi - lo], out=total[1:])
        found.append(mix((total[ends] - total[starts]) * down[starts]))
        ends_all.append(np.stack([starts, ends]) + lo)
    hashes = np.concatenate(found) if found else np.zeros(0, np.uint64)
    spans = np.concatenate(ends_all, axis=1) if ends_all else np.zeros((2, 0), np.int64)
    return Words(hashes, np.searchsorted(spans[0], offsets, "left"), spans, raw)


def windows(words: Words, size: int = 5) -> Words:
    """Hashes of all windows of ``size`` consecutive words of each text; a text with fewer words
    but at least one has one window of all of them."""
    n = np.diff(words.first)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    first = np.concatenate([[0], np.cumsum(count)])
    at = np.repeat(words.first[:-1] - first[:-1], count) + np.arange(first[-1])
    end = np.repeat(words.first[1:], count)
    out = np.zeros(len(at), dtype=np.uint64)
    for k in range(size):
        place = at + k
        ok = place < end
        h = np.where(ok, words.hashes[np.minimum(place, max(len(words.hashes) - 1, 0))], np.uint64(k)) if len(at) else out
        out = mix(out * np.uint64(_BASE) + h)
    return Words(out, first)


def labelled(items: Words) -> np.ndarray:
    """Hashes of items together with how often the same item stood before in its text."""
    owner = np.repeat(np.arange(len(items.first) - 1), np.diff(items.first))
    if not len(owner):
        return items.hashes
    order = np.lexsort((items.hashes, owner))
    h, o = items.hashes[order], owner[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    at = np.arange(len(h))
    times = at - np.maximum.accumulate(np.where(new, at, 0))
    out = np.empty_like(items.hashes)
    out[order] = np.where(times > 0, mix(h + times.astype(np.uint64) * np.uint64(_BASE)), h)
    return out
