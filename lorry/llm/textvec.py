"""Vectorised text helpers for Arrow string columns (numpy inside tasks).

Words are the maximal runs of bytes other than space and 0x09-0x0D, with A-Z
lower-cased.  All work is done on the raw UTF-8 bytes, a fraction of a MB at a time (what
processor caches hold), so
memory stays bounded whatever the batch holds.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
PRIME = 0x9E3779B97F4A7C15
_M64 = (1 << 64) - 1


def tidy(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The task, with what it freed given back to the system when it ends:
    workers are kept for later stages, and allocators keep what was freed."""

    def run(it: Iterator) -> Iterator:
        try:
            yield from task(it)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element by element."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def constants(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    first = (seed * 0xD1342543DE82EF95 + 1) & _M64
    return mix(np.uint64(first) + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(PRIME))


def byte_values() -> np.ndarray:
    """A random 64-bit value per byte, the same for A-Z and a-z."""
    t = constants(11, 256) | np.uint64(1)
    t[65:91] = t[97:123]
    return t


def powers(n: int, base: int = PRIME) -> np.ndarray:
    p = np.full(max(n, 1), base, np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


def batches(column: pa.Array, most: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yields ``(first row, last row + 1, bytes, offsets)`` of at most about
    ``most`` bytes each (one row at least); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offs = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo, n = 0, len(column)
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + most, "right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi, raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


class Words(NamedTuple):
    start: np.ndarray  # byte offsets into the buffer
    stop: np.ndarray
    doc: np.ndarray  # row in the chunk
    hash: np.ndarray  # 64 bits, case-folded


def _words(buf: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    separator = np.zeros(256, bool)
    separator[list(SEPARATORS)] = True
    inside = ~separator[buf]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    at = cuts[(cuts > 0) & (cuts < len(buf))]
    begin[at] = inside[at]
    last[at - 1] = inside[at - 1]
    start = np.flatnonzero(begin)
    stop = np.flatnonzero(last) + 1
    if not len(start):
        return start, stop, np.zeros(0, np.uint64)
    length = stop - start
    place = np.arange(len(buf), dtype=np.int64)
    place -= np.repeat(np.append(start, len(buf)), np.diff(np.concatenate([[0], start[1:], [len(buf)], [len(buf)]])))[: len(buf)]
    np.clip(place, 0, int(length.max()) - 1, out=place)
    value = byte_values()[buf] * powers(int(length.max()))[place]
    value[~inside] = 0
    return start, stop, mix(np.add.reduceat(value, start) + length.astype(np.uint64))


def words(buf: np.ndarray, offs: np.ndarray, most: int = 2 * CHUNK) -> Words:
    """All words of the chunk, in order.  A text longer than ``most`` bytes is
    worked through in pieces cut at separators."""
    out, lo = [], 0
    while lo < len(buf) or not out:
        hi = min(len(buf), lo + most)
        while hi < len(buf) and buf[hi] not in SEPARATORS:  # a long word stays whole
            ahead = np.flatnonzero(np.isin(buf[hi:hi + 4096], SEPARATORS))
            hi = hi + int(ahead[0]) if len(ahead) else min(len(buf), hi + 4096)
            if len(ahead):
                break
        s, e, h = _words(buf[lo:hi], offs - lo)
        out.append((s + lo, e + lo, h))
        lo = hi
        if lo >= len(buf):
            break
    start, stop, h = (np.concatenate(x) for x in zip(*out, strict=True))
    return Words(start, stop, np.searchsorted(offs, start, "right") - 1, h)


def shingles(w: Words, n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words within a document, with the documents
    (ascending).  A document of fewer words has its whole sequence as one."""
    n = len(w.hash)
    count = np.bincount(w.doc, minlength=n_docs)
    first = np.cumsum(count) - count
    p = powers(k + 1, 0xD6E8FEB86659FD93)
    at = np.flatnonzero((w.doc[: max(0, n - k + 1)] == w.doc[k - 1:]) if n >= k else np.zeros(0, bool))
    h = np.zeros(len(at), np.uint64)
    for j in range(k):
        h += w.hash[at + j] * p[j + 1]
    short = np.flatnonzero((count > 0) & (count < k))
    doc = w.doc[at]
    if len(short):
        own = np.zeros(len(short), np.uint64)
        for j in range(k - 1):
            has = count[short] > j
            own[has] += w.hash[first[short[has]] + j] * p[j + 1]
        h, doc = np.concatenate([h, own + count[short].astype(np.uint64)]), np.concatenate([doc, short])
        order = np.argsort(doc, kind="stable")
        h, doc = h[order], doc[order]
    return mix(h), doc


def distinct(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of each document, ascending by document and hash."""
    if not len(h):
        return h, doc
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[keep], doc[keep]


def lists(values: np.ndarray, doc: np.ndarray, n_docs: int, kind: pa.DataType) -> pa.ListArray:
    """Arrow list column: the values of each document (``doc`` ascending)."""
    offs = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n_docs))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(values, kind))
