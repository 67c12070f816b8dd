"""Vectorised helpers on whole texts: Arrow buffers in, numpy arrays out.

Texts are handled as UTF-8 bytes. A batch is cut into slices of about
``SLICE_BYTES`` bytes at document borders (a longer document is a slice of its
own), so the memory of the numpy temporaries is bounded by the longest text.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of the words ``[^\x20\x09-\x0D]+``.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False

#: Bytes of the words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of lower-cased texts.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = True
ALNUM[97:123] = True
ALNUM[128:] = True

_MULT = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_MULT), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of an odd multiplier and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        n = max(n, 2 * SLICE_BYTES)
        for k, m in enumerate((_MULT, _INV)):
            p = np.full(n, m, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of an Arrow text column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def slices(off: np.ndarray, limit: int = SLICE_BYTES):
    """Row ranges (lo, hi) of about ``limit`` bytes; a longer row stands alone."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def text_slices(column, limit: int = SLICE_BYTES):
    """(lo, hi, bytes, offsets) of each slice of a text column."""
    data, off = text_buffers(column)
    for lo, hi in slices(off, limit):
        o = off[lo : hi + 1]
        yield lo, hi, data[o[0] : o[-1]], o - o[0]


def word_bounds(data: np.ndarray, off: np.ndarray, table: np.ndarray):
    """Starts, ends and document index of the maximal runs of ``table`` bytes; runs end at document borders."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = table[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    begins = off[:-1][off[:-1] < off[1:]]
    ends = off[1:][off[:-1] < off[1:]] - 1
    first[begins] = inside[begins]
    last[ends] = inside[ends]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    return s, e, np.searchsorted(off, s, side="right") - 1


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """C with C[j] - C[i] a polynomial in data[i:j], to be scaled by the inverse power of i."""
    p, _ = powers(len(data) + 1)
    c = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p[: len(data)], out=c[1:])
    return c


def span_hash(c: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [s, e) of the text whose prefix hash is c."""
    _, inv = powers(len(c))
    h = (c[e] - c[s]) * inv[s]
    return mix(h + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    return span_hash(prefix_hash(data), s, e)


def distinct_sorted(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values (np.unique without its hash table)."""
    x = np.sort(x)
    if len(x) < 2:
        return x
    keep = np.empty(len(x), bool)
    keep[0] = True
    np.not_equal(x[1:], x[:-1], out=keep[1:])
    return x[keep]


def distinct_counts(x: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values with their counts, or their sums of weights."""
    if not len(x):
        return x, np.zeros(0, np.int64)
    if weights is not None:
        order = np.argsort(x, kind="stable")
        x = x[order]
    else:
        x = np.sort(x)
    at = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
    if weights is None:
        return x[at], np.diff(np.append(at, len(x)))
    return x[at], np.add.reduceat(weights[order], at)


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The integers of all ranges [start, start + length), one after the other."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    keep = lengths > 0
    starts, lengths = np.asarray(starts, np.int64)[keep], lengths[keep]
    step = np.ones(total, np.int64)
    at = np.cumsum(lengths)[:-1]
    step[0] = starts[0]
    step[at] = starts[1:] - starts[:-1] - lengths[:-1] + 1
    return np.cumsum(step)


def pack_keys(key: np.ndarray, count: np.ndarray) -> bytes:
    """Sorted keys as differences, with counts; by byte planes, compressed."""
    step = np.diff(key, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    planes = [step.T.tobytes(), count.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()]
    return zlib.compress(b"".join(planes), 1)


def unpack_keys(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zlib.decompress(raw), np.uint8).reshape(10, -1)
    step = np.zeros((planes.shape[1], 8), np.uint8)
    step[:, :6] = planes[:6].T
    return np.cumsum(step.view("<u8").ravel().astype(np.uint64)), np.ascontiguousarray(planes[6:].T).view("<u4").ravel().astype(np.int64)


def merge_counts(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of several (keys, counts), with sums of their counts."""
    key = np.concatenate([k for k, _ in parts])
    count = np.concatenate([c for _, c in parts])
    if not len(key):
        return key, count
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[at], np.add.reduceat(count, at)
