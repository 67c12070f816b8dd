"""Suffix arrays by induced sorting and their permuted common prefixes, in numpy.

Induced sorting scans buckets; here a bucket's entries are handled a wave at a
time. A wave induces all its predecessors at once: those of other buckets go
to their ends in order, those of the same bucket are the next wave. Waves are
as many as the buckets plus the longest runs of one symbol, each a handful of
numpy calls, and the work is linear in the text.
"""

from __future__ import annotations

import numpy as np

from helixframe.llm._text import mix, powers

#: Recursion levels with more symbols than this are sorted by doubling ranks, as their buckets hold few rows each.
MAX_SYMBOLS = 1024


def suffix_array(t: np.ndarray, symbols: int) -> np.ndarray:
    """Order of the suffixes of ``t``; its last symbol is 0 and occurs only there."""
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int32)
    if symbols > MAX_SYMBOLS:
        return _by_doubling(t)
    t = t.astype(np.int16)
    small = _types(t)
    lms = np.zeros(n, bool)
    lms[1:] = small[1:] & ~small[:-1]
    at = np.flatnonzero(lms).astype(np.int32)
    induce = _Inducer(t, symbols, small)
    # Leftmost-smaller substrings get their order by inducing from any order within buckets.
    sa = induce(at[np.argsort(t[at], kind="stable")])
    by_substring = sa[lms[sa]]
    end = np.append(at[1:], n - 1)
    stop = np.zeros(n, np.int32)
    stop[at] = end
    c = _prefix(t)
    h, size = _span(c, by_substring, stop[by_substring] + 1), stop[by_substring] - by_substring
    new = np.ones(len(at), np.int64)
    new[1:] = (h[1:] != h[:-1]) | (size[1:] != size[:-1])
    names = np.cumsum(new) - 1
    if names[-1] + 1 < len(at):
        name_at = np.zeros(n, np.int32)
        name_at[by_substring] = names
        order = suffix_array(name_at[at], int(names[-1]) + 1)
        by_substring = at[order]
    return induce(by_substring)


def _types(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next; the last counts as such."""
    n = len(t)
    differ = t[1:] != t[:-1]
    near = np.where(differ, np.arange(n - 1), n)
    near = np.minimum.accumulate(near[::-1])[::-1]
    rises = t[1:] > t[:-1]
    return np.append(rises[near], True)


class _Inducer:
    def __init__(self, t: np.ndarray, symbols: int, small: np.ndarray):
        self.t, self.symbols, self.small = t, symbols, small
        count = np.bincount(t, minlength=symbols)
        self.ends = np.cumsum(count)
        self.starts = self.ends - count
        self.larger = np.bincount(t[~small], minlength=symbols)

    def _wave(self, entries: np.ndarray, kind: bool) -> np.ndarray:
        """Predecessors of one type, stably by their first symbol."""
        before = entries[entries > 0] - 1
        before = before[self.small[before] == kind]
        return before[np.argsort(self.t[before], kind="stable")] if len(before) > 1 else before

    def __call__(self, lms: np.ndarray) -> np.ndarray:
        """The suffix array that an order of the leftmost-smaller suffixes (grouped by first symbol) induces."""
        t, sa = self.t, np.full(len(self.t), -1, np.int32)
        count = np.bincount(t[lms], minlength=self.symbols)
        begin = np.cumsum(count) - count
        alive = np.flatnonzero(self.ends > self.starts)
        head = self.starts.copy()
        for c in alive.tolist():
            done = self.starts[c]
            while done < head[c]:
                wave = sa[done : head[c]]
                done = head[c]
                self._put(sa, self._wave(wave, False), head, 1)
            if count[c]:
                self._put(sa, self._wave(lms[begin[c] : begin[c] + count[c]], False), head, 1)
        tail = self.ends.copy()
        for c in alive[::-1].tolist():
            done = self.ends[c]
            while done > tail[c]:
                wave = sa[tail[c] : done][::-1]
                done = tail[c]
                self._put(sa, self._wave(wave, True), tail, -1)
            if self.larger[c]:
                self._put(sa, self._wave(sa[self.starts[c] : self.starts[c] + self.larger[c]][::-1], True), tail, -1)
        sa[0] = len(t) - 1
        return sa

    def _put(self, sa: np.ndarray, rows: np.ndarray, pointer: np.ndarray, way: int) -> None:
        """Append rows, grouped by first symbol, at their buckets' pointers."""
        if not len(rows):
            return
        c = self.t[rows]
        at = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1])))
        size = np.diff(np.append(at, len(c)))
        rank = np.arange(len(c)) - np.repeat(at, size)
        key = c[at]
        if way > 0:
            sa[np.repeat(pointer[key], size) + rank] = rows
        else:
            sa[np.repeat(pointer[key], size) - 1 - rank] = rows
        pointer[key] += way * size


def _by_doubling(t: np.ndarray) -> np.ndarray:
    """Suffix order by pairs of ranks over doubling distances; only suffixes that still share a rank are sorted again."""
    n = len(t)
    order = np.argsort(t)
    place, rank = np.arange(n), np.empty(n, np.int64)
    s = t[order]
    rank[order] = np.maximum.accumulate(np.where(np.concatenate(([True], s[1:] != s[:-1])), place, 0))
    at, step = place, 1
    while True:
        own = rank[order[at]]
        same = own[1:] == own[:-1]
        at = at[np.concatenate(([False], same)) | np.concatenate((same, [False]))]
        if not len(at):
            return order.astype(np.int32)
        rows = order[at]
        ahead = rows + step
        key = rank[rows] * (n + 1) + np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        by = np.argsort(key)
        rows, key = rows[by], key[by]
        order[at] = rows
        # A group's rank is its first place in the order.
        rank[rows] = np.maximum.accumulate(np.where(np.concatenate(([True], key[1:] != key[:-1])), at, 0))
        step *= 2


def _prefix(t: np.ndarray) -> np.ndarray:
    p, _ = powers(len(t) + 1)
    c = np.zeros(len(t) + 1, np.uint64)
    np.cumsum(mix(t.astype(np.uint64) + np.uint64(1)) * p[: len(t)], out=c[1:])
    return c


def _span(c: np.ndarray, s, e) -> np.ndarray:
    _, inv = powers(len(c))
    return (c[e] - c[s]) * inv[s]


def permuted_common_prefixes(t: np.ndarray, sa: np.ndarray, c: np.ndarray | None = None) -> np.ndarray:
    """For each position, the length it has in common with the suffix before it in ``sa``.

    Only irreducible positions (whose left neighbours differ) are measured, by
    bisection on prefix hashes; the others have one less than the position before.
    """
    n = len(t)
    c = _prefix(t) if c is None else c
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    here = np.arange(n)
    same = np.zeros(n, bool)
    ok = (here > 0) & (phi > 0)
    same[ok] = t[here[ok] - 1] == t[phi[ok] - 1]
    same &= np.concatenate(([False], phi[:-1] >= 0))
    first = np.flatnonzero(~same)
    a, b = first, phi[first]
    common = np.zeros(len(first), np.int64)
    left = np.flatnonzero(b >= 0)
    limit = np.zeros(len(first), np.int64)
    limit[left] = n - np.maximum(a[left], b[left])
    low, high = np.zeros(len(left), np.int64), limit[left]
    # Doubling first, so that short common prefixes cost few steps.
    reach = np.minimum(8, high)
    grow = np.arange(len(left))
    while len(grow):
        i, j, r = a[left[grow]], b[left[grow]], reach[grow]
        hit = _span(c, i, i + r) == _span(c, j, j + r)
        low[grow[hit]] = r[hit]
        high[grow[~hit]] = r[~hit] - 1
        grow = grow[hit & (r < limit[left[grow]])]
        reach[grow] = np.minimum(reach[grow] * 4, limit[left[grow]])
    rows = np.flatnonzero(low < high)
    while len(rows):
        i, j = a[left[rows]], b[left[rows]]
        mid = (low[rows] + high[rows] + 1) // 2
        hit = _span(c, i, i + mid) == _span(c, j, j + mid)
        low[rows[hit]] = mid[hit]
        high[rows[~hit]] = mid[~hit] - 1
        rows = rows[low[rows] < high[rows]]
    common[left] = low
    size = np.diff(np.append(first, n))
    return np.repeat(common + first, size) - here
