"""Suffix arrays and nearest smaller values over numpy arrays of one block of texts.

A block holds several texts one after another. A suffix ends where its text ends, so
no match ever crosses from one text to the next.
"""

from __future__ import annotations

import numpy as np


class SuffixArray:
    """Suffixes of a block in order, with ranks by doubled prefixes.

    ``symbols`` must differ between texts (code text and symbol into one number);
    ``ends`` gives for every position where its text ends. ``levels[k]`` ranks
    positions by their next 2**k symbols: two ranks are equal if and only if these
    are equal and inside one text. ``order`` and ``place`` are the suffix array and
    its inverse.
    """

    def __init__(self, symbols: np.ndarray, ends: np.ndarray):
        n = len(symbols)
        order = np.argsort(symbols, kind="stable").astype(np.int32)
        ordered = symbols[order]
        new = np.ones(n, bool)
        new[1:] = ordered[1:] != ordered[:-1]
        first = np.maximum.accumulate(np.where(new, np.arange(n, dtype=np.int32), 0))
        rank = np.empty(n, np.int32)
        rank[order] = first
        self.levels: list[np.ndarray] = []
        slots = np.flatnonzero(_repeated(new)).astype(np.int32)  # places whose group is not single
        reach = 1
        while len(slots):
            self.levels.append(rank)
            at = order[slots]
            head = first[slots]
            beyond = at.astype(np.int64) + reach
            inside = beyond < ends[at]
            then = np.where(inside, rank[np.where(inside, beyond, 0)], -1)
            by = np.lexsort((then, head))
            at, head, then = at[by], head[by], then[by]
            order[slots] = at
            new = np.ones(len(slots), bool)
            new[1:] = (head[1:] != head[:-1]) | (then[1:] != then[:-1])
            leader = np.maximum.accumulate(np.where(new, slots, 0))
            rank = rank.copy()
            rank[at] = leader
            first[slots] = leader
            slots = slots[_repeated(new)]
            reach *= 2
        self.order, self.place = order, rank

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols the suffixes at ``a`` and ``b`` share at their start."""
        n = len(self.order)
        length = np.zeros(len(a), np.int64)
        alive, nested = np.arange(len(a)), []
        for rank in self.levels:
            alive = alive[rank[a[alive]] == rank[b[alive]]]
            if not len(alive):
                break
            nested.append(alive)
        for k in range(len(nested) - 1, -1, -1):
            i = nested[k]
            p, q = a[i] + length[i], b[i] + length[i]
            ok = (p < n) & (q < n)
            rank = self.levels[k]
            same = ok & (rank[np.where(ok, p, 0)] == rank[np.where(ok, q, 0)]) & (p != q)
            length[i[same]] += 1 << k
        return length

    def common_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols before ``a`` and before ``b`` are the same, reading backwards."""
        length = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            p, q = a - length - (1 << k), b - length - (1 << k)
            ok = (p >= 0) & (q >= 0)
            rank = self.levels[k]
            same = ok & (rank[np.where(ok, p, 0)] == rank[np.where(ok, q, 0)])
            length[same] += 1 << k
        return length

    def lcp(self) -> np.ndarray:
        """``lcp[k]``: symbols that the suffixes in places k - 1 and k share; 0 in place 0."""
        out = np.zeros(len(self.order), np.int64)
        if self.levels:
            one = self.levels[0][self.order]
            k = np.flatnonzero(one[1:] == one[:-1]) + 1
            out[k] = self.common(self.order[k - 1].astype(np.int64), self.order[k].astype(np.int64))
        return out


def _repeated(new: np.ndarray) -> np.ndarray:
    """Members of groups of two or more, where ``new`` marks the first of each group."""
    last = np.ones(len(new), bool)
    last[:-1] = new[1:]
    return ~(new & last)


def next_smaller(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each index of ``at`` the next index with a smaller value, else the length.

    All indices gallop at once: blocks of doubled length are skipped while their
    least value is no smaller, then blocks of halved length.
    """
    n = len(values)
    least = [values]
    pos, mine = at + 1, values[at]
    alive, stopped, k = np.arange(len(at)), [], 0

    def skip(i: np.ndarray, k: int) -> np.ndarray:
        ok = pos[i] + (1 << k) <= n
        ok[ok] = least[k][pos[i[ok]]] >= mine[i[ok]]
        return ok

    while len(alive):
        go = skip(alive, k)
        stopped.append(alive[~go])
        alive = alive[go]
        pos[alive] += 1 << k
        k += 1
        if len(alive):
            half, block = 1 << (k - 1), least[-1]
            if len(block) > half:
                least.append(np.minimum(block[:-half], block[half:]))
            else:
                stopped.append(alive)
                break
    waiting = np.zeros(0, np.int64)
    for k in range(len(stopped) - 1, -1, -1):
        if len(waiting) and k < len(least):
            go = waiting[skip(waiting, k)]
            pos[go] += 1 << k
        waiting = np.concatenate([waiting, stopped[k]])
    return pos


def previous_smaller(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each index of ``at`` the last index before it with a smaller value, else -1."""
    n = len(values)
    return n - 1 - next_smaller(values[::-1], n - 1 - at)


def previous_factors(owner: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """Longest previous factors of suffixes given in suffix order.

    ``owner[k]`` numbers the text of the suffix in place k. The longest match with a
    text of a smaller number is the one with the previous or with the next smaller
    ``owner`` in suffix order; its length is the least ``lcp`` on the way there.
    """
    n = len(owner)
    every = np.arange(n)
    out = np.zeros(n, np.int64)
    # Matches of no length end the way, so they bound the search.
    for backwards in (False, True):
        own = owner[::-1] if backwards else owner
        # way[k]: what places k and k + 1 share, in the direction of the search.
        way = np.zeros(n, np.int64)
        way[:-1] = lcp[::-1][:-1] if backwards else lcp[1:]
        to = next_smaller(own, every)
        got = _least(way, every, np.minimum(to, n - 1))
        got[to >= n] = 0
        out = np.maximum(out, got[::-1] if backwards else got)
    return out


def _least(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The least of values[lo:hi] for each pair; 0 where the range is empty."""
    out = np.zeros(len(lo), np.int64)
    size = np.maximum(hi - lo, 0)
    power = np.zeros(len(lo), np.int64)
    power[size > 0] = np.log2(size[size > 0]).astype(np.int64)
    block, k = values, 0
    while True:
        i = np.flatnonzero((size > 0) & (power == k))
        if len(i):
            out[i] = np.minimum(block[lo[i]], block[hi[i] - (1 << k)])
        if not (power > k).any():
            return out
        block = np.minimum(block[: -(1 << k)], block[1 << k :])
        k += 1
