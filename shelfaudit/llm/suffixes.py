"""Suffix arrays by induced sorting, and permuted common prefixes, with numpy.

Induced sorting goes bucket by bucket (a bucket holds the suffixes of one first
symbol); the suffixes that a bucket induces are placed together, in order, so
the work is a handful of array operations for each bucket and not a step for
each suffix. Callers ask for matches within `DEPTH` symbols only, so the order need
not be right beyond that.
"""

from __future__ import annotations

import numpy as np

DEPTH = 128
SMALL_ALPHABET = 1024


def classify(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which suffixes are smaller than the next one, and the leftmost of each run
    of those. `t` ends with a symbol smaller than all others."""
    step = np.sign(np.diff(t.astype(np.int64)))
    turns = np.flatnonzero(step)
    smaller = np.ones(len(t), dtype=bool)
    smaller[:-1] = step[turns[np.searchsorted(turns, np.arange(len(t) - 1))]] > 0
    return smaller, np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1


def _deal(sa: np.ndarray, fill: np.ndarray, places: np.ndarray, t: np.ndarray, way: int) -> None:
    """Puts suffixes, in order, at the fronts (way 1) or backs (-1) of their buckets."""
    if not len(places):
        return
    first = t[places]
    order = np.argsort(first, kind="stable")
    first = first[order]
    run = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1])))
    lengths = np.diff(np.append(run, len(first)))
    within = np.arange(len(first)) - np.repeat(run, lengths)
    sa[fill[first] + way * within] = places[order]
    fill[first[run]] += way * lengths


def induce(t: np.ndarray, smaller: np.ndarray, lms: np.ndarray, sigma: int) -> np.ndarray:
    """All suffixes in order, given the order `lms` of the leftmost-smaller ones."""
    ends = np.cumsum(np.bincount(t, minlength=sigma))
    heads = np.concatenate(([0], ends[:-1]))
    sa = np.full(len(t), -1)
    own = np.bincount(t[lms], minlength=sigma)
    stops = np.cumsum(own)
    fill = heads.copy()
    used = np.flatnonzero(np.diff(np.append(heads, len(t))))

    def before(places: np.ndarray, kind: bool) -> np.ndarray:
        places = places[places > 0] - 1
        return places[smaller[places] == kind]

    by_bucket = lms[np.argsort(t[lms], kind="stable")]
    for c in used:  # larger suffixes, from the front
        done = heads[c]
        while done < fill[c]:
            at, done = done, fill[c]
            _deal(sa, fill, before(sa[at:done], False), t, 1)
        _deal(sa, fill, before(by_bucket[stops[c] - own[c] : stops[c]], False), t, 1)
    larger_end, fill = fill, ends - 1
    for c in used[::-1]:  # smaller suffixes, from the back
        done = ends[c] - 1
        while done > fill[c]:
            at, done = done, fill[c]
            _deal(sa, fill, before(sa[done + 1 : at + 1][::-1], True), t, -1)
        _deal(sa, fill, before(sa[heads[c] : larger_end[c]][::-1], True), t, -1)
    if len(t):
        sa[0] = len(t) - 1  # the end symbol has no suffix that could induce it
    return sa


def _by_doubling(names: np.ndarray) -> np.ndarray:
    """The order of the suffixes of a string, by their first DEPTH / 2 names."""
    rank, length = names.astype(np.int64), 1
    while True:
        ahead = np.zeros(len(rank), dtype=np.int64)
        ahead[:-length] = rank[length:] + 1
        key = rank * (len(rank) + 2) + ahead
        order = np.argsort(key, kind="stable")
        new = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        rank = np.empty(len(rank), dtype=np.int64)
        rank[order] = new
        length *= 2
        if new[-1] == len(rank) - 1 or length >= min(DEPTH // 2, len(rank)):
            return order


def suffix_array(t: np.ndarray, sigma: int) -> np.ndarray:
    """The suffixes of `t` in order. `t` ends with 0, which is nowhere else."""
    smaller, lms = classify(t)
    if len(lms) < 2:
        return induce(t, smaller, lms, sigma)
    sa = induce(t, smaller, lms, sigma)
    is_lms = np.zeros(len(t), dtype=bool)
    is_lms[lms] = True
    order = sa[is_lms[sa]]
    # Leftmost-smaller substrings reach to the next one's first symbol.
    end = np.empty(len(t), dtype=np.int64)
    end[lms] = np.append(lms[1:], len(t) - 1) + 1
    power = np.cumprod(np.full(len(t) + 1, np.uint64(0x9E3779B97F4A7C55)))
    back = np.cumprod(np.full(len(t) + 1, np.uint64(pow(0x9E3779B97F4A7C55, -1, 1 << 64))))
    total = np.zeros(len(t) + 1, dtype=np.uint64)
    np.cumsum((t.astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
    content = (total[end[order]] - total[order]) * back[order]
    length = end[order] - order
    new = (content[1:] != content[:-1]) | (length[1:] != length[:-1])
    names = np.concatenate(([0], np.cumsum(new)))
    if names[-1] < len(lms) - 1:
        reduced = np.empty(len(t), dtype=np.int64)
        reduced[order] = names
        reduced = reduced[lms]
        if names[-1] < SMALL_ALPHABET:
            ranked = suffix_array(np.append(reduced + 1, 0), int(names[-1]) + 2)[1:]
        else:
            ranked = _by_doubling(reduced)
        order = lms[ranked]
    return induce(t, smaller, order, sigma)


def common_prefixes(t: np.ndarray, sa: np.ndarray, restart: np.ndarray) -> np.ndarray:
    """For each place of `t` the symbols, up to DEPTH, that its suffix shares with
    the one before it in `sa`.

    A suffix whose preceding symbol equals that of the suffix before it shares one
    symbol less than its neighbour to the left, so only the others are compared;
    `restart` names places to compare in any case."""
    n = len(t)
    previous = np.full(n, -1)
    previous[sa[1:]] = sa[:-1]
    free = np.ones(n, dtype=bool)
    inner = np.flatnonzero((previous[1:] > 0)) + 1
    free[inner] = t[inner - 1] != t[previous[inner] - 1]
    free[restart] = True
    places = np.flatnonzero(free & (previous >= 0))
    shared = np.full(n, -n)
    shared[free] = 0
    alive = places
    for depth in range(DEPTH):
        alive = alive[(alive + depth < n) & (previous[alive] + depth < n)]
        alive = alive[t[alive + depth] == t[previous[alive] + depth]]
        if not len(alive):
            break
        shared[alive] = depth + 1
    here = np.arange(n)
    return np.maximum.accumulate(shared + here) - here
