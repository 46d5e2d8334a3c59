"""Plain versions that the tests of this folder compare with."""

from __future__ import annotations

import re


def shingles(text):
    words = [
        bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in (text or "").encode().split()
    ]
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_force(rows):
    """(id, shingles, smallest id reachable by links), by all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[:x]:
            common = len(sets[i] & sets[j])
            union = len(sets[i] | sets[j])
            if common and 100 * common >= 80 * union:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {(i, len(sets[i]), root(i)) for i in ids}


def contains(text, item):
    """Does the text hold 80 of 100 five-word shingles of the item?"""
    own, all_ = (shingles(re.sub(r"[^a-z0-9]+", " ", (t or "").lower())) for t in (item, text))
    return 100 * len(own & all_) >= 80 * len(own)
