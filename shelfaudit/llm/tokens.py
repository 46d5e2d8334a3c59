"""Vectorised word and byte hashing for one Arrow batch at a time.

Words are the runs of characters other than space and U+0009..U+000D. A word's
hash is a polynomial over its bytes modulo 2**64, finished by a mixer, so equal
words hash alike in every task; windows of words combine the hashes of their
words by position. Long texts are cut at blanks into blocks, so memory follows
the block and not the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: A block's arrays hold eight bytes for each of its bytes, several of them at once, in
#: every Python worker.
BLOCK_BYTES = 1 << 18
SHAPED_BYTES = 1 << 21  # of those with shapes, whose users add up a table for each block

_BASE = np.uint64(0x9E3779B97F4A7C55)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)

BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Separators for words of letters and digits: every other ASCII character.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_powers = np.ones(1, dtype=np.uint64)
_inverse = np.ones(1, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit words."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX_1
    x ^= x >> np.uint64(27)
    x *= _MIX_2
    x ^= x >> np.uint64(31)
    return x


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse
    if len(_powers) < n:
        size = 1 << int(n - 1).bit_length()
        step = np.full(size, _BASE)
        back = np.full(size, np.uint64(pow(int(_BASE), -1, 1 << 64)))
        step[0] = back[0] = np.uint64(1)
        _powers, _inverse = np.cumprod(step), np.cumprod(back)
    return _powers, _inverse


def hash_block(
    raw: np.ndarray, lower: bool, blank: np.ndarray = BLANK
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, first and past-the-end byte positions of the words of `raw`."""
    edge = np.diff(np.concatenate(([True], blank[raw], [True])).view(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.empty(0, np.uint64), starts, ends
    powers, inverse = power_tables(len(raw) + 1)
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    values = (_LOWER[raw] if lower else raw).astype(np.uint64)
    values += np.uint64(1)
    values *= powers[: len(raw)]
    np.cumsum(values, out=total[1:])
    hashes = (total[ends] - total[starts]) * inverse[starts]
    return mix(hashes + (ends - starts).astype(np.uint64) * _MIX_1), starts, ends


def _blocks(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of `most` bytes together, or one larger text."""
    first, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield first, i
            first, total = i, 0
        total += int(size) + 1
    if first < len(sizes):
        yield first, len(sizes)


def shapes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for a word's last two bytes."""
    second = np.where(ends - starts > 1, raw[ends - 2], 0).astype(np.int32)
    return (second << 8) | raw[ends - 1]


def shaped_blocks(
    texts: list[bytes],
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """As word_blocks, A-Z lower-cased, with the shapes of the words; one long text at
    a time."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    for first, last in _blocks(sizes, SHAPED_BYTES):
        parts = (
            _stretches(texts[first], BLANK, SHAPED_BYTES)
            if last - first == 1
            else [np.frombuffer(b" ".join(texts[first:last]) + b" ", dtype=np.uint8)]
        )
        hashes, forms = [np.empty(0, np.uint64)], [np.empty(0, np.int32)]
        for raw in parts:
            raw = _LOWER[raw]
            own, starts, ends = hash_block(raw, False)
            hashes.append(own)
            forms.append(shapes(raw, starts, ends))
        counts = [sum(map(len, hashes))]
        if last - first > 1:
            bounds = np.cumsum([len(t) + 1 for t in texts[first:last]])
            counts = np.diff(np.searchsorted(starts, bounds), prepend=0)
        yield first, np.concatenate(hashes), np.concatenate(forms), np.asarray(counts)


def _stretches(raw: bytes, blank: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """A text in blocks of `most` bytes and up to the next blank."""
    at = 0
    data = np.frombuffer(raw, dtype=np.uint8)
    while at < len(data):
        end = min(len(data), at + most)
        while end < len(data) and not blank[data[end]]:
            end += 1
        yield data[at:end]
        at = end


def _long_text(raw: bytes, lower: bool, blank: np.ndarray) -> np.ndarray:
    parts = [hash_block(x, lower, blank)[0] for x in _stretches(raw, blank, BLOCK_BYTES)]
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text of an Arrow column; null gives none."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [t or b"" for t in column.cast(kind).to_pylist()]


def word_blocks(
    texts: list[bytes], lower: bool = False, blank: np.ndarray = BLANK
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts: the first one's number, the word hashes of all, and how many
    of them each text has."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    for first, last in _blocks(sizes, BLOCK_BYTES):
        if last - first == 1 and len(texts[first]) > BLOCK_BYTES:
            hashes = _long_text(texts[first], lower, blank)
            yield first, hashes, np.array([len(hashes)])
            continue
        raw = np.frombuffer(b" ".join(texts[first:last]) + b" ", dtype=np.uint8)
        hashes, starts, _ = hash_block(raw, lower, blank)
        ends = np.cumsum([len(t) + 1 for t in texts[first:last]])
        yield first, hashes, np.diff(np.searchsorted(starts, ends), prepend=0)


def word_hashes(
    texts: list[bytes], lower: bool = False, blank: np.ndarray = BLANK
) -> Iterator[np.ndarray]:
    """The word hashes of each text, in order."""
    for _, hashes, counts in word_blocks(texts, lower, blank):
        yield from np.split(hashes, np.cumsum(counts)[:-1])


def windows(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of `width` words; empty if there are fewer."""
    n = len(words) - width + 1
    if n < 1:
        return np.empty(0, np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        total *= _BASE
        total += words[i : i + n]
    return mix(total)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
