"""Substring dedup by recompression.

A text's words are named by their hashes. Every round puts each symbol on the
left or the right side by a bit of its name and replaces a left symbol followed
by a right one by a new symbol, named by the two names. A name depends on what
it stands for and nothing else, so all tasks give equal substrings equal
interior symbols without a dictionary, and a round needs no shuffle. Equal
neighbours are on the same side, so a run of one word stays as it is.

With each symbol goes the stretch of words that decides it: itself and the
neighbours that were asked whether they pair with it. A window of words sees the
symbols whose stretch it holds, whatever surrounds it. Its key is the smallest
name among those of LONG words or more, or the longest symbol if there is none.
Windows with equal words thus have equal keys, and a shared key reveals a
repeat. The windows of shared keys are verified by a hash of all their words.

Defined results: null text has no words; a text shorter than a window loses
nothing; rows equal in id and text are one document and get equal results; a
null id is the last; of rows with one id but different texts neither is earlier;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import documents, settled
from .repeats import (
    WINDOWS,
    Batches,
    covered,
    firsts,
    keyed,
    lists,
    marks_of,
    own_window,
    owners,
    packed,
    shared_keys,
    unpacked,
    unpacked_runs,
    window_batch,
)

WIDTH = 20
ROUNDS = 6
LONG = 5

_PAIR = np.uint64(0xD6E8FEB86659FD93)
_LENGTH_SHIFT = np.uint64(56)


def symbols(words: np.ndarray, stop: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Names, first word of the deciding stretch, its length, and own length, of
    all symbols whose stretch fits a window. `stop` marks places between texts."""
    name, here = words, np.arange(len(words))
    lo, hi, size = here, here + 1, np.ones(len(words), dtype=np.int64)
    found = [(name[~stop], lo[~stop], (hi - lo)[~stop], size[~stop])]
    for round_ in range(ROUNDS):
        left = (tokens.mix(name ^ np.uint64(round_ * 2 + 1)) & np.uint64(1)).astype(bool)
        pair = np.flatnonzero((left & ~stop)[:-1] & (~left & ~stop)[1:])
        # A left symbol asked the next one, a right symbol the one before.
        asked = np.where(left, np.minimum(np.arange(len(name)) + 1, len(name) - 1), 0)
        asked = np.where(left, asked, np.maximum(np.arange(len(name)) - 1, 0))
        lo, hi = (
            np.where(stop, lo, np.minimum(lo, lo[asked])),
            np.where(stop, hi, np.maximum(hi, hi[asked])),
        )
        merged = tokens.mix(name[pair] * _PAIR + name[pair + 1])
        name, size = name.copy(), size.copy()
        name[pair] = merged
        size[pair] += size[pair + 1]
        keep = np.ones(len(name), dtype=bool)
        keep[pair + 1] = False
        at = pair - np.searchsorted(pair, pair)  # places after the second ones go
        name, lo, hi, size, stop = name[keep], lo[keep], hi[keep], size[keep], stop[keep]
        found.append((name[at], lo[at], (hi - lo)[at], size[at]))
    columns = [np.concatenate(x) for x in zip(*found, strict=True)]
    fits = columns[2] <= width
    return tuple(c[fits] for c in columns)


def window_keys(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each window of several texts' words the key and where its symbol lies."""
    starts = np.cumsum(counts) - counts
    spread = np.arange(len(words)) + np.repeat(np.arange(len(counts)), counts) + 1
    total = len(words) + len(counts) + 1
    stop = np.ones(total, dtype=bool)
    stop[spread] = False
    placed = np.zeros(total, dtype=np.uint64)
    placed[spread] = words
    name, lo, length, size = symbols(placed, stop, width)
    best = np.full(total, -1)  # the number of each window's symbol, in the order below
    keys, places = np.empty(0, np.uint64), np.empty(0, np.int64)
    # Long symbols serve most windows; short ones only where there is no long one.
    for chosen in (size >= LONG, size < LONG):
        if not chosen.all():
            near = np.cumsum(np.append(0, (best < 0) & ~stop))
            chosen &= near[lo + 1] > near[np.maximum(lo + length - width, 0)]
        which = np.flatnonzero(chosen)
        rank = np.where(size[which] >= LONG, 0, 255 - size[which]).astype(np.uint64)
        rank = (rank << _LENGTH_SHIFT) | (name[which] >> np.uint64(8))
        # Of equal places the last one written stays: the smallest name, leftmost.
        which = which[np.lexsort((lo[which], rank))[::-1]]
        first, fits = lo[which], length[which]
        new = np.full(total, -1)
        for before in range(width):
            inside = np.flatnonzero((fits <= width - before) & (first >= before))
            at = first[inside] - before
            better = inside > new[at]
            new[at[better]] = inside[better]
        open_ = (best < 0) & (new >= 0)
        best[open_] = new[open_] + len(keys)
        keys = np.concatenate((keys, name[which]))
        places = np.concatenate((places, first))
    n = np.maximum(counts - width + 1, 0)
    place = np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(n.sum())
    best = best[spread[place]] if len(place) else best[:0]
    return keys[best], places[best]


def _keys_of(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each text's distinct keys; flagged if windows see it in two places."""
    for _, words, counts in tokens.word_blocks(texts):
        keys, places = window_keys(words, counts, WIDTH)
        ends = np.cumsum(np.maximum(counts - WIDTH + 1, 0))
        new = np.ones(len(keys), dtype=bool)
        new[1:] = (places[1:] != places[:-1]) | (keys[1:] != keys[:-1])
        new[ends[ends < len(keys)]] = True
        for a, b in zip(np.append(0, ends[:-1]), ends, strict=True):
            own = keys[a:b][new[a:b]]
            distinct, found = np.unique(own, return_counts=True)
            yield distinct, found > 1


def _windows(rows: DataFrame) -> DataFrame:
    """The windows whose key is shared. A window that its document had before is
    sure to go, so each document asks once for a sequence of words."""

    def emit(batches: Batches) -> Batches:
        for batch in batches:
            ids, ds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for at, texts in unpacked_runs(batch.column(2)):
                for first, words, counts in tokens.word_blocks(texts):
                    keys, _ = window_keys(words, counts, WIDTH)
                    n = np.maximum(counts - WIDTH + 1, 0)
                    hashes = tokens.windows(words, WIDTH)
                    starts, ends = np.cumsum(counts) - counts, np.cumsum(n)
                    for i in range(len(counts)):
                        k = at + first + i
                        shared = batch.column(3)[k].values.to_numpy().view(np.uint64)
                        pos = np.flatnonzero(np.isin(keys[ends[i] - n[i] : ends[i]], shared))
                        window = hashes[starts[i] + pos]
                        _, head = np.unique(window, return_index=True)
                        known = np.ones(len(pos), dtype=bool)
                        known[head] = False
                        d = np.full(len(pos), ds[k])
                        place = window.view(np.int64).copy()
                        place[known] = own_window(pos[known], d[known])
                        one, id_ = np.ones(len(pos)), np.full(len(pos), ids[k])
                        yield window_batch(place, id_, lists(pos), one, d, known)

    return rows.select("_id", "_d", "_blob", "_keys").mapInArrow(emit, WINDOWS)


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _whole(batches: Batches) -> Batches:
    for batch in batches:
        words = [t.split() for t in tokens.utf8(batch.column(3))]
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:3],
                batch.column(4),
                pa.array([len(w) for w in words], pa.int64()),
                pa.array([_digest(w) for w in words], pa.string()),
            ],
            ["doc_id", "_id", "_h", "_d", "n_words", "_all"],
        )


def _kept(batches: Batches) -> Batches:
    for batch in batches:
        removed, digests = [], []
        marks = zip(batch.column(2), batch.column(3), strict=True)
        for raw, (starts, n) in zip(unpacked(batch.column(1)), marks, strict=True):
            words = raw.split()
            out = covered(starts.values.to_numpy(), n.values.to_numpy(), WIDTH, len(words))
            removed.append(int(out.sum()))
            digests.append(_digest([w for w, x in zip(words, out, strict=True) if not x]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
            ["_d", "_removed", "_kept"],
        )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    rows = keyed(docs)
    whole = settled(
        rows.select("doc_id", "_id", "_h", "text", "_d").mapInArrow(
            _whole, "doc_id long, _id long, _h long, _d long, n_words long, _all string"
        )
    )
    copies = firsts(whole)
    shared = shared_keys(rows, _keys_of)
    # The other exact copies lose every word.
    blobs = packed(rows, ["_id", "_h", "_d"])
    marks = marks_of(_windows(blobs.join(owners(whole, shared), ["_id", "_h"])))
    again = packed(rows, ["_d"]).join(marks, "_d").select("_d", "_blob", "_starts", "_n")
    kept = settled(again.mapInArrow(_kept, "_d long, _removed long, _kept string")).distinct()
    copy = (F.col("_id") > F.col("_first")) & (F.col("n_words") >= WIDTH)
    return (
        whole.join(copies, "_h", "left")
        .join(kept, "_d", "left")
        .select(
            "doc_id",
            "n_words",
            F.when(copy, F.col("n_words"))
            .otherwise(F.coalesce("_removed", F.lit(0)))
            .cast("long")
            .alias("n_removed"),
            F.when(copy, F.sha2(F.lit(""), 256))
            .otherwise(F.coalesce("_kept", "_all"))
            .alias("kept_sha256"),
        )
    )


def op9_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))


ORACLE = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (
  SELECT doc_id, unnest(range(1, len(w) - 18)) AS pos, w FROM words WHERE len(w) >= 20),
windows AS (
  SELECT doc_id, pos, md5(array_to_string(w[pos:pos + 19], ' ')) AS h FROM starts),
marked AS (
  SELECT doc_id, pos FROM windows
  QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, pos) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos FROM marked),
places AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM words),
kept AS (
  SELECT p.doc_id, count(*) AS n_words, count(g.pos) AS n_removed,
         coalesce(string_agg(p.word, ' ' ORDER BY p.pos) FILTER (g.pos IS NULL), '') AS rest
  FROM places p LEFT JOIN gone g USING (doc_id, pos) GROUP BY p.doc_id)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words,
       coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id)
"""
