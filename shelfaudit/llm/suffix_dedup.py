"""Substring dedup with suffix arrays, in shards.

A suffix array of a whole corpus has no place in one task, so the text is first
cut to what can repeat. Every window of WIDTH bytes has a key: the smallest hash
of the GRAM-byte strings in it, which only depends on its bytes. Keys that one
text alone has are dropped. Windows of one key that follow each other make a
piece, and the pieces of a key, with equal ones taken together, come to one
shard. There a suffix array of all that have the hash of a window in common with
another one is built by induced sorting, the permuted common prefixes tell which
suffixes share WIDTH bytes, and every window is removed that a smaller doc_id has
too. A key with more bytes of different pieces than
`SHARD_BYTES` goes by the hash of each of its windows to further tasks instead,
so no task holds more than a shard.

Defined results: null text is empty; a text shorter than a window loses nothing;
rows equal in id and text are one document and get equal results; a null id is
the last; of rows with one id but different texts neither is earlier; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import documents, settled
from .repeats import (
    WINDOWS,
    Batches,
    covered,
    firsts,
    heads,
    keyed,
    lists,
    marks_of,
    owners,
    packed,
    shared_keys,
    short,
    unpacked,
    unpacked_runs,
    window_batch,
)
from .suffixes import common_prefixes, suffix_array

WIDTH = 50
GRAM = 20
PIECE = 48  # WIDTH + PIECE stays below the depth of the common prefixes
PIECES_AT_ONCE = 10_000
SHARD_BYTES = 1 << 20


def _grams(raw: np.ndarray, width: int) -> np.ndarray:
    """A hash of every `width` bytes."""
    if len(raw) < width:
        return np.empty(0, np.uint64)
    powers, inverse = tokens.power_tables(len(raw) + 1)
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    values = raw.astype(np.uint64)
    values += np.uint64(1)
    values *= powers[: len(raw)]
    np.cumsum(values, out=total[1:])
    return tokens.mix((total[width:] - total[:-width]) * inverse[: len(total) - width])


def window_keys(raw: np.ndarray) -> np.ndarray:
    """The key of every window of WIDTH bytes."""
    span = WIDTH - GRAM + 1
    least = _grams(raw, GRAM)
    if len(least) < span:
        return np.empty(0, np.uint64)
    reach = 1
    while reach < span:
        step = min(reach, span - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    return least


def _blocks(texts: list[bytes]) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """Texts of about a block end to end, and where each begins and the last ends."""
    run, first, total = [], 0, 0
    for i, raw in enumerate(texts):
        run.append(raw)
        total += len(raw)
        if total >= tokens.BLOCK_BYTES or i == len(texts) - 1:
            yield first, b"".join(run), np.cumsum([0, *map(len, run)])
            run, first, total = [], i + 1, 0


def _long_keys(raw: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """The window keys of a text in stretches, so that a long one needs no more
    memory than a block, with the place of each stretch."""
    for at in range(0, max(1, len(raw) - WIDTH + 1), tokens.BLOCK_BYTES):
        part = raw[at : at + tokens.BLOCK_BYTES + WIDTH - 1]
        yield at, window_keys(np.frombuffer(part, dtype=np.uint8))


def text_keys(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The window keys of each text."""
    for _, raw, bounds in _blocks(texts):
        keys = np.concatenate([k for _, k in _long_keys(raw)])
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield keys[a : max(a, b - WIDTH + 1)]


def _keys_of(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for keys in text_keys(texts):
        new = np.ones(len(keys), dtype=bool)
        new[1:] = keys[1:] != keys[:-1]
        distinct = np.unique(keys[new])
        yield distinct, np.zeros(len(distinct), dtype=bool)


#: A piece and all its places in the document d.
PIECES = "key long, piece binary, id long, d long, pos array<int>"


def _of_block(
    texts: list[bytes], use: list[np.ndarray], keys: list[np.ndarray]
) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]]:
    """Of the windows in `use`, some pieces at a time: the number of the text, the key,
    the bytes and the places. Equal pieces of a text are one with several places."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    base = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts)), list(map(len, use)))
    key = np.concatenate(keys)
    # Windows of two texts are never next to each other.
    place = np.concatenate(use) + base[owner]
    new = np.ones(len(place), dtype=bool)
    new[1:] = (np.diff(place) > 1) | (key[1:] != key[:-1])
    run = np.flatnonzero(new)
    # A run of one key is longer than a piece only in periodic text.
    offset = np.arange(len(place)) - np.repeat(run, np.diff(np.append(run, len(place))))
    head = np.flatnonzero(offset % PIECE == 0)
    last = np.append(place[head[1:] - 1], place[-1:])
    owner, key, start = owner[head], key[head], place[head]
    raw = b"".join(texts)
    again: dict[int, list[int]] = {}  # further places of a piece
    order = np.lexsort((key, owner))
    same = (key[order[1:]] == key[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    once = np.ones(len(start), dtype=bool)
    if same.any():
        met: dict[tuple[int, bytes], int] = {}
        several = np.append(same, False) | np.append(False, same)
        for i in np.sort(order[several]).tolist():
            first = met.setdefault((int(owner[i]), raw[start[i] : last[i] + WIDTH]), i)
            if first != i:
                again.setdefault(first, []).append(int(start[i] - base[owner[i]]))
                once[i] = False
    counts = np.ones(len(start), dtype=np.int64)
    for i, places in again.items():
        counts[i] += len(places)
    flat = np.repeat(start - base[owner], counts * once)
    ends = np.cumsum(counts * once)
    for i, places in again.items():
        flat[ends[i] - len(places) : ends[i]] = places
    owner, key, start, last, counts = (x[once] for x in (owner, key, start, last, counts))
    places = lists(flat, counts)
    for i in range(0, len(start), PIECES_AT_ONCE):
        part = slice(i, i + PIECES_AT_ONCE)
        pieces = _cut_out(raw, start[part], last[part] - start[part] + WIDTH)
        yield owner[part], key[part], pieces, places[part]


def _cut_out(raw: bytes, start: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The strings of the given starts and lengths."""
    ends = np.append(0, np.cumsum(lengths))
    index = np.arange(ends[-1]) + np.repeat(start - ends[:-1], lengths)
    data = np.frombuffer(raw, dtype=np.uint8)[index]
    buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.binary(), len(lengths), buffers)


def _pieces(rows: DataFrame) -> DataFrame:
    """The pieces of shared keys."""

    def emit(batches: Batches) -> Batches:
        for batch in batches:
            ids, ds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for at, texts in unpacked_runs(batch.column(2)):
                use, own = [], []
                for i, keys in enumerate(text_keys(texts)):
                    use.append(np.flatnonzero(np.isin(short(keys), batch.column(3)[at + i].values)))
                    own.append(keys[use[-1]])
                for owner, key, piece, places in _of_block(texts, use, own):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(key.view(np.int64)),
                            piece,
                            pa.array(ids[at + owner]),
                            pa.array(ds[at + owner]),
                            places,
                        ],
                        [x.split()[0] for x in PIECES.split(", ")],
                    )

    return rows.select("_id", "_d", "_blob", "_keys").mapInArrow(emit, PIECES)


class _Shard:
    """Rows of PIECES, to be sorted: different pieces, each of the smallest id that
    has it."""

    def __init__(self, rows: pa.Table) -> None:
        rows = rows.combine_chunks()
        one = [c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in rows.columns]
        self.ids, self.ds = one[2].to_numpy(), one[3].to_numpy()
        self.counts = np.diff(one[4].offsets.to_numpy())
        self.flat = one[4].flatten().to_numpy()
        ends = np.frombuffer(one[1].buffers()[1], dtype=np.int32)
        ends = ends[one[1].offset : one[1].offset + len(self.ids) + 1].astype(np.int64)
        self.lengths = np.diff(ends)
        self.raw = np.frombuffer(one[1].buffers()[2] or b"", dtype=np.uint8)[ends[0] : ends[-1]]

    def runs(
        self, piece: np.ndarray, within: np.ndarray, n: np.ndarray, window: np.ndarray | None
    ) -> pa.RecordBatch:
        """Rows for n windows from `within` on of the pieces named; sure ones if they
        have no window hash."""
        ids, ds = self.ids[piece], self.ds[piece]
        begin = np.cumsum(self.counts) - self.counts
        own = self.counts[piece]
        take = np.repeat(begin[piece] - (np.cumsum(own) - own), own) + np.arange(own.sum())
        places = self.flat[take] + np.repeat(within, own)
        sure = window is None
        if sure:  # nothing to compare: they go with the others of their document
            window = ds
        return window_batch(window, ids, lists(places, own), n, ds, np.full(len(ds), sure))

    def whole(self) -> pa.RecordBatch:
        """All windows of each piece, as sure ones."""
        n = self.lengths - WIDTH + 1
        return self.runs(np.arange(len(n)), np.zeros(len(n), np.int64), n, None)

    def _hashes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of every window the piece, the place in it and a hash."""
        n = self.lengths - WIDTH + 1
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        starts = np.repeat(np.cumsum(self.lengths) - self.lengths, n) + within
        return np.repeat(np.arange(len(n)), n), within, _grams(self.raw, WIDTH)[starts]

    def windows(self) -> pa.RecordBatch:
        """Each window by its hash, for a key too large for a shard."""
        owner, within, hashes = self._hashes()
        return self.runs(owner, within, np.ones(len(owner)), hashes.view(np.int64))

    def alike(self) -> np.ndarray:
        """Which pieces may share a window with another one: those that share no
        window's hash need not be sorted."""
        owner, _, hashes = self._hashes()
        order = np.argsort(hashes, kind="stable")
        own, hashes = owner[order], hashes[order]
        met = np.flatnonzero((hashes[1:] == hashes[:-1]) & (own[1:] != own[:-1]))
        out = np.zeros(len(self.lengths), dtype=bool)
        out[own[met]] = out[own[met + 1]] = True
        return out

    def repeats(self) -> pa.RecordBatch:
        """The windows that a smaller id has too, by a suffix array of the pieces."""
        ids, lengths = self.ids, self.lengths
        # Symbols: bytes from 2 on, 1 behind each piece, 0 at the end.
        starts = np.cumsum(lengths + 1) - lengths - 1
        t = np.ones(lengths.sum() + len(lengths) + 1, dtype=np.int64)
        within = np.arange(len(self.raw)) + np.repeat(np.arange(len(lengths)), lengths)
        t[within] = self.raw
        t[within] += 2
        t[-1] = 0
        sa = suffix_array(t, 258)
        shared = common_prefixes(t, sa, starts)
        owner = np.repeat(np.arange(len(lengths)), lengths + 1)
        within = np.arange(len(t) - 1) - starts[owner]
        valid = np.append(within <= lengths[owner] - WIDTH, False)
        # A suffix that shares WIDTH symbols with a valid one is valid.
        group = np.cumsum(shared[sa] < WIDTH)[valid[sa]]
        order = sa[valid[sa]]
        begin = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        own = ids[owner[order]]
        least = np.repeat(
            np.minimum.reduceat(own, begin), np.diff(np.append(begin, len(order)))
        )
        out = np.sort(order[own > least])
        new = np.ones(len(out), dtype=bool)
        new[1:] = (np.diff(out) > 1) | (owner[out[1:]] != owner[out[:-1]])
        run = np.flatnonzero(new)
        n = np.diff(np.append(run, len(out)))
        return self.runs(owner[out[run]], within[out[run]], n, None)


def _piece_bytes(rows: pa.Table | pa.RecordBatch) -> int:
    return pc.sum(pc.binary_length(rows.column("piece"))).as_py() or 0


def _alike(rows: pa.Table) -> pa.Table:
    """The rows, of whole keys, that have to be sorted."""
    return rows.filter(pa.array(_Shard(rows).alike())) if rows.num_rows > 1 else rows.slice(0, 0)


def _copies(batch: pa.RecordBatch, last: pa.RecordBatch | None) -> np.ndarray:
    """Which rows have a piece that a smaller id has too; `last` is the row before,
    with the smallest id of its piece."""
    key, piece, ids = batch.column("key").to_numpy(), batch.column("piece"), batch.column("id")
    head = np.ones(len(key), dtype=bool)
    equal = pc.equal(piece.slice(1), piece.slice(0, len(key) - 1))
    head[1:] = (key[1:] != key[:-1]) | ~equal.to_numpy(zero_copy_only=False)
    ids = ids.to_numpy()
    least = ids[np.maximum.accumulate(np.where(head, np.arange(len(key)), 0))]
    if last is not None and key[0] == last["key"][0].as_py() and piece[0] == last["piece"][0]:
        first = np.flatnonzero(head[1:])
        least[: first[0] + 1 if len(first) else None] = last["id"][0].as_py()
    return ids > least


def _sorted_shards(batches: Batches) -> Batches:
    """Reads pieces in the order of key, piece and id."""
    shard: list[pa.Table] = []  # of the keys before
    own: list[pa.Table] = []  # of the key now read
    size, large, last = 0, False, None
    for batch in batches:
        if not batch.num_rows:
            continue
        copy = _copies(batch, last)
        if copy.any():
            yield _Shard(pa.Table.from_batches([batch.filter(pa.array(copy))])).whole()
        kept = pa.Table.from_batches([batch.filter(pa.array(~copy))])
        key = kept.column("key").to_numpy()
        now = last["key"][0].as_py() if last is not None else None
        end = batch.column("key")[-1].as_py()
        # Rows of the key read before, of keys that end here, of the last key.
        a, b = int(np.searchsorted(key, now, "right")) if now is not None else 0, len(key)
        if end != now:
            b = int(np.searchsorted(key, end, "left"))
        own.append(kept.slice(0, a))
        if end != now:
            done = pa.concat_tables(own)
            if not large:
                shard.append(_alike(done))
            elif done.num_rows:
                yield _Shard(done).windows()
            middle = kept.slice(a, b - a)
            each = heads(key[a:b])
            if len(each):
                lengths = pc.binary_length(middle.column("piece")).to_numpy()
                count = np.diff(np.append(each, b - a))
                over = np.add.reduceat(lengths, each) >= SHARD_BYTES
                for i in np.flatnonzero(over).tolist():
                    yield _Shard(middle.slice(each[i], count[i])).windows()
                # Alone, a piece has no windows in common with others of its key.
                rest = middle.filter(pa.array(np.repeat(~over & (count > 1), count)))
                shard.append(_alike(rest))
            own, large = [kept.slice(b)], False
        if sum(map(_piece_bytes, own)) >= SHARD_BYTES:
            yield _Shard(pa.concat_tables(own)).windows()
            own, large = [], True
        if sum(map(_piece_bytes, shard)) >= SHARD_BYTES:
            yield _Shard(pa.concat_tables(shard)).repeats()
            shard = []
        if not copy.all():
            last = batch.slice(np.flatnonzero(~copy)[-1], 1)
    if own:
        done = pa.concat_tables(own)
        if not large:
            shard.append(_alike(done))
        elif done.num_rows:
            yield _Shard(done).windows()
    if sum(x.num_rows for x in shard):
        yield _Shard(pa.concat_tables(shard)).repeats()


def _whole(batches: Batches) -> Batches:
    for batch in batches:
        texts = tokens.utf8(batch.column(3))
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:3],
                batch.column(4),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
            ],
            ["doc_id", "_id", "_h", "_d", "n_bytes", "_all"],
        )


def _kept(batches: Batches) -> Batches:
    for batch in batches:
        removed, spans, digests = [], [], []
        marks = zip(batch.column(2), batch.column(3), strict=True)
        for raw, (starts, n) in zip(unpacked(batch.column(1)), marks, strict=True):
            out = covered(starts.values.to_numpy(), n.values.to_numpy(), WIDTH, len(raw))
            removed.append(int(out.sum()))
            spans.append(int(out[0]) + int((out[1:] & ~out[:-1]).sum()))
            rest = np.frombuffer(raw, dtype=np.uint8)[~out].tobytes()
            digests.append(hashlib.sha256(rest).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(removed, pa.int64()),
                pa.array(spans, pa.int64()),
                pa.array(digests, pa.string()),
            ],
            ["_d", "_removed", "_spans", "_kept"],
        )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    rows = keyed(docs)
    whole = settled(
        rows.select("doc_id", "_id", "_h", "text", "_d").mapInArrow(
            _whole, "doc_id long, _id long, _h long, _d long, n_bytes long, _all string"
        )
    )
    copies = firsts(whole)
    shared = shared_keys(rows, _keys_of, shortened=True)
    # The other exact copies lose every byte.
    blobs = packed(rows, ["_id", "_h", "_d"])
    pieces = _pieces(blobs.join(owners(whole, shared), ["_id", "_h"]))
    dealt = pieces.repartition("key").sortWithinPartitions("key", "piece", "id")
    marks = marks_of(dealt.mapInArrow(_sorted_shards, WINDOWS))
    again = packed(rows, ["_d"]).join(marks, "_d").select("_d", "_blob", "_starts", "_n")
    kept = settled(
        again.mapInArrow(_kept, "_d long, _removed long, _spans long, _kept string")
    ).distinct()
    copy = (F.col("_id") > F.col("_first")) & (F.col("n_bytes") >= WIDTH)
    return (
        whole.join(copies, "_h", "left")
        .join(kept, "_d", "left")
        .select(
            "doc_id",
            "n_bytes",
            F.when(copy, F.col("n_bytes"))
            .otherwise(F.coalesce("_removed", F.lit(0)))
            .cast("long")
            .alias("n_removed"),
            F.when(copy, 1).otherwise(F.coalesce("_spans", F.lit(0))).cast("long").alias("n_spans"),
            F.when(copy, F.sha2(F.lit(""), 256))
            .otherwise(F.coalesce("_kept", "_all"))
            .alias("kept_sha256"),
        )
    )


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))


ORACLE = r"""
WITH texts AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
parts AS (
  SELECT doc_id, base, x[2 * base + 1:2 * base + 2098] AS x
  FROM (SELECT *, unnest(range(0, strlen(x) // 2 - 49, 1000)) AS base FROM texts)),
starts AS (
  SELECT doc_id, base, x, unnest(range(0, least(1000, strlen(x) // 2 - 49))) AS pos FROM parts),
windows AS (
  SELECT doc_id, base + pos AS pos, md5(x[2 * pos + 1:2 * pos + 100]) AS h FROM starts),
firsts AS (
  SELECT h, min(doc_id) AS first_id FROM windows GROUP BY h),
marked AS (
  SELECT doc_id, pos, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS last_pos
  FROM windows JOIN firsts USING (h) WHERE doc_id > first_id),
runs AS (
  SELECT doc_id, pos, sum((last_pos IS NULL OR pos > last_pos + 50)::INT)
           OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM marked),
spans AS (
  SELECT doc_id, min(pos) AS f, max(pos) + 50 AS t FROM runs GROUP BY doc_id, run),
gaps AS (
  SELECT doc_id, f, t, coalesce(lag(t) OVER (PARTITION BY doc_id ORDER BY f), 0) AS kept_from,
         row_number() OVER (PARTITION BY doc_id ORDER BY f DESC) = 1 AS is_last
  FROM spans),
rest AS (
  SELECT doc_id, sum(t - f) AS n_removed, count(*) AS n_spans,
         string_agg(x[2 * kept_from + 1:2 * f]
           || CASE WHEN is_last THEN x[2 * t + 1:] ELSE '' END, '' ORDER BY f) AS kept
  FROM gaps JOIN texts USING (doc_id) GROUP BY doc_id)
SELECT doc_id, (strlen(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM texts LEFT JOIN rest USING (doc_id)
"""
