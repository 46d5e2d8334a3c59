"""What the two substring operators share: which keys several texts have, and
how marks are brought back to the documents.

A scheme gives each text a set of keys such that texts with an equal window have
an equal key for it. Keys are dealt by hash, sorted, and read in order, so a task
holds one row of a key at a time however many texts share it. Exact copies
count as one text here: their rows have the same text hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import settled

LAST_ID = (1 << 63) - 1
Batches = Iterator[pa.RecordBatch]


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, _id (null last), _h (of the text), _d (of id and text), text.

    Rows that are equal in id and text share _d; they get equal results."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("_id"),
        F.xxhash64(text).alias("_h"),
        text.alias("text"),
    )
    return rows.select("doc_id", "_id", "_h", F.xxhash64("_id", "_h").alias("_d"), "text")


def heads(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before it."""
    new = np.ones(len(columns[0]), dtype=bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def several(batches: Batches) -> Batches:
    """Of rows (key, h, again) in order: those whose key has two h or `again`."""
    held = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)]
    for batch in batches:
        if not batch.num_rows:
            continue
        new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        key, h, again = (np.concatenate(x) for x in zip(held, new, strict=True))
        at = heads(key, h)
        key, h, again = key[at], h[at], np.logical_or.reduceat(again, at)
        run = heads(key)
        lengths = np.diff(np.append(run, len(key)))
        shared = np.repeat((lengths > 1) | np.logical_or.reduceat(again, run), lengths)
        held = [key[-1:], h[-1:], shared[-1:]]
        out = shared[:-1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(key[:-1][out]), pa.array(h[:-1][out])], ["key", "h"]
        )
    out = held[2].astype(bool)
    yield pa.RecordBatch.from_arrays(
        [pa.array(held[0][out]), pa.array(held[1][out])], ["key", "h"]
    )


def short(keys: np.ndarray) -> np.ndarray:
    """The upper half of each key, which tells the keys of one text apart well enough."""
    return (keys >> np.uint64(32)).astype(np.uint32).view(np.int32)


def shared_keys(
    rows: DataFrame,
    keys_of: Callable[[list[bytes]], Iterator[tuple[np.ndarray, np.ndarray]]],
    shortened: bool = False,
) -> DataFrame:
    """_h and the keys (an array) that its text shares with another text, or has
    twice if the scheme says so. `keys_of` gives each text's keys and those flags.
    `shortened`: the keys are shared as a whole, and given by `short`."""

    def emit(batches: Batches) -> Batches:
        for batch in batches:
            texts = tokens.utf8(batch.column(1))
            own = batch.column(0).to_numpy()
            keys, flags, counts = [np.empty(0, np.uint64)], [np.empty(0, bool)], []
            for key, again in keys_of(texts):
                keys.append(key)
                flags.append(again)
                counts.append(len(key))
            columns = (np.concatenate(keys).view(np.int64), np.repeat(own, counts))
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, columns), pa.array(np.concatenate(flags))], ["key", "h", "again"]
            )

    flat = rows.select("_h", "text").mapInArrow(emit, "key long, h long, again boolean")
    dealt = flat.repartition("key").sortWithinPartitions("key", "h")
    shared = dealt.mapInArrow(several, "key long, h long")
    key = F.shiftright("key", 32).cast("int") if shortened else F.col("key")
    return shared.groupBy(F.col("h").alias("_h")).agg(F.collect_set(key).alias("_keys"))


def owners(whole: DataFrame, shared: DataFrame) -> DataFrame:
    """_h, _id and _keys of the first of each text's exact copies, which stands for all."""
    ids = whole.groupBy("_h").agg(F.min("_id").alias("_id"))
    # Joined before the cut, as both are dealt by _h there.
    return settled(ids.join(shared, "_h"))


def firsts(rows: DataFrame) -> DataFrame:
    """_h and the smallest _id of its rows, for texts of several ids."""
    ids = rows.groupBy("_h").agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"))
    return ids.filter("_first <> _last").select("_h", "_first")


def packed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """`keys` (long columns) and the text as a zstandard blob, to move less."""

    def pack(batches: Batches) -> Batches:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            blobs = [packer.compress(t) for t in tokens.utf8(batch.column(len(keys)))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keys)], pa.array(blobs, pa.binary())], [*keys, "_blob"]
            )

    schema = ", ".join(f"{k} long" for k in keys) + ", _blob binary"
    return rows.select(*keys, "text").mapInArrow(pack, schema)


def unpacked(column: pa.Array) -> Iterator[bytes]:
    opener = zstandard.ZstdDecompressor()
    for blob in column:
        yield opener.decompress(blob.as_py())


def unpacked_runs(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about a block together, with the first one's number."""
    run, total, first = [], 0, 0
    for i, raw in enumerate(unpacked(column)):
        run.append(raw)
        total += len(raw)
        if total >= tokens.BLOCK_BYTES:
            yield first, run
            run, total, first = [], 0, i + 1
    if run:
        yield first, run


def own_window(pos: np.ndarray, d: np.ndarray) -> np.ndarray:
    """A window of its own for each row that is sure, so that they spread over tasks."""
    mixed = tokens.mix(d.view(np.uint64) + tokens.mix(pos.astype(np.uint64)))
    return mixed.view(np.int64)


def later(batches: Batches) -> Batches:
    """Of WINDOWS rows in order: d, pos and n of those that have a larger id than
    the first of their window, or are sure, at each of their places."""
    first = [np.empty(0, np.int64)] * 2
    for batch in batches:
        if not batch.num_rows:
            continue
        w, i, n, d, known = (
            batch.column(x).to_numpy(zero_copy_only=False) for x in (0, 1, 3, 4, 5)
        )
        w, i = (np.concatenate(x) for x in zip(first, (w, i), strict=True))
        run = heads(w)
        head = np.repeat(run, np.diff(np.append(run, len(w))))
        out = np.flatnonzero((i > i[head])[len(first[0]) :] | known)
        first = [x[run[-1] : run[-1] + 1] for x in (w, i)]
        pos = batch.column(2).take(pa.array(out))
        times = np.repeat(out, pc.list_value_length(pos).to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays(
            [pa.array(d[times]), pos.flatten(), pa.array(n[times])], ["_d", "pos", "n"]
        )


#: A run of n windows, at each of the places `pos` of the document d.
WINDOWS = "window long, id long, pos array<int>, n int, d long, sure boolean"


def window_batch(
    window: np.ndarray, ids: np.ndarray, pos: pa.Array, n: np.ndarray, d: np.ndarray, sure: np.ndarray
) -> pa.RecordBatch:
    columns = [window, ids, pos, n.astype(np.int32), d, sure]
    names = [x.split()[0] for x in WINDOWS.split(", ")]
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names
    )


def lists(flat: np.ndarray, counts: np.ndarray | None = None) -> pa.Array:
    """Lists of the given lengths (one each if none are given)."""
    ends = np.arange(len(flat) + 1) if counts is None else np.append(0, np.cumsum(counts))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat.astype(np.int32)))


def marks_of(windows: DataFrame) -> DataFrame:
    """For each _d the starts (and how many follow each) of the windows to remove."""
    dealt = windows.repartition("window").sortWithinPartitions("window", "id")
    marks = dealt.mapInArrow(later, "_d long, pos int, n int")
    found = marks.groupBy("_d").agg(F.collect_set(F.struct("pos", "n")).alias("_m"))
    starts, n = F.col("_m.pos").alias("_starts"), F.col("_m.n").alias("_n")
    return settled(found.select("_d", starts, n))


def covered(starts: np.ndarray, number: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n places the windows of `width` from `number` starts on cover."""
    delta = np.zeros(n + 1, dtype=np.int64)
    np.add.at(delta, starts, 1)
    np.add.at(delta, np.minimum(starts + number - 1 + width, n), -1)
    return np.cumsum(delta[:n]) > 0
