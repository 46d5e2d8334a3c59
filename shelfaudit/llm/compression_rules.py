"""Quality rules by compression bands.

A text's zstandard ratio (compressed over raw bytes) falls with its length, so
each length band has its own limits: below, the text is repetitive; above, it is
incompressible. Fixed chunks of the text are compressed by themselves as well,
which finds repetition or noise in a part of a text; a text goes if too many of
its chunks are out of their limits. Texts of less than two chunks have smaller
ones, with limits of their own. The last chunk ends with the text and overlaps
the one before, so every byte is in a chunk.

Defined results: null and empty texts have no words and fail the base rules; a
text shorter than the first band passes the bands; rows are judged one by one,
so repeated rows get equal results; further columns are ignored. Whole texts are
read, one at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from . import tokens
from .common import documents


@dataclass(frozen=True)
class Bands:
    """Limits for texts of at least so many bytes: (bytes, least, most ratio)."""

    whole: tuple[tuple[int, float, float], ...] = (
        (256, 0.50, 0.95),
        (512, 0.46, 0.85),
        (1024, 0.44, 0.75),
        (2048, 0.42, 0.70),
        (4096, 0.40, 0.65),
        (8192, 0.385, 0.62),
        (16384, 0.365, 0.60),
        (65536, 0.33, 0.58),
    )
    chunk_bytes: int = 2048
    chunk: tuple[float, float] = (0.35, 0.75)
    #: For texts of less than two chunks: (bytes of the text, of a chunk, least, most).
    short: tuple[tuple[int, int, float, float], ...] = (
        (0, 256, 0.50, 0.87),
        (2048, 512, 0.45, 0.77),
    )
    bad_chunks: float = 0.3
    level: int = 3


SCHEMA = """doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long,
n_repeat_words long, base_failed boolean, kept boolean, ratio double, chunks long,
bad_chunks long"""
REPEAT_WORDS = 8

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
#: Bytes that begin a code point of a word.
_WORD_CHAR = np.array([not t and not 0x80 <= b < 0xC0 for b, t in enumerate(tokens.BLANK)])


def duplicate_lines(raw: bytes) -> int:
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def repeated_words(words: np.ndarray, width: int = REPEAT_WORDS) -> int:
    """Words covered by a window of `width` words found twice or more."""
    seen = tokens.windows(words, width)
    _, inverse, counts = np.unique(seen, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    if not len(starts):
        return 0
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + width, -1)
    return int((np.cumsum(covered) > 0).sum())


def verdict(raw: bytes, bands: Bands, packer: zstandard.ZstdCompressor) -> tuple:
    """In its bands?, the whole text's ratio, chunks, chunks out of their limits."""
    if len(raw) < bands.whole[0][0]:
        return True, None, 0, 0
    ratio = len(packer.compress(raw)) / len(raw)
    _, least, most = [b for b in bands.whole if b[0] <= len(raw)][-1]
    size, low, high = bands.chunk_bytes, *bands.chunk
    if len(raw) < 2 * size:
        _, size, low, high = [b for b in bands.short if b[0] <= len(raw)][-1]
    starts = list(range(0, len(raw) - size + 1, size))
    if starts[-1] + size < len(raw):
        starts.append(len(raw) - size)
    bad = 0
    for i in starts:
        bad += not low <= len(packer.compress(raw[i : i + size])) / size <= high
    kept = least <= ratio <= most and bad <= bands.bad_chunks * len(starts)
    return kept, ratio, len(starts), bad


def compression_rules(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The base counts, the compression figures and the verdict of every document."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=bands.level)
        for batch in batches:
            texts = tokens.utf8(batch.column(1))
            rows = []
            for raw, words in zip(texts, tokens.word_hashes(texts), strict=True):
                data = np.frombuffer(raw, dtype=np.uint8)
                n, repeats = len(words), repeated_words(words)
                failed = n < 20 or 100 * repeats > 30 * n
                kept, *figures = verdict(raw, bands, packer)
                rows.append(
                    (
                        n,
                        int(_WORD_CHAR[data].sum()),
                        int(_SYMBOL[data].sum()),
                        duplicate_lines(raw),
                        repeats,
                        failed,
                        bool(kept and not failed),
                        *figures,
                    )
                )
            columns = list(zip(*rows, strict=True)) or [()] * 10
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, columns, kinds)],
                [x.split()[0] for x in SCHEMA.split(",")],
            )

    return docs.selectExpr("cast(doc_id AS long) AS doc_id", "text").mapInArrow(judge, SCHEMA)


def op8_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_rules(documents(spark, sf_dir))
