"""Benchmark decontamination by size-partitioned MinHash containment search.

Items and documents are sets of distinct shingles of five words, lower-case and
without punctuation. A short item inside a long document has a tiny Jaccard
similarity, so what counts is containment: the share of the item's shingles that
the document holds. Items are partitioned by their number of shingles. Each
partition keeps, as an item's sketch, its k smallest hashes, with k the least
number that a document holding `threshold` of any item of the partition cannot
miss entirely. A document that hits a sketch is a candidate; its shared shingles
are then counted exactly.

Items are worked through in blocks of at most `BLOCK_ITEMS` by a hash of their
id, so what a task holds has a fixed bound however large the benchmark is.

Defined results: null and empty items and documents match nothing; an item of
fewer than five words is one shingle of all its words and is matched by that run
of words; repeated documents and items each get their rows; ids that are null
stay null; an empty table gives no rows; further columns are ignored. Whole texts
are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import documents, hash_key

WORDS = 5
PERCENT = 80
BLOCK_ITEMS = 20_000
SCHEMA = "doc_id long, item_id long, item_shingles long, shared long, containment double"


def _shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Distinct hashes; the width takes part, so widths do not mix."""
    return np.unique(tokens.windows(words, width) ^ np.uint64(width))


def _need(n: int, percent: int) -> int:
    """Shingles of `n` that a match shares: ceil(percent * n / 100)."""
    return -(-percent * n // 100)


class Sketches:
    """The items of a block: their shingles, and the sketch hashes of each."""

    def __init__(self, ids: list, texts: list[bytes], width: int, percent: int):
        self.ids, self.size = [], []
        shingles, owners, sketch = [], [], []
        widths = set()
        words = tokens.word_hashes(texts, lower=True, blank=tokens.NOT_ALNUM)
        for item_id, own in zip(ids, words, strict=True):
            if not len(own):
                continue
            widths.add(min(width, len(own)))
            s = _shingles(own, min(width, len(own)))
            # A partition's sizes lie between two powers of two; its sketches
            # are long enough for the largest of them.
            largest = (1 << len(s).bit_length()) - 1
            sketch.append(s[: largest - _need(largest, percent) + 1])
            shingles.append(s)
            owners.append(np.full(len(s), len(self.ids)))
            self.ids.append(item_id)
            self.size.append(len(s))
        self.widths = sorted(widths)
        none = np.empty(0, np.uint64)
        flat, owner = np.concatenate([*shingles, none]), np.concatenate([*owners, none]).astype(int)
        order = np.argsort(flat, kind="stable")
        self.shingles, self.owner = flat[order], owner[order]
        self.sketch = np.unique(np.concatenate([*sketch, none]))
        self.need = np.array([_need(n, percent) for n in self.size], dtype=np.int64)

    def matches(self, words: np.ndarray) -> Iterator[tuple[int, int]]:
        """(item, shared shingles) of the items that a document holds."""
        own = np.concatenate([_shingles(words, w) for w in self.widths])
        at = np.searchsorted(self.sketch, own)
        at[at == len(self.sketch)] = 0
        if not len(own) or not (self.sketch[at] == own).any():
            return
        first = np.searchsorted(self.shingles, own, side="left")
        last = np.searchsorted(self.shingles, own, side="right")
        spans = [self.owner[a:b] for a, b in zip(first, last, strict=True) if b > a]
        shared = np.bincount(np.concatenate(spans), minlength=len(self.ids))
        for i in np.flatnonzero((shared >= self.need) & (self.need > 0)):
            yield int(i), int(shared[i])


def _match_block(docs: DataFrame, block: Sketches) -> DataFrame:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = tokens.utf8(batch.column(1))
            ids = batch.column(0).to_pylist()
            rows = [
                (doc_id, block.ids[i], block.size[i], shared, shared / block.size[i])
                for doc_id, words in zip(
                    ids,
                    tokens.word_hashes(texts, lower=True, blank=tokens.NOT_ALNUM),
                    strict=True,
                )
                for i, shared in block.matches(words)
            ]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64()] * 4 + [pa.float64()]
            names = [x.split()[0] for x in SCHEMA.split(",")]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns, kinds)), names)

    return docs.selectExpr("cast(doc_id AS long) AS doc_id", "text").mapInArrow(search, SCHEMA)


def _blocks(benchmark: DataFrame, width: int, percent: int) -> Iterator[Sketches]:
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    blocks = max(1, -(-2 * items.count() // BLOCK_ITEMS))
    for block in range(blocks):
        own = items.filter(hash_key(F.col("item_id"), F.col("text")) % blocks == block).collect()
        texts = [r.text.encode() if r.text else b"" for r in own]
        sketches = Sketches([r.item_id for r in own], texts, width, percent)
        if sketches.ids:
            yield sketches


def contained_items(
    docs: DataFrame, benchmark: DataFrame, width: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row for each document and item of which it holds `percent` or more:
    doc_id, item_id, item_shingles, shared, containment."""
    found = [_match_block(docs, block) for block in _blocks(benchmark, width, percent)]
    if not found:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    return reduce(DataFrame.union, found)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, width: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """The rows of `docs` that hold no item, with all their columns."""
    for block in _blocks(benchmark, width, percent):

        def clean(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = tokens.utf8(batch.column("text"))
                words = tokens.word_hashes(texts, lower=True, blank=tokens.NOT_ALNUM)
                kept = [next(block.matches(w), None) is None for w in words]
                yield batch.filter(pa.array(kept, pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contained_items(documents(spark, sf_dir), benchmark)


ORACLE = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
items AS (
  SELECT item_id, w, least(5, len(w)) AS width FROM item_words WHERE len(w) > 0),
item_starts AS (
  SELECT item_id, width, w, unnest(range(1, len(w) - width + 2)) AS pos FROM items),
item_shingles AS (
  SELECT DISTINCT item_id, width, array_to_string(w[pos:pos + width - 1], ' ') AS s
  FROM item_starts),
doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
doc_starts AS (
  SELECT doc_id, width, w, unnest(range(1, len(w) - width + 2)) AS pos
  FROM doc_words, (SELECT DISTINCT width FROM items)),
doc_shingles AS (
  SELECT DISTINCT doc_id, width, array_to_string(w[pos:pos + width - 1], ' ') AS s
  FROM doc_starts),
shared AS (
  SELECT doc_id, item_id, count(*) AS shared
  FROM doc_shingles JOIN item_shingles USING (width, s) GROUP BY doc_id, item_id),
sizes AS (
  SELECT item_id, count(*) AS n FROM item_shingles GROUP BY item_id)
SELECT doc_id, item_id, n AS item_shingles, shared, shared::DOUBLE / n AS containment
FROM shared JOIN sizes USING (item_id) WHERE 100 * shared >= 80 * n
"""
