"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over the distinct words of a text learns from confirmed
toxic examples and unlabelled text. Unlabelled text holds toxic documents too,
at the class prior, so its risk as harmless text is corrected by the prior times
the risk of the toxic examples as harmless text; where that corrected part falls
below zero the step goes the other way, which keeps it from overfitting.

Both training sets are bounded samples of the labelled rows of the training folds:
`MAX_TOXIC` of the confirmed toxic ones, and `MAX_UNLABELLED` of all, toxic ones
too, whose labels are not looked at. The prior is counted over all labelled rows. The
model has a weight for words found in several toxic examples only; every whole text is
scored in the tasks.

Defined results: null and empty texts have no words and get the score of the
bias; without toxic examples every score is 0; repeated rows get equal scores;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import documents, fold
from .features import FOLDS, bounded, labelled, texts_of

MAX_TOXIC = 4_000
MAX_UNLABELLED = 8_000
MAX_WORDS = 20_000
LEAST_DOCS = 4
STEPS = 400
RATE = 0.05
SPARSITY = 2e-4


def _words(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    texts = tokens.utf8(batch.column("text"))
    for words in tokens.word_hashes(texts, lower=True, blank=tokens.NOT_ALNUM):
        yield np.unique(words)


def _sets(sample: DataFrame) -> list[np.ndarray]:
    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [w.view(np.int64) for w in _words(batch)]
            column = pa.array(words, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), column], ["doc_id", "w"])

    table = sample.select("doc_id", "text").mapInArrow(distinct, "doc_id long, w array<long>")
    found = table.toArrow().combine_chunks().sort_by("doc_id")
    column = found.column("w").combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    flat = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    lengths = np.diff(column.offsets.to_numpy()) if len(column) else np.empty(0, np.int64)
    return np.split(flat, np.cumsum(lengths)[:-1]) if len(lengths) else []


def _vocabulary(toxic: list[np.ndarray], unlabelled: list[np.ndarray]) -> np.ndarray:
    """Words of several toxic examples, those most typical of them first."""
    words, counts = np.unique(np.concatenate(toxic), return_counts=True)
    words, counts = words[counts >= LEAST_DOCS], counts[counts >= LEAST_DOCS]
    other = np.concatenate([*unlabelled, np.empty(0, np.uint64)])
    at = np.searchsorted(words, other)
    at[at == len(words)] = 0
    hits = at[words[at] == other] if len(words) else at[:0]
    seen = np.bincount(hits, minlength=len(words)) / max(1, len(unlabelled))
    lift = counts / len(toxic) - seen
    return np.sort(words[np.argsort(-lift, kind="stable")[:MAX_WORDS]])


def _indexed(sets: list[np.ndarray], words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each word of the vocabulary in each document."""
    rows, columns = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for i, own in enumerate(sets):
        at = np.searchsorted(words, own)
        at[at == len(words)] = 0
        at = at[words[at] == own] if len(words) else at[:0]
        rows.append(np.full(len(at), i))
        columns.append(at)
    return np.concatenate(rows), np.concatenate(columns)


def fit(toxic: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> dict:
    """Words, their weights and the bias, by proximal steps on the corrected risk
    with the sigmoid loss; the words are pulled to zero."""
    if not toxic or not unlabelled or not 0 < prior < 1:
        return {}
    words = _vocabulary(toxic, unlabelled)
    (pr, pc), (ur, uc) = _indexed(toxic, words), _indexed(unlabelled, words)
    w, b = np.zeros(len(words)), float(np.log(prior / (1 - prior)))
    moment, second = np.zeros(len(words) + 1), np.zeros(len(words) + 1)
    for step in range(1, STEPS + 1):
        p = np.bincount(pr, w[pc], len(toxic)) + b
        u = np.bincount(ur, w[uc], len(unlabelled)) + b
        sp, su = (1 / (1 + np.exp(-np.clip(x, -30, 30))) for x in (p, u))
        # loss(z, toxic) = 1 - sigmoid(z), loss(z, harmless) = sigmoid(z)
        harmless = su.mean() - prior * sp.mean()
        dp, du = sp * (1 - sp) / len(toxic), su * (1 - su) / len(unlabelled)
        if harmless >= 0:
            gp, gu = -2 * prior * dp, du
        else:
            gp, gu = prior * dp, -du
        g = np.bincount(pc, gp[pr], len(words)) + np.bincount(uc, gu[ur], len(words))
        g = np.append(g, gp.sum() + gu.sum())
        moment = 0.9 * moment + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        size = RATE / (np.sqrt(second / (1 - 0.999**step)) + 1e-6)
        change = size * moment / (1 - 0.9**step)
        w -= change[:-1]
        b -= change[-1]
        w = np.sign(w) * np.maximum(0, np.abs(w) - SPARSITY * np.minimum(size[:-1], 100))
    keep = w != 0
    return {"words": words[keep], "w": w[keep], "b": b}


def train(docs: DataFrame, labels: DataFrame, column: str) -> dict:
    known = labelled(labels, column)
    counts = known.agg(F.count("*").alias("n"), F.sum("label").alias("toxic")).first()
    prior = (counts.toxic or 0) / max(1, counts.n)
    toxic = bounded(known.filter("label = 1").select("doc_id"), MAX_TOXIC, "toxic")
    # The prior is that of the labelled rows, so the unlabelled text is theirs too.
    unlabelled = bounded(known.select("doc_id"), MAX_UNLABELLED, "free")
    return fit(_sets(texts_of(docs, toxic)), _sets(texts_of(docs, unlabelled)), prior)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = train(docs, labels, "toxic")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.zeros(batch.num_rows)
            for i, own in enumerate(_words(batch) if model else []):
                at = np.searchsorted(model["words"], own)
                at[at == len(model["words"])] = 0
                hit = at[model["words"][at] == own] if len(model["words"]) else at[:0]
                z = model["w"][hit].sum() + model["b"]
                score[i] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    rows = docs.selectExpr("cast(doc_id AS long) AS doc_id", "text")
    scores = rows.mapInArrow(scored, "doc_id long, score double, predicted int")
    held_out = (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out")
    return scores.select("doc_id", held_out, "score", "predicted")


def op6_toxicity_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity_scores(documents(spark, sf_dir), labels)
