"""Training rows for the classifiers: which labelled documents, and their figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, hash_key

FOLDS = 5


def labelled(labels: DataFrame, column: str) -> DataFrame:
    """doc_id, label of the rows to learn from: one per id, without the held-out
    fold 0. Null labels and ids are left out; of several labels 1 wins."""
    return (
        labels.filter(F.col(column).isNotNull() & F.col("doc_id").isNotNull())
        .filter(fold(F.col("doc_id")) != 0)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col(column).cast("int")).alias("label"))
    )


def bounded(ids: DataFrame, rows: int, seed: str) -> DataFrame:
    """At most `rows` of the rows, the same in every run."""
    return ids.orderBy(hash_key(F.lit(seed), F.col("doc_id")), "doc_id").limit(rows)


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """`ids` (at most some ten thousand rows by `bounded`) with the text of each. Of
    several rows of one id it is the text of least hash, so there are no more rows
    than ids."""
    rows = docs.selectExpr("cast(doc_id AS long) AS doc_id", "text")
    found = rows.join(F.broadcast(ids), "doc_id")
    return found.groupBy(*ids.columns).agg(F.min_by("text", F.xxhash64("text")).alias("text"))
