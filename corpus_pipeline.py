"""From raw documents to balanced shards: filter, dedup, decontaminate, mix, shard.

Each stage takes what the one before it kept. All but the last return the columns
of their input. Null ids are ids like others; a row whose text is null or empty
counts as a document without words, which the mix does not take.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfaudit.llm.common import cut, documents, free_names
from shelfaudit.llm.decontamination import decontaminate
from shelfaudit.llm.mixing import mixed_documents
from shelfaudit.llm.ngram_join import first_rows
from shelfaudit.llm.quality import score_documents, train
from shelfaudit.llm.sharding import shard_documents


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Those that the quality classifier does not reject."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "quality")
    score, predicted = free_names(docs.columns, "score", "predicted")
    scored = score_documents(docs, model, names=(score, predicted))
    return scored.filter(F.col(predicted) == 1).select(*docs.columns)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest id, null last;
    of equal ids one row. `docs` is stored, so that rows keep their numbers."""
    row = free_names(docs.columns, "_row")[0]
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    first = first_rows(numbered, row)
    return numbered.join(first, row, "left_semi").select(*docs.columns)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Those that hold no item of the benchmark."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixed_documents(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every row."""
    return shard_documents(docs, [F.col("text")])


STAGES = [
    ("quality", good_documents),
    ("near_duplicates", distinct_documents),
    ("decontamination", clean_documents),
    ("mix", mixed),
    ("shards", sharded),
]

# Near duplicates are components of a similarity join, and the classifier is
# trained; tests/llm compares the pipeline with a version written without Spark.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
