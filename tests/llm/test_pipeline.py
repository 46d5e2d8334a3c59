"""Every stage of the pipeline on what the one before it kept, without Spark."""

from __future__ import annotations

import random
import tracemalloc
from collections import Counter
from functools import reduce

import corpus_pipeline
import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from shelfaudit.llm import mixing, tokens
from tests_llm_brute import brute_force, contains


def _tables(folder):
    rng = random.Random(11)
    words = [f"{a}{b}" for a in "bcdfghklm" for b in ("on", "ist", "en", "um", "ar")]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    items = [text(20) for _ in range(3)]
    texts = [text(rng.randint(60, 200)) for _ in range(80)]
    texts += [t[:-2] + text(2) for t in texts[:12]] + [texts[20]] * 6
    texts += [text(40) + items[k % 3] + text(30) for k in range(9)]
    good = [" ".join(t) for t in texts]
    bad = [" ".join(f"{w}### |" for w in text(60)) for _ in range(30)]
    rows = [(i, t, f"s{i % 5}") for i, t in enumerate([*good, *bad, None, ""])]
    label = [(i, int(i < len(good))) for i, *_ in rows[:-2]]
    n = len(rows)
    pq.write_table(
        pa.table({
            "doc_id": [r[0] for r in rows], "text": pa.array([r[1] for r in rows], pa.string()),
            "lang": ["en"] * n, "source": [r[2] for r in rows], "n_chars": [0] * n,
        }), f"{folder}/documents.parquet")
    pq.write_table(
        pa.table({"doc_id": [x for x, _ in label], "quality": [y for _, y in label], "toxic": [0] * len(label)}),
        f"{folder}/labels.parquet")
    pq.write_table(
        pa.table({"item_id": [0, 1, 2], "text": [" ".join(x) for x in items]}), f"{folder}/benchmark.parquet")
    return rows, len(good), [" ".join(x) for x in items]


def test_stages(spark, tmp_path):
    rows, n_good, items = _tables(tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    def apply(name, docs):
        stages[name](spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        return out, [(r.doc_id, r.text, r.source) for r in out.collect()] if "text" in out.columns else out.collect()

    columns = docs.columns
    docs, kept = apply("quality", docs)
    ids = {r[0] for r in kept}
    assert set(range(n_good)) <= ids and not ids & set(range(n_good, len(rows) - 2))

    first = {i for i, _, c in brute_force([(i, t) for i, t, _ in kept]) if i == c}
    docs, kept = apply("near_duplicates", docs)
    assert {r[0] for r in kept} == first and len(kept) == len(first) < len(ids)

    clean = {i for i, t, _ in kept if not any(contains(t, item) for item in items)}
    docs, kept = apply("decontamination", docs)
    assert {r[0] for r in kept} == clean and len(clean) < len(first)

    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", kept)
    taken = con.execute(f"SELECT doc_id, size, taken FROM ({mixing.ORACLE})").fetchall()
    docs, kept = apply("mix", docs)
    assert docs.columns == columns
    assert Counter(r[0] for r in kept) == Counter({i: -(-t // n) for i, n, t in taken if t})

    _, placed = apply("shards", docs)
    counts = Counter(r.shard for r in placed)
    assert Counter(r.doc_id for r in placed) == Counter(r[0] for r in kept)
    sizes = [counts[s] for s in range(16)]
    assert max(sizes) - min(sizes) <= 1
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(placed)


def test_one_row_of_each_group_of_near_duplicates_stays(spark, tmp_path):
    rng = random.Random(7)
    words = [f"{a}{b}" for a in "bcdfghklm" for b in ("on", "ist", "en", "um", "ar")]
    a, b, c, d, e = (" ".join(rng.choice(words) for _ in range(120)) for _ in range(5))
    rows = [
        (1, a, "s"), (1, a, "s"), (1, a, "t"),  # repeated rows, and an id with more than one
        (2, a + " end", "s"), (2, b, "s"),  # text, of which one has a copy with a smaller id
        (None, c, "s"), (None, c + " end", "s"),  # a group of null ids alone
        (None, b + " end", "s"), (None, d, "s"), (3, d, "s"),  # copies of documents with ids
        (4, e, "s"), (5, None, "s"), (None, "", "s"), (None, None, "s"),
    ]
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(
        3).write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    out = corpus_pipeline.distinct_documents(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    kept = [tuple(r) for r in out.collect()]
    assert set(kept) <= set(rows)
    assert Counter(i for i, *_ in kept) == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, None: 3}
    by_id = {i: t for i, t, _ in kept if i is not None}
    assert by_id == {1: a, 2: b, 3: d, 4: e, 5: None}
    assert {t for i, t, _ in kept if i is None} in ({c, "", None}, {c + " end", "", None})


def test_columns_of_users_stay_in_every_stage(spark, tmp_path):
    _tables(tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = ["score", "predicted", "_id", "_row", "_words", "_size", "_epoch", "_times", "n"]
    for i, name in enumerate(names):
        docs = docs.withColumn(name, F.col("doc_id") * 100 + i)
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{number}")
        out = spark.read.parquet(f"{tmp_path}/{number}")
        assert out.columns == docs.columns and not out.isEmpty()
        wrong = [F.col(x) != F.col("doc_id") * 100 + i for i, x in enumerate(names)]
        assert out.filter(reduce(lambda a, b: a | b, wrong)).isEmpty(), name


def test_mix_takes_equal_rows_one_by_one(spark):
    text = " ".join(["word"] * 10)
    for ids in (range(400), [None] * 400, [7] * 400):
        rows = [(i, text, "s") for i in ids]
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
        assert mixing.mixed_documents(docs).count() == 600


def test_pipeline_of_empty_tables(spark, tmp_path):
    _tables(tmp_path)
    for name in ("documents", "labels", "benchmark"):
        empty = spark.read.parquet(f"{tmp_path}/{name}.parquet").limit(0)
        empty.write.parquet(f"{tmp_path}/empty/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").collect() == []


def test_hashing_words_of_a_batch_takes_little_memory():
    texts = [(" ".join(f"w{i}x{j}" for j in range(1000))).encode() for i in range(1000)]
    texts += [b"", b" ".join(texts[:100])]  # a text larger than a block
    tracemalloc.start()
    counts = [len(words) for words in tokens.word_hashes(texts)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert counts == [1000] * 1000 + [0, 100_000]
    assert peak < 32e6
