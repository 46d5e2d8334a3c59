"""One id, or null, on a third of all rows: no task gets them all."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfaudit.llm import common, mixing, ngram_join, sharding


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows have the id 7, a third none."""
    doc_id = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") + 100)
    return spark.range(0, 6000, 1, 6).select(
        doc_id.cast("long").alias("doc_id"),
        F.expr("repeat('word ', cast(1 + id % 9 AS int))").alias("text"),
        F.lit("s").alias("source"),
    )


def test_running_total_splits_rows_of_one_key(spark):
    rows = spark.range(0, 5000, 1, 5).select(F.lit(1).alias("k"), F.col("id"), F.lit("b").alias("b"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dealt = common._dealt(rows, ["b", "k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = [r["count"] for r in dealt.groupBy("_part").count().collect()]
    assert len(parts) > 1 and max(parts) < 3000
    total = common.running_total(rows, ["b"], ["k"], F.lit(2), "before")
    assert sorted(r.before for r in total.collect()) == list(range(0, 10_000, 2))
    assert sorted(total.columns) == ["b", "before", "id", "k"]


def test_mix_of_hot_ids_meets_its_target(hot):
    rows = hot.collect()
    size = sum(len(r.text.split()) for r in rows)
    out = mixing.mix_sources(hot).collect()
    assert len(out) == len(rows) and {r.source_size for r in out} == {size}
    assert sum(r.taken for r in out) == int(out[0].target) == size * 3 // 2
    again = mixing.mix_sources(hot.repartition(3)).collect()
    key = lambda r: (r.doc_id or -1, r.size, r.taken)
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_shards_of_hot_ids_are_even(hot):
    out = sharding.shard_documents(hot, []).collect()
    slots = {}
    for r in out:
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(slots) == 16
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert {len(v) for v in slots.values()} == {375}


def test_sets_of_rows_without_id_are_found_by_their_text(spark):
    base = [" ".join(f"w{(k * 31 + j) % 97}x{k}" for j in range(60)) for k in range(40)]
    texts = [t for b in base for t in (b, b + " end", b.upper())]
    docs = spark.createDataFrame([(None, t) for t in texts] * 3, "doc_id long, text string")
    keep = ngram_join.first_rows(docs.withColumn("row", F.monotonically_increasing_id()), "row")
    assert keep.count() == len(base)
    rows = docs.select(F.lit(5).cast("long").alias("id"), "text", F.xxhash64("text").alias("h"))
    owners = spark.createDataFrame([], "dig long, id long, h long, end long")
    plan = ngram_join._sets_of(rows, owners, owners.select("dig"))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "(id" in text and "h#" in text.split("Join Inner")[1].split("\n")[0]
