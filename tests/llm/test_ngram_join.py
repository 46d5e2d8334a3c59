"""The Jaccard join against all pairs, on texts made to be hard for it."""

from __future__ import annotations

import random

from shelfaudit.llm import ngram_join, token_groups
from tests_llm_brute import brute_force


def _texts(seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    text = lambda n: [rng.choice(words) for _ in range(n)]

    def edited(base, share):
        return [rng.choice(words) if rng.random() < share else w for w in base]

    out = []
    for size, family, share in ((200, 120, 0.03), (80, 60, 0.02), (400, 25, 0.01), (30, 40, 0.02)):
        base = text(size)
        out += [base, *(edited(base, share) for _ in range(family))]
    passage = text(60)
    for n in (5, 10, 15, 20, 60, 100, 300):  # from mostly the passage to hardly
        out += [[*text(n), *passage, *text(2)] for _ in range(40)]
    for _ in range(40):  # nested texts, around the limit of sizes
        base = text(100)
        out += [base, base[: rng.randint(75, 90)], [*base, *text(rng.randint(5, 30))]]
    out += [text(rng.randint(1, 8)) for _ in range(30)]
    out += [["same"] * 50, ["same"] * 200, ["Same"] * 7, ["a", "b"], ["A", "b"], []]
    out += [out[0]] * 50
    rng.shuffle(out)
    return [(i * 3 + 1, " ".join(w)) for i, w in enumerate(out)]


def test_links_as_all_pairs_do(spark):
    rows = [*_texts(), (9_001, None), (9_002, ""), (9_003, " \t\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {tuple(r) for r in ngram_join.similar_documents(docs).collect()}
    assert found == brute_force(rows)


def test_odd_rows(spark):
    rows = [(1, "a b c d e f", 1, 2), (1, "a b c d e f", 1, 2), (None, "a b c d e f", 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long, dig long")
    found = sorted(map(tuple, ngram_join.similar_documents(docs).collect()), key=str)
    assert found == [(1, 2, 1), (1, 2, 1), (None, 2, 1)]
    assert ngram_join.similar_documents(docs.limit(0)).collect() == []


def test_blocks_do_not_depend_on_partitions(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, rng.randint(0, 40), i % 3 == 0, i % 7, rng.randint(1, 900)) for i in range(3000)]
    members = spark.createDataFrame(rows, "dig long, key long, solo boolean, label long, n int")
    monkeypatch.setattr(token_groups, "BLOCK_TOKENS", 20_000)
    found = []
    for n in (3, 41):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            members = members.withColumn("place", members.dig)
            out = token_groups.block_numbers(members, ["key", "solo", "n", "place"]).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 4)
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        found.append({(r.dig, r.number) for r in out})
    assert found[0] == found[1] and len(found[0]) == 3000
    total = sum(r[4] for r in rows)
    assert total / 20_000 <= len({b for _, b in found[0]}) <= total / 20_000 + 25
