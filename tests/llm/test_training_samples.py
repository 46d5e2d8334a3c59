"""Bounded training samples, and both fits against plain versions of themselves."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from shelfaudit.llm import features, quality, sharding, tokens, toxicity
from shelfaudit.llm.common import hash_key

WORDS = np.arange(1, 41, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def test_repeated_ids_give_one_training_row(spark):
    ids = [i for i in range(40) if i % 8]
    docs = spark.createDataFrame(
        [(7, f"text {i % 3}") for i in range(3000)] + [(i, f"own {i}") for i in ids if i != 7],
        "doc_id long, text string",
    )
    labels = spark.createDataFrame([(i, i % 2) for i in ids] * 2, "doc_id long, quality int")
    chosen = features.bounded(features.labelled(labels, "quality"), 10, "quality")
    found = features.texts_of(docs, chosen).collect()
    assert len(found) <= 10
    assert len({r.doc_id for r in found}) == len(found)
    every = features.texts_of(docs, features.labelled(labels, "quality")).collect()
    texts = [r.text for r in every if r.doc_id == 7]
    assert len(texts) == 1 and texts[0].startswith("text ")


def test_null_text_of_a_training_row_stays(spark):
    docs = spark.createDataFrame([(1, None), (1, None), (2, "a")], "doc_id long, text string")
    ids = spark.createDataFrame([(1,), (2,)], "doc_id long")
    found = {r.doc_id: r.text for r in features.texts_of(docs, ids).collect()}
    assert found == {1: None, 2: "a"}


def test_unlabelled_text_is_of_labelled_rows_alone(spark):
    """Documents that no label names change nothing, however many there are."""
    named = [(i, int(i % 5 == 0)) for i in range(200)]
    labels = spark.createDataFrame(named, "doc_id long, toxic int")
    text = lambda i: f"vile rude nasty word{i % 7}" if i % 5 == 0 else f"calm kind word{i % 7}"
    own = [(i, text(i)) for i in range(200)]
    other = [(1000 + i, "vile rude nasty") for i in range(500)]
    models = [
        toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), labels, "toxic")
        for rows in (own, own + other)
    ]
    assert len(models[0]["words"])
    np.testing.assert_array_equal(models[0]["words"], models[1]["words"])
    np.testing.assert_allclose(models[0]["w"], models[1]["w"])


def _sample(rng, n, toxic):
    odds = np.where(np.arange(40) < 8, 0.7 if toxic else 0.05, 0.3)
    return [WORDS[rng.random(40) < odds] for _ in range(n)]


def _plain_fit(toxic, unlabelled, prior, steps):
    """The corrected risk's gradient from dense rows, one document at a time."""
    words = toxicity._vocabulary(toxic, unlabelled)
    rows = lambda sets: np.array([[*np.isin(words, s), 1] for s in sets], float)
    p_rows, u_rows = rows(toxic), rows(unlabelled)
    at = np.append(np.zeros(len(words)), np.log(prior / (1 - prior)))
    first, second = np.zeros(len(at)), np.zeros(len(at))
    turned = 0
    for step in range(1, steps + 1):
        g_toxic, g_as_harmless, g_free = (np.zeros(len(at)) for _ in range(3))
        as_harmless = free = 0.0
        for x in p_rows:
            s = 1 / (1 + np.exp(-x @ at))
            as_harmless += s / len(p_rows)
            g_toxic -= s * (1 - s) * x / len(p_rows)
            g_as_harmless += s * (1 - s) * x / len(p_rows)
        for x in u_rows:
            s = 1 / (1 + np.exp(-x @ at))
            free += s / len(u_rows)
            g_free += s * (1 - s) * x / len(u_rows)
        if free - prior * as_harmless >= 0:
            g = prior * g_toxic + g_free - prior * g_as_harmless
        else:
            g, turned = -(g_free - prior * g_as_harmless), turned + 1
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        size = toxicity.RATE / (np.sqrt(second / (1 - 0.999**step)) + 1e-6)
        at = at - size * first / (1 - 0.9**step)
        pull = toxicity.SPARSITY * np.minimum(size[:-1], 100)
        at[:-1] = np.sign(at[:-1]) * np.maximum(0, np.abs(at[:-1]) - pull)
    keep = at[:-1] != 0
    return words[keep], at[:-1][keep], at[-1], turned


def test_unlabelled_fit_follows_the_plain_gradient(monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 60)
    rng = np.random.default_rng(3)
    toxic = _sample(rng, 20, True)
    # The corrected part falls below zero in some steps, which then turn.
    for prior in (0.2, 0.8):
        unlabelled = _sample(rng, 12, True) + _sample(rng, 48, False)
        model = toxicity.fit(toxic, unlabelled, prior)
        words, w, b, turned = _plain_fit(toxic, unlabelled, prior, 60)
        assert 0 < turned < 60
        np.testing.assert_array_equal(model["words"], words)
        np.testing.assert_allclose(model["w"], w, rtol=1e-6, atol=1e-9)
        np.testing.assert_allclose(model["b"], b, rtol=1e-6)


def test_pairwise_fit_is_where_the_loss_is_least():
    """No step from the weights lowers the loss of the pairs, added up pair by pair."""
    rng = np.random.default_rng(5)
    label = np.repeat([0, 1], [30, 50])
    x = rng.normal(size=(80, quality.N_FIGURES)) + 0.4 * label[:, None]
    model = quality.fit(x, label)
    z = (x - x.mean(axis=0)) / (x.std(axis=0) + 1e-9)
    draw = np.random.default_rng(0)
    pairs = min(quality.MAX_PAIRS, 50 * 50)
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    chosen = list(zip(draw.choice(good, pairs), draw.choice(bad, pairs), strict=True))

    def loss(w):
        total = sum(np.log1p(np.exp(-(z[g] - z[b]) @ w)) for g, b in chosen)
        return total / pairs + quality.RIDGE / 2 * w @ w

    least = loss(model["w"])
    for i in range(quality.N_FIGURES):
        for change in (-0.01, 0.01):
            w = model["w"].copy()
            w[i] += change
            assert loss(w) > least
    assert model["at"] == np.quantile(z @ model["w"], 30 / 80)


def _placed(spark, rows, n, rounds=4):
    df = spark.createDataFrame(rows, "_uid long, _links array<long>")
    items = df.withColumn("_key", hash_key(F.col("_uid")))
    found = sharding.balanced_labels(items, n, rounds).collect()
    assert sorted(r._uid for r in found) == list(range(len(rows)))
    sizes = np.bincount([r.shard for r in found], minlength=n)
    assert sizes.max() - sizes.min() <= 1
    return {r._uid: r.shard for r in found}


def test_settled_groups_stay_and_split_ones_meet(spark):
    """Threes and single rows: every group ends in one shard."""
    rows = [(i, [10_000 + i // 3]) for i in range(300)] + [(300 + i, []) for i in range(100)]
    shard = _placed(spark, rows, 8)
    assert all(len({shard[3 * g + i] for i in range(3)}) == 1 for g in range(100))


def test_rows_of_several_keys_are_never_settled_early(spark):
    """Chains of keys: rows of one key hang on others that have two."""
    rows = [(i, [i // 4, 1000 + (i + 2) // 4]) for i in range(200)]
    whole, split = [(3, 1, [3]), (4, 1, [3])], [(5, 0, [4]), (6, 1, [4])]
    chain = [(0, 0, [1]), (1, 0, [1, 2]), (2, 0, [2])]
    state = spark.createDataFrame(
        chain + whole + split, "_uid long, _shard int, _links array<long>"
    )
    assert sorted(r._uid for r in sharding._unsettled(state).collect()) == [0, 1, 2, 5, 6]
    _placed(spark, rows, 4)


def test_all_groups_settled_or_no_links(spark):
    _placed(spark, [(i, [i // 5]) for i in range(20)], 4)
    _placed(spark, [(i, []) for i in range(9)], 4)


def _labelled_texts(spark, n):
    """Good and bad texts that overlap; the ids leave out the held-out fold."""
    rng = np.random.default_rng(8)
    ids = [i for i in range(2 * n) if zlib.crc32(str(i).encode()) % 5][:n]
    good = (rng.random(n) < 0.6).astype(int)
    marks = np.maximum(0, rng.poisson(np.where(good == 1, 1, 3), n))
    texts = [f"word{i % 89} and some more" + " #x" * int(m) for i, m in zip(ids, marks, strict=True)]
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, int(g)) for i, g in zip(ids, good, strict=True)], "doc_id long, quality int"
    )
    x = np.array([quality.figures(*_parts(t)) for t in texts])
    return docs.repartition(4), labels, x, good


def _parts(text):
    return text.encode(), next(iter(tokens.word_hashes([text.encode()])))


def test_quality_learns_from_every_labelled_row(spark):
    """More rows than the former sample had: scaling and threshold are those of all."""
    docs, labels, x, good = _labelled_texts(spark, 13_000)
    model = quality.train(docs, labels, "quality")
    np.testing.assert_allclose(model["mean"], x.mean(axis=0), rtol=0, atol=1e-8)
    np.testing.assert_allclose(model["spread"], x.std(axis=0), rtol=0, atol=1e-8)
    scores = ((x - model["mean"]) / model["spread"]) @ model["w"]
    np.testing.assert_allclose(model["at"], np.quantile(scores, 1 - good.mean()), atol=1e-9)


def test_quality_weights_follow_all_pairs(spark):
    docs, labels, x, good = _labelled_texts(spark, 400)
    model = quality.train(docs, labels, "quality")
    z = (x - model["mean"]) / model["spread"]
    diff = (z[good == 1][:, None] - z[good == 0][None]).reshape(-1, x.shape[1])
    p = 1 / (1 + np.exp(diff @ model["w"]))
    gradient = -(diff * p[:, None]).mean(axis=0) + quality.RIDGE * model["w"]
    assert np.abs(gradient).max() < 1e-3
    assert np.abs(model["w"]).max() > 0.1


def test_ranks_of_many_equal_scores(spark, monkeypatch):
    monkeypatch.setattr(quality, "FEW", 5)
    values = [0.25] * 500 + [float(i) ** 3 for i in range(300)] + [-1e6]
    scores = spark.createDataFrame([(v,) for v in values], "s double")
    for rank in (0, 1, 250, 502, 503, 700, 800):
        assert quality._ranked(scores, rank) == sorted(values)[rank]
