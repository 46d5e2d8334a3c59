"""Small tests of the corpus operators, against versions without Spark."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import time
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import zstandard

from shelfaudit.llm import (
    class_model,
    compression_rules,
    decontamination,
    mixing,
    quality,
    recompression,
    repeats,
    sharding,
    suffix_dedup,
    suffixes,
    toxicity,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _corpus():
    rng = random.Random(5)
    words = [f"{a}{b}" for a in "abcdefgh" for b in ("on", "ist", "e", "um.", "Är")]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = text(60)
    rows = [(i, text(rng.randint(1, 120)), "en", f"s{i % 4}", 0) for i in range(60)]
    rows += [(100 + i, f"{text(30)} {passage} {text(9)}", "en", "s0", 0) for i in range(12)]
    rows += [(200 + i, rows[60][1], "en", "s0", 0) for i in range(9)]
    rows += [(300 + i, "same " * 200 + text(i), "en", None, 0) for i in range(4)]
    rows += [(400, None, None, None, None), (401, "", "", "", 0), (402, " \n\t ", "en", "s1", 3)]
    rows += [(None, passage, "en", "s1", 0), (60, rows[5][1], "en", "s1", 0)]
    rows += [(60, rows[5][1], "en", "s1", 0), (403, "x" * 5000, "en", "s2", 0)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return _corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    # Further columns may have the names that the operators use themselves.
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("size", "_h", "key", "shard", "score", "target", "_d", "n", "label"):
        df = df.selectExpr("*", f"1 AS `{name}`")
    return df


@pytest.fixture(scope="module")
def labels(spark):
    found = [(i, int(i % 7 > 0), int(i % 5 == 0)) for i in range(60)] + [(None, 1, 1), (3, None, None)]
    return spark.createDataFrame(found, "doc_id long, quality int, toxic int")


def _duck(rows, sql):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    return sorted(con.execute(sql).fetchall(), key=repr)


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_mix_equals_sql(docs, rows):
    names = "doc_id", "size", "source_size", "target", "taken"
    out = mixing.mix_sources(docs).select(*names)
    found = sorted((tuple(r) for r in out.collect()), key=repr)
    assert found == _duck(rows, mixing.ORACLE)
    assert mixing.mix_sources(docs.limit(0)).collect() == []
    again = mixing.mixed_documents(docs)
    assert again.columns == docs.columns and again.filter("text IS NULL").isEmpty()


def test_shards_are_even_and_keep_equal_texts(docs, rows):
    from pyspark.sql import functions as F

    out = sharding.shard_documents(docs, [F.col("text")], n=4).collect()
    assert len(out) == len(rows)
    by_shard = {s: sorted(r.slot for r in out if r.shard == s) for s in range(4)}
    assert all(v == list(range(len(v))) for v in by_shard.values())
    counts = [len(v) for v in by_shard.values()]
    assert max(counts) - min(counts) <= 1
    sizes = sorted(len((r[1] or "").encode()) + 1 for r in rows)
    assert sorted(r.size for r in out) == sizes
    crcs = {zlib.crc32(r[1].encode()) for r in rows if r[1] is not None}
    assert {r.text_crc32 for r in out} == crcs | {None}
    family = zlib.crc32(rows[60][1].encode())
    assert len({r.shard for r in out if r.text_crc32 == family}) == 1
    assert sharding.shard_documents(docs.limit(0), [F.col("text")]).collect() == []


def test_shards_of_one_group_of_all_rows(spark):
    from pyspark.sql import functions as F

    df = spark.range(103).selectExpr("id AS doc_id", "'x' AS text", "'s' AS source")
    counts = sharding.shard_documents(df, [F.col("text")]).groupBy("shard").count().collect()
    assert sorted({r["count"] for r in counts}) == [6, 7] and len(counts) == 16


def test_shards_join_texts_that_all_occur_twice(spark):
    from pyspark.sql import functions as F

    df = spark.range(800).selectExpr("id AS doc_id", "concat('text ', id % 400) AS text")
    out = sharding.shard_documents(df, [F.col("text")]).collect()
    shards, counts = {}, {}
    for r in out:
        shards.setdefault(r.text_crc32, set()).add(r.shard)
        counts[r.shard] = counts.get(r.shard, 0) + 1
    assert len(out) == 800 and set(counts.values()) == {50} and len(counts) == 16
    # What rings of moves cannot join is a forest over the shards.
    assert sum(len(x) > 1 for x in shards.values()) <= 30


def test_moves_go_round_in_rings_of_full_shards():
    asked = {(0, 1): {3: 1}, (1, 2): {7: 1}, (2, 0): {0: 1}, (2, 3): {0: 1}}
    limit = sharding._admit(asked, [5] * 4, [5] * 4)
    assert [limit[p] > max(s) for p, s in asked.items()] == [True, True, True, False]


def _by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


def test_repeated_words_go(docs, rows):
    gone, seen = {}, {}
    for x, (i, text, *_) in enumerate(_by_id(rows)):
        words = _words(text)
        out = np.zeros(len(words) + 20, dtype=bool)
        for s in range(len(words) - 19):
            first = seen.setdefault(tuple(words[s : s + 20]), (i, s))
            if first[0] != i or first[1] < s:
                out[s : s + 20] = True
        kept = " ".join(w for w, o in zip(words, out, strict=False) if not o)
        gone[x] = (i, len(words), int(out[: len(words)].sum()), hashlib.sha256(kept.encode()).hexdigest())
    found = sorted((tuple(r) for r in recompression.remove_repeats(docs).collect()), key=repr)
    assert found == sorted(gone.values(), key=repr)
    assert recompression.remove_repeats(docs.limit(0)).collect() == []


def test_repeated_bytes_go(docs, rows, monkeypatch):
    expected, seen = [], {}
    for i, text, *_ in _by_id(rows):
        raw = (text or "").encode()
        out = np.zeros(len(raw), dtype=bool)
        for s in range(len(raw) - 49):
            if seen.setdefault(raw[s : s + 50], i) != i:
                out[s : s + 50] = True
        spans = int((np.diff(np.append(0, out.astype(int))) == 1).sum())
        kept = np.frombuffer(raw, dtype=np.uint8)[~out].tobytes()
        expected.append((i, len(raw), int(out.sum()), spans, hashlib.sha256(kept).hexdigest()))
    found = sorted((tuple(r) for r in suffix_dedup.remove_repeats(docs).collect()), key=repr)
    assert found == sorted(expected, key=repr)
    # The same by the windows of keys that are too large for a shard.
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 200)
    again = sorted((tuple(r) for r in suffix_dedup.remove_repeats(docs).collect()), key=repr)
    assert again == found
    assert suffix_dedup.remove_repeats(docs.limit(0)).collect() == []


@pytest.mark.parametrize("operator", [suffix_dedup, recompression])
def test_stored_steps_leave_no_shuffle_files(spark, docs, operator):
    local = Path(spark.conf.get("spark.local.dir"))
    files = lambda: set(local.rglob("shuffle_*.data"))
    before = files()
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(key)
    found = operator.remove_repeats(docs)
    for _ in range(100):  # they are deleted a little later
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert spark.conf.get(key) == setting
    assert found.count() == docs.count()  # reads none of them


def _piece_batches(pieces, step):
    """Batches of (key, piece, id) as they are sorted; each row is a document of its own."""
    rows = [(k, p, i, n, [5]) for n, (k, p, i) in enumerate(sorted(pieces))]
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
    names = [x.split()[0] for x in suffix_dedup.PIECES.split(", ")]
    for at in range(0, len(rows), step):
        columns = zip(*rows[at : at + step], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


def test_pieces_without_a_common_window_are_not_sorted(monkeypatch):
    sorted_bytes = []
    plain = suffix_dedup.suffix_array
    monkeypatch.setattr(
        suffix_dedup, "suffix_array", lambda t, n: sorted_bytes.append(len(t)) or plain(t, n)
    )
    rng = np.random.default_rng(6)
    text = lambda n: rng.integers(97, 123, n, dtype=np.uint8).tobytes()
    common, whole = text(52), text(60)
    pieces = [(k % 7, text(70), 100 + k) for k in range(70)]  # the keys alone are shared
    pieces += [(3, common + text(9), 1), (3, text(9) + common, 2), (3, whole, 3), (3, whole, 4), (3, whole, 5)]
    number = {(k, p, i): n for n, (k, p, i) in enumerate(sorted(pieces))}
    removed = {
        (number[pieces[71]], 5 + 9, 3),  # three windows of the second `common`
        (number[pieces[73]], 5, 11),
        (number[pieces[74]], 5, 11),
    }
    for step in (1, 2, 1000):
        sorted_bytes.clear()
        out = suffix_dedup._sorted_shards(_piece_batches(pieces, step))
        rows = [r for batch in out for r in batch.to_pylist()]
        assert {(r["d"], r["pos"][0], r["n"]) for r in rows} == removed
        assert all(r["sure"] for r in rows)
        assert sum(sorted_bytes) < 200


def test_pieces_of_a_text_have_all_places_and_shared_keys_four_bytes(spark):
    rng = np.random.default_rng(7)
    part = rng.integers(97, 123, 120, dtype=np.uint8).tobytes()
    raw = part + b"-" + part + b"=" * 400
    keys = next(suffix_dedup.text_keys([raw]))
    found = {}
    for owner, _, piece, places in suffix_dedup._of_block([raw], [np.arange(len(keys))], [keys]):
        for o, p, at in zip(owner.tolist(), piece.to_pylist(), places.to_pylist(), strict=True):
            assert o == 0 and p not in found and all(raw[x : x + len(p)] == p for x in at)
            found[p] = at
    windows = [x + n for p, at in found.items() for x in at for n in range(len(p) - 49)]
    assert sorted(windows) == list(range(len(raw) - 49))
    assert max(map(len, found.values())) > 2  # periodic text
    docs = spark.createDataFrame([(1, "ab" * 60), (2, "ab" * 60 + "c")], "doc_id long, text string")
    rows = repeats.keyed(docs)
    shared = repeats.shared_keys(rows, suffix_dedup._keys_of, shortened=True)
    assert shared.schema["_keys"].dataType.simpleString() == "array<int>"
    assert shared.count() == 2


def test_suffix_arrays_and_prefixes():
    rng = np.random.default_rng(2)
    for _ in range(150):
        t = np.append(rng.integers(1, rng.integers(2, 6), rng.integers(1, 70)), 0)
        sa = suffixes.suffix_array(t, int(t.max()) + 1)
        assert sa.tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())
        shared = suffixes.common_prefixes(t, sa, np.array([0]))
        for a, b in zip(sa[:-1], sa[1:], strict=True):
            pairs = zip(t[a:], t[b:], strict=False)
            n = next((k for k, (x, y) in enumerate(pairs) if x != y), min(len(t) - a, len(t) - b))
            assert shared[b] == n


def test_contained_items(spark, docs, rows):
    words = _words(rows[61][1])
    items = [(1, " ".join(words[5:25]).upper()), (2, "no such words in any text"), (3, words[40])]
    items += [(4, None), (5, ""), (None, " ".join(words[31:50])), (7, "same same same")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    norm = lambda t: re.sub(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", " ", t or "").translate(
        {c: c + 32 for c in range(65, 91)}).split(" ")
    clean = lambda t: [w for w in norm(t) if w]

    def grams(w, k):
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}

    expected = []
    for i, text, *_ in rows:
        for j, item in items:
            w = clean(item)
            k = min(5, len(w))
            if k:
                own = grams(w, k)
                shared = len(own & grams(clean(text), k))
                if 100 * shared >= 80 * len(own):
                    expected.append((i, j, len(own), shared, shared / len(own)))
    found = [tuple(r) for r in decontamination.contained_items(docs, bench).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr) and expected
    left = decontamination.decontaminate(docs, bench)
    assert left.columns == docs.columns and left.count() == len(rows) - len({
        x for x, r in enumerate(rows) if any(e[0] == r[0] for e in expected)})
    assert decontamination.contained_items(docs, bench.limit(0)).collect() == []


def test_base_counts_of_the_rules(docs, rows):
    found = {}
    for r in compression_rules.compression_rules(docs).collect():
        found.setdefault(r.doc_id, r)
    for i, text, *_ in rows:
        words, r = _words(text), found[i]
        if i == 60:
            text = next(t for j, t, *_ in rows if j == 60 and len(_words(t)) == r.n_words)
            words = _words(text)
        seen, covered = {}, set()
        for s in range(len(words) - 7):
            seen.setdefault(tuple(words[s : s + 8]), []).append(s)
        for places in seen.values():
            covered |= {s + k for s in places for k in range(8) if len(places) > 1}
        lines = [x for x in (text or "").split("\n") if _words(x)]
        failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered), failed)
        assert not (failed and r.kept)
    assert compression_rules.compression_rules(docs.limit(0)).collect() == []


def test_parts_of_texts_are_tested_by_chunks():
    rng = random.Random(3)
    letters, odds = "etaoinsrhldcumfpgwybvk", [12, 9, 8, 8, 7, 7, 6, 6, 6, 4, 4, 3, 3, 2, 2, 2, 2, 2, 2, 1, 1, 1]
    words = ["".join(rng.choices(letters, odds, k=rng.randint(2, 8))) for _ in range(3000)]
    plain = lambda n: " ".join(rng.choice(words) for _ in range(n))[:n].encode()
    noise = lambda n: base64.b64encode(rng.randbytes(n))[:n]
    bands, packer = compression_rules.Bands(), zstandard.ZstdCompressor(level=3)
    verdict = lambda raw: compression_rules.verdict(raw, bands, packer)
    for n in (300, 700, 1500, 2500, 3900, 4096, 5000, 9000):
        kept, _, chunks, bad = verdict(plain(n))
        assert kept and chunks and not bad
    for n in (1300, 1700, 2000, 2400):  # noise at an end of a text below two chunks
        for raw in (plain(n) + noise(n // 2), noise(n // 2) + plain(n)):
            kept, ratio, _, bad = verdict(raw)
            low, high = [b[1:] for b in bands.whole if b[0] <= len(raw)][-1]
            assert low <= ratio <= high and bad and not kept
    kept, _, chunks, bad = verdict(plain(4096) + noise(2047))  # the tail of a long one
    assert (kept, chunks, bad) == (False, 3, 1)


@pytest.mark.parametrize("scores", [quality.quality_scores, toxicity.toxicity_scores])
def test_scores_are_whole_and_ignore_other_columns(docs, labels, rows, scores):
    out = scores(docs, labels).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    cut = 0.3 if scores is quality.quality_scores else 0.5
    assert all(r.predicted == int(r.score >= cut) for r in out)
    for r in out:
        text = b"" if r.doc_id is None else str(r.doc_id).encode()
        assert r.held_out == (zlib.crc32(text) % 5 == 0)
    assert scores(docs.limit(0), labels).collect() == []
    assert len(scores(docs, labels.limit(0)).collect()) == len(rows)


@pytest.mark.parametrize(
    ("scores", "column"), [(quality.quality_scores, "quality"), (toxicity.toxicity_scores, "toxic")]
)
def test_held_out_accuracy(spark, scores, column):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = scores(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id")
    held = out.filter("held_out").collect()
    assert sum(r.predicted == r[column] for r in held) >= 0.9 * len(held)


def test_class_scores(spark, docs, rows):
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    rows = [*rows, *((700 + i, "The the THE cat Äpfel ÄPFEL", "en", "s0", 0) for i in range(6))]
    more = spark.createDataFrame(rows[-6:], SCHEMA)
    out = class_model.score_texts(docs.unionByName(more, allowMissingColumns=True)).collect()
    rows = [(i, lower(t)) for i, t, *_ in rows]
    train = [_words(t) for i, t in rows if not held(i)]
    counts = {}
    for w in (w for text in train for w in text):
        counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()) + len(train), len(counts) + 1
    log = lambda c: np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
    expected = sorted(
        (held(i), len(_words(t)) + 1, sum(w in counts for w in _words(t)) + 1,
         round(sum(log(counts.get(w, 0)) for w in _words(t)) + log(len(train)), 6))
        for i, t in rows
    )
    assert len(out) == len(rows)
    assert expected == sorted((r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in out)
    assert {r.train_tokens for r in out} == {n}
    assert all(r.score <= 0 for r in out)
    assert class_model.score_texts(docs.limit(0)).collect() == []


def test_class_scores_ignore_capitals(spark):
    six = [(i, "The the THE cat") for i in range(6)]
    out = class_model.score_texts(spark.createDataFrame(six, "doc_id long, text string")).collect()
    held = sum(zlib.crc32(str(i).encode()) % 5 == 1 for i in range(6))
    train = 6 - held
    n, v = 5 * train, 3
    log = lambda c: np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
    base = 3 * log(3 * train) + 2 * log(train)
    assert {(r.train_tokens, r.n_known, round(r.base_score, 6)) for r in out} == {(n, 5, round(base, 6))}


def test_exchange_finds_classes():
    rng = np.random.default_rng(0)
    pairs = np.zeros((9, 9))
    line = [0]
    for _ in range(3000):  # a word of 1-4, then one of 5-8
        line += [int(rng.integers(1, 5)), int(rng.integers(5, 9))]
    np.add.at(pairs, (line[:-1], line[1:]), 1)
    owner = class_model.exchange(pairs, classes=3)
    assert len(set(owner[1:5])) == len(set(owner[5:9])) == 1 and owner[1] != owner[5]


def test_every_training_word_has_the_class_of_greatest_gain(spark, docs, rows, monkeypatch):
    seen = {}
    beside, classed = class_model._beside, class_model._classed

    def spy_beside(training, units, owner, k):
        seen.update(units=units, owner=owner, k=k)
        return beside(training, units, owner, k)

    def spy_classed(counted, joint):
        seen.update(joint=joint, table=classed(counted, joint))
        return seen["table"]

    for name, x in (("CORE", 4), ("FREQUENT", 5), ("_beside", spy_beside), ("_classed", spy_classed)):
        monkeypatch.setattr(class_model, name, x)
    out = class_model.score_texts(docs).collect()
    units, owner, k, joint = (seen[x] for x in ("units", "owner", "k", "joint"))

    def hashed(word):
        _, words, forms, _ = next(class_model.tokens.shaped_blocks([word.encode()]))
        return int(words.view(np.int64)[0]), int(units.of(words, forms)[0])

    words = {w: hashed(w) for _, t, *_ in rows for w in _words(t)}
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    seed = {w: int(owner[u]) for w, (_, u) in words.items()}
    lines = [_words(t) for i, t, *_ in rows if not held(i)]
    before, behind = {}, {}
    for line in lines:
        classes = [0, *[seed[w] for w in line], 0]
        for x, w in enumerate(line):
            before.setdefault(w, np.zeros(k))[classes[x]] += 1
            behind.setdefault(w, np.zeros(k))[classes[x + 2]] += 1
    h = lambda x: float((x * np.log(np.maximum(x, 1))).sum())
    table = {r.word: (r["class"], r.n) for r in seen["table"].collect()}
    assert len(table) == sum(u > 4 for w, (_, u) in words.items() if w in before)

    def likelihood(j, size, c, s, w, add):
        a, b = before[w], behind[w]
        row, column = j[c] - (0 if add else b), j[:, c] - (0 if add else a)
        left, right = (j.sum(axis=x)[c] - (0 if add else size) for x in (1, 0))
        return (h(row + b) - h(row) + h(column + a) - h(column)
                - h(left + size) + h(left) - h(right + size) + h(right))

    for w, (key, unit) in words.items():
        if unit <= 4 or w not in before:
            continue
        n = behind[w].sum()
        gains = [likelihood(joint, n, c, seed[w], w, c != seed[w]) for c in range(1, k)]
        assert table[key][1] == n and gains[table[key][0] - 1] >= max(gains) - 1e-6
    assert any(table[words[w][0]][0] != seed[w] for w in before if words[w][1] > 4)

    own = {w: table[key][0] if key in table else seed[w] for w, (key, _) in words.items()}
    count = {w: behind[w].sum() for w in behind}
    size, kinds, pairs = np.zeros(k), np.zeros(k), np.zeros((k, k))
    size[0], kinds[0] = len(lines), 1
    for w, n in count.items():
        size[own[w]] += n
        kinds[own[w]] += 1
    for line in lines:
        classes = [0, *[own[w] for w in line], 0]
        np.add.at(pairs, (classes[:-1], classes[1:]), 1)
    chance = (size + 1) / (size.sum() + k)
    step = np.log10((pairs + 5 * chance) / (pairs.sum(axis=1, keepdims=True) + 5))
    of_class = np.log10(size + 0.5 * (kinds + 1))
    scores = []
    for i, t, *_ in rows:
        line = _words(t)
        classes = [0, *[own[w] for w in line], 0]
        score = sum(step[a, b] for a, b in zip(classes, classes[1:], strict=False))
        score += sum(np.log10(count.get(w, 0) + 0.5) - of_class[own[w]] for w in line)
        scores.append((i is None, i or 0, round(score + np.log10(len(lines) + 0.5) - of_class[0], 6)))
    assert sorted(scores) == sorted((r.doc_id is None, r.doc_id or 0, round(r.score, 6)) for r in out)
