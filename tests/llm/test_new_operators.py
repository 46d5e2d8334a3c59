"""Manifest, BPE and filter audit, against versions without Spark."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from shelfaudit.llm import bpe, common, filter_audit, manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PATH = public_tokenizers.path(bpe.VOCABULARY)


def _rows():
    rng = random.Random(3)
    words = ["Alpha", "beta", "GAMMA", "delta's", "naïve", "x#1", "漢字", "I'll"]
    text = lambda n: " ".join(rng.choice(words) + str(rng.randint(0, n)) for _ in range(n))
    rows = [(i, text(rng.randint(0, 150)), f"l{i % 3}", f"s{i % 4}", i) for i in range(120)]
    rows += [(1000 + i, "CAPITALS " + rows[i][1], "l0", "hot", None) for i in range(40)]
    # One id on a third of the rows, equal rows, null ids, and null values.
    rows += [(7, text(20), "l1", "hot", i) for i in range(60)] + [(8, "same Row", "l2", "hot", 1)] * 40
    rows += [(None, rows[3][1], None, None, None), (None, "own", "l1", "s1", 2), (None, None, None, None, None)]
    rows += [(500, None, "l1", None, None), (501, "", "", "", 0), (502, " \n\t ", "l2", "one", 3)]
    rows += [(503, "Long " * 30_000, "l1", "two", 5), (504, "w" * 3000, "l1", "two", 6)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return _rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for name in ("rank", "digest", "path", "_text", "ids", "row", "part", "A", "known", "good", "size"):
        df = df.selectExpr("*", f"'user' AS `{name}`")
    return df


def _parquet(spark, tmp_path, docs, labels=None):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    if labels is not None:
        labels.write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _mark(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def _tree(nodes):
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [_h(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
        levels.append(nodes)
    return levels


def _path(levels, i):
    for nodes in levels[:-1]:
        first = i // 16 * 16
        run = nodes[first : first + 16]
        yield run[: i - first], run[i - first + 1 :]
        i //= 16


def _manifest(rows):
    """What op11 gives, as sorted tuples."""
    by = defaultdict(list)
    for i, text, lang, source, n in rows:
        leaf = _h(*map(_mark, (i, source, lang, n, text)))
        low = None if text is None else re.sub("[A-Z]", lambda m: m[0].lower(), text)
        tampered = i is not None and zlib.crc32(str(i).encode()) % 5 == 0
        start = _h(*map(_mark, (i, source, lang, n, low))) if tampered else leaf
        by[source].append((i is not None, i or 0, leaf, start, i))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: _tree([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in order}
    top = _tree([trees[s][-1][0] for s in order])
    root = top[-1][0]
    out = []
    for place, s in enumerate(order):
        for rank, (_, _, leaf, start, i) in enumerate(sorted(by[s], key=lambda x: x[:3])):
            path = [*_path(trees[s], rank), *_path(top, place)]
            proof = _h(*[x for a, b in path for x in a + b])
            for a, b in path:
                start = _h(*a, start, *b)
            out.append((i, leaf, trees[s][-1][0], root, proof, start, start == root))
    return sorted(out, key=repr)


def test_manifest_equals_plain_version(spark, docs, rows, tmp_path):
    found = manifest.op11_merkle_manifest(spark, _parquet(spark, tmp_path, docs)).collect()
    assert sorted(map(tuple, found), key=repr) == _manifest(rows)
    assert any(not r.verified for r in found) and any(r.verified for r in found)


def test_manifest_of_single_rows_and_none(spark, docs, rows, tmp_path):
    for i, part in enumerate((rows[:1], rows[:17], rows[255:])):
        df = spark.createDataFrame(part, SCHEMA)
        out = manifest.op11_merkle_manifest(spark, _parquet(spark, tmp_path / str(i), df))
        assert sorted(map(tuple, out.collect()), key=repr) == _manifest(part)
    empty = _parquet(spark, tmp_path / "empty", docs.limit(0))
    assert manifest.op11_merkle_manifest(spark, empty).collect() == []


def test_manifest_proves_some_leaves_and_finds_changes(spark, docs, rows):
    leaf = manifest.leaf_digest(docs).alias("digest")
    m = manifest.build_manifest(docs.select("doc_id", "source", leaf))
    some = m.leaves.filter("doc_id % 10 = 3")
    proven = manifest.with_paths(m, some)
    assert proven.count() == some.count() > 10
    root = m.root.first().digest
    again = proven.select(manifest.folded(F.col("digest"), F.col("path")).alias("r")).distinct()
    assert [r.r for r in again.collect()] == [root]
    # No order of the input shows; a changed row does.
    other = docs.orderBy(F.desc("n_chars"))
    same = manifest.build_manifest(other.select("doc_id", "source", leaf))
    assert same.root.first().digest == root
    changed = docs.withColumn("text", F.when(F.col("doc_id") != 3, F.col("text")))
    leaf = manifest.leaf_digest(changed).alias("digest")
    assert manifest.build_manifest(changed.select("doc_id", "source", leaf)).root.first().digest != root


def test_levels():
    for n in (0, 1, 2, 16, 17, 256, 257, 4096, 4097, 10**9):
        levels, left = 0, n
        while left > 1:
            left, levels = -(-left // 16), levels + 1
        assert manifest.levels_above(n) == levels


def test_manifest_sql(spark, rows, tmp_path):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    known = [r for r in rows if r[0] is not None]
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", known)
    assert sorted(con.execute(manifest.ORACLE).fetchall(), key=repr) == _manifest(known)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.Vocabulary(PATH))


def _ids(encoder, texts):
    found = [x for block in encoder.blocks(texts) for x in block]
    return [np.frombuffer(x, "<u4").tolist() for x in found]


def _expected(tokenizer, texts):
    return [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_ids_of_tokens_side_by_side(encoder, tokenizer):
    rng = random.Random(1)
    tokens = [t.decode("utf-8", "ignore") for t in encoder.vocabulary.text]
    texts = ["".join(rng.choice(tokens) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    texts += ["".join(rng.choice("ab ") for _ in range(rng.randint(0, 70))) for _ in range(1000)]
    texts += ["a" * n for n in range(200)] + [" " * n + "\n" * (n % 3) for n in range(100)]
    texts += ["x" * 50_000, "ab" * 20_000, "", "a<|endoftext|>b", "<|endoftext|>" * 3, " <|endoftext|> x"]
    assert _ids(encoder, texts) == _expected(tokenizer, texts)


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.text(max_size=60), max_size=5))
def test_ids_of_any_text(encoder, tokenizer, texts):
    assert _ids(encoder, texts) == _expected(tokenizer, texts)


def test_guesses_are_checked_not_trusted(encoder):
    vocabulary = encoder.vocabulary
    words = [t for t in vocabulary.text if t][300:6000]
    pairs = [a + b for a, b in itertools.pairwise(words) if len(a + b) <= 60]
    ids, failing = vocabulary.encode_words(pairs)
    exact = [bpe.merged(vocabulary.of_byte[list(w)].tolist(), vocabulary.ranks)[0] for w in pairs]
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == exact
    assert 0 < failing < len(pairs)


def test_letters_are_those_of_the_tokenizer():
    split = pre_tokenizers.ByteLevel(add_prefix_space=False)
    splitter = bpe.Splitter()
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    odd = set(regex.findall(splitter.newer.pattern, "".join(map(chr, points))))
    for c in [*points[::23], *map(ord, odd)]:
        for before in "a1!":
            text = before + chr(c) + before
            assert len(splitter.words(text)) == len(split.pre_tokenize_str(text)), hex(c)


def test_bpe_over_a_table(spark, docs, rows, tokenizer, monkeypatch):
    for block in (bpe.BLOCK_CHARS, 50):
        monkeypatch.setattr(bpe, "BLOCK_CHARS", block)
        monkeypatch.setattr(bpe, "KEPT_WORDS", block)
        monkeypatch.setattr(bpe, "SLICE", 64 if block == 50 else 1 << 18)
        encoded = bpe.encode_texts(docs, PATH)
        assert set(encoded.columns) == set(docs.columns)  # `ids` is replaced
        out = bpe.decode_ids(encoded, PATH).select("doc_id", "text", "_text", "ids", "decoded")
        got = out.collect()
        assert len(got) == len(rows) and all(r._text == "user" for r in got)
        ids = [np.frombuffer(r.ids, "<u4").tolist() for r in got]
        assert ids == _expected(tokenizer, [r.text or "" for r in got])
        assert all(r.decoded == (r.text or "") for r in got)
    assert bpe.encode_texts(docs.limit(0), PATH).collect() == []


def test_bpe_query(spark, docs, rows, tokenizer, tmp_path):
    got = bpe.op12_speculative_bpe(spark, _parquet(spark, tmp_path, docs)).collect()
    expected = []
    for row in rows:
        ids = tokenizer.encode(row[1] or "", add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        packed = np.array(ids, "<u4").tobytes()
        expected.append((row[0], len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def test_bpe_query_has_one_worker_a_task(spark, docs, tmp_path):
    query = bpe.op12_speculative_bpe(spark, _parquet(spark, tmp_path, docs))
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    taken = docs.withColumn("Decoded", docs["doc_id"])
    both = bpe.encode_texts(taken, PATH, decoded="decoded")
    apart = bpe.decode_ids(bpe.encode_texts(taken, PATH), PATH)
    assert set(both.columns) == set(apart.columns)
    columns = ["doc_id", "text", "ids", "decoded"]
    assert sorted(map(repr, both.select(columns).collect())) == sorted(map(repr, apart.select(columns).collect()))


def test_decoding_of_any_ids(spark, tokenizer):
    rng = random.Random(2)
    ids = [[rng.randint(0, 50_300) for _ in range(n)] for n in (0, 1, 5, 300)] + [[172, 173]]
    packed = [(i, np.array(x, "<u4").tobytes()) for i, x in enumerate(ids)] + [(9, None)]
    out = bpe.decode_ids(spark.createDataFrame(packed, "i int, ids binary"), PATH).collect()
    expected = [tokenizer.decode(x, skip_special_tokens=False) for x in ids] + [""]
    assert [r.decoded for r in sorted(out)] == expected


def test_other_tokenizer_files_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def labels(spark):
    found = [(i, int(i % 3 > 0), int(i % 4 == 0)) for i in range(110)]
    found += [(7, 0, 1), (7, 1, 0), (None, 1, 1), (5, None, None), (5, 1, None)]
    return spark.createDataFrame(found, "doc_id long, quality int, toxic int")


def _failures(rows):
    least = {}
    for i, text, *_ in rows:
        key = float("inf") if i is None else i
        least[text or ""] = min(key, least.get(text or "", key))
    for i, text, lang, *_ in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": least[t] < (float("inf") if i is None else i),
        }
        yield lang or "", {x for x in fails if fails[x]}, i


def _audit(rows, labels):
    known = defaultdict(lambda: (0, 0))
    for i, q, x in labels:
        if i is not None:
            known[i] = (max(known[i][0], int(q == 1)), max(known[i][1], int(x == 1)))
    failed = [(part, fails, *(known[i] if i is not None else (0, 0))) for part, fails, i in _failures(rows)]
    out = []
    for part in {f[0] for f in failed}:
        own = [f for f in failed if f[0] == part]
        steps, shapley = [], defaultdict(int)
        for order in itertools.permutations("ABCDE"):
            kept = own
            for i, x in enumerate(order):
                gone = [f for f in kept if x in f[1]]
                kept = [f for f in kept if x not in f[1]]
                vain = sum(x in f[1] and bool(f[1] & set(order[:i])) for f in own)
                alone = sum(f[1] == {x} for f in own)
                shapley[x] += len(gone)
                lost = sum(f[2] for f in gone), sum(f[3] for f in gone)
                steps.append((part, "".join(order), i + 1, len(kept), len(gone), vain, alone, *lost, x))
        out += [(*s[:-1], shapley[s[-1]]) for s in steps]
    return sorted(out)


def test_audit_equals_plain_version(spark, docs, rows, labels, tmp_path):
    sf_dir = _parquet(spark, tmp_path, docs, labels)
    got = filter_audit.op13_filter_audit(spark, sf_dir).collect()
    expected = _audit(rows, [tuple(r) for r in labels.collect()])
    assert sorted(map(tuple, got)) == expected
    assert len(got) == 600 * len({r[0] for r in expected})


def test_audit_of_clean_and_empty_tables(spark, docs, labels, tmp_path):
    clean = [(i, " ".join(f"w{i}x{j}" for j in range(120)), "l", "s", 1) for i in range(3)]
    sf_dir = _parquet(spark, tmp_path / "clean", spark.createDataFrame(clean, SCHEMA), labels.limit(0))
    got = filter_audit.op13_filter_audit(spark, sf_dir)
    assert got.count() == 600 and got.filter("kept <> 3 OR removed + redundant + shapley > 0").isEmpty()
    sf_dir = _parquet(spark, tmp_path / "empty", docs.limit(0), labels)
    assert filter_audit.op13_filter_audit(spark, sf_dir).collect() == []


def test_audit_with_other_filters(spark):
    rows = [(i, "p", i % 2, 0, i % 2 == 0, i % 3 == 0) for i in range(12)]
    df = spark.createDataFrame(rows, "row long, part string, good int, toxic int, X boolean, Y boolean")
    got = {(r.filter_order, r.step): r for r in filter_audit.audit(df, "XY").collect()}
    assert got["XY", 1].removed == 6 and got["XY", 2].removed == 2 and got["XY", 2].redundant == 2
    assert got["YX", 2].kept == 4 and got["YX", 1].shapley == 4 + 2 and got["YX", 1].good_lost == 2


def test_audit_sql(rows, labels):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INT, toxic INT)")
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", [tuple(r) for r in labels.collect()])
    assert sorted(con.execute(filter_audit.ORACLE).fetchall()) == _audit(rows, [tuple(r) for r in labels.collect()])


def test_lineage_needs_a_shared_folder_on_a_cluster(monkeypatch):
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Frame:
        class sparkSession:  # noqa: N801
            sparkContext = Context
            conf = {"spark.checkpoint.dir": None}

    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        common.cut(Frame)
