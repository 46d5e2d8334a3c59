"""Jaccard self-join on five-word shingles with a token-group matrix.

A document is the set of its distinct shingles, as 64-bit hashes; documents with
equal sets are one here. Its head is the beginning of the set in hash order. If
two sets link (80 of 100 parts in common), the one whose head ends first, z,
misses at most a fifth of its shingles in the other, so that much of its head
less a fifth of its size lies in the other's head: about a tenth of z's size or
more. Two ways find every such pair:

1. Pairs that share a token (a shingle of both heads) of few documents. They
   are listed token by token, and kept if what they share, with their tokens of
   many documents added, can reach the bound.
2. Pairs that share tokens of many documents only. Then both have as many of
   these as the bound asks for, which holds for members of large families of
   near copies and for texts that are to a good part a common passage. These
   first try a leader each, the document of a token that consists of frequent
   tokens most, and so fall into groups of similar documents. The token-group
   matrix (token_groups.py) finds the links between groups on whole sets.

Pairs that pass are verified on the whole sets, and components are taken over
the links. Members of one component are never compared with each other again, so
a family of n near copies costs n comparisons and not n squared.

Defined results: texts without words and null texts have no shingles and are
alone; fewer than five words are one shingle of all of them; repeated rows and
ids each get a row; null ids come last, and a component of null ids alone has a
null id; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import cut, documents
from .components import components
from .repeats import LAST_ID, Batches, packed, unpacked_runs
from .token_groups import group_links

WIDTH = 5
FREQUENT = 16  # a token of more documents goes by the token-group matrix

EMPTY = np.empty(0, np.int64)


def shingle_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, in order."""
    for words in tokens.word_hashes(texts, lower=True):
        if 0 < len(words) < WIDTH:
            yield tokens.windows(words, len(words)) ^ np.uint64(len(words))
        else:
            yield np.unique(tokens.windows(words, WIDTH))


def digest(shingles: np.ndarray) -> int:
    """A signed hash of a whole set."""
    total = tokens.mix(shingles).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(tokens.mix(np.array([total]))[0].view(np.int64))


def head_size(n):
    """Shingles in the head of a set of n (a number, an array or a column)."""
    return n // 5 + (11 * n + 99) // 100 + 1


def _head_size(n: Column) -> Column:
    return F.least(n, F.floor(n / 5) + F.floor((11 * n + 99) / 100) + 1)


def _bound(n: Column, other: Column) -> Column:
    """Shingles that the head of z, of size n, shares with a linked set's head:
    its length, less what z has that the other has not."""
    common = F.ceil(4 * (n + other) / 9)
    return F.greatest(F.lit(1), _head_size(n) - n + F.greatest(common, n - F.floor(n / 5)))


def _sizes_link(n, other):
    return (100 * n >= 80 * other) & (100 * other >= 80 * n)


def _end(shingles: np.ndarray) -> int:
    """Where a set's head ends, as a number that keeps the order of hashes."""
    head = shingles[: head_size(len(shingles))]
    return int(head[-1] >> np.uint64(1)) if len(head) else 0


def _documents(batches: Batches) -> Batches:
    for batch in batches:
        sets = [(len(s), digest(s), _end(s)) for s in shingle_sets(tokens.utf8(batch.column(1)))]
        columns = zip(*sets, strict=True) if sets else [()] * 3
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.int64()) for c in columns), *batch.columns[2:]],
            ["id", "n", "dig", "end", *batch.schema.names[2:]],
        )


def _heads(batches: Batches) -> Batches:
    for batch in batches:
        for s in shingle_sets(tokens.utf8(batch.column(0))):
            if len(s):
                head = s[: head_size(len(s))].view(np.int64)
                columns = [head, np.full(len(head), digest(s)), np.full(len(head), len(s))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], ["token", "dig", "n"]
                )


TOKENS = "token long, a long, b long, na long, nb long"


def _postings(batches: Batches) -> Batches:
    """Reads (token, dig, n) in order. Tokens of up to FREQUENT sets give their
    pairs (a < b) of sizes that can link; others give a row for each set, as a.

    Holds FREQUENT rows of a token, and of a larger one just the last."""
    held = [EMPTY] * 3
    counted = 0  # rows of the held token that have been given already
    for batch in _appended(batches):
        if batch is not None:
            new = [batch.column(i).to_numpy() for i in range(3)]
            token, dig, n = (np.concatenate(x) for x in zip(held, new, strict=True))
        else:
            token, dig, n = held
        if not len(token):
            continue
        first = np.ones(len(token), dtype=bool)
        first[1:] = (token[1:] != token[:-1]) | (dig[1:] != dig[:-1])
        token, dig, n = token[first], dig[first], n[first]
        run = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
        size = np.diff(np.append(run, len(token)))
        size_known = size.copy()
        size_known[0] += counted
        large = np.repeat(size_known > FREQUENT, size)
        done = np.ones(len(token), dtype=bool)
        given = np.zeros(len(token), dtype=bool)
        if counted:
            given[0] = True  # the held row of a frequent token was given before
        if batch is not None:
            last = slice(run[-1], None)
            if large[-1]:
                before = counted if len(run) == 1 else 0
                counted = before + int(size[-1]) - 1
                held = [token[-1:], dig[-1:], n[-1:]]
                # The last row is given now and kept to know it again.
            else:
                done[last] = False
                held = [token[last], dig[last], n[last]]
                counted = 0
        out = large & done & ~given
        if out.any():
            yield _token_batch(token[out], dig[out], dig[out], n[out], n[out])
        small = ~large & done
        for width in range(1, FREQUENT):
            a = np.flatnonzero(small[:-width]) if len(token) > width else EMPTY
            b = a + width
            a = a[token[a] == token[b]]
            b = a + width
            fits = _sizes_link(n[a], n[b])
            a, b = a[fits], b[fits]
            if len(a):
                yield _token_batch(np.zeros(len(a), np.int64), dig[a], dig[b], n[a], n[b])


def _appended(batches: Batches) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _token_batch(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c) for c in columns], [x.split()[0] for x in TOKENS.split(", ")]
    )


def _leaders(hot: DataFrame, heavy: DataFrame) -> DataFrame:
    """For each document of mostly frequent tokens the leader that most of its
    tokens name: of a token, the document with the largest share of frequent
    tokens in a range of sizes. Whoever gets no link this way is not lost: it is
    a group of its own."""
    wide = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.25)))
    rows = hot.join(heavy.select("dig", "share"), "dig").withColumn("range", wide)
    named = rows.groupBy("token", "range").agg(
        F.max(F.struct("share", "dig", "n")).alias("leader")
    )
    votes = (
        rows.join(named, ["token", "range"])
        .filter("dig <> leader.dig")
        .groupBy("dig", "n", "leader")
        .agg(F.count("*").alias("votes"))
    )
    named_by = F.struct("votes", F.col("leader.dig").alias("b"), F.col("leader.n").alias("nb"))
    best = votes.groupBy("dig", "n").agg(F.max(named_by).alias("best"))
    return best.select(F.col("dig").alias("a"), "best.b", F.col("n").alias("na"), "best.nb")


def _least(n: Column) -> Column:
    """Shingles that the head of z, of size n, shares with any linked set's head."""
    return F.greatest(F.lit(1), _head_size(n) - F.floor(n / 5))


def _linkable(frequent: DataFrame) -> DataFrame:
    """dig, n of the documents that can have a link of frequent tokens alone."""
    n = F.col("n")
    # A partner has in its head what z shares; a larger z shares less.
    partner = F.col("hot") >= _bound(F.floor(n * 5 / 4), n)
    return frequent.filter((F.col("hot") >= F.col("least")) | partner).select("dig", "n")


def _members(linkable: DataFrame, leaders: DataFrame, groups: DataFrame) -> DataFrame:
    """key, solo, label, dig, n: those of one component, or of one leader, have one key."""
    own = groups.select(F.col("node").alias("dig"), F.col("component").alias("own"))
    led = leaders.select(F.col("a").alias("dig"), F.col("b").alias("leader"))
    of_leader = groups.select(F.col("node").alias("leader"), F.col("component").alias("led"))
    return (
        linkable.join(own, "dig", "left")
        .join(led, "dig", "left")
        .join(of_leader, "leader", "left")
        .select(
            F.coalesce("own", "led", "leader", "dig").alias("key"),
            F.isnull("own").alias("solo"),
            F.coalesce("own", "dig").alias("label"),
            "dig",
            "n",
        )
    )


def _sets_of(docs: DataFrame, owners: DataFrame, wanted: DataFrame) -> DataFrame:
    """dig, shingles of the sets in `wanted` (dig), from the text of one owner each.
    Rows are told apart by id and hash of the text: rows of one id, or of none, meet
    only sets of their own."""
    sought = owners.select("dig", "id", "h").join(wanted, "dig")
    blobs = packed(docs, ["id", "h"]).join(sought, ["id", "h"])

    def emit(batches: Batches) -> Batches:
        for batch in batches:
            dig = batch.column(0).to_numpy()
            for at, texts in unpacked_runs(batch.column(1)):
                for i, s in enumerate(shingle_sets(texts)):
                    if digest(s) == dig[at + i]:  # texts may share a hash
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(dig[at + i : at + i + 1]), pa.array([s.view(np.int64)])],
                            ["dig", "s"],
                        )

    found = blobs.select("dig", "_blob").mapInArrow(emit, "dig long, s array<long>")
    return found.dropDuplicates(["dig"])


def _links(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs whose sets have 80 of 100 parts in common."""

    def verify(batches: Batches) -> Batches:
        for batch in batches:
            kept = []
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                x, y = (v.values.to_numpy().view(np.uint64) for v in (x, y))
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                common = int((y[at] == x).sum())
                if 100 * common >= 80 * (len(x) + len(y) - common):
                    kept.append(i)
            yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    joined = (
        pairs.select("a", "b")
        .join(sets.select(F.col("dig").alias("a"), F.col("s").alias("sa")), "a")
        .join(sets.select(F.col("dig").alias("b"), F.col("s").alias("sb")), "b")
    )
    return cut(joined.select("a", "b", "sa", "sb").mapInArrow(verify, "a long, b long"))


def _components_of(docs: DataFrame, row: str | None = None) -> DataFrame:
    """id (LAST_ID for null), n, c of every row: its component, or its id if it has
    no shingles. The column `row` (long) is passed on."""
    extra = [row] if row else []
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"),
        F.coalesce("text", F.lit("")).alias("text"),
        *extra,
    )
    hashed = F.xxhash64("text").alias("h")
    rows = keyed.select("id", "text", hashed)
    fields = ["id", "n", "dig", "end", "h", *extra]
    own = keyed.select("id", "text", hashed, *extra)
    whole = cut(own.mapInArrow(_documents, ", ".join(f"`{x}` long" for x in fields)))
    owners = whole.filter("n > 0").groupBy("dig").agg(
        F.min(F.struct("id", "h")).alias("first"), F.min("end").alias("end")
    )
    owners = cut(owners.select("dig", "first.id", "first.h", "end"))
    heads = rows.select("text").mapInArrow(_heads, "token long, dig long, n long")
    dealt = heads.repartition("token").sortWithinPartitions("token", "dig")
    found = cut(dealt.mapInArrow(_postings, TOKENS))

    hot = found.filter("a = b").select("token", F.col("a").alias("dig"), F.col("na").alias("n"))
    n = F.col("n")
    frequent = cut(
        hot.groupBy("dig", "n")
        .agg(F.count("*").alias("hot"))
        .join(owners.select("dig", "end"), "dig")
        .withColumn("least", _least(n))
        .withColumn("share", F.col("hot") / _head_size(n))
    )
    heavy = frequent.filter("hot >= least")
    counts = frequent.select("dig", "hot")
    na, nb = F.col("na"), F.col("nb")
    least = F.least(_bound(na, nb), _bound(nb, na))
    sharing = (
        found.filter("a <> b")
        .groupBy("a", "b", "na", "nb")
        .agg(F.count("*").alias("shared"))
        .join(counts.select(F.col("dig").alias("a"), F.col("hot").alias("ha")), "a", "left")
        .join(counts.select(F.col("dig").alias("b"), F.col("hot").alias("hb")), "b", "left")
        .na.fill(0, ["ha", "hb"])
        .filter(F.col("shared") + F.least("ha", "hb") >= least)
        .select("a", "b", "na", "nb")
    )
    leaders = cut(_leaders(hot, heavy))
    pairs = cut(sharing.union(leaders).distinct())
    linkable = _linkable(frequent)
    wanted = pairs.select(F.col("a").alias("dig")).union(pairs.select("b"))
    wanted = wanted.union(linkable.select("dig")).distinct()
    sets = cut(_sets_of(rows, owners, wanted))
    links = _links(sets, pairs)
    groups = components(links)
    members = cut(_members(linkable, leaders, groups))
    more = cut(group_links(members, sets))
    if not more.isEmpty():  # links of components
        joined = components(more).toDF("component", "least")
        alone = joined.join(groups, joined.component == groups.node, "left_anti")
        groups = groups.join(joined, "component", "left").select(
            "node", F.coalesce("least", "component").alias("component")
        )
        groups = groups.union(alone)
    named = whole.join(groups, whole.dig == groups.node, "left").select(
        "id",
        "n",
        F.when(F.col("n") == 0, F.struct(F.lit(False).alias("set"), F.col("id").alias("k")))
        .otherwise(F.struct(F.lit(True).alias("set"), F.coalesce("component", "dig").alias("k")))
        .alias("c"),
        *extra,
    )
    return cut(named)


def first_rows(docs: DataFrame, row: str) -> DataFrame:
    """The values of `row`, a number that each row has for itself, of the rows to
    keep: of each component the one with the smallest id (null comes last), then
    `row`; rows without shingles are alone and stay."""
    named = _components_of(docs, row)
    least = named.filter("n > 0").groupBy("c").agg(F.min(F.struct("id", row)).alias("least"))
    return least.select(f"least.{row}").union(named.filter("n = 0").select(row))


def similar_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    named = _components_of(docs)
    least_id = named.groupBy("c").agg(F.min("id").alias("least"))
    null = F.lit(None).cast("long")
    return named.join(least_id, "c").select(
        F.when(F.col("id") == LAST_ID, null).otherwise(F.col("id")).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("least") == LAST_ID, null).otherwise(F.col("least")).alias("component_id"),
    )


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(documents(spark, sf_dir))


ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS pos
  FROM words WHERE len(w) > 0),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[pos:pos + 4], ' ') AS s FROM starts),
sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * n_both >= 80 * (x.n + y.n - n_both)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM documents JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
  USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""
