"""A Merkle manifest of a dataset, kept by content: digest to children.

Every document is a leaf. The leaves of a source stand in the order of their ids;
runs of 16 nodes become a node, level by level, until one is left, the subroot of
the source; the subroots, in the order of their sources, become the root in the same
way. What is stored is a record for each inner node under its own digest: the digests
of its children, side by side.

Proofs are found by descent. A request names a leaf by its source's rank and its own
rank within the source. It starts at the root, looks up the record of the digest it
stands at, goes on with the child that the next digit (base 16) of the rank names and
collects the other children. Requests with the same digits so far descend as one row,
so the root is looked up once and not once for each leaf, and only the last step is
taken leaf by leaf. The segments of a path, collected from the top, are reversed for
folding a leaf up to the root.

Ranks come from a sort by ranges and the sizes of the ranges, so that a source of any
size is spread over many tasks.

Defined results: null values have a mark of their own, and a null source is a source,
the first; null ids come before others; rows of one id stand in the order of their
digests, and rows equal in all values have equal leaves, so their order does not show;
empty texts are values like others; columns that the leaf has not are ignored, and so
are names, as rows are carried under names of this module; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, documents, with_ranks

FANOUT_BITS = 4
DIGEST_BYTES = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SOURCE = ["known", "name"]  # known: false for a null source
TAMPER_FOLDS = 5
SEGMENT = "struct<before: binary, after: binary>"


def digest(*parts: Column) -> Column:
    """SHA-256 of the parts side by side."""
    return F.unhex(F.sha2(F.concat(*[p.cast("binary") for p in parts]), 256))


def text_of(digests: Column) -> Column:
    """Digests as hash input: lower-case hexadecimal text."""
    return F.lower(F.hex(digests))


def marked(value: Column) -> Column:
    """The length and the value, or a mark for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(docs: DataFrame, **instead: Column) -> Column:
    """The leaf of each row; `instead` gives other values for some fields."""
    return digest(*[marked(instead.get(f, docs[f])) for f in FIELDS])


class Manifest(NamedTuple):
    """`leaves`: known, name, rank, size (of the source), digest, and the columns of
    the rows. `sources`: known, name, size, rank. `records`: digest, children. `root`:
    digest, one row or none."""

    leaves: DataFrame
    sources: DataFrame
    records: DataFrame
    root: DataFrame


def levels_above(size: int) -> int:
    """How often runs of 16 are joined until one of `size` nodes is left."""
    return max(0, -(-(max(1, size) - 1).bit_length() // FANOUT_BITS))


def _levels(size: Column) -> Column:
    bits = F.when(size > 1, F.length(F.bin(size - 1))).otherwise(0)
    return F.ceil(bits / FANOUT_BITS).cast("int")


def _grow(nodes: DataFrame, by: list[str]) -> tuple[DataFrame | None, DataFrame]:
    """The records above `nodes` (by, rank, size of the group, digest), None if there
    are none, and by, digest of the node that is left of each group."""
    largest = nodes.agg(F.max("size")).first()[0] or 0
    records, tops = None, []
    for _ in range(levels_above(largest)):
        tops.append(nodes.filter("size = 1"))
        of_run = F.array_sort(F.collect_list(F.struct("rank", "digest")))
        side_by_side = F.array_join(F.transform(of_run, lambda c: F.hex(c.digest)), "")
        nodes = cut(
            nodes.filter("size > 1")
            .groupBy(*by, F.shiftright("rank", FANOUT_BITS).alias("rank"), "size")
            .agg(F.unhex(side_by_side).alias("children"))
            .withColumn("digest", digest(text_of(F.col("children"))))
            .withColumn("size", F.expr(f"(size + {(1 << FANOUT_BITS) - 1}) DIV {1 << FANOUT_BITS}"))
        )
        new = nodes.select("digest", "children")
        records = records.union(new) if records else new
        nodes = nodes.drop("children")
    tops.append(nodes)
    return records, reduce(DataFrame.unionByName, tops).select(*by, "digest")


def build_manifest(rows: DataFrame) -> Manifest:
    """The manifest of `rows`: source, doc_id, digest (of the leaf, binary) and further
    columns, which stay with the leaves. None may be called known, name, rank or size,
    or begin with an underscore."""
    named = cut(
        rows.withColumn("known", F.col("source").isNotNull())
        .withColumn("name", F.coalesce(F.col("source").cast("string"), F.lit("")))
        .drop("source")
    )
    leaves = cut(with_ranks(named, SOURCE, ["doc_id", "digest"]))
    records, subroots = _grow(leaves.select(*SOURCE, "rank", "size", "digest"), SOURCE)
    sizes = leaves.groupBy(*SOURCE).agg(F.count("*").alias("leaves"))
    subroots = subroots.join(sizes, SOURCE).withColumn("all", F.lit(0))
    subroots = cut(with_ranks(cut(subroots), ["all"], SOURCE))
    above, root = _grow(subroots.select("all", "rank", "size", "digest"), ["all"])
    sources = subroots.select(*SOURCE, F.col("leaves").alias("size"), "rank")
    found = [r for r in (records, above) if r is not None]
    if not found:
        found = [root.select("digest", F.lit(None).cast("binary").alias("children")).limit(0)]
    stored = found[0].unionByName(found[-1]) if len(found) > 1 else found[0]
    stored = cut(stored.groupBy("digest").agg(F.min("children").alias("children")))
    return Manifest(leaves, sources, stored, root.select("digest"))


def _segment(children: Column, digit: Column) -> Column:
    """The children before and behind the one that the digit names."""
    at = digit.cast("int") * DIGEST_BYTES
    before = F.substring(children, F.lit(1), at)
    after = F.substring(children, at + DIGEST_BYTES + 1, F.octet_length(children))
    return F.struct(before.alias("before"), after.alias("after"))


def _child(children: Column, digit: Column) -> Column:
    return F.substring(children, digit.cast("int") * DIGEST_BYTES + 1, F.lit(DIGEST_BYTES))


def _step(at: DataFrame, records: DataFrame) -> DataFrame:
    """Rows with prefix, left, digest, path one digit further down."""
    digits = F.sequence(F.lit(0), (F.octet_length("children") / DIGEST_BYTES - 1).cast("int"))
    opened = at.join(records, "digest").withColumn("digit", F.explode(digits))
    digit, children = F.col("digit"), F.col("children")
    new = {
        "prefix": F.shiftleft("prefix", FANOUT_BITS) + digit,
        "left": F.col("left") - 1,
        "digest": _child(children, digit),
        "path": F.concat("path", F.array(_segment(children, digit))),
    }
    return opened.select([new.get(c, F.col(c)).alias(c) for c in at.columns])


def with_paths(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """`requests`, some of the manifest's leaves (none given: all), with root, subroot
    and path: the digests before and behind the node at each level, from the leaf's run
    up to the root."""
    records = manifest.records
    n_sources, largest = manifest.sources.agg(F.count("*"), F.max("size")).first()
    zero = F.lit(0).cast("long").alias("prefix")
    runs = None
    if requests is not None:
        run = F.shiftright("rank", FANOUT_BITS).alias("run")
        runs = cut(requests.select(*SOURCE, "size", run).distinct())
    requests = manifest.leaves if requests is None else requests

    def asked(rows: DataFrame, prefixes: DataFrame | None, on: list[str]) -> DataFrame:
        """Those of the rows whose prefix a request has."""
        if prefixes is not None:
            rows = rows.join(prefixes.select(on).distinct(), on, "left_semi")
        return cut(rows)

    at = manifest.root.select(
        zero,
        F.lit(levels_above(n_sources)).alias("left"),
        "digest",
        F.col("digest").alias("root"),
        F.array().cast(f"array<{SEGMENT}>").alias("path"),
    )
    places = manifest.sources
    if runs is not None:
        places = places.join(runs.select(*SOURCE).distinct(), SOURCE, "left_semi")
    for left in reversed(range(levels_above(n_sources))):
        prefix = F.shiftright("rank", FANOUT_BITS * left).alias("prefix")
        at = asked(_step(at, records), None if runs is None else places.select(prefix), ["prefix"])
    subroots = at.withColumnRenamed("prefix", "rank").withColumn("subroot", F.col("digest"))
    at = subroots.join(places, "rank").select(
        *SOURCE, zero, _levels(F.col("size")).alias("left"), "digest", "root", "subroot", "path"
    )
    ended = [at.filter("left <= 1")]
    for _ in range(levels_above(largest or 0) - 1):
        prefixes = None
        if runs is not None:
            lefts = runs.withColumn("left", F.explode(F.sequence(F.lit(1), _levels(F.col("size")))))
            shift = F.expr(f"shiftright(run, {FANOUT_BITS} * (left - 1))")
            prefixes = lefts.withColumn("prefix", shift)
        at = _step(at.filter("left > 1"), records)
        at = asked(at, prefixes, [*SOURCE, "left", "prefix"])
        ended.append(at.filter("left = 1"))
    # A lone leaf is its own subroot: no record, no segment.
    opened = reduce(DataFrame.unionByName, ended).join(records, "digest", "left").select(
        *SOURCE,
        F.col("prefix").alias("run"),
        F.when(F.col("left") > 0, F.col("children")).alias("children"),
        "path",
        "subroot",
        "root",
    )
    digit = F.col("rank").bitwiseAND((1 << FANOUT_BITS) - 1)
    last = F.when(F.col("children").isNull(), F.array().cast(f"array<{SEGMENT}>")).otherwise(
        F.array(_segment(F.col("children"), digit))
    )
    return (
        requests.withColumn("run", F.shiftright("rank", FANOUT_BITS))
        .join(opened, [*SOURCE, "run"])
        .withColumn("path", F.reverse(F.concat("path", last)))
        .drop("run", "children")
    )


def siblings(path: Column) -> Column:
    """The digests of a path as hash input, from the leaf's run up, left to right."""
    return F.array_join(F.transform(path, lambda s: text_of(F.concat(s.before, s.after))), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings of its path."""
    up = lambda node, s: digest(text_of(s.before), text_of(node), text_of(s.after))
    return F.aggregate(path, leaf, up)


def lower_ascii(text: Column) -> Column:
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(text, upper, upper.lower())


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    tampered = F.crc32(docs["doc_id"].cast("string")) % TAMPER_FOLDS == 0
    changed = F.when(tampered, leaf_digest(docs, text=lower_ascii(docs["text"])))
    rows = docs.select(
        "doc_id",
        docs["source"],
        leaf_digest(docs).alias("digest"),
        changed.alias("changed"),
    )
    manifest = build_manifest(rows)
    proven = with_paths(manifest)
    path = F.col("path")
    root = F.col("folded")
    return (
        proven.withColumn("folded", folded(F.coalesce("changed", "digest"), path))
        .select(
            "doc_id",
            text_of(F.col("digest")).alias("leaf"),
            text_of(F.col("subroot")).alias("subroot"),
            text_of(F.col("root")).alias("root"),
            F.sha2(siblings(path).cast("binary"), 256).alias("proof_sha256"),
            text_of(root).alias("folded_root"),
            (root == F.col("root")).alias("verified"),
        )
    )


def _field(name: str) -> str:
    return f"coalesce(strlen({name}::VARCHAR)::VARCHAR || ':' || {name}::VARCHAR, '-')"


_LEAF = " || ".join(map(_field, FIELDS))
_TAMPERED = _LEAF.replace("text::", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')::")
ORACLE = f"""
WITH RECURSIVE
crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, _:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
leaves AS (
  SELECT doc_id, source, sha256({_LEAF}) AS leaf, sha256({_TAMPERED}) AS lower_leaf,
         list_transform(range(1, length(doc_id::VARCHAR) + 1),
           lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT) AS bytes
  FROM documents),
marked AS (
  SELECT doc_id, source, leaf, lower_leaf, xor(list_reduce(bytes, lambda c, b:
           xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295) % 5 = 0 AS tampered,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
         count(*) OVER (PARTITION BY source) AS n
  FROM leaves, crc_table),
low AS (
  SELECT 0 AS level, source, rank AS place, leaf AS h, n FROM marked
  UNION ALL
  SELECT level + 1, source, place // 16, sha256(string_agg(h, '' ORDER BY place)), (n + 15) // 16
  FROM low WHERE n > 1 GROUP BY level, source, place // 16, n),
subroots AS (
  SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place,
         count(*) OVER () AS n FROM low WHERE n = 1),
high AS (
  SELECT 0 AS level, place, h, n FROM subroots
  UNION ALL
  SELECT level + 1, place // 16, sha256(string_agg(h, '' ORDER BY place)), (n + 15) // 16
  FROM high WHERE n > 1 GROUP BY level, place // 16, n),
segments AS (
  SELECT m.doc_id, m.source, m.rank, l.level AS level,
         coalesce(string_agg(l.h, '' ORDER BY l.place) FILTER (l.place < m.rank >> 4 * l.level), '') AS before,
         coalesce(string_agg(l.h, '' ORDER BY l.place) FILTER (l.place > m.rank >> 4 * l.level), '') AS after
  FROM marked m JOIN low l ON l.n > 1 AND l.source IS NOT DISTINCT FROM m.source
       AND l.place >> 4 = m.rank >> 4 * (l.level + 1)
  GROUP BY m.doc_id, m.source, m.rank, l.level
  UNION ALL
  SELECT m.doc_id, m.source, m.rank, 100 + l.level,
         coalesce(string_agg(l.h, '' ORDER BY l.place) FILTER (l.place < s.place >> 4 * l.level), ''),
         coalesce(string_agg(l.h, '' ORDER BY l.place) FILTER (l.place > s.place >> 4 * l.level), '')
  FROM marked m JOIN subroots s ON s.source IS NOT DISTINCT FROM m.source
       JOIN high l ON l.n > 1 AND l.place >> 4 = s.place >> 4 * (l.level + 1)
  GROUP BY m.doc_id, m.source, m.rank, l.level),
paths AS (
  SELECT m.doc_id, m.source, m.rank, m.leaf,
         CASE WHEN m.tampered THEN m.lower_leaf ELSE m.leaf END AS start,
         coalesce(list(struct_pack(before := before, after := after) ORDER BY level)
           FILTER (level IS NOT NULL), []) AS path
  FROM marked m LEFT JOIN segments s ON s.source IS NOT DISTINCT FROM m.source AND s.rank = m.rank
  GROUP BY ALL),
folds AS (
  SELECT source, rank, 0 AS done, start AS h, path FROM paths
  UNION ALL
  SELECT source, rank, done + 1, sha256(path[done + 1].before || h || path[done + 1].after), path
  FROM folds WHERE done < len(path))
SELECT p.doc_id, p.leaf, s.h AS subroot, r.h AS root,
       sha256(array_to_string(list_transform(p.path, lambda x: x.before || x.after), '')) AS proof_sha256,
       f.h AS folded_root, f.h = r.h AS verified
FROM paths p
JOIN folds f ON f.source IS NOT DISTINCT FROM p.source AND f.rank = p.rank AND f.done = len(p.path)
JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source
JOIN (SELECT h FROM high WHERE n = 1) r ON true
"""
