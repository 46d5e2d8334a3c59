"""The token-group matrix of the n-gram Jaccard join.

Documents (sets of 64-bit tokens) that are known to be similar, or that chose the
same leader, are put side by side and cut into blocks of bounded size. A group is
a block, or all blocks that hold only one and the same component. Each block
stores the union of its members' tokens.

Two sets of 80 of 100 parts in common share one of the rarest tokens of each: of
any fixed order of tokens, of the first n - ceil(0.8 n) + 1 of both. So the matrix
holds, for each token that is among those of some member, the groups. A block is
held against the groups that share a token with it, block by block: the overlap of
each member with the union of the other block bounds what it can share, members
below the bound go, and the rest are compared. Members of which less than 80 of
100 tokens are in any other block stay out of this. Members of one component are
never compared, and of the links between components of two blocks only as many
are given as join the same components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut
from .repeats import Batches

BLOCK_MEMBERS = 1024
BLOCK_TOKENS = 200_000  # a block has at most one set beyond that
CHUNK = 4096  # tokens compared at once
COMPONENT = np.int64(0x5DEECE66D)  # tells a component from the block of its first member

MEMBERS = "labels array<long>, sizes array<int>, ends array<int>, tokens array<long>"
BLOCKS = f"block long, unit long, mixed boolean, {MEMBERS}"


def _one(schema: str, *values) -> pa.RecordBatch:
    """A batch of one row; arrays are its lists."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    names, columns = [], []
    for field, value in zip(schema.split(", "), values, strict=True):
        name, kind = field.split()
        if kind.startswith("array"):
            flat = pa.array(value, kinds[kind[6:-1]])
            columns.append(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat))
        else:
            columns.append(pa.array([value], kinds[kind]))
        names.append(name)
    return pa.RecordBatch.from_arrays(columns, names)


def _block(rows: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
    """One block of rows (label, dig, tokens). Its unit is the group it is of."""
    labels = np.array([r[0] for r in rows], np.int64)
    sizes = np.array([len(r[2]) for r in rows], np.int32)
    mixed = bool((labels != labels[0]).any())
    # A lone document is a component too, so its block can only meet others.
    unit = rows[0][1] if mixed else int(labels[0] ^ COMPONENT)
    tokens = np.concatenate([r[2] for r in rows])
    ends = np.cumsum(sizes, dtype=np.int32)
    return _one(BLOCKS, rows[0][1], unit, mixed, labels, sizes, ends, tokens)


def _into_blocks(batches: Batches) -> Batches:
    """Reads (number of the block, label, dig, tokens) in order."""
    held: list[tuple[int, int, np.ndarray]] = []
    now = None
    for batch in batches:
        number, label, dig = (batch.column(i).to_pylist() for i in range(3))
        for i, s in enumerate(batch.column(3)):
            if held and number[i] != now:
                yield _block(held)
                held = []
            now = number[i]
            held.append((label[i], dig[i], s.values.to_numpy()))
    if held:
        yield _block(held)


def block_numbers(members: DataFrame, order: list[str]) -> DataFrame:
    """dig, label, and the number of each member's block: the members in `order`, cut
    whenever another BLOCK_TOKENS are full. A member weighs as many tokens as it has,
    but so much at least that a block has at most BLOCK_MEMBERS. How the members are
    dealt over partitions does not show."""
    dealt = members.select("dig", "label", "n", *order).repartitionByRange(*order)
    placed = cut(
        dealt.sortWithinPartitions(*order).select(
            "dig",
            "label",
            F.greatest("n", F.lit(BLOCK_TOKENS // BLOCK_MEMBERS + 1)).alias("weight"),
            F.monotonically_increasing_id().alias("at"),
        )
    ).withColumn("part", F.shiftright("at", 33))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("part").agg(F.sum("weight").alias("w"))  # a row for each partition
    before = F.coalesce(F.sum("w").over(earlier), F.lit(0)).alias("before")
    within = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    total = F.col("before") + F.coalesce(F.sum("weight").over(within), F.lit(0))
    numbered = placed.join(parts.select("part", before), "part")
    return numbered.select("dig", "label", F.floor(total / BLOCK_TOKENS).alias("number"))


def _unions(batches: Batches) -> Batches:
    for batch in batches:
        block = batch.column(0).to_numpy()
        for i, t in enumerate(batch.column(1)):
            token = np.unique(t.values.to_numpy())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(token), block[i])), pa.array(token)], ["block", "token"]
            )


TRIMMED = f"block long, unit long, lo long, hi long, {MEMBERS}, prefix array<long>"


def _trim(batches: Batches) -> Batches:
    """Reads block, unit, MEMBERS, and the tokens that other blocks have with their
    frequencies. Gives the members that can link with other blocks, their tokens
    that others have, and the prefix tokens. Tokens of no other block come first
    in the order."""
    for batch in batches:
        for i in range(batch.num_rows):
            block, unit = (batch.column(c)[i].as_py() for c in range(2))
            labels, sizes, _, token, known, often = (
                batch.column(c)[i].values.to_numpy() for c in range(2, 8)
            )
            order = np.argsort(known)
            known, often = known[order], often[order]
            at = np.searchsorted(known, token)
            at[at == len(known)] = 0
            frequency = np.where(known[at] == token, often[at], 0)
            sizes = sizes.astype(np.int64)
            member = np.repeat(np.arange(len(sizes)), sizes)
            by = np.lexsort((token, frequency, member))
            start = np.cumsum(sizes) - sizes
            place = np.arange(len(token)) - np.repeat(start, sizes)
            first = place < np.repeat(sizes - -(-4 * sizes // 5) + 1, sizes)
            left = np.bincount(member[frequency > 0], minlength=len(sizes))
            keeps = 5 * left >= 4 * sizes
            inside = (frequency > 0) & keeps[member]
            chosen = by[first & inside[by]]
            if len(chosen):
                yield _one(
                    TRIMMED,
                    block,
                    unit,
                    sizes[keeps].min(),
                    sizes[keeps].max(),
                    labels[keeps],
                    sizes[keeps].astype(np.int32),
                    np.cumsum(left[keeps], dtype=np.int32),
                    token[inside],
                    np.unique(token[chosen]),
                )


class _Members:
    """Members of a block: labels, sizes, some tokens and the member that each is of."""

    def __init__(self, labels: np.ndarray, sizes: np.ndarray, ends: np.ndarray, tokens: np.ndarray):
        self.labels, self.sizes, self.tokens = labels, sizes.astype(np.int64), tokens
        self.member = np.repeat(np.arange(len(ends)), np.diff(np.append(0, ends)))

    def within(self, union: np.ndarray) -> None:
        """Keep the tokens of the union, and of those only the tokens of members
        of which enough are left to reach 80 of 100 with anyone."""
        at = np.searchsorted(union, self.tokens)
        at[at == len(union)] = 0
        inside = union[at] == self.tokens if len(union) else np.zeros(len(at), bool)
        left = np.bincount(self.member[inside], minlength=len(self.sizes))
        inside &= (5 * left >= 4 * self.sizes)[self.member]
        self.tokens, self.member = self.tokens[inside], self.member[inside]


def _shared(a: _Members, b: _Members) -> np.ndarray:
    """How many tokens each member of a shares with each of b."""
    a.within(np.unique(b.tokens))
    b.within(np.unique(a.tokens))
    rows, columns = np.unique(a.member), np.unique(b.member)
    common = np.zeros((len(a.sizes), len(b.sizes)), np.int64)
    both = np.intersect1d(a.tokens, b.tokens)
    if not len(both):
        return common
    total = np.zeros((len(rows), len(columns)), np.float64)
    number = [np.searchsorted(both, x.tokens) for x in (a, b)]
    held = [np.append(both, 0)[n] == x.tokens for n, x in zip(number, (a, b), strict=True)]
    for start in range(0, len(both), CHUNK):
        sides = []
        for x, n, of, kept in ((a, number[0], rows, held[0]), (b, number[1], columns, held[1])):
            here = kept & (n >= start) & (n < start + CHUNK)
            side = np.zeros((len(of), min(CHUNK, len(both) - start)), np.float32)
            side[np.searchsorted(of, x.member[here]), n[here] - start] = 1
            sides.append(side)
        total += sides[0] @ sides[1].T
    common[np.ix_(rows, columns)] = total
    return common


def _spanning(pairs: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs of labels that join the same labels as all `pairs` do."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for x, y in np.unique(pairs, axis=0).tolist():
        if (p := root(x)) != (q := root(y)):
            parent[p] = q
            yield x, y


def _links(a: _Members, b: _Members) -> Batches:
    common = _shared(a, b)
    union = a.sizes[:, None] + b.sizes[None, :] - common
    linked = (100 * common >= 80 * union) & (a.labels[:, None] != b.labels[None, :])
    x, y = np.nonzero(linked)
    links = list(_spanning(np.column_stack((a.labels[x], b.labels[y])))) if len(x) else []
    if links:
        columns = [pa.array(c, pa.int64()) for c in zip(*links, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, ["a", "b"])


def _compare(batches: Batches) -> Batches:
    """Reads MEMBERS of two blocks; gives links of their labels."""
    for batch in batches:
        for i in range(batch.num_rows):
            sides = [batch.column(c)[i].values.to_numpy() for c in range(8)]
            yield from _links(_Members(*sides[:4]), _Members(*sides[4:]))


def _compare_own(batches: Batches) -> Batches:
    """The same for MEMBERS of one block."""
    for batch in batches:
        for i in range(batch.num_rows):
            side = [batch.column(c)[i].values.to_numpy() for c in range(4)]
            yield from _links(_Members(*side), _Members(*side))


def _sizes_fit() -> Column:
    return (5 * F.col("hi") >= 4 * F.col("lo_b")) & (5 * F.col("hi_b") >= 4 * F.col("lo"))


def group_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) of labels, enough to join all components that links of
    `members` join. Columns: key (equal for documents expected to be similar),
    solo (has no link yet), label (its component, or its own dig), dig, n. `sets` has
    the tokens of each: dig, s."""
    link = "a long, b long"
    lists = [x.split()[0] for x in MEMBERS.split(", ")]
    order = ["key", "solo", "grouped", "size", "place"]
    grouped = members.withColumns(
        {
            "grouped": F.when(~F.col("solo"), F.col("label")),
            "size": F.col("n"),
            "place": F.col("dig"),
        }
    )
    numbered = block_numbers(grouped, order).join(sets, "dig")
    dealt = numbered.repartition("number").sortWithinPartitions("number", "dig")
    blocks = cut(dealt.select("number", "label", "dig", "s").mapInArrow(_into_blocks, BLOCKS))
    union = cut(blocks.select("block", "tokens").mapInArrow(_unions, "block long, token long"))
    often = union.groupBy("token").agg(F.count("*").alias("often")).filter("often > 1")
    known = (
        union.join(often, "token")
        .groupBy("block")
        .agg(F.collect_list(F.struct("token", "often")).alias("known"))
        .select("block", F.col("known.token").alias("known"), F.col("known.often").alias("often"))
    )
    trimmed = cut(
        blocks.join(known, "block")
        .select("block", "unit", *lists, "known", "often")
        .mapInArrow(_trim, TRIMMED)
    )
    asking = trimmed.select("block", "unit", "lo", "hi", F.explode("prefix").alias("token"))
    matrix = asking.groupBy("token", F.col("unit").alias("other")).agg(
        F.min("lo").alias("lo_b"), F.max("hi").alias("hi_b")
    )
    groups = (
        asking.join(matrix, "token")
        .filter(F.col("unit") < F.col("other"))
        .filter(_sizes_fit())
        .select("block", "other")
        .distinct()
    )
    opened = asking.select(
        "token",
        F.col("unit").alias("other"),
        F.col("block").alias("block_b"),
        F.col("lo").alias("lo_b"),
        F.col("hi").alias("hi_b"),
    )
    pairs = cut(
        asking.join(groups, "block")
        .join(opened, ["token", "other"])
        .filter(_sizes_fit())
        .select("block", "block_b")
        .distinct()
    )
    side = trimmed.select("block", *lists)
    other = side.toDF("block_b", *[f"{c}_b" for c in lists])
    between = pairs.join(side, "block").join(other, "block_b")
    between = between.select(*lists, *[f"{c}_b" for c in lists]).mapInArrow(_compare, link)
    within = blocks.filter("mixed").select(*lists).mapInArrow(_compare_own, link)
    return between.union(within).distinct()
